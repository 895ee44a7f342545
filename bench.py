"""Time the headline queries on the driver's tables and print one JSON line.

Every query starts from the Parquet tables; nothing is shared between queries. The session start and
one small query to load classes are not counted.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

import coterie as ct

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Shared hours per edge: at 14 the graph is sparse and deep, at 12 dense and shallow; at 10 it has 68,328 edges.
SPARSE, DENSE, LARGE, PARTS = 14, 12, 10, 4


def _hours(spark, k):
    return ct.coaffiliation_edges(ct.co_active_hours(spark, FOLDER), k)


def _parts(spark):
    return ct.coaffiliation_edges(ct.customer_parts(spark, FOLDER), PARTS)


def _communities(edges):
    return ct.community_lines(ct.best_communities(ct.removal_order(ct.edge_betweenness(edges))))


QUERIES = {
    "coaffiliation_hours": lambda spark: _hours(spark, DENSE),
    "coaffiliation_parts": _parts,
    "betweenness_sparse": lambda spark: ct.edge_betweenness(_hours(spark, SPARSE)),
    "betweenness_dense": lambda spark: ct.edge_betweenness(_hours(spark, DENSE)),
    "communities_sparse": lambda spark: _communities(_hours(spark, SPARSE)),
    "communities_dense": lambda spark: _communities(_hours(spark, DENSE)),
    "structural_dense": lambda spark: ct.community_lines(ct.structural_components(_hours(spark, DENSE))),
    "betweenness_large": lambda spark: ct.edge_betweenness(_hours(spark, LARGE)),
    "communities_large": lambda spark: _communities(_hours(spark, LARGE)),
    "structural_large": lambda spark: ct.community_lines(ct.structural_components(_hours(spark, LARGE))),
}


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("coterie-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "20g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    ct.affiliations(ct.co_active_hours(spark, FOLDER)).count()
    seconds = {}
    for name, query in QUERIES.items():
        start = time.perf_counter()
        query(spark).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total time of the headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
