import duckdb
import pytest

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.01"
QUICK = [
    "ratings_text", "affiliations", "affiliation_sets", "coaffil_edges", "adjacency", "graph_size",
    "structural_similarity_open", "structural_components_half", "affiliation_sets_rows", "adjacency_rows", "vertices",
    "similarity_repeated", "structural_components_mu", "similar_edges", "ratings_dropped", "betweenness_of_sources",
    "cut_curve_late",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("events", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    # Queries on documents are there only with their subpackage, and not all of them have a form in SQL.
    optional = {*driver._llm.queries(), "pipeline"} if driver._llm else set()
    assert set(driver.queries()) - optional == set(driver.oracle_sql()) - optional


def test_flagship(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 16 and sum(r.score for r in rows) == pytest.approx(186)
    top = max(rows, key=lambda r: r.score)
    assert (top.src, top.dst, top.score) == (4, 14, pytest.approx(27.5))


@pytest.mark.parametrize("name", QUICK)
def test_against_sql(spark, duck, name):
    found = driver.queries()[name](spark, FOLDER)
    expected = duck.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(columns)
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == sorted(expected.fetchall())
