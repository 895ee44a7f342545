"""``(user, item)`` views of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def co_active_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Users and the hours, counted from 1970, in which they have an event."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    hour = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("long") * 24 + F.hour("ts")
    return events.select(F.col("user_id").alias("user"), hour.alias("item"))


def customer_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Customers and the parts they ordered."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey", "l_partkey")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")
    )
