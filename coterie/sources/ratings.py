"""The ratings text file: a header line, then ``user,item,...``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_ratings(spark: SparkSession, path: str, on_error: str = "fail") -> DataFrame:
    """``(user, item)`` from comma-separated lines without quoting; further fields are ignored.

    Every line equal to the first one is taken for a header. A line without two integers raises
    by default and is left out with ``on_error="drop"``.
    """
    if on_error not in ("fail", "drop"):
        raise ValueError("on_error must be 'fail' or 'drop'")
    lines = spark.read.text(path)
    # The first line of the first file by name that has any, found in one scan whichever files it starts with.
    placed = lines.select(
        "value", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).alias("place")
    )
    header = placed.agg(F.min_by("value", "place")).first()[0]
    if header is not None:
        lines = lines.where(F.col("value") != header)
    fields = F.split("value", ",", -1)
    user, item = (F.get(fields, F.lit(i)).try_cast("long") for i in (0, 1))
    if on_error == "drop":
        parsed = lines.select(user.alias("user"), item.alias("item"))
        return parsed.where("user IS NOT NULL AND item IS NOT NULL")
    bad = F.raise_error(F.concat(F.lit("not a rating: "), F.col("value"))).cast("long")
    return lines.select(F.coalesce(user, bad).alias("user"), F.coalesce(item, bad).alias("item"))
