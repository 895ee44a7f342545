"""Global ranks and running sums without a window over everything."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

# Bits that monotonically_increasing_id keeps for the row within its partition.
_ROW_BITS = 33


def with_rank(df: DataFrame, order: list[Column], name: str, scratch: Scratch) -> DataFrame:
    """Add the 1-based position of each row in a total order.

    Range-sorts, numbers the rows inside each sorted partition, and shifts them by the sizes of
    the partitions before. Only the per-partition sizes, one row each, meet in one task.
    """
    sorted_rows = scratch.save(
        df.orderBy(*order).withColumn("slot", F.monotonically_increasing_id())
    )
    part = F.shiftright("slot", _ROW_BITS)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sorted_rows.df.groupBy(part.alias("part"))
        .agg(F.count(F.lit(1)).alias("held"))
        .select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("skip"))
    )
    in_part = F.col("slot") - F.shiftleft(F.shiftright("slot", _ROW_BITS), _ROW_BITS)
    return (
        sorted_rows.df.withColumn("part", part)
        .join(F.broadcast(offsets), "part")
        .withColumn(name, F.col("skip") + in_part + 1)
        .drop("part", "skip", "slot")
    )


def running_sums(
    rows: DataFrame, keys: list[str], position: str, last: int, sums: dict[str, str]
) -> DataFrame:
    """Running totals per key, up to but without the row itself.

    ``sums`` maps a value column to the name of its total. Positions are unique per key and lie in
    ``0..last``; they are cut into about sqrt(last) stretches, so that both windows, over the
    stretches and inside one, are bounded by sqrt(last) rows however large a key is.
    """
    width = math.isqrt(max(last, 1)) + 1
    cut = rows.withColumn("stretch", F.floor(F.col(position) / width))
    earlier = Window.partitionBy(*keys).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = cut.groupBy(*keys, "stretch").agg(*[F.sum(v).alias(f"{v}_all") for v in sums]).select(
        *keys, "stretch",
        *[F.coalesce(F.sum(f"{v}_all").over(earlier), F.lit(0)).alias(f"{v}_before") for v in sums],
    )
    inside = (
        Window.partitionBy(*keys, "stretch").orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    )
    for value, total in sums.items():
        cut = cut.withColumn(total, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    out = cut.join(stretches, [*keys, "stretch"])
    for value, total in sums.items():
        out = out.withColumn(total, F.col(total) + F.col(f"{value}_before"))
    return out.drop("stretch", *[f"{v}_before" for v in sums])
