"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .limits import limit, partitions
from .scratch import Saved, Scratch, size


def fits(table: Saved, scratch: Scratch, most: int | None = None) -> bool:
    """Whether a table is small enough to broadcast, by its rows and by the files it was saved in."""
    rows = limit(scratch.spark, "broadcastRows")
    if table.rows > (rows if most is None else min(rows, most)):
        return False
    return not table.path or size(scratch.spark, table.path) <= limit(scratch.spark, "broadcastBytes")


# Slots of a task's sketch for each hot key there may be, at least; the sketch takes three quarters of a power of two and at most 2^20.
_SLOTS_EACH = 16
_MOST_SLOTS = 1 << 20
_HASH = "__coterie_hot"
# Types whose equal values have equal hashes.
_HASHED = {"bigint", "int", "smallint", "tinyint", "string", "date", "boolean", "binary"}


def hot_hashes(keys: DataFrame, on: list[str], rows: int, scratch: Scratch) -> Saved:
    """One column with ``xxhash64(*on)`` of every key that holds more than 1/``hotKeys`` of the ``rows``, and few others.

    Each task sums its own rows in a sketch of frequent items and reports those that it is sure of; the reports are added up by
    hash. A sketch of s slots misses at most 7/s of its rows of a key and adds at most 3.5/s, so no key beyond the share is missed if the reports
    need only come to that much less, and all keys found hold a third of it or more. Nothing grows with the number of keys: a
    task sends one sketch, and no task or driver gets them all.
    """
    most = min(limit(scratch.spark, "hotKeys"), _MOST_SLOTS // _SLOTS_EACH)
    slots = 1 << (most * _SLOTS_EACH - 1).bit_length()
    tracked = slots * 3 // 4
    of_task = (
        keys.select(F.spark_partition_id().alias("task"), F.xxhash64(*on).alias("hash"))
        .groupBy("task").agg(F.expr(f"approx_top_k(hash, {tracked}, {tracked})").alias("found"))
        .select(F.inline("found"))
    )
    enough = rows / most - 7 * rows / slots
    return scratch.save(
        of_task.groupBy(F.col("item").alias(_HASH)).agg(F.sum("count").alias("held")).where(F.col("held") > enough).select(_HASH)
    )


def _hot_by_hash(rows: DataFrame, table: DataFrame, on: list[str]) -> bool:
    """Whether a key's hash is the same on both sides."""
    left, right = dict(rows.dtypes), dict(table.dtypes)
    return all(left[c] == right[c] and left[c] in _HASHED for c in on)


def lookup_join(
    big: DataFrame | Saved, table: Saved, on: list[str], scratch: Scratch, how: str = "inner", most: int | None = None,
    keys_of: Saved | None = None,
) -> DataFrame:
    """Join ``big`` to a table with few rows per key (usually one).

    A table counted to be small is broadcast. Beyond that size the hot keys of ``big`` are
    found by sketches of its key columns; there are at most three times ``hotKeys``
    of them, so their table rows are broadcast and only the even rest is shuffled. As ``big`` is
    then read twice and its keys once more, it is written first unless it is a saved step already. Keys of other types or of two different ones are
    counted. ``most`` lowers the number of rows that may be broadcast, for tables with wide rows. Where a saved ``keys_of`` holds the keys
    of ``big`` row by row, hot keys are looked for there and ``big`` is not written.
    """
    spark = scratch.spark
    if fits(table, scratch, most):
        rows = big.df if isinstance(big, Saved) else big
        return rows.join(F.broadcast(table.df), on, how)
    if keys_of is None:
        big = keys_of = big if isinstance(big, Saved) else scratch.save(big)
    rows = big.df if isinstance(big, Saved) else big
    if _hot_by_hash(keys_of.df, table.df, on) and _hot_by_hash(rows, table.df, on):
        hot = hot_hashes(keys_of.df, on, keys_of.rows, scratch)
        keep: Column | list[str] = F.xxhash64(*on) == F.col(_HASH)
    else:
        hot_share = keys_of.rows // limit(spark, "hotKeys")
        hot = scratch.save(
            keys_of.df.groupBy(*on).agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > hot_share).select(*on)
        )
        keep = on
    if hot.rows == 0:
        return rows.join(table.df, on, how)
    keys = F.broadcast(hot.df)
    hot_table = F.broadcast(table.df.join(keys, keep, "left_semi"))
    even = rows.join(keys, keep, "left_anti").join(table.df, on, how)
    return even.unionByName(rows.join(keys, keep, "left_semi").join(hot_table, on, how))


def group_sizes(rows: Saved, key: str, scratch: Scratch) -> Saved:
    """``(key, held)`` with the exact number of ``pairs`` that the groups make and of groups too ``wide`` for a block."""
    block, held = limit(scratch.spark, "blockRows"), F.col("held").cast("double")
    return scratch.save(
        rows.df.groupBy(key).agg(F.count(F.lit(1)).alias("held")),
        pairs=F.coalesce(F.sum(held * (held - 1) / 2), F.lit(0.0)), wide=F.coalesce(F.sum((held > block).cast("long")), F.lit(0)),
    )


def pairs_within(rows: Saved, key: str, value: str, scratch: Scratch, sizes: Saved | None = None) -> DataFrame:
    """``(key, x, y)`` for every two values ``x < y`` that share a key; ``(key, value)`` is unique.

    Groups up to ``blockRows`` are joined as they are. A larger group is cut into blocks by a
    hash of the value and each pair of blocks becomes a join key of its own, so no task ever
    has to hold more than two blocks, whatever the size of the group. ``sizes`` are those of ``group_sizes`` if known.
    """
    block = limit(scratch.spark, "blockRows")
    pairs, wide = rows.rows**2 // 2, None
    if sizes is None and rows.rows > block:
        sizes = group_sizes(rows, key, scratch)
    if sizes is not None:
        pairs = int(sizes.metrics["pairs"])
        blocks = F.ceil(F.col("held") / block).cast("int").alias("blocks")
        wide = Saved(sizes.df.where(F.col("held") > block).select(key, blocks), sizes.metrics["wide"])
    parts = partitions(scratch.spark, pairs)
    if wide is None or wide.rows == 0:
        grouped = rows.df.select(key, value).repartition(parts, key)
        left = grouped.withColumnRenamed(value, "x")
        return left.join(grouped.withColumnRenamed(value, "y"), key).where("x < y")

    cut = (
        lookup_join(rows, wide, [key], scratch, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64(value), F.col("blocks")).cast("int"))
    )
    last = F.col("blocks") - 1
    left = cut.select(
        key, F.col(value).alias("x"), F.col("block").alias("i"),
        F.explode(F.sequence(F.col("block"), last)).alias("j"),
    )
    right = cut.select(
        key, F.col(value).alias("y"), F.explode(F.sequence(F.lit(0), F.col("block"))).alias("i"),
        F.col("block").alias("j"),
    )
    return (
        left.repartition(parts, key, "i", "j")
        .join(right.repartition(parts, key, "i", "j"), [key, "i", "j"])
        .where("i < j OR x < y")
        .select(key, F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    )


# Rows of a block of a cell, in units of ``blockRows``; each row is shuffled once for each block, and a block is compared by one task.
_CELL_BLOCKS = 6


def pairs_in_cells(rows: Saved, key: str, scratch: Scratch, wanted: Column) -> DataFrame:
    """Every two rows ``x`` and ``y`` with different values of the unique ``key`` for which ``wanted`` holds, once in either order.

    Rows are cut into blocks by a hash of the key, and each pair of blocks is a cell that one task compares whole. Only the rows are
    shuffled, once for each block, and ``wanted`` is part of the join, so that pairs without it are never written.
    """
    blocks = max(1, -(-rows.rows // (_CELL_BLOCKS * limit(scratch.spark, "blockRows"))))
    cells = blocks * (blocks + 1) // 2
    cut = rows.df.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("long"))
    # Cell (i, j) with i <= j; a row is on the left in its own row of cells and on the right in its column.
    left = cut.select("*", F.explode(F.sequence("block", F.lit(blocks - 1).cast("long"))).alias("other"))
    right = cut.select("*", F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("other"))
    left = left.withColumn("cell", F.col("block") * blocks + F.col("other")).repartition(cells, "cell").alias("x")
    right = right.withColumn("cell", F.col("other") * blocks + F.col("block")).repartition(cells, "cell").alias("y")
    once = F.expr(f"x.block <> y.block OR x.{key} < y.{key}")
    return left.join(right.hint("shuffle_hash"), (F.col("x.cell") == F.col("y.cell")) & once & wanted)
