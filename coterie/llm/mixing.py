"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.order import with_rank
from ..plans.scratch import Saved, Scratch
from .text import n_words, whole

# Slots of a source's hash range in which sizes are summed before the fractional repetition is cut.
SLOTS = 4096
# Equal rows that are numbered in one array.
_DEALT = 10_000


def _targets(sources: Saved, share: float, most: float, scratch: Scratch) -> Saved:
    """Add ``target`` to ``(source, source_size, weight)``.

    Every round deals out what the clamped sources leave, by weight, and clamps those that it lifts
    above their cap. A round is one aggregate over the sources; only its two sums reach the driver.
    """
    cap = F.col("source_size") * F.lit(most)
    now = scratch.save(
        sources.df.withColumn("full", F.lit(False)),
        total=F.coalesce(F.sum("source_size"), F.lit(0)), free=F.sum("weight"),
    )
    wanted = share * now.metrics["total"]
    left, free = wanted, now.metrics["free"]
    while free:
        level = F.lit(float(left)) * F.col("weight") / F.lit(float(free))
        step = scratch.save(
            now.df.withColumn("was", F.col("full")).withColumn("full", F.col("full") | (level > cap)),
            lifted=F.expr("count_if(full AND NOT was)"),
            used=F.coalesce(F.sum(F.when(F.col("full"), cap)), F.lit(0.0)),
            free=F.sum(F.when(~F.col("full"), F.col("weight"))),
        )
        if not step.metrics["lifted"]:
            return scratch.save(
                now.df.select("source", "source_size", F.when(F.col("full"), cap).otherwise(level).alias("target"))
            )
        now = Saved(step.df.drop("was"), step.rows)
        left, free = wanted - step.metrics["used"], step.metrics["free"]
    return scratch.save(now.df.select("source", "source_size", cap.cast("double").alias("target")))


def mix(
    docs: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, epochs: float = 2.0, seed: int = 0,
    with_raw: bool = False,
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row for each row of ``docs (doc_id, text, source)``.

    Sizes are words. Sources by code point, null last, weigh ``weights`` over and over and share
    ``share`` times all sizes; no source is to give more than ``epochs`` times its size, and what it
    cannot give goes to the others by weight. Each document is taken the whole number of
    times that its source repeats. The rest of the target is one more pass over a seeded sample: documents lie at
    a hash position (of the id, the whole text and a number among equal rows), slots of positions are summed, and the pass stops where the sums reach the
    rest; inside the slot where that happens, at the same share of its positions. Texts without words
    have size 0 and give nothing; rows that are there twice count twice. No document is repeated more
    than ``epochs`` times, rounded up.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        raw = [F.sha2(whole(), 256).alias("raw_sha256")] if with_raw else []
        rows = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), "source", n_words(whole()).alias("size"),
            F.xxhash64(whole()).alias("of_text"), *raw,
        )
        # Equal rows are folded ahead of the shuffle and dealt out again, each with a number and so with a place of its own.
        alike = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))
        several = alike.withColumn("low", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(_DEALT).cast("long"))))
        numbered = several.withColumn("number", F.explode(F.sequence(F.col("low"), F.least(F.col("n"), F.col("low") + _DEALT) - 1)))
        place = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "of_text", "number"), F.lit(1 << 40))
        kept = [c for c in rows.columns if c != "of_text"]
        sized = scratch.save(numbered.select(*kept, place.alias("place")), keep=True)
        sums = scratch.save(sized.df.groupBy("source").agg(F.sum("size").cast("long").alias("source_size")))
        ranked = with_rank(sums.df, [F.col("source").asc_nulls_last()], "rank", scratch)
        weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int") + 1)
        targets = _targets(scratch.save(ranked.withColumn("weight", weight).drop("rank")), share, epochs, scratch)

        # The slot of each source in which its fractional pass ends.
        width = (1 << 40) // SLOTS
        slot = F.floor(F.col("place") / F.lit(width))
        slots = sized.df.groupBy("source", slot.alias("slot")).agg(F.sum("size").alias("held"))
        before = Window.partitionBy("source").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
        whole_passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        rest = F.col("target") - whole_passes * F.col("source_size")
        ends = (
            slots.withColumn("skip", F.coalesce(F.sum("held").over(before), F.lit(0)))
            .join(targets.df.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
            .where((F.col("skip") <= rest) & (rest < F.col("skip") + F.col("held")))
            .select(F.col("of").alias("ends_of"), (F.col("slot") * width + (rest - F.col("skip")) / F.col("held") * width).alias("until"))
        )
        plan = targets.df.join(ends, F.col("source").eqNullSafe(F.col("ends_of")), "left").select(
            F.col("source").alias("of"), "source_size", "target", whole_passes.cast("long").alias("passes"),
            F.coalesce("until", F.lit(0.0)).alias("until"),
        )
        plan = scratch.save(plan, keep=True)
        once_more = (F.col("place") < F.col("until")).cast("long")
        return sized.df.join(plan.df, F.col("source").eqNullSafe(F.col("of"))).select(
            "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
            (F.col("size") * (F.col("passes") + once_more)).cast("long").alias("taken"),
            *([(F.col("passes") + once_more).alias("copies"), "raw_sha256", "source"] if with_raw else []),
        )
