"""Quality rules on documents with verdicts on their hosts, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import Saved, Scratch
from ..plans.skew import lookup_join
from .text import whole, words

SYMBOLS = "#*$%&|<>"


def _repeat_words(window: int) -> Column:
    """Words of ``w`` that lie in a window of words found twice or more in the text.

    Window hashes are sorted; most texts have no equal neighbours and are done. Else the windows that do repeat
    are taken in the order of the text, and each covers its words up to the next one's start.
    """
    last = F.size("w") - F.lit(window - 1)
    hashes = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(F.col("w"), i, window)))
    return F.when(last >= 2, hashes).otherwise(F.array().cast("array<bigint>"))


def _covered(window: int) -> Column:
    ordered = F.sort_array(
        F.transform(F.col("h"), lambda x, i: F.struct(x.alias("x"), i.alias("i")))
    )
    return F.aggregate(
        F.sort_array(F.transform(
            F.filter(F.transform(ordered, lambda e, k: F.struct(
                e["i"].alias("i"),
                (F.coalesce(F.get(F.col("s"), k - 1) == e["x"], F.lit(False))
                 | F.coalesce(F.get(F.col("s"), k + 1) == e["x"], F.lit(False))).alias("again"),
            )), lambda e: e["again"]),
            lambda e: e["i"],
        )),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("end")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(F.lit(window), i + window - acc["end"])).alias("n"), (i + window).alias("end")
        ),
        lambda acc: acc["n"],
    )


def measures(docs: DataFrame, *carried: Column, window: int = 5) -> DataFrame:
    """Add the counts that the rules use: words, their code points, symbols, duplicate lines, repeated words."""
    text = F.col("t")
    return (
        docs.select(*carried, whole().alias("t"))
        .withColumn("w", words(text))
        .withColumn("h", _repeat_words(window))
        .withColumn("s", F.sort_array("h"))
        .withColumn("lines", F.filter(F.split(text, "\n"), lambda x: F.translate(x, " \t\n\x0b\x0c\r", "") != ""))
        .withColumn("again", F.size("s") > F.size(F.array_distinct("s")))
        .select(
            *[c for c in docs.select(*carried).columns],
            F.size("w").cast("long").alias("n_words"),
            F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.size("lines").cast("long").alias("n_lines"),
            F.when(F.col("again"), _covered(window)).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        )
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def soft_failed() -> Column:
    """Rules that count against a host, and against a document only on a host with a bad verdict."""
    mean = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    return (
        (F.col("n_symbols") * 10 > F.col("n_words")) | (F.col("n_dup_lines") * 10 > F.col("n_lines") * 3)
        | (mean < 2) | (mean > 20)
    )


def host_verdicts(measured: DataFrame, worst: float = 0.5) -> DataFrame:
    """``(host, n_docs, n_failed, rate, shrunk_rate, bad)`` from ``(host, failed)``.

    Rates of hosts with few documents say little, so each is drawn to the mean of all by a beta prior whose
    strength is fitted to the hosts by moments: the variance of the rates beyond what their sizes
    explain. A host is bad when its shrunk rate is above ``worst``.
    """
    hosts = measured.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(
        F.sum("n_docs").alias("n"), F.sum("n_failed").alias("k"), F.count(F.lit(1)).alias("hosts"),
        F.sum(F.col("n_failed") * rate).alias("squares"), F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("sizes"),
    )
    mean = F.col("k") / F.col("n")
    # Weighted between-host variance less its part from sampling.
    between = (F.col("squares") - F.col("n") * mean * mean) - (F.col("hosts") - 1) * mean * (1 - mean)
    spread = F.greatest(between / F.greatest(F.col("n") - F.col("sizes") / F.col("n"), F.lit(1e-9)), F.lit(1e-9))
    strength = F.greatest(F.lit(1.0), F.least(F.lit(1e6), mean * (1 - mean) / spread - 1))
    prior = moments.select(mean.alias("mean"), F.coalesce(strength, F.lit(1.0)).alias("strength"))
    shrunk = (F.col("n_failed") + F.col("mean") * F.col("strength")) / (F.col("n_docs") + F.col("strength"))
    return (
        hosts.join(F.broadcast(prior))  # one row
        .select("host", "n_docs", "n_failed", rate.alias("rate"), shrunk.alias("shrunk_rate"), (shrunk > worst).alias("bad"))
    )


def quality(docs: DataFrame, host: str = "source", worst: float = 0.5, with_raw: bool = False) -> DataFrame:
    """``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)`` per row.

    A document goes when it fails a base rule: fewer than ten words, or more than a fifth of its words in
    repeated windows. Failures of base and soft rules are summed by ``host`` (a null host is one of its own),
    and on a host with a bad verdict a soft rule is enough to go. Null and empty texts have no words
    and so fail. Equal rows are judged alike. Other columns are ignored.
    """
    with Scratch(docs.sparkSession) as scratch:
        carried = [F.col("doc_id").cast("long").alias("doc_id"), F.col(host).alias("host")]
        carried += [F.sha2(whole(), 256).alias("raw_sha256")] if with_raw else []
        saved = scratch.save(
            measures(docs, *carried).withColumn("base_failed", base_failed()).withColumn("soft", soft_failed()),
        )
        judged = host_verdicts(saved.df.select("host", (F.col("base_failed") | F.col("soft")).alias("failed")), worst)
        named = F.coalesce(F.concat(F.lit("h"), F.col("host").cast("string")), F.lit("none"))
        bad = scratch.save(judged.where("bad").select(named.alias("named"), "bad"))
        joined = lookup_join(Saved(saved.df.withColumn("named", named), saved.rows), bad, ["named"], scratch, "left")
        kept = ~(F.col("base_failed") | (F.col("soft") & F.coalesce("bad", F.lit(False))))
        return scratch.save(
            joined.select(
                "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                kept.alias("kept"), *(["raw_sha256"] if with_raw else []),
            ),
            keep=True,
        ).df
