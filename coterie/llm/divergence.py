"""How far the sources of a language differ in their words: distances of all pairs, and the terms that set a source apart.

Terms are counted per task, then by term, and dealt to chunks of a bounded number of terms. A chunk meets all groups (sources) of
its language, so that it knows the shares of terms that a group does not have. It gives partial sums for the pairs of groups and,
per group, a dominance skyband of its terms: a term with k others that have at least its count in the group, at most its
count in the language and an earlier name is behind them all in the ranking by divergence, and is dropped. Skybands
are merged until one is left for each group, or merging drops too little, and only what remains is ranked exactly.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.limits import partitions
from ..plans.scratch import Saved, Scratch
from ..plans.skew import lookup_join

MIN_DOCS = 3
TOP = 200
# Terms in a chunk, groups that one chunk compares with all others, rows of skybands that are merged at once.
CHUNK_TERMS = 20_000
SOURCE_BLOCK = 500
MERGE_ROWS = 200_000
# Entries that a task counts before it sends them on, and bytes of text that are split at once.
_HELD = 400_000
_PIECE = 4 << 20
_UNIT = 1_000_000_000
# All of ASCII but letters separates; letters are lowered.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 97 <= b <= 122 else 32 for b in range(256))
_TERM_ROWS = "lang string, source string, term binary, held long, docs long"
_FOUND = "lang string, source string, item string, value decimal(38,0), held long, total long"


def _terms(text: bytes) -> Iterator[list[bytes]]:
    text, at = text.translate(_TABLE), 0
    while at < len(text):
        to = text.find(b" ", at + _PIECE) + 1 or len(text)
        yield text[at:to].split()
        at = to


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of the terms of each group, summed over the documents that a task reads."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs) in held.items():
            if counts:
                n = len(counts)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * n, pa.string()), "source": pa.array([source] * n, pa.string()),
                    "term": pa.array(counts.keys(), pa.binary()), "held": pa.array(counts.values(), pa.int64()),
                    "docs": pa.array([docs[t] for t in counts], pa.int64()),
                })

    for batch in batches:
        columns = (batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        for lang, source, text in zip(*columns, batch.column("text").cast(pa.large_binary())):
            counts, docs = held.setdefault((lang, source), (Counter(), Counter()))
            before, distinct = len(counts), set()
            for terms in _terms(text.as_py() or b""):
                counts.update(terms)
                distinct.update(terms)
            docs.update(distinct)
            size += len(counts) - before
            if size >= _HELD:
                yield from out()
                held, size = {}, 0
    yield from out()


def shares(counts: np.ndarray, totals: np.ndarray | int, kept: int) -> np.ndarray:
    """``1 + floor(10^9 (count + 1) / (total + kept))`` in whole numbers, three digits at a time."""
    whole = np.asarray(totals, np.int64) + kept
    out, rest = np.divmod(np.asarray(counts, np.int64) + 1, whole)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def skyband(held: np.ndarray, total: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    """Places of the terms that fewer than ``k`` others dominate: ``held`` no less, ``total`` no more, an earlier name.

    In the order below, a term's dominators come before it. A term that is left out has k dominators in the band, which also
    dominate whatever it dominates, so it is enough to compare with the band.
    """
    order = np.lexsort((names, total, -held))
    band, band_total, band_name = [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    for at in range(0, len(order), 512):
        some = order[at : at + 512]
        t, n = total[some], names[some]
        before = ((band_total <= t[:, None]) & (band_name < n[:, None])).sum(1)
        inside = (t[None, :] <= t[:, None]) & (n[None, :] < n[:, None])
        before += np.tril(inside, -1).sum(1)
        stays = before < k
        band.append(some[stays])
        band_total, band_name = np.append(band_total, t[stays]), np.append(band_name, n[stays])
    return np.concatenate(band) if band else np.zeros(0, np.int64)


def _table(rows: list[tuple]) -> pa.Table:
    """Of columns ``(lang, source, item, value, held, total)``; an item without ``held`` is a source, with a partial sum."""
    kinds = [pa.string(), pa.string(), pa.string(), pa.decimal128(38, 0), pa.int64(), pa.int64()]
    names = ["lang", "source", "item", "value", "held", "total"]
    columns = [np.concatenate(c) if rows else [] for c in zip(*rows)] or [[]] * 6
    whole = [pa.array(c.tolist() if len(c) else [], t) for c, t in zip(columns, kinds)]
    return pa.table(dict(zip(names, whole)))


def _objects(values) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


def _compared(k: int):
    """Partial sums and skybands of one chunk of terms against the groups of one block of its language."""

    def compared(key: tuple, terms: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("number")
        lang, sources = key[0].as_py(), _objects(groups["source"].to_pylist())
        own = np.flatnonzero(groups["own"].to_numpy(zero_copy_only=False))
        sizes, kept, whole = groups["size"].to_numpy(), groups["kept"][0].as_py(), groups["lang_size"][0].as_py()
        names, totals = _objects(terms["term"].to_pylist()), terms["total"].to_numpy()
        lists = terms["groups"].combine_chunks()
        row = np.repeat(np.arange(len(names)), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        flat = lists.flatten()
        column, count = flat.field("number").to_numpy().astype(np.int64), flat.field("held").to_numpy()
        rows = []
        # Pairs: every share of the own groups against every share of all groups, a bounded number of terms at a time.
        sums = np.zeros((len(own), len(sources)), np.int64)
        step = max(1, 2_000_000 // len(sources))
        for at in range(0, len(names), step):
            here = slice(*np.searchsorted(row, (at, at + step)))
            counts = np.zeros((min(step, len(names) - at), len(sources)), np.int64)
            counts[row[here] - at, column[here]] = count[here]
            p = shares(counts, sizes, kept)
            for i, s in enumerate(own):
                apart = p[:, [s]] - p
                sums[i] += (apart * apart // p).sum(0)
        for i, s in enumerate(own):
            others = np.delete(np.arange(len(sources)), s)
            n = len(others)
            nothing = _objects([None] * n)
            rows.append((_objects([lang] * n), _objects([sources[s]] * n), sources[others], _objects(sums[i][others].tolist()), nothing, nothing))
        # Terms: names are compared as UTF-8, in which code points keep their order.
        by_name = np.empty(len(names), np.int64)
        by_name[np.argsort(names)] = np.arange(len(names))
        q = shares(totals, whole, kept)
        by_group = np.argsort(column, kind="stable")
        cuts = np.searchsorted(column[by_group], np.arange(len(sources) + 1))
        for s in own:
            mine = by_group[cuts[s] : cuts[s + 1]]
            p = shares(count[mine], sizes[s], kept)
            mine = mine[p > q[row[mine]]]
            best = mine[skyband(count[mine], totals[row[mine]], by_name[row[mine]], k)]
            p, over = shares(count[best], sizes[s], kept), q[row[best]]
            value = (p - over) * (p - over) // over
            n = len(best)
            rows.append((_objects([lang] * n), _objects([sources[s]] * n), names[row[best]], _objects(value.tolist()),
                         _objects(count[best].tolist()), _objects(totals[row[best]].tolist())))
        return _table(rows)

    return compared


def _merged(k: int):
    def merged(key: tuple, rows: pa.Table) -> pa.Table:
        names = _objects(rows["item"].to_pylist())
        by_name = np.empty(len(names), np.int64)
        by_name[np.argsort(names)] = np.arange(len(names))
        band = skyband(rows["held"].to_numpy(), rows["total"].to_numpy(), by_name, k)
        return rows.take(pa.array(band)).select(["lang", "source", "item", "value", "held", "total"])

    return merged


def _merge(bands: Saved, top: int, scratch: Scratch) -> Saved:
    """Skybands of whole groups, merged a bounded number of rows at a time while that drops at least half."""
    while True:
        held = scratch.save(
            bands.df.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows"))
            .select("lang", "source", F.ceil(F.col("rows") / MERGE_ROWS).alias("buckets")),
            most=F.max("buckets"),
        )
        cut = lookup_join(bands, held, ["lang", "source"], scratch).withColumn(
            "bucket", F.pmod(F.xxhash64("item"), F.col("buckets"))
        ).drop("buckets")
        merged = scratch.save(cut.groupBy("lang", "source", "bucket").applyInArrow(_merged(top), _FOUND))
        if (held.metrics["most"] or 1) == 1 or merged.rows * 2 > bands.rows:
            return merged
        bands = merged


def _ranked(rows: Saved, top: int, scratch: Scratch) -> DataFrame:
    """The first ``top`` of each group, in slices first, so that no task sorts a large group."""
    order = [F.desc("value"), F.asc("item")]
    slices = F.pmod(F.xxhash64("item"), F.lit(partitions(scratch.spark, rows.rows)))
    some = Window.partitionBy("lang", "source", "slice").orderBy(*order)
    first = rows.df.withColumn("slice", slices).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order))).where(F.col("rank") <= top)


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for ``docs (text, lang, source)``.

    Terms are runs of letters and of characters beyond ASCII, A-Z in lower case; those in at least ``min_docs`` documents (rows) of a
    language are kept. A group is a language and source that occur. Part ``pair`` has each other source of the language with the
    sum of ``floor((p - q)^2 / q)`` over all kept terms, p and q being the shares in the two groups; part ``term`` has the
    ``top`` kept terms of the group whose share p is above the share q in the language. Null texts, languages and
    sources count as empty ones; a language without kept terms gives pairs with value 0 and a source alone in its
    language no pairs. Equal rows count as often as they are there, equal values are ordered by item. An empty
    table gives an empty result. Other columns are ignored.
    """
    if min_docs < 1 or top < 1:
        raise ValueError("min_docs and top must be at least 1")
    with Scratch(docs.sparkSession) as scratch:
        text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
        rows = docs.select(text("lang"), text("source"), text("text"))
        # A task sends a term of a group about once; both sums then need the one shuffle by term.
        counted = rows.mapInArrow(_counted, _TERM_ROWS).repartition("lang", "term")
        by_group = counted.groupBy("lang", "term", "source").agg(F.sum("held").alias("held"), F.sum("docs").alias("docs"))
        terms = scratch.save(
            by_group.groupBy("lang", "term").agg(
                F.sum("held").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "held")).alias("groups")
            ).where(F.col("docs") >= min_docs).select("lang", F.col("term").cast("string").alias("term"), "total", "groups")
        )
        langs = scratch.save(terms.df.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("total").alias("lang_size")))
        sizes = scratch.save(
            terms.df.select("lang", F.inline("groups")).groupBy("lang", "source").agg(F.sum("held").alias("size"))
        )
        # The result has a row for every two sources of a language, so their number per language is moderate.
        numbered = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        every = scratch.save(
            docs.select(text("lang"), text("source")).distinct()
            .join(sizes.df, ["lang", "source"], "left").join(langs.df, "lang", "left")
            .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("size", "kept", "lang_size")])
            .withColumn("number", numbered.cast("int"))
            .withColumn("chunks", F.greatest(F.lit(1), F.ceil(F.col("kept") / CHUNK_TERMS)).cast("int"))
        )
        blocks = scratch.save(every.df.groupBy("lang").agg(F.max("chunks").alias("chunks"), F.ceil(F.count(F.lit(1)) / SOURCE_BLOCK).cast("int").alias("blocks")))

        # Names of sources become their numbers, so that rows of terms stay narrow.
        spread = terms.df.withColumn("groups", F.explode("groups")).select("lang", "term", "total", "groups.source", "groups.held")
        dealt = (
            lookup_join(spread, every.select("lang", "source", "number"), ["lang", "source"], scratch)
            .groupBy("lang", "term", "total").agg(F.sort_array(F.collect_list(F.struct("number", "held"))).alias("groups"))
        )
        dealt = (
            lookup_join(dealt, blocks, ["lang"], scratch)
            .withColumn("chunk", F.pmod(F.xxhash64("term"), F.col("chunks")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("chunks", "blocks")
        )
        met = (
            lookup_join(every.select("lang", "source", "number", "size", "kept", "lang_size"), blocks, ["lang"], scratch)
            .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("own", F.floor(F.col("number") / SOURCE_BLOCK) == F.col("block")).drop("chunks", "blocks")
        )
        keys = ["lang", "chunk", "block"]
        found = scratch.save(dealt.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInArrow(_compared(top), _FOUND))

        pairs = (
            found.df.where("held IS NULL").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))))
        )
        best = _merge(scratch.save(found.df.where("held IS NOT NULL")), top, scratch)
        columns = ["lang", "source", "part", "item", F.col("value").cast("long").alias("value"), "rank"]
        return scratch.save(
            pairs.withColumn("part", F.lit("pair")).select(*columns)
            .unionByName(_ranked(best, top, scratch).withColumn("part", F.lit("term")).select(*columns)),
            keep=True,
        ).df
