"""Phrases whose words occur together more often than apart, by relational mining of occurrences (SETM).

The occurrence relation of length one, (language, piece, position, word), is written sorted, in blocks of whole documents. One
level makes the next: the relation is merge-joined with itself on the piece and the adjacent position, the
grams of each block are counted there, and the counts of all blocks are summed by gram. Only occurrences of
frequent grams (a semi-join) are extended. A gram is named by its two overlapping parts of one word less, both frequent.

Positions are numbered through a block with a free number between pieces, so "same piece, next position" is "next
number". A gram is one row per block and level, however often it occurs, so no gram is a hot key. What a block holds is written as
a row with its places, sorted, and a short row for each of its grams, so that no file is read or written by rows of many grams.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.limits import partitions
from ..plans.scratch import Saved, Scratch
from ..plans.skew import lookup_join
from .exchange import expand, squeeze

LONGEST = 3
MIN_COUNT = 10
TOP = 2000
# A candidate goes when a longer one around it has at least this share of its occurrences, in percent.
COVERED = 50
# Tokens in a block, and bytes of text that are split at once (up to the next end of a piece).
BLOCK_TOKENS = 1_000_000
# Full blocks that the open blocks of all languages of a task may add up to.
_ALL_BLOCKS = 6
_CHUNK = 1 << 20
_BREAK = b"."
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_ENDS + b"\t", _BREAK * len(_ENDS) + b" ").translate(
    bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
)
# Bits of a gram's name for its code in a block, for the block in its partition and for the partition.
_CODE_BITS, _BLOCK_BITS, _PART_BITS = 31, 12, 20
# Slices of a language that are ranked apart, for each task's worth of rows.
_SLICES = 16
# Rows of grams, with their words, that may be broadcast.
_SMALL = 50_000
# Rows of grams that a task sends at once.
_SENT = 1 << 16
# A row has either the occurrences of a block or a gram of it, whose code is written as two numbers that files hold in next to no space.
_RELATION = "block long, places binary, codes binary, high int, low int, counts long"
_WORDS = f"{_RELATION}, lang string, tokens long, words string"
_GRAMS = f"{_RELATION}, firsts long, seconds long"
_KINDS = {
    "block": pa.int64(), "places": pa.binary(), "codes": pa.binary(), "high": pa.int32(), "low": pa.int32(), "counts": pa.int64(), "lang": pa.string(),
    "tokens": pa.int64(), "words": pa.string(), "firsts": pa.int64(), "seconds": pa.int64(),
}


def _tokens(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lower case with breaks between pieces; a stretch that ends with a piece at a time."""
    text, at = text.translate(_TABLE), 0
    while at < len(text):
        to = text.find(_BREAK, at + _CHUNK) + 1 or len(text)
        yield [*text[at:to].replace(_BREAK, b" . ").split(), _BREAK]
        at = to


def _rows(schema: str, same: dict, places: np.ndarray, codes: np.ndarray, grams: dict, first: int = 0, **once) -> Iterator[pa.RecordBatch]:
    """The occurrences of a block in one row, with what is there ``once``, and then its ``grams``, with codes from ``first`` on, in short rows; ``same`` is in all rows."""
    fields = [(name, _KINDS[name]) for name in (column.split()[0] for column in schema.split(", "))]

    def batch(rows: int, found: dict) -> pa.RecordBatch:
        columns = [pa.array([same[n]] * rows, kind) if n in same else pa.array(found[n], kind) if n in found else pa.nulls(rows, kind) for n, kind in fields]
        return pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    yield batch(1, {"places": [squeeze(places.astype(np.int32))], "codes": [squeeze(codes.astype(np.int32))]} | {n: [v] for n, v in once.items()})
    held = len(grams["counts"])
    code = np.arange(first, first + held, dtype=np.int32)
    grams = grams | {"high": code >> 8, "low": code & 255}
    for k in range(0, held, _SENT):
        yield batch(min(_SENT, held - k), {n: values[k : k + _SENT] for n, values in grams.items()})


def _occurrences(block_tokens: int):
    """Blocks of the occurrence relation of length one: sorted places with local word codes, the words and their counts."""

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        if part >> _PART_BITS:
            raise ValueError("more partitions than names of blocks")
        # By language: codes of the words so far, the break being 0, and the tokens as codes.
        held: dict[str, tuple[dict[bytes, int], array]] = {}
        size = 0

        def out(lang: str) -> Iterator[pa.RecordBatch]:
            nonlocal made, size
            known, tokens = held.pop(lang)
            size -= len(tokens)
            if made >> _BLOCK_BITS:
                raise ValueError("more text in a partition than names of blocks")
            codes = np.frombuffer(tokens, np.int32)
            places = np.flatnonzero(codes)
            # All words but the break.
            grams = {
                "counts": np.bincount(codes, minlength=len(known))[1:],
                "words": pa.array(known, pa.binary()).cast(pa.string()).slice(1),
            }
            yield from _rows(_WORDS, {"block": part << _BLOCK_BITS | made, "lang": lang}, places, codes[places], grams, 1, tokens=len(places))
            made += 1

        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for lang, text in zip(batch.column("lang").to_pylist(), texts):
                for tokens in _tokens(text.as_py() or b""):
                    known, codes = held.setdefault(lang, ({_BREAK: 0}, array("i")))
                    for word in set(tokens).difference(known):
                        known[word] = len(known)
                    codes.extend(map(known.__getitem__, tokens))
                    size += len(tokens)
                    if len(codes) >= block_tokens:
                        yield from out(lang)
                    elif size >= _ALL_BLOCKS * block_tokens:
                        for other in list(held):
                            yield from out(other)
        for lang in list(held):
            yield from out(lang)

    return occurrences


def _extend(key: tuple, relation: pa.Table, frequent: pa.Table) -> pa.Table:
    """Join the frequent occurrences of one block with those at the next place, and count the grams that this makes."""
    found = []
    if len(relation) and len(frequent):
        row = relation.select(["block", "places", "codes"]).to_pylist()[0]
        places, codes = expand(row["places"], np.int32), expand(row["codes"], np.int32)
        # Grams in the order of their names, so that those beside each other differ little.
        frequent = frequent.sort_by("id")
        known = frequent["code"].to_numpy()
        names = np.full(max(int(codes.max(initial=0)), int(known.max())) + 1, -1, np.int64)
        local = names.copy()
        names[known], local[known] = frequent["id"].to_numpy(), np.arange(len(known))
        stays = local[codes] >= 0
        places, codes = places[stays], codes[stays]
        # Both sides are sorted by place, so the merge join of (place) with (place - 1) looks at neighbours only.
        met = np.flatnonzero(np.diff(places) == 1)
        left, right = codes[met], codes[met + 1]
        grams, which, counts = np.unique(local[left] << 32 | local[right], return_inverse=True, return_counts=True)
        if len(grams):
            found = _rows(_GRAMS, {"block": row["block"]}, places[met], which, {
                "counts": counts, "firsts": names[known[grams >> 32]], "seconds": names[known[grams & 0xFFFFFFFF]],
            })
    names = [column.split()[0] for column in _GRAMS.split(", ")]
    return pa.Table.from_batches(found, pa.schema([(n, _KINDS[n]) for n in names]))


def _frequent(relation: Saved, names: list[str], min_count: int, scratch: Scratch) -> Saved:
    """``(block, code, id, a, named, *names)``: the grams of each block that are frequent in all blocks together.

    One shuffle by gram serves the group-count and the semi-join: every row, a gram of a block with its count there, meets
    the sum of its gram. A gram is named by the first block that has it and by its code there, both in one number.
    """
    # Ids are not shared by languages, words are.
    by = [*names, *(["lang"] if names == ["words"] else [])]
    own = F.shiftleft("block", _CODE_BITS).bitwiseOR(F.expr("high * 256 + low").cast("long"))
    rows = relation.df.where("low IS NOT NULL").select(own.alias("own"), *by, "counts")
    # As many tasks as the rows ask for, however many those are.
    rows = rows.repartition(partitions(scratch.spark, relation.rows), *by)
    same = Window.partitionBy(*by)
    counted = rows.withColumn("a", F.sum("counts").over(same)).withColumn("id", F.min("own").over(same))
    code = F.col("own").bitwiseAND(F.lit((1 << _CODE_BITS) - 1)).cast("int")
    return scratch.save(counted.where(F.col("a") >= min_count).select(
        F.shiftright("own", _CODE_BITS).alias("block"), code.alias("code"), "id", "a", (F.col("own") == F.col("id")).alias("named"), *by
    ))


def _shortest_cut() -> Column:
    """``(score, cut, l, r)`` of the lowest-scoring cut, the smallest of equal ones, in exact decimals."""
    exact = lambda c: c.cast("decimal(15,0)")
    million = F.lit(1_000_000).cast("decimal(7,0)")

    def at(cut: Column) -> Column:
        left, right = F.get("prefixes", cut - 1), F.get("suffixes", F.size("suffixes") - cut)
        return F.struct(
            F.call_function("div", million * exact(F.col("a")) * exact(F.col("a")), exact(left) * exact(right)).alias("score"),
            cut.alias("cut"), left.alias("l"), right.alias("r"),
        )

    return F.array_min(F.transform(F.sequence(F.lit(1), F.size("prefixes")), at))


def mined(docs: DataFrame, longest: int, min_count: int, scratch: Scratch) -> tuple[list[Saved], DataFrame]:
    """Frequent grams by length, each ``(lang, id, phrase, last, a, prefixes, suffixes[, first, second])``, and ``(lang, n)``.

    ``prefixes`` and ``suffixes`` hold the counts of the first and the last 1, 2, ... words.
    """
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")
    )
    relation = scratch.save(texts.mapInArrow(_occurrences(BLOCK_TOKENS), _WORDS))
    sizes = scratch.save(relation.df.groupBy("lang").agg(F.sum("tokens").alias("n"))).df
    frequent = _frequent(relation, ["words"], min_count, scratch)
    none = F.array().cast("array<bigint>")
    levels = [scratch.save(
        frequent.df.where("named").select("lang", "id", F.col("words").alias("phrase"), F.col("words").alias("last"), "a",
                                          none.alias("prefixes"), none.alias("suffixes"))
    )]
    for _ in range(longest - 1):
        if not frequent.rows:
            break
        parts = partitions(scratch.spark, relation.rows + frequent.rows)
        relation = scratch.save(
            relation.df.where("places IS NOT NULL").select("block", "places", "codes").repartition(parts, "block").groupBy("block")
            .cogroup(frequent.df.select("block", "code", "id").repartition(parts, "block").groupBy("block")).applyInArrow(_extend, _GRAMS)
        )
        frequent = _frequent(relation, ["firsts", "seconds"], min_count, scratch)
        found = scratch.save(frequent.df.where("named").select("id", "firsts", "seconds", "a"))
        shorter = levels[-1]
        part = lambda side, *more: shorter.select(f"id AS {side}s", f"a AS {side}_a", *more)
        one = lookup_join(
            found, part("first", "lang", "phrase AS first_phrase", "prefixes AS first_prefixes"), ["firsts"], scratch, most=_SMALL
        )
        both = lookup_join(one, part("second", "last", "suffixes AS second_suffixes"), ["seconds"], scratch, most=_SMALL)
        levels.append(scratch.save(both.select(
            "lang", "id", F.concat_ws(" ", "first_phrase", "last").alias("phrase"), "last", "a",
            F.concat("first_prefixes", F.array("first_a")).alias("prefixes"),
            F.concat("second_suffixes", F.array("second_a")).alias("suffixes"),
            F.col("firsts").alias("first"), F.col("seconds").alias("second"),
        )))
    return levels, sizes


def _uncovered(grams: Saved, longer: Saved | None, scratch: Scratch) -> DataFrame:
    """Without those inside a longer candidate that is at least ``COVERED`` percent as frequent.

    A gram of one word more around it is at least as frequent as any that is longer still, so it decides.
    """
    if longer is None or not longer.rows:
        return grams.df
    around = scratch.save(
        longer.df.select(F.explode(F.array("first", "second")).alias("id"), F.col("a").alias("longer"))
        .groupBy("id").agg(F.max("longer").alias("longer"))
    )
    marked = lookup_join(grams, around, ["id"], scratch, "left", most=_SMALL)
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    return marked.where(F.col("longer").isNull() | (100 * exact("longer") < COVERED * exact("a"))).drop("longer")


def collocations(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best phrases of each language of ``docs (text, lang)``.

    Pieces lie between ``.,;:!?`` and ends of lines, words between spaces and tabs, A-Z in lower case. Candidates are phrases of 2 to
    ``longest`` words within a piece that occur at least ``min_count`` times in a language. The score of a
    cut is ``floor(10^6 a^2 / (l r))`` with the counts of its two parts, that of a phrase is its lowest. A null text is
    empty, a null language is ``und``; texts without words and an empty table give nothing. Equal rows count as often as
    they are there, equal scores are ordered by ``a`` and then by the phrase. Other columns are ignored.
    """
    if longest < 2 or min_count < 1 or top < 1:
        raise ValueError("longest must be at least 2, min_count and top at least 1")
    with Scratch(docs.sparkSession) as scratch:
        levels, sizes = mined(docs, longest, min_count, scratch)
        levels = levels + [None] * (longest - len(levels))
        columns = ["lang", "phrase", "a", "prefixes", "suffixes"]
        parts = [
            _uncovered(grams, longer, scratch).select(*columns)
            for grams, longer in zip(levels[1:], [*levels[2:], None]) if grams is not None
        ]
        if not parts:
            parts = [levels[0].df.select(*columns).limit(0)]
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        scored = scratch.save(every.withColumn("best", _shortest_cut()).select("lang", "phrase", "a", "best.l", "best.r", "best.score"))
        # Ranked in slices first, so that no task sorts all phrases of a language.
        order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
        slices = F.pmod(F.xxhash64("phrase"), F.lit(_SLICES * partitions(scratch.spark, scored.rows)))
        first = scored.df.withColumn("slice", slices).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order)))
        last = first.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
        ranked = scratch.save(last.where(F.col("rank") <= top).drop("slice"))
        out = lookup_join(ranked, Saved(sizes, ranked.rows), ["lang"], scratch)
        return scratch.save(out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), keep=True).df
