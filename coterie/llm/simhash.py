"""SimHash near-duplicates by bit-sliced comparison.

Two fingerprints with at most three differing bits agree in two of five blocks of bits at least, so each
fingerprint is filed under its ten pairs of blocks. Inside a file, the fingerprints' bits are stored as planes (one
word holds the same bit of 64 fingerprints), the distances of all lanes are updated together by carry-save
counters, and words whose lanes are all beyond the radius are abandoned.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ..operators.components import connected_components
from ..operators.edges import vertices
from ..plans.scratch import Scratch, release
from ..plans.skew import lookup_join

SEED = 42
RADIUS = 3
# First bit and width of each block.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
# A file with more fingerprints is cut into parts of about this size, and each two parts meet in a task.
FILE_ROWS = 4_096
# Shingles whose bits are counted at a time.
_STEP = 1 << 16
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, size: int = 3) -> int:
    """The 64-bit SimHash of the text's word shingles; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < size:
        return xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[: len(words) - size].tolist()]
    stops = (ends[size - 1 :] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for k in range(0, len(starts), _STEP):
        hashes = [xxh64_intdigest(line[i:j], SEED) for i, j in zip(starts[k : k + _STEP], stops[k : k + _STEP])]
        counts += np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
        out = {n: batch.column(n) for n in batch.schema.names if n != "text"}
        yield pa.RecordBatch.from_pydict({**out, "fp": pa.array(found.view(np.int64))})


def fingerprints(docs: DataFrame) -> DataFrame:
    """``fp`` in place of ``text``."""
    kept = [f for f in docs.schema.fields if f.name != "text"]
    return docs.mapInArrow(_fingerprints, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in kept), "fp long"]))


def _planes(values: np.ndarray) -> np.ndarray:
    """Bit planes ``(64, words)`` of 64-bit values, padded to whole words."""
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    padded = np.zeros((-(-len(values) // 64) * 64, 64), np.uint8)
    padded[: len(values)] = bits
    return np.packbits(padded.T.copy(), axis=1).view(np.uint64)


def within_radius(planes: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """A word with bits set for the lanes whose planes hold at most ``radius`` ones; ``planes`` is (64, words)."""
    out = np.zeros(planes.shape[1], np.uint64)
    alive = np.arange(planes.shape[1])
    n = radius.bit_length()
    counters = np.zeros((n, planes.shape[1]), np.uint64)
    over = np.zeros(planes.shape[1], np.uint64)
    for k, plane in enumerate(planes):
        carry = plane[alive]
        for c in counters:
            c ^= carry
            carry = carry & ~c
        over |= carry
        if k % 8 == 7:
            # Lanes beyond the radius without an overflow yet.
            past = over.copy()
            if (1 << n) - 1 != radius:
                past |= _greater(counters, radius)
            stay = past != _ALL
            if not stay.any():
                return out
            if not stay.all():
                alive, counters, over = alive[stay], np.ascontiguousarray(counters[:, stay]), over[stay]
    past = over if (1 << n) - 1 == radius else over | _greater(counters, radius)
    out[alive] = ~past
    return out


def _greater(counters: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is greater than ``radius``, compared bit by bit from the top."""
    more, same = np.zeros_like(counters[0]), np.full_like(counters[0], _ALL)
    for j in range(len(counters) - 1, -1, -1):
        if radius >> j & 1:
            same = same & counters[j]
        else:
            more |= same & counters[j]
            same = same & ~counters[j]
    return more


def _lanes(words: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(words.view(np.uint8), count=n))


def _links_of_small(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple]:
    """Links inside many small groups: every lane is one pair, whose planes are those of the XOR."""
    for size in np.unique(sizes):
        first = starts[sizes == size]
        i, j = np.triu_indices(size, 1)
        step = max(1, 1_000_000 // len(i))
        for k in range(0, len(first), step):
            a = (first[k : k + step, None] + i).ravel()
            b = (first[k : k + step, None] + j).ravel()
            hit = _lanes(within_radius(_planes(values[a] ^ values[b])), len(a))
            yield a[hit], b[hit]


def _links_of_large(values: np.ndarray) -> tuple:
    """Links inside one group: 64 queries at a time against the planes of all members."""
    planes = _planes(values)
    width = planes.shape[1]
    found = []
    for k in range(0, len(values), 64):
        asked = values[k : k + 64]
        flip = np.where(asked[None, :] >> np.arange(63, -1, -1, dtype=np.uint64)[:, None] & np.uint64(1), _ALL, np.uint64(0))
        hits = within_radius((planes[:, None, :] ^ flip[:, :, None]).reshape(64, -1)).reshape(len(asked), width)
        q, lane = np.nonzero(np.unpackbits(hits.view(np.uint8), axis=1, count=len(values)))
        later = lane > q + k
        found.append((q[later] + k, lane[later]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n members the smallest one it is linked to through others."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(jumped := label[label], label):
            label = jumped
        if np.array_equal(before, label):
            break
        differ = label[a] != label[b]
        a, b = a[differ], b[differ]
    return label


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links in files that arrive sorted by ``(file, cell)``; a file's links come out as stars."""
    rest = None
    for batch in _with_end(batches):
        if batch is not None:
            key = np.stack([batch.column("file").to_numpy(), batch.column("cell").to_numpy()])
            fp = batch.column("fp").to_numpy().view(np.uint64)
            if rest is not None:
                key, fp = np.concatenate([rest[0], key], axis=1), np.concatenate([rest[1], fp])
        elif rest is None:
            return
        else:
            key, fp = rest
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
        if batch is not None:
            if not len(cuts):
                rest = key, fp
                continue
            rest = key[:, cuts[-1] :], fp[cuts[-1] :]
            fp, cuts = fp[: cuts[-1]], cuts[:-1]
        starts = np.concatenate([[0], cuts]).astype(np.int64)
        sizes = np.diff(np.append(starts, len(fp)))
        small = (sizes > 1) & (sizes <= 64)
        pairs = list(_links_of_small(fp, starts[small], sizes[small]))
        for s, n in zip(starts[sizes > 64], sizes[sizes > 64]):
            x, y = _links_of_large(fp[s : s + n])
            pairs.append((x + s, y + s))
        if pairs:
            label = _stars(len(fp), *(np.concatenate(x) for x in zip(*pairs)))
            at = np.flatnonzero(label != np.arange(len(fp)))
            if len(at):
                yield pa.RecordBatch.from_pydict(
                    {"src": pa.array(fp[label[at]].view(np.int64)), "dst": pa.array(fp[at].view(np.int64))}
                )


def _with_end(batches):
    yield from batches
    yield None


def near_links(distinct: DataFrame, scratch: Scratch) -> DataFrame:
    """``(src, dst)`` fingerprints that connect all within the radius, at most one row per fingerprint and file."""
    keys = []
    for t, (x, y) in enumerate(combinations(BLOCKS, 2)):
        value = F.lit(t).cast("long")
        for first, width in (x, y):
            part = F.shiftrightunsigned("fp", 64 - first - width).bitwiseAND(F.lit((1 << width) - 1))
            value = F.shiftleft(value, width).bitwiseOR(part)
        keys.append(value)
    filed = scratch.save(distinct.select("fp", F.explode(F.array(*keys)).alias("file")))
    large = scratch.save(
        filed.df.groupBy("file").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > FILE_ROWS)
        .select("file", F.ceil(F.col("held") / FILE_ROWS).cast("int").alias("parts"))
    )
    cells = filed.df.withColumn("cell", F.lit(0).cast("long"))
    if large.rows:
        part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("long")
        others = F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda o: F.least(o.cast("long"), F.col("part")) * F.col("parts") + F.greatest(o.cast("long"), F.col("part")),
        )
        cells = (
            lookup_join(filed, large, ["file"], scratch, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
            .withColumn("part", part).select("fp", "file", F.explode(others).alias("cell"))
        )
    return cells.repartition("file", "cell").sortWithinPartitions("file", "cell").mapInArrow(
        _links, "src long, dst long"
    )


def simhash_dedup(docs: DataFrame, with_raw: bool = False) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row for each row of ``docs (doc_id, text)``.

    A text with fewer than three words has one shingle, one without words (null, empty) the fingerprint
    zero, which links like any other. The component is named by its smallest id (null if all are
    null). Equal fingerprints are one vertex, so copies make no links. Other columns are ignored.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        columns = [F.col("doc_id").cast("long").alias("doc_id"), "text"]
        columns += [F.sha2(F.coalesce("text", F.lit("")), 256).alias("raw_sha256")] if with_raw else []
        rows = scratch.save(fingerprints(docs.select(*columns)), keep=True)
        distinct = scratch.save(rows.df.groupBy("fp").agg(F.min("doc_id").alias("least")))
        edges = scratch.save(near_links(distinct.df.select("fp"), scratch).where("src <> dst").distinct())
        labels = connected_components(vertices(edges.df), edges.df) if edges.rows else None
        if labels is None:
            named = distinct.df.withColumn("community", F.col("fp"))
        else:
            named = distinct.df.join(labels.withColumnRenamed("vertex", "fp"), "fp", "left").withColumn(
                "community", F.coalesce("community", "fp")
            )
        named = scratch.save(named)
        if labels is not None:
            release(labels)
        component = named.df.groupBy("community").agg(F.min("least").alias("component_id"))
        names = scratch.save(named.df.join(component, "community").select("fp", "community", "component_id"), keep=True)
        return rows.df.join(names.df, "fp").select(
            "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
            *(["raw_sha256", "community"] if with_raw else []),
        )
