"""Windows that occur more than once, found from a sample of anchors that equal windows share.

Sequences are arrays of 64-bit values: bytes, or words by their hash. Every window of ``width`` values takes the
least of the hashed grams inside it (the leftmost of equal ones) as its anchor, so equal windows have
equal anchors at the same place inside. Neighbouring windows with the same anchor are a run; there are far fewer
runs than windows. Windows whose gram is found once are settled by it, and so are runs that are equal as
a whole to all others with their gram; only the rest is looked at window by window.

Two exchanges give the totals: first of grams and whole runs, then of single windows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import Saved, Scratch
from .blocks import unpacked
from .exchange import LAST, OWNER_KEYS, REQUEST, answered, request, request_batch, totals_of

# Values looked at together; longer documents are cut into pieces that overlap by a window.
PIECE = 1 << 18
_ROOM = 1 << 10
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP = _powers(int(_BASE), PIECE + _ROOM)
_DOWN = _powers(pow(int(_BASE), -1, 1 << 64), PIECE + _ROOM)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of hashes."""
    h = h ^ (h >> np.uint64(29))
    h = h * _MIX
    return h ^ (h >> np.uint64(32))


def together(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One identifier for two in order."""
    return mixed(a * _BASE + mixed(b))


class Rolling:
    """Hashes of any stretch of a piece from its prefix sums."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(values * _UP[: self.n], out=self.sums[1:])

    def grams(self, size: int) -> np.ndarray:
        return mixed((self.sums[size:] - self.sums[:-size]) * _DOWN[: self.n - size + 1])

    def stretches(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * _DOWN[start])


@dataclass(frozen=True)
class Shape:
    """Windows of ``width`` values, grams of ``gram``; how to read a text, and the window's identifier from grams."""

    width: int
    gram: int
    read: Callable[[bytes], np.ndarray]
    identify: Callable[[Rolling], np.ndarray]
    earlier_only: bool  # the first occurrence stays


@dataclass
class Piece:
    rolling: Rolling
    docs: np.ndarray  # per run: place of the document in the block
    shift: np.ndarray  # per run: place of the document's value 0 in the piece
    start: np.ndarray  # per run: first window, in the piece
    end: np.ndarray
    grams: np.ndarray
    whole: np.ndarray


def pieces(texts: list[bytes], shape: Shape) -> Iterator[Piece]:
    """The runs of a block's texts, a bounded number of values at a time, in a fixed order."""
    parts, held = [], 0
    for doc, text in enumerate(texts):
        values = shape.read(text)
        for at in range(0, max(0, len(values) - shape.width + 1), PIECE - shape.width):
            part = values[at : at + PIECE - 1]
            if held + len(part) > PIECE:
                yield _runs(parts, shape)
                parts, held = [], 0
            parts.append((doc, at, part))
            held += len(part)
    if parts:
        yield _runs(parts, shape)


def _runs(parts: list[tuple[int, int, np.ndarray]], shape: Shape) -> Piece:
    width, span = shape.width, shape.width - shape.gram + 1
    values = np.concatenate([p[2] for p in parts])
    sizes = np.array([len(p[2]) for p in parts])
    at = np.cumsum(sizes) - sizes
    rolling = Rolling(values)
    grams = rolling.grams(shape.gram)
    bits = np.uint64((1 << (PIECE.bit_length())) - 1)
    least = (grams & ~bits) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while 2 * step <= span:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < span:
        least = np.minimum(least[: len(least) - (span - step)], least[span - step :])
    anchor = (least & bits).astype(np.int64)
    inside = np.zeros(len(values) + 1, np.int8)
    np.add.at(inside, at, 1)
    np.add.at(inside, at + np.maximum(sizes - width + 1, 0), -1)
    inside = np.cumsum(inside[: len(anchor)], dtype=np.int8).astype(bool)
    cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])) + 1
    start, end = np.concatenate([[0], cut]), np.append(cut, len(anchor))
    start, end = start[inside[start]], end[inside[start]]
    part = np.searchsorted(at, start, "right") - 1
    anchors = anchor[start]
    whole = together(
        rolling.stretches(start, end - 1 + width),
        ((anchors - start) << 32 | (end - start)).astype(np.uint64),
    )
    docs = np.array([p[0] for p in parts])[part]
    shift = at[part] - np.array([p[1] for p in parts])[part]
    return Piece(rolling, docs, shift, start, end, grams[anchors], whole)


def _orders(ids: pa.Array) -> np.ndarray:
    """The documents' ids as they compare; null last."""
    return np.asarray(ids.fill_null(LAST))


def _unique(keys: np.ndarray, orders: np.ndarray | None) -> tuple:
    """Distinct keys with their counts and least orders."""
    if orders is None:
        return (*np.unique(keys, return_counts=True), None)
    by = np.lexsort((orders, keys))
    first = np.flatnonzero(np.diff(keys[by], prepend=keys[by][:1] ^ np.uint64(1)) != 0) if len(keys) else by
    return keys[by][first], np.diff(np.append(first, len(keys))), orders[by][first]


def _ask_runs(shape: Shape, owners: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data")):
                ids, texts = unpacked(data.as_py())
                orders = _orders(ids) if shape.earlier_only else None
                keys, who = [], []
                for piece in pieces(texts, shape):
                    keys += [piece.grams, piece.whole]
                    who += [piece.docs, piece.docs]
                if keys:
                    asked = _unique(np.concatenate(keys), None if orders is None else orders[np.concatenate(who)])
                    yield request_batch([request(block, *asked, owners)])

    return ask


class _Settled:
    """What the first answers say about the runs of a block: repeated for sure, or to be looked at."""

    def __init__(self, ids: pa.Array, texts: list[bytes], answers: pa.Table, shape: Shape, owners: int):
        self.orders = _orders(ids)
        self.pieces = lambda: pieces(texts, shape)
        found = [np.concatenate([p.grams, p.whole]) for p in self.pieces()]
        self.keys = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
        self.totals, self.first = totals_of(self.keys, answers, owners)
        self.earlier_only = shape.earlier_only
        # The run that stands for its equals in this block: that of the first document, leftmost.
        if found:
            whole = [(p.whole, self.orders[p.docs], p.docs, p.start - p.shift) for p in self.pieces()]
            w, o, d, s = (np.concatenate(x) for x in zip(*whole))
            by = np.lexsort((s, d, o, w))
            self.leader = np.zeros(len(w), bool)
            self.leader[by[np.flatnonzero(np.diff(w[by], prepend=w[by][:1] ^ np.uint64(1)) != 0)]] = True

    def __iter__(self) -> Iterator[tuple[Piece, np.ndarray, np.ndarray]]:
        """Each piece with masks of its runs: repeated for sure, and to be looked at window by window."""
        seen = 0
        for piece in self.pieces():
            gram = self.totals[np.searchsorted(self.keys, piece.grams)]
            at = np.searchsorted(self.keys, piece.whole)
            again, lead = self.totals[at] > 1, self.leader[seen : seen + len(piece.whole)] & self.first[at]
            seen += len(piece.whole)
            sure = again & ~lead if self.earlier_only else again
            yield piece, sure, lead & (gram > self.totals[at])


def _windows(piece: Piece, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the windows of the chosen runs, and the run of each."""
    at = np.flatnonzero(runs)
    sizes = (piece.end - piece.start)[at]
    run = np.repeat(at, sizes)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    return piece.start[run] + np.arange(len(run)) - first, run


def _ask_windows(shape: Shape, run_owners: int, owners: int):
    def ask(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        for block, data in zip(blocks["block"].to_pylist(), blocks["data"]):
            settled = _Settled(*unpacked(data.as_py()), answers, shape, run_owners)
            keys, who = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for piece, _, open_runs in settled:
                place, run = _windows(piece, open_runs)
                if len(place):
                    keys.append(shape.identify(piece.rolling)[place])
                    who.append(settled.orders[piece.docs[run]])
            asked = _unique(np.concatenate(keys), np.concatenate(who) if shape.earlier_only else None)
            rows.append(request(block, *asked, owners))
        return pa.Table.from_batches([request_batch(rows)])

    return ask


def _apply(shape: Shape, run_owners: int, owners: int, finish):
    def apply(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        second = pa.compute.equal(answers["level"], 2)
        for data in blocks["data"]:
            ids, texts = unpacked(data.as_py())
            runs = answers.filter(pa.compute.invert(second))
            settled = _Settled(ids, texts, runs, shape, run_owners)
            spans, opened = [], []
            for piece, sure, open_runs in settled:
                spans.append((piece.docs[sure], (piece.start - piece.shift)[sure], (piece.end - piece.shift)[sure]))
                place, run = _windows(piece, open_runs)
                if len(place):
                    opened.append((shape.identify(piece.rolling)[place], piece.docs[run], place - piece.shift[run]))
            if opened:
                keys, docs, place = (np.concatenate(x) for x in zip(*opened))
                distinct = np.unique(keys)
                totals, first = totals_of(distinct, answers.filter(second), owners)
                at = np.searchsorted(distinct, keys)
                again = totals[at] > 1
                if shape.earlier_only:
                    by = np.lexsort((place, docs, settled.orders[docs], keys))
                    lead = np.zeros(len(keys), bool)
                    lead[by[np.flatnonzero(np.diff(keys[by], prepend=keys[by][:1] ^ np.uint64(1)) != 0)]] = True
                    again &= ~(lead & first[at])
                spans.append((docs[again], place[again], place[again] + 1))
            docs, start, end = (np.concatenate(x) for x in zip(*spans)) if spans else (np.zeros(0, np.int64),) * 3
            out.append(finish(ids, texts, docs, start, end - 1 + shape.width))
        return pa.concat_tables(out)

    return apply


def union(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches that touch or overlap joined into maximal ones."""
    by = np.argsort(start, kind="stable")
    start, reach = start[by], np.maximum.accumulate(end[by])
    new = np.append(True, start[1:] > reach[:-1])
    return start[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)]


def per_document(n: int, docs: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The maximal stretches of each of n documents."""
    by = np.argsort(docs, kind="stable")
    cuts = np.searchsorted(docs[by], np.arange(n + 1))
    none = np.zeros(0, np.int64)
    for i, j in zip(cuts[:-1], cuts[1:]):
        yield union(start[by[i:j]], end[by[i:j]]) if j > i else (none, none)


def removed(blocks: Saved, shape: Shape, finish, schema: str, scratch: Scratch) -> DataFrame:
    """What ``finish(ids, texts, docs, start, end)`` makes of each block and the stretches to remove, saved."""
    size = blocks.metrics["size"] or 0
    # Runs are at least a fortieth of the values; windows that stay open are at most as many as the values.
    run_owners = max(1, -(-(size // 20) // OWNER_KEYS))
    owners = max(1, -(-(size // 12) // OWNER_KEYS))
    blobs = blocks.df.select("block", "data")
    runs = scratch.save(answered(blobs.mapInArrow(_ask_runs(shape, run_owners), REQUEST)))
    asked = blobs.groupBy("block").cogroup(runs.df.groupBy("block")).applyInArrow(
        _ask_windows(shape, run_owners, owners), REQUEST
    )
    windows = scratch.save(answered(asked))
    answers = runs.df.withColumn("level", F.lit(1)).unionByName(windows.df.withColumn("level", F.lit(2)))
    return scratch.save(
        blobs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
            _apply(shape, run_owners, owners, finish), schema
        ),
        keep=True,
    ).df
