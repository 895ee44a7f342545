"""Windows of values that occur more than once, by doubling their length level by level.

The windows of a short length are looked up in the whole corpus first. Only a window both of whose halves were found
twice is looked up at the next level, twice as long (the halves overlap where the length is odd), until the full length is reached or
no candidates survive. What is open at a level is kept beside the question as a bit for each place, so no earlier answer is read again.

Below the full length it does no harm to take two windows for one, so keys are cut to a few bits more than are needed to tell the windows
of the corpus apart. Each owner of a stretch of the keys marks what it is asked for in a table of fixed size and answers with a bit for a key:
found twice or not. At the full length keys have 64 bits and owners say who has the first of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import Saved, Scratch
from .blocks import unpacked
from .exchange import ANSWER, LAST, OWNER_KEYS, REQUEST, answered, request, request_batch, totals_of
from .repeats import mixed, together

# A first level is at most this long.
SHORTEST = 8
# Values looked at together; longer documents are cut into parts.
PIECE = 1 << 21
# Keys of an owner at a level below the last: the size of its table in bytes is two to this power.
_SLOTS = 26
# Keys are this many bits longer than the number of values asks for. One in 2 to the power of it is taken for repeated by
# chance, but only two such neighbours pass a level.
_SPARE = 4
# A block and the number of a piece in it make a sender.
_PIECES = 11
_STATE = -1
_BASE = np.uint64(0x9E3779B97F4A7C15)


def lengths_to(width: int) -> list[int]:
    """The lengths of all levels, each at least half of the next."""
    out = [width]
    while out[0] > SHORTEST:
        out.insert(0, -(-out[0] // 2))
    return out


@dataclass(frozen=True)
class Levels:
    """The lengths, how to read the values of a text, bits of a key below the last level, owners at the last."""

    lengths: list[int]
    read: Callable[[bytes], np.ndarray]
    bits: int
    owners: int

    @property
    def last(self) -> int:
        return len(self.lengths) - 1


@dataclass(frozen=True)
class Piece:
    """Documents, or a part of one, that are looked at together."""

    values: np.ndarray
    docs: np.ndarray  # place of the document of each part in the block
    at: np.ndarray  # where each part starts in the piece
    sizes: np.ndarray
    shift: np.ndarray  # where the document's value 0 would be in the piece

    def names(self, lengths: list[int]) -> np.ndarray:
        """Identifiers of the windows of the last of ``lengths`` at all places, each from the two windows of the level before."""
        n = len(self.values) - lengths[0] + 1
        ids = self.values[:n]
        for k in range(1, lengths[0]):
            ids = ids * _BASE + self.values[k : n + k]
        ids = mixed(ids)
        for short, long in pairwise(lengths):
            ids = together(ids[: len(ids) - (long - short)], ids[long - short :])
        return ids

    def inside(self, length: int) -> np.ndarray:
        """Whether the window of a place ends in the part in which it starts."""
        turns = np.zeros(len(self.values) + 1, np.int8)
        np.add.at(turns, self.at, 1)
        np.add.at(turns, self.at + self.sizes - length + 1, -1)
        return np.cumsum(turns[: len(self.values) - length + 1], dtype=np.int8).astype(bool)

    def parts(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.at, places, "right") - 1


def _piece(parts: list[tuple[int, int, np.ndarray]]) -> Piece:
    sizes = np.array([len(p[2]) for p in parts])
    at = np.cumsum(sizes) - sizes
    return Piece(
        np.concatenate([p[2] for p in parts]), np.array([p[0] for p in parts]), at, sizes,
        at - np.array([p[1] for p in parts]),
    )


def pieces(texts: list[bytes], levels: Levels) -> Iterator[Piece]:
    """The texts of a block with a window at least, a bounded number of values at a time, in a fixed order.

    Parts of a long text overlap by less than a window, so each window of the full length is in one piece; a shorter one may be
    counted in two, which only keeps it open.
    """
    width = levels.lengths[-1]
    parts, held = [], 0
    for doc, text in enumerate(texts):
        values = levels.read(text)
        for at in range(0, max(0, len(values) - width + 1), PIECE - width):
            part = values[at : at + PIECE - 1]
            if held + len(part) > PIECE:
                yield _piece(parts)
                parts, held = [], 0
            parts.append((doc, at, part))
            held += len(part)
    if parts:
        yield _piece(parts)


def _pack(values: np.ndarray) -> bytes:
    """Ascending distinct numbers below 2^26: upper bits in unary, two lower bytes as they are."""
    high = (values >> np.uint64(16)).astype(np.int64)
    unary = np.zeros(len(values) + int(high[-1]) + 1, np.uint8)
    unary[high + np.arange(len(values))] = 1
    return len(values).to_bytes(8, "little") + values.astype(np.uint16).tobytes() + np.packbits(unary).tobytes()


def _unpack(code: bytes) -> np.ndarray:
    n = int.from_bytes(code[:8], "little")
    unary = np.unpackbits(np.frombuffer(code, np.uint8, offset=8 + 2 * n))
    high = np.flatnonzero(unary) - np.arange(n)
    return high << 16 | np.frombuffer(code, np.uint16, n, 8)


def _question(sender: int, keys: np.ndarray) -> dict:
    """Columns of the rows that ask whether keys are found twice."""
    seen, held = np.unique(keys, return_counts=True)
    to, first = np.unique(seen >> np.uint64(_SLOTS), return_index=True)
    cuts = list(zip(first, [*first[1:], len(seen)]))
    local = seen & np.uint64((1 << _SLOTS) - 1)
    return {
        "block": [sender] * len(to), "owner": to.astype(np.int64).tolist(), "code": [_pack(local[i:j]) for i, j in cuts],
        "counts": [np.packbits(held[i:j] > 1).tobytes() for i, j in cuts], "orders": [None] * len(to),
    }


def _mark(table: pa.Table) -> pa.Table:
    """The answers of one owner, a list at a time."""
    marks = np.zeros(1 << _SLOTS, np.uint8)
    codes, counts = table["code"], table["counts"]
    for code, twice in zip(codes, counts):
        at = _unpack(code.as_py())
        more = np.unpackbits(np.frombuffer(twice.as_py(), np.uint8), count=len(at))
        marks[at] = np.minimum(marks[at] + 1 + more, 2)
    bits = [np.packbits(marks[_unpack(code.as_py())] > 1).tobytes() for code in codes]
    return pa.table({
        "block": table["block"], "owner": table["owner"], "totals": pa.array(bits, pa.binary()),
        "first": pa.nulls(len(table), pa.binary()),
    })


def _found_twice(keys: np.ndarray, told: pa.Table) -> np.ndarray:
    """Which keys, in any order, the answers to a sender call repeated."""
    seen, place = np.unique(keys, return_inverse=True)
    twice = np.zeros(len(seen), bool)
    to, first, size = np.unique((seen >> np.uint64(_SLOTS)).astype(np.int64), return_index=True, return_counts=True)
    at = dict(zip(to.tolist(), zip(first.tolist(), size.tolist())))
    for owner, bits in zip(told["owner"].to_pylist(), told["totals"].to_pylist()):
        start, n = at[owner]
        twice[start : start + n] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n)
    return twice[place]


def _state(sender: int, open_: np.ndarray) -> dict:
    code = zstandard.ZstdCompressor(level=1).compress(np.packbits(open_).tobytes())
    return {"block": [sender], "owner": [_STATE], "code": [code], "counts": [None], "orders": [None]}


class _Asked:
    """A block at a level: its pieces with what is open there and the names of all windows."""

    def __init__(self, block: int, data: bytes, level: int, levels: Levels, told: pa.Table | None = None):
        self.ids, self.texts = unpacked(data)
        self.orders = np.asarray(self.ids.fill_null(LAST))
        self.block, self.level, self.levels, self.told = block, level, levels, told

    def __iter__(self) -> Iterator[tuple[int, Piece, np.ndarray, np.ndarray, pa.Table | None]]:
        """Sender, piece, names, whether open, and the answers to the sender."""
        lengths = self.levels.lengths[: self.level + 1]
        told = self.told
        senders = None if told is None else told["block"].to_numpy()
        for number, piece in enumerate(pieces(self.texts, self.levels)):
            sender, mine, state = self.block << _PIECES | number, None, None
            open_ = piece.inside(lengths[-1])
            if told is not None:
                mine = told.filter(pa.array(senders == sender))
                is_state = np.asarray(mine["owner"]) == _STATE
                state = mine["totals"].filter(pa.array(is_state)).to_pylist()
                mine = mine.filter(pa.array(~is_state))
            if state:
                raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(state[0]), np.uint8)
                open_ = np.unpackbits(raw, count=len(open_)).astype(bool)
            yield sender, piece, piece.names(lengths), open_, mine

    def question(self, sender: int, piece: Piece, names: np.ndarray, open_: np.ndarray, level: int) -> dict:
        if level < self.levels.last:
            return _question(sender, names[open_] >> np.uint64(64 - self.levels.bits))
        keys, places = names[open_], np.flatnonzero(open_)
        orders = self.orders[piece.docs[piece.parts(places)]]
        by = np.lexsort((orders, keys))
        keys, orders = keys[by], orders[by]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else by
        counts = np.diff(np.append(first, len(keys)))
        return request(sender, keys[first], counts, orders[first], self.levels.owners)


def _ask_first(levels: Levels):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch["block"].to_pylist(), batch["data"]):
                asked = _Asked(block, data.as_py(), 0, levels)
                for sender, piece, names, open_, _ in asked:
                    yield request_batch([asked.question(sender, piece, names, open_, 0)])

    return ask


def _ask_next(level: int, levels: Levels):
    """Apply the answers of the level before, and ask about the windows both of whose halves were found twice."""
    more = levels.lengths[level] - levels.lengths[level - 1]

    def ask(blocks: pa.Table, told: pa.Table) -> pa.Table:
        rows = []
        for block, data in zip(blocks["block"].to_pylist(), blocks["data"]):
            asked = _Asked(block, data.as_py(), level - 1, levels, told)
            for sender, piece, names, open_, mine in asked:
                twice = open_.copy()
                twice[open_] = _found_twice(names[open_] >> np.uint64(64 - levels.bits), mine)
                longer = together(names[: len(names) - more], names[more:])
                open_ = twice[: len(longer)] & twice[more:] & piece.inside(levels.lengths[level])
                rows += [asked.question(sender, piece, longer, open_, level), _state(sender, open_)]
        return pa.Table.from_batches([request_batch(rows)])

    return ask


def _apply(levels: Levels, any_open: bool, finish):
    """Windows that are not the first of their kind, joined to stretches and handed to ``finish``."""
    width = levels.lengths[-1]

    def apply(blocks: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for block, data in zip(blocks["block"].to_pylist(), blocks["data"]):
            asked = _Asked(block, data.as_py(), levels.last, levels, told)
            spans = []
            for _, piece, names, open_, mine in asked if any_open else ():
                places = np.flatnonzero(open_)
                if not len(places):
                    continue
                docs = piece.docs[piece.parts(places)]
                distinct, key = np.unique(names[places], return_inverse=True)
                totals, first = totals_of(distinct, mine, levels.owners)
                # Of equal windows in this piece, that of the first document, leftmost.
                by = np.lexsort((places, docs, asked.orders[docs], key))
                lead = np.zeros(len(key), bool)
                lead[by[np.flatnonzero(np.diff(key[by], prepend=-1))]] = True
                gone = (totals[key] > 1) & ~(lead & first[key])
                start = places[gone] - piece.shift[piece.parts(places[gone])]
                spans.append((docs[gone], start, start + width))
            docs, start, end = (np.concatenate(x) for x in zip(*spans)) if spans else (np.zeros(0, np.int64),) * 3
            out.append(finish(asked.ids, asked.texts, docs, start, end))
        return pa.concat_tables(out)

    return apply


def later_windows_removed(blocks: Saved, width: int, read, value_bytes: int, finish, schema: str, scratch: Scratch) -> DataFrame:
    """What ``finish(ids, texts, docs, start, end)`` makes of each block and its windows that occur earlier, saved.

    ``read`` turns a text into 64-bit values, of about ``value_bytes`` bytes each, from which only the number of bits and of owners follows.
    """
    values = (blocks.metrics["size"] or 0) // value_bytes
    bits = min(64, max(_SLOTS, values.bit_length() + _SPARE))
    levels = Levels(lengths_to(width), read, bits, max(1, values // OWNER_KEYS))
    blobs = blocks.df.select("block", "data")

    def answers(questions: DataFrame, level: int) -> Saved:
        told = answered(questions) if level == levels.last else questions.groupBy("owner").applyInArrow(_mark, ANSWER)
        return scratch.save(told)

    def with_blobs(told: DataFrame, step, out: str) -> DataFrame:
        home = told.withColumn("home", F.shiftright("block", _PIECES))
        return blobs.groupBy("block").cogroup(home.groupBy("home")).applyInArrow(step, out)

    told, any_open = answers(blobs.mapInArrow(_ask_first(levels), REQUEST), 0).df, True
    for level in range(1, len(levels.lengths)):
        asked = scratch.save(with_blobs(told, _ask_next(level, levels), REQUEST), questions=F.count_if(F.col("owner") != _STATE))
        any_open = bool(asked.metrics["questions"])
        if not any_open:
            break
        state = asked.df.where(F.col("owner") == _STATE).selectExpr("block", "owner", "code AS totals", "CAST(NULL AS BINARY) AS first")
        told = answers(asked.df.where(F.col("owner") != _STATE), level).df.unionByName(state)
    return scratch.save(with_blobs(told, _apply(levels, any_open, finish), schema), keep=True).df
