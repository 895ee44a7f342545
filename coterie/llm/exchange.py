"""Totals of 64-bit keys over all blocks, by an exchange of compressed sorted lists.

A block sends each of its distinct keys once, with its own count, to the key's owner: an equal share of the key
range. Owners add up and answer in the order in which they were asked, so keys are not sent back. A key that
fills a third of all rows is one entry per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .exact_dedup import _by_owner, golomb_decode, golomb_encode

# Keys that an owner should receive.
OWNER_KEYS = 2_000_000
REQUEST = "block long, owner long, code binary, counts binary, orders binary"
ANSWER = "block long, owner long, totals binary, first binary"
LAST = np.iinfo(np.int64).max


def squeeze(values: np.ndarray) -> bytes:
    """An array of integers, compressed by byte planes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def expand(code: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(code), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def request(block: int, keys: np.ndarray, counts: np.ndarray, orders: np.ndarray | None, owners: int) -> dict:
    """Columns of the rows that ask for ascending distinct ``keys``; ``orders`` says who comes first."""
    owner = _by_owner(keys, owners)
    to, first = np.unique(owner, return_index=True)
    cuts = list(zip(first, [*first[1:], len(keys)]))
    return {
        "block": [block] * len(to), "owner": to.tolist(),
        "code": [golomb_encode(keys[i:j]) for i, j in cuts],
        "counts": [squeeze(counts[i:j].astype(np.uint32)) for i, j in cuts],
        "orders": [None if orders is None else squeeze(orders[i:j].astype(np.int64)) for i, j in cuts],
    }


def request_batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"block": pa.int64(), "owner": pa.int64()}
    names = ("block", "owner", "code", "counts", "orders")
    return pa.RecordBatch.from_pydict(
        {n: pa.array([x for r in rows for x in r[n]], kinds.get(n, pa.binary())) for n in names}
    )


def _answer(table: pa.Table) -> pa.Table:
    keys = [golomb_decode(c) for c in table["code"].to_pylist()]
    counts = np.concatenate([expand(c, np.uint32) for c in table["counts"].to_pylist()]).astype(np.int64)
    sizes = [len(k) for k in keys]
    blocks = np.repeat(table["block"].to_numpy(), sizes)
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    # Sums of a whole corpus; their upper bytes are mostly zeros, which cost little.
    totals = np.bincount(place, counts, len(every)).astype(np.int64)[place]
    coded = table["orders"].to_pylist()
    orders = np.zeros(len(place), np.int64) if coded[0] is None else np.concatenate([expand(c, np.int64) for c in coded])
    # The first asker of each key: by its order, then by its block.
    by = np.lexsort((blocks, orders, place))
    first = np.zeros(len(place), np.uint8)
    first[by[np.flatnonzero(np.diff(place[by], prepend=-1))]] = 1
    cuts = np.cumsum(sizes)[:-1]
    return pa.table({
        "block": table["block"], "owner": table["owner"],
        "totals": pa.array([squeeze(x) for x in np.split(totals, cuts)], pa.binary()),
        "first": pa.array([np.packbits(x).tobytes() for x in np.split(first, cuts)], pa.binary()),
    })


def answered(requests: DataFrame) -> DataFrame:
    return requests.groupBy("owner").applyInArrow(_answer, ANSWER)


def totals_of(keys: np.ndarray, answers: pa.Table, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """The totals of the ascending ``keys``, and whether this block is the first to hold each."""
    totals, first = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    owner = _by_owner(keys, owners)
    starts = dict(zip(*(x.tolist() for x in np.unique(owner, return_index=True))))
    for to, code, bits in zip(*(answers[n].to_pylist() for n in ("owner", "totals", "first"))):
        got = expand(code, np.int64)
        at = slice(starts[to], starts[to] + len(got))
        totals[at] = got
        first[at] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(got)).astype(bool)
    return totals, first
