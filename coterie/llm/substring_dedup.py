"""Removal of word windows that occur earlier, by level-wise doubling.

Windows of a short length are looked up first, and only windows both of whose halves were found twice are looked up at
twice that length, until the full length is reached or no candidates survive; see ``levels``. With 20 words the lengths are 5, 10 and 20,
with 80 they are 5, 10, 20, 40 and 80.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..plans.scratch import Scratch
from .blocks import packed
from .levels import later_windows_removed
from .repeats import PIECE, _UP, _DOWN, per_document, together

WINDOW = 20
# Bytes from which a word has a cryptographic hash. Sums over bytes take some built words of 1,024 letters and more for one.
_LONG_WORD = 256
# Bytes of a word, about; only sizes follow from it.
_WORD_BYTES = 4
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def _word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words between white space start and end, in bytes."""
    white = np.concatenate([[True], _WHITE[np.frombuffer(text, np.uint8)], [True]])
    edges = np.flatnonzero(white[1:] != white[:-1])
    return edges[::2], edges[1::2]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word: from sums over its bytes, a piece of the text at a time, and by BLAKE2 for long words."""
    start, end = _word_places(text)
    if not len(start):
        return np.zeros(0, np.uint64)
    out = np.empty(len(start), np.uint64)
    raw = np.frombuffer(text, np.uint8)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + PIECE, "right")))
        low, high = int(start[at]), int(end[to - 1])
        if high - low <= PIECE:  # else it is one long word
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum((raw[low:high].astype(np.uint64) + np.uint64(1)) * _UP[: high - low], out=sums[1:])
            s, e = start[at:to] - low, end[at:to] - low
            out[at:to] = together((sums[e] - sums[s]) * _DOWN[s], (e - s).astype(np.uint64))
        at = to
    for k in np.flatnonzero(end - start >= _LONG_WORD).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(text[start[k] : end[k]], digest_size=8).digest(), "little")
    return out


def _kept(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple[int, int, bytes]:
    """Number of words, words removed, and the other words joined by spaces."""
    words = text.split()
    kept, at = [], 0
    for i, j in zip(start.tolist(), end.tolist()):
        kept += words[at:i]
        at = j
    kept += words[at:]
    return len(words), len(words) - len(kept), b" ".join(kept)


def _finish(ids: pa.Array, texts: list[bytes], docs: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
    rows = [_kept(t, s, e) for t, (s, e) in zip(texts, per_document(len(texts), docs, start, end))]
    return pa.table({
        "doc_id": ids, "n_words": pa.array([r[0] for r in rows], pa.int64()),
        "n_removed": pa.array([r[1] for r in rows], pa.int64()),
        "kept_sha256": pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string()),
    })


def _texts(ids: pa.Array, texts: list[bytes], docs: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
    rows = [_kept(t, s, e) for t, (s, e) in zip(texts, per_document(len(texts), docs, start, end))]
    return pa.table({"doc_id": ids, "text": pa.array([r[2].decode("utf-8", "surrogatepass") for r in rows], pa.string())})


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)``, one row for each row of ``docs (doc_id, text)``.

    A word goes when it lies in a window of ``window`` words whose words also start earlier: in a document with a
    smaller id (a null id is the greatest; of equal ids the one that is read first), or before it in the same one.
    Texts with fewer words, null and empty ones lose nothing. Other columns are ignored.
    """
    return _run(docs, window, _finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, text)``: the words that substring_dedup() keeps, joined by spaces."""
    return _run(docs, window, _texts, "doc_id long, text string")


def _run(docs: DataFrame, window: int, finish, schema: str) -> DataFrame:
    if window < 2:
        raise ValueError("window must be at least 2")
    with Scratch(docs.sparkSession) as scratch:
        return later_windows_removed(packed(docs, scratch), window, word_hashes, _WORD_BYTES, finish, schema, scratch)
