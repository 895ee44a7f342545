"""Removal of repeated byte strings by anchored window hashes; no bucket-pointer refinement.

Windows that share a sampled anchor are a run. The grams of 40 bytes at anchors and the whole runs are counted over the corpus by their
hashes: a run that occurs twice as a whole is repeated, one whose gram occurs nowhere else is done. Only in the runs left
open are single windows counted, by a hash of all 200 bytes. That hash is put together from those of 40, 80 and 160
bytes, which is arithmetic inside a block: these lengths are neither sorted nor looked up. Owners of ranges of the
64-bit hashes count them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..plans.scratch import Scratch
from .blocks import packed
from .repeats import Rolling, Shape, per_document, removed, together

WIDTH = 200
GRAM = 40


def _read(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8).astype(np.uint64) + np.uint64(1)


def _identify(width: int, gram: int):
    def identify(rolling: Rolling) -> np.ndarray:
        """Identifiers of the strings of ``width`` bytes at all offsets, by doubling from the grams."""
        grams = ids = rolling.grams(gram)
        length = gram
        while 2 * length <= width:
            ids = together(ids[:-length], ids[length:])
            length *= 2
        while length < width:
            more = min(gram, width - length)
            # The last gram may overlap what is there already.
            ids = together(ids[: len(grams) - (length + more - gram)], grams[length + more - gram :])
            length += more
        return ids

    return identify


def _finish(ids: pa.Array, texts: list[bytes], docs: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
    gone, spans, kept = [], [], []
    for text, (s, e) in zip(texts, per_document(len(texts), docs, start, end)):
        gone.append(int((e - s).sum()))
        spans.append(len(s))
        digest, at = hashlib.sha256(), 0
        for i, j in zip(s.tolist(), e.tolist()):
            digest.update(text[at:i])
            at = j
        digest.update(text[at:])
        kept.append(digest.hexdigest())
    return pa.table({
        "doc_id": ids, "n_bytes": pa.array([len(t) for t in texts], pa.int64()), "n_removed": pa.array(gone, pa.int64()),
        "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(kept, pa.string()),
    })


def _spans(ids: pa.Array, texts: list[bytes], docs: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Table:
    found = list(per_document(len(texts), docs, start, end))
    place = np.repeat(np.arange(len(texts)), [len(s) for s, _ in found])
    return pa.table({
        "doc_id": ids.take(pa.array(place)),
        "start": pa.array(np.concatenate([s for s, _ in found] or [place]), pa.int64()),
        "end": pa.array(np.concatenate([e for _, e in found] or [place]), pa.int64()),
    })


def suffix_dedup(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``, one row for each row of ``docs (doc_id, text)``.

    Every byte goes that lies in a string of ``width`` bytes which starts anywhere else too, in this or another
    row, overlaps included. Texts shorter than that, null and empty ones lose nothing; of rows that are there twice
    both lose everything long enough. Other columns are ignored.
    """
    return _run(docs, width, gram, _finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``(doc_id, start, end)``: the maximal stretches of bytes that suffix_dedup() removes."""
    return _run(docs, width, gram, _spans, "doc_id long, start long, end long")


def _run(docs: DataFrame, width: int, gram: int, finish, schema: str) -> DataFrame:
    if not 0 < gram <= width:
        raise ValueError("gram must be between 1 and width")
    with Scratch(docs.sparkSession) as scratch:
        shape = Shape(width, gram, _read, _identify(width, gram), earlier_only=False)
        return removed(packed(docs, scratch), shape, finish, schema, scratch)
