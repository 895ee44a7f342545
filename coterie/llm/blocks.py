"""Documents packed into blocks of bounded size, for operators that look at texts more than once.

A block is a few megabytes of whole texts, compressed. The table of blocks is written once, so what is numbered
by a document's place in its block stays valid in every later step, whatever is lost or run again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import Saved, Scratch

# Bytes of text in a block, apart from a single longer one.
BLOCK_BYTES = 8 << 20


def _pack(block_bytes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, held, size = TaskContext.get().partitionId(), 0, [], 0

        def out():
            nonlocal count, held, size
            table = pa.Table.from_batches(held).combine_chunks()
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(table)
            row = {
                "block": pa.array([part << 32 | count], pa.int64()), "docs": pa.array([len(table)], pa.int64()),
                "bytes": pa.array([size], pa.int64()), "data": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
            }
            count, held, size = count + 1, [], 0
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column("text").cast(pa.large_binary())), 0))
            start = 0
            for end in range(len(batch)):
                if size and size + lengths[end] > block_bytes:
                    if end > start:
                        held.append(batch.slice(start, end - start))
                    start = end
                    yield out()
                size += int(lengths[end])
            if start < len(batch):
                held.append(batch.slice(start))
        if held:
            yield out()

    return pack


def packed(docs: DataFrame, scratch: Scratch, block_bytes: int = BLOCK_BYTES) -> Saved:
    """``(block, docs, bytes, data)`` of ``docs (doc_id, text)``, saved."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return scratch.save(
        rows.mapInArrow(_pack(block_bytes), "block long, docs long, bytes long, data binary"), size=F.sum("bytes")
    )


def unpacked(data: bytes) -> tuple[pa.Array, list[bytes]]:
    """The ids (null where they were) and the texts as UTF-8, a null one empty."""
    table = pa.ipc.open_stream(data).read_all().combine_chunks()
    texts = table["text"].cast(pa.large_binary()).to_pylist()
    return table["doc_id"].combine_chunks(), [t or b"" for t in texts]
