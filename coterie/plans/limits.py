"""Size limits, all read from the session so that a cluster can tune them.

Set ``spark.coterie.<name>`` on the session to change one. None of them changes a result: each
only decides between two exact ways of doing the same work.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    # A table is broadcast only when it was counted and has at most this many rows.
    "broadcastRows": 1_000_000,
    # And only when the files it was saved in hold at most this many bytes, for rows of any width.
    "broadcastBytes": 64 << 20,
    # A key is hot when it holds more than 1/hotKeys of the rows.
    "hotKeys": 10_000,
    # Groups and neighbour lists larger than this are split into blocks of about this size.
    "blockRows": 1_000,
    # The co-affiliation join looks at its prefix filter when the plain join makes more pairs than this a row,
    "pairsPerRow": 100,
    # and uses it when the pairs left, times the items to compare for each of them and this, are fewer. With 0 it always does.
    "prefixGain": 4,
    # From this many pairs of the plain join on, bitmaps of the items are looked at,
    "bitmapPairs": 20_000_000,
    # and used when there are at most this many words of 64 items; generated code grows with them (measured with 12).
    "bitmapWords": 16,
    # Similarity looks at bitmaps of vertex blocks where the neighbour lists that go with the edges have this many values,
    "listValues": 1_000_000_000,
    # and uses them when an edge has at most this many words of 64 vertices for each of these values.
    "wordGain": 1,
    # A block's bitmaps take at most this many bytes; a task holds two blocks.
    "cellBytes": 96 << 20,
    # The lists are shuffled once for each block, up to this many blocks; beyond, one block after another goes to all tasks.
    "cellCopies": 32,
    # Lists of up to this many values are sorted as one array, also where they come in shorter rows.
    "sortedValues": 1_000_000,
    # Betweenness of all sources is searched for in tasks that get the whole graph, compressed, from this many edges on,
    "searchEdges": 500_000,
    # up to this many, of which a task holds some 40 bytes each,
    "taskEdges": 4_000_000,
    # and with at least this many edges a vertex.
    "taskDegree": 8,
    # Work that multiplies its input is spread so that a task makes about this many rows.
    "rowsPerTask": 500_000,
    # Path searches run in batches of sources so that a partition holds about this many states.
    "statesPerPartition": 2_000_000,
}


def limit(spark: SparkSession, name: str) -> int:
    return int(spark.conf.get(f"spark.coterie.{name}", str(DEFAULTS[name])))


def partitions(spark: SparkSession, rows: int) -> int:
    """How many partitions to use for work that yields ``rows`` rows from a smaller input.

    Adaptive execution sizes partitions by their input, which tells nothing about such work. There is no
    ceiling, so that the rows of a task do not grow with the data.
    """
    return max(1, -(-rows // limit(spark, "rowsPerTask")))
