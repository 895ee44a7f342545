"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Every sender (a stretch of the saved keys) sorts its distinct 64-bit fingerprints, cuts them by owner, an
equal share of the fingerprint range, and sends the gaps as a Golomb-Rice code. The owner merges the lists
of all senders and answers each with one bit per fingerprint: seen more than once, or not. Only rows
with a set bit, the suspects, have their texts shuffled and compared byte by byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import Saved, Scratch
from .text import whole, without_white

# Rows of one sender, and fingerprints that one owner should receive.
SENDER_ROWS = 100_000
OWNER_KEYS = 500_000


def golomb_encode(values: np.ndarray) -> bytes:
    """Ascending distinct unsigned 64-bit values as a Rice code of their gaps.

    The unary quotients and the fixed-width remainders are kept in two streams, so that both can be
    decoded without a loop over the values.
    """
    if not len(values):
        return b""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    gaps[0] = 0
    width = max(0, int(float(gaps.sum(dtype=np.float64)) / len(values) + 1).bit_length() - 1)
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + len(values), np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    shifts = np.arange(width, dtype=np.uint64)[::-1]
    rests = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8) if width else np.zeros(0, np.uint8)
    head = np.array([len(values), width, len(unary), values[0]], np.uint64).tobytes()
    return head + np.packbits(unary).tobytes() + np.packbits(rests.ravel()).tobytes()


def golomb_decode(code: bytes) -> np.ndarray:
    if not code:
        return np.zeros(0, np.uint64)
    n, width, n_unary, first = (int(x) for x in np.frombuffer(code, np.uint64, 4))
    cut = 32 + -(-n_unary // 8)
    unary = np.unpackbits(np.frombuffer(code[32:cut], np.uint8), count=n_unary)
    quotients = np.diff(np.flatnonzero(unary), prepend=-1) - 1
    gaps = quotients.astype(np.uint64) << np.uint64(width)
    if width:
        rests = np.unpackbits(np.frombuffer(code[cut:], np.uint8), count=n * width).reshape(n, width)
        for j in range(width):
            gaps |= rests[:, j].astype(np.uint64) << np.uint64(width - 1 - j)
    gaps[0] = first
    return np.cumsum(gaps, dtype=np.uint64)


def _by_owner(fingerprints: np.ndarray, owners: int):
    """The owner of each of the sorted fingerprints: equal shares of the 64-bit range."""
    share = np.uint64(min((1 << 64) - 1, (1 << 64) // owners + 1))
    return (fingerprints // share).astype(np.int64)


def _send(owners: int):
    def send(key: tuple, table: pa.Table) -> pa.Table:
        seen, held = np.unique(table["fp"].to_numpy().astype(np.int64).view(np.uint64), return_counts=True)
        owner = _by_owner(seen, owners)
        to, first = np.unique(owner, return_index=True)
        ends = [*first[1:], len(seen)]
        return pa.table({
            "owner": pa.array(to, pa.int64()),
            "sender": pa.array([key[0].as_py()] * len(to), pa.int64()),
            "code": pa.array([golomb_encode(seen[i:j]) for i, j in zip(first, ends)], pa.binary()),
            # Found twice by the sender itself already.
            "twice": pa.array([np.packbits(held[i:j] > 1).tobytes() for i, j in zip(first, ends)], pa.binary()),
        })

    return send


def _answer(table: pa.Table) -> pa.Table:
    lists = [golomb_decode(code) for code in table["code"].to_pylist()]
    twice = [np.unpackbits(np.frombuffer(b, np.uint8), count=len(v)) for b, v in zip(table["twice"].to_pylist(), lists)]
    every = np.concatenate(lists)
    _, place, held = np.unique(every, return_inverse=True, return_counts=True)
    heavy = (held > 1) | (np.bincount(place, np.concatenate(twice), len(held)) > 0)
    cuts = np.cumsum([len(v) for v in lists])[:-1]
    return pa.table({
        "sender": table["sender"], "owner": table["owner"],
        "bits": pa.array([np.packbits(x).tobytes() for x in np.split(heavy[place], cuts)], pa.binary()),
    })


def _suspects(owners: int):
    def suspects(keys: pa.Table, answers: pa.Table) -> pa.Table:
        fp = keys["fp"].to_numpy().astype(np.int64).view(np.uint64)
        seen, place = np.unique(fp, return_inverse=True)
        owner = _by_owner(seen, owners)
        heavy = np.zeros(len(seen), bool)
        for to, bits in zip(answers["owner"].to_pylist(), answers["bits"].to_pylist()):
            at = np.flatnonzero(owner == to)
            heavy[at] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(at)).astype(bool)
        return keys.filter(pa.array(heavy[place]))

    return suspects


def suspects(keys: Saved) -> DataFrame:
    """The rows of ``keys (sender, fp, ...)`` whose fingerprint occurs more than once anywhere."""
    owners = max(1, -(-keys.rows // OWNER_KEYS))
    sent = keys.df.select("sender", "fp").groupBy("sender").applyInArrow(
        _send(owners), "owner long, sender long, code binary, twice binary"
    )
    answers = sent.groupBy("owner").applyInArrow(_answer, "sender long, owner long, bits binary")
    return keys.df.groupBy("sender").cogroup(answers.groupBy("sender")).applyInArrow(
        _suspects(owners), keys.df.schema
    )


def exact_dedup(docs: DataFrame, with_raw: bool = False) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row for each row of ``docs (doc_id, text)``.

    Texts are equal when they are the same without white space; null counts as empty, and all empty
    texts are one group. The row with the most code points stays, then the smallest id (a null id
    last), then the first of fully equal rows. Other columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with Scratch(spark) as scratch:
        text = whole()
        bare = without_white(text)
        rows = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.length(text).cast("long").alias("points"),
            F.xxhash64(bare).alias("fp"), F.sha2(bare, 256).alias("text_sha256"), F.sha2(text, 256).alias("raw_sha256"),
            F.monotonically_increasing_id().alias("row"),
        )
        part = F.shiftleft(F.shiftright("row", 33), 33)
        sender = part + F.floor((F.col("row") - part) / SENDER_ROWS)
        keys = scratch.save(rows.withColumn("sender", sender), keep=True)
        suspected = scratch.save(suspects(keys.select("sender", "fp", "doc_id", "text_sha256")))

        # Byte verification: identical texts meet in the partial aggregation, so a text with very many
        # copies is sent once per task.
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), bare.alias("bare")).withColumn(
            "text_sha256", F.sha2("bare", 256)
        )
        asked = suspected.df.select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha")).distinct()
        # Always by a shuffle: how many suspects there are follows the input, so they are not broadcast.
        compared = texts.hint("merge").join(
            asked, texts["doc_id"].eqNullSafe(asked["id"]) & (texts["text_sha256"] == asked["sha"]), "left_semi"
        )
        verified = scratch.save(
            compared.groupBy(F.xxhash64("bare").alias("fp"), "text_sha256", "bare").agg(F.count(F.lit(1)).alias("copies"))
            .groupBy("fp", "text_sha256").agg(F.count(F.lit(1)).alias("texts"), F.sum("copies").alias("copies"))
            .where("copies > 1"),
            unlike=F.max("texts"),
        )
        if (verified.metrics["unlike"] or 1) > 1:
            raise ValueError("two different texts have the same SHA-256")
        # The greatest struct: most code points, then smallest id (a null is least; turned bits cannot overflow), then first row.
        rank = F.max(F.struct("points", F.bitwise_not("doc_id").alias("neg"), F.bitwise_not("row").alias("back"), "doc_id", "row"))
        # Summed before the shuffle, so that a group with very many copies is a row per task.
        groups = (
            keys.df.groupBy("fp", "text_sha256").agg(F.count(F.lit(1)).alias("held"), rank.alias("best"))
            .where("held > 1").join(verified.df.select("fp", "text_sha256"), ["fp", "text_sha256"], "left_semi")
        )
        groups = scratch.save(groups, keep=True)
        out = keys.df.join(groups.df, ["fp", "text_sha256"], "left")
        return out.select(
            "doc_id",
            F.when(F.col("held").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
            F.coalesce("held", F.lit(1)).cast("long").alias("group_size"),
            (F.col("held").isNull() | (F.col("best.row") == F.col("row"))).alias("kept"),
            "text_sha256", *(["raw_sha256"] if with_raw else []),
        )
