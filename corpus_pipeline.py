"""From raw documents to token ids in five stages, each written and read again by the next.

Every stage takes ``(spark, docs, sf_dir)`` and decides on all rows it is given. All but the last return the columns of
``docs`` (``doc_id``, ``text``, ``source`` and any others, whatever their names); rows are told apart by id and text. A null text is an
empty one, a null id and a null source are values of their own, and an empty table gives an empty result. Of rows
that are equal in all that a stage looks at, the one with the least hash of the other columns stands for all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coterie.llm.bpe import encode
from coterie.llm.exact_dedup import exact_dedup
from coterie.llm.mixing import mix
from coterie.llm.quality import quality
from coterie.llm.queries import tokenizer_path
from coterie.llm.simhash import simhash_dedup
from coterie.llm.text import documents, packed_rows, same_rows
from coterie.plans.scratch import Scratch


def _keys(decisions: DataFrame) -> DataFrame:
    return decisions.select(F.col("doc_id").alias("keep_doc"), F.col("raw_sha256").alias("keep_sha"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, null and empty texts among them; rows that are there twice are judged alike and both stay."""
    return same_rows(docs, _keys(quality(docs, with_raw=True).where("kept")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays: the longest, then that with the smallest id (a null id last); empty texts are one group."""
    return same_rows(docs, _keys(exact_dedup(docs, with_raw=True).where("kept")), once=True)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the smallest id stays (a null id last, equal ids by their text)."""
    grouped = simhash_dedup(docs, with_raw=True)
    stays = grouped.groupBy("community").agg(
        F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "raw_sha256")).alias("one")
    )
    return same_rows(docs, _keys(stays.select("one.doc_id", "one.raw_sha256")), once=True)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is there as often as the mix takes it; those not taken go, and so do texts without words."""
    taken = (
        mix(docs, with_raw=True).where("copies > 0").groupBy("doc_id", "raw_sha256", "source").agg(F.sum("copies").alias("copies"))
        .select(F.col("doc_id").alias("of"), F.col("raw_sha256").alias("raw"), F.col("source").alias("from"), "copies")
    )
    # One of each group of rows with equal id, text and source; their copies are summed.
    alike = packed_rows(docs).groupBy("id", "sha", F.col("row.source").alias("source")).agg(F.min_by("row", "tie").alias("row"))
    joined = alike.join(
        taken, F.col("id").eqNullSafe(F.col("of")) & (F.col("sha") == F.col("raw")) & F.col("source").eqNullSafe(F.col("from"))
    )
    return joined.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids)``: ids as little-endian unsigned 32-bit integers.

    The operator runs whole: each text is encoded and decoded again. The text that the ids decode to follows from them and is not a column here.
    """
    return encode(docs, tokenizer_path()).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids"
    )


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing sources", mixed_sources),
    ("BPE encoding", token_ids),
]

# The mix samples by a hash and BPE merges by rank: SQL has no form for either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = documents(spark, sf_dir)
    with Scratch(spark) as scratch:
        for name, stage in STAGES:
            docs = scratch.save(stage(spark, docs, sf_dir), keep=name == STAGES[-1][0]).df
        return docs
