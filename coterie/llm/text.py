"""Column expressions on document texts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of the contracts: [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def whole(text: str | Column = "text") -> Column:
    """The text, a null one as an empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lowered(text: Column) -> Column:
    """With A-Z in lower case; other letters stay as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def without_white(text: Column) -> Column:
    return F.translate(text, WHITE, "")


def words(text: Column) -> Column:
    """The words between white space, in order; an empty array for a text without any."""
    bare = F.trim(text, F.lit(WHITE))
    # One blank between words is the usual case, and splitting at a plain character is fast.
    odd = F.contains(bare, F.lit("  "))
    for c in WHITE[1:]:
        odd = odd | F.contains(bare, F.lit(c))
    return (
        F.when(bare == "", F.array().cast("array<string>"))
        .when(odd, F.split(bare, "[\\x20\\x09-\\x0D]+")).otherwise(F.split(bare, " "))
    )


def n_words(text: Column) -> Column:
    """Number of words, without building them: the gaps between words and one more."""
    bare = F.trim(text, F.lit(WHITE))
    gaps = F.length(F.regexp_replace(bare, "[\\x20\\x09-\\x0D]+", " ")) - F.length(
        without_white(bare)
    )
    return F.when(bare == "", F.lit(0)).otherwise(gaps + 1).cast("long")


def packed_rows(docs: DataFrame) -> DataFrame:
    """``(id, sha, tie, row)``: each row whole, in one column, so that no name of its own columns can clash.

    ``sha`` is the SHA-256 of its text (a null one as empty), ``tie`` a hash of all other columns.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    others = [c for c, (name, kind) in zip(columns, docs.dtypes) if name != "text" and "map<" not in kind]
    return docs.select(
        F.col("doc_id").cast("long").alias("id"), F.sha2(whole(), 256).alias("sha"), F.xxhash64(*others).alias("tie"),
        F.struct(*columns).alias("row"),
    )


def same_rows(docs: DataFrame, decisions: DataFrame, once: bool = False) -> DataFrame:
    """The rows of ``docs`` whose ``(doc_id, text)`` is in ``decisions (keep_doc, keep_sha)``.

    Texts are compared by SHA-256, so two rows that share an id but not a text are told apart. With
    ``once`` a row that is there several times stays once: of rows with equal id and text the one with the least
    hash of its other columns. All columns of ``docs`` are returned, whatever their names.
    """
    marked = packed_rows(docs)
    joined = marked.join(
        decisions.distinct(), marked["id"].eqNullSafe(F.col("keep_doc")) & (marked["sha"] == F.col("keep_sha")), "left_semi"
    )
    if once:
        joined = joined.groupBy("id", "sha").agg(F.min_by("row", "tie").alias("row"))
    return joined.select("row.*")
