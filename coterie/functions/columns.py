"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def edge_key(a: str, b: str) -> list[Column]:
    """The canonical ``src < dst`` form of an undirected edge."""
    return [F.least(a, b).alias("src"), F.greatest(a, b).alias("dst")]


def both_directions(a: str, b: str, *carried: str) -> Column:
    """Generate an edge row in both directions in one pass over the edges."""
    extra = [F.col(c) for c in carried]
    there = F.struct(F.col(a).alias(a), F.col(b).alias(b), *extra)
    back = F.struct(F.col(b).alias(a), F.col(a).alias(b), *extra)
    return F.inline(F.array(there, back))


def score_line(digits: int | None = None) -> Column:
    """``(a,b,score)``; the score in full, or with a fixed number of decimals."""
    text = F.col("score").cast("string") if digits is None else F.format_string(f"%.{digits}f", "score")
    return F.concat(
        F.lit("("), F.col("src").cast("string"), F.lit(","), F.col("dst").cast("string"), F.lit(","), text, F.lit(")")
    )


def community_line() -> Column:
    """``[v1,v2,...]`` from ``members``; only the ``first`` line opens and only the ``last`` one closes.

    A line that goes on ends in a comma, so joining a community's lines gives its one list.
    """
    members = F.array_join(F.col("members").cast("array<string>"), ",")
    return F.concat(F.when(F.col("first"), "[").otherwise(""), members, F.when(F.col("last"), "]").otherwise(","))
