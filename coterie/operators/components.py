"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import both_directions, edge_key
from ..plans.limits import limit
from ..plans.lists import ROW_LENGTH, sorted_lists
from ..plans.scratch import Saved, Scratch
from ..plans.skew import lookup_join

# Steps that a vertex looks ahead in a small table between two checks whether all have arrived.
_HOPS = 6


def tree_roots(picks: Saved, scratch: Scratch) -> Saved:
    """Add ``root`` to ``picks (vertex, pick, ...)``, in which every vertex picked another one.

    Each pick must be the vertex's best by one order on edges or vertices. Then the picks form
    trees whose only cycle is one mutual pair; its smaller member becomes the root. Every round
    multiplies how far a vertex sees, so a path of length n takes log n rounds.
    """
    target = picks.select("vertex AS pick", "pick AS back")
    root = "CASE WHEN back = vertex AND vertex < pick THEN vertex ELSE pick END AS root"
    met = lookup_join(picks, target, ["pick"], scratch)
    seen = scratch.settle(met.selectExpr(*picks.df.columns, root), picks.rows)
    # Looking up a small table again is cheap; a large one is written and checked after each step.
    hops = _HOPS if picks.rows <= limit(scratch.spark, "broadcastRows") else 1
    while True:
        step = seen.select("vertex AS root", "root AS next")
        ahead = lookup_join(seen, step, ["root"], scratch)
        for _ in range(hops - 1):
            ahead = lookup_join(ahead.drop("root").withColumnRenamed("next", "root"), step, ["root"], scratch)
        arrived = scratch.save(ahead, moved=F.expr("count_if(next <> root)"))
        if not arrived.metrics["moved"]:
            return arrived.select(*picks.df.columns, "root")
        seen = arrived.select(*picks.df.columns, "next AS root")


def relabel(
    rows: DataFrame | Saved, column: str, roots: Saved, scratch: Scratch, how: str = "inner", **carried: str
) -> DataFrame:
    """Replace the vertex in ``column`` by its root; ``carried`` renames further root columns to bring along.

    With ``how="left"`` a vertex that took no part in the round stays as it is.
    """
    table = roots.select(f"vertex AS {column}", "root AS to_root", *[f"{c} AS {name}" for c, name in carried.items()])
    joined = lookup_join(rows, table, [column], scratch, how)
    return joined.withColumn(column, F.expr(f"coalesce(to_root, {column})")).drop("to_root")


def _contractions(edges: DataFrame, scratch: Scratch) -> list[Saved]:
    """Contract the graph until no edge is left; one ``(vertex, root)`` table per round.

    Every vertex picks its smallest neighbour, so each round at least halves the vertices.
    """
    rounds = []
    ends = edges.where("src <> dst").select(F.col("src").alias("a"), F.col("dst").alias("b"))
    # What an operator of this library wrote need not be written again.
    written = getattr(edges, "_coterie_simple", False) and hasattr(edges, "_coterie_result")
    left = Saved(ends, edges.count()) if written else scratch.save(ends)
    while left.rows:
        picks = (
            left.df.select(both_directions("a", "b")).groupBy(F.col("a").alias("vertex")).agg(F.min("b").alias("pick"))
        )
        roots = tree_roots(scratch.settle(picks, 2 * left.rows), scratch)
        rounds.append(roots)
        joined = relabel(relabel(left, "a", roots, scratch), "b", roots, scratch).where("a <> b")
        left = scratch.save(
            joined.select(*edge_key("a", "b")).distinct().select(F.col("src").alias("a"), F.col("dst").alias("b"))
        )
    return rounds


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``(community, vertex)`` for all vertices; a community is named by its smallest vertex."""
    with Scratch(vertices.sparkSession) as scratch:
        rounds = _contractions(edges, scratch)
        everyone = vertices.select("vertex").distinct()
        if not rounds:
            return scratch.save(everyone.select(F.col("vertex").alias("community"), "vertex"), keep=True).df
        # Put the rounds together from the last, smallest one back, so that each table is read once.
        to_end = rounds[-1].select("vertex", "root")
        for earlier in reversed(rounds[:-1]):
            later = to_end.select("vertex AS root", "root AS end")
            to_end = scratch.settle(
                lookup_join(earlier.select("vertex", "root"), later, ["root"], scratch, "left")
                .select("vertex", F.coalesce("end", "root").alias("root")),
                earlier.rows,
            )
        names = scratch.settle(to_end.df.groupBy("root").agg(F.min("vertex").alias("community")), to_end.rows)
        named = lookup_join(to_end, names, ["root"], scratch).select("community", "vertex")
        labels = everyone.join(named, "vertex", "left").select(
            F.coalesce("community", "vertex").alias("community"), "vertex"
        )
        return scratch.save(labels, keep=True).df


def community_members(labels: DataFrame, row_length: int = ROW_LENGTH) -> DataFrame:
    """``(community, part, members)``: the sorted vertices of each community, ``row_length`` to a row."""
    with Scratch(labels.sparkSession) as scratch:
        saved = scratch.save(labels.select("community", "vertex"))
        return scratch.save(sorted_lists(saved, "community", "vertex", "members", scratch, row_length), keep=True).df
