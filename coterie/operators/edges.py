"""The co-affiliation graph and its basic views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import both_directions, edge_key
from ..plans.limits import limit
from ..plans.lists import ROW_LENGTH, packed_distinct, sorted_lists
from ..plans.order import with_rank
from ..plans.scratch import Saved, Scratch
from ..plans.skew import group_sizes, lookup_join, pairs_in_cells, pairs_within


def affiliations(rows: DataFrame) -> DataFrame:
    """Distinct ``(user, item)``; a repeated rating counts once."""
    return rows.select("user", "item").distinct()


def simple_edges(edges: DataFrame) -> DataFrame:
    """``(src, dst)`` of the simple undirected graph: ``src < dst``, each edge once, no nulls, no self-loops.

    All graph operators read their edges through this, so repeats and either orientation give the same
    result. Tables that an operator of this library made are simple already and pass as they are.
    """
    if getattr(edges, "_coterie_simple", False):
        return mark_simple(edges.select("src", "dst"))
    # A null end makes the comparison null, which filters the row.
    return mark_simple(edges.where("src <> dst").select(*edge_key("src", "dst")).distinct())


def mark_simple(edges: DataFrame) -> DataFrame:
    """Note on this very DataFrame that its edges are simple; whatever is derived from it starts without the mark."""
    edges._coterie_simple = True
    return edges


def settled_edges(edges: DataFrame, scratch: Scratch) -> Saved:
    """The simple edges as a saved step; what an operator of this library wrote is not written again."""
    simple = simple_edges(edges)
    marked = getattr(edges, "_coterie_simple", False)
    if marked and hasattr(edges, "_coterie_result"):
        return Saved(simple, edges.count())
    rows = 0 if marked else edges.count()
    bigint = dict(edges.dtypes)["src"] == dict(edges.dtypes)["dst"] == "bigint"
    if bigint and rows > 10 * limit(scratch.spark, "broadcastRows"):
        simple = packed_distinct(edges.where("src <> dst").select(*edge_key("src", "dst")), rows)
    saved = scratch.save(simple)
    mark_simple(saved.df)
    return saved


def affiliation_sets(rows: DataFrame, row_length: int = ROW_LENGTH) -> DataFrame:
    """``(user, part, items)``: the sorted distinct items of each user, ``row_length`` to a row."""
    with Scratch(rows.sparkSession) as scratch:
        saved = scratch.save(affiliations(rows))
        return scratch.save(sorted_lists(saved, "user", "item", "items", scratch, row_length), keep=True).df


def coaffiliation_edges(rows: DataFrame, min_shared: int = 9) -> DataFrame:
    """``(src, dst, weight)`` for every two users who share at least ``min_shared`` distinct items.

    Pairs are counted by a self-join on the item. Where that makes many, a prefix filter goes first: all items are
    ordered by their number of holders, and each user sets aside the ``min_shared - 1`` with most. Any two users with
    ``min_shared`` items in common still meet on the rarest one, so no edge is missed; what they share among the
    items set aside is added afterwards. Where there are few items and nearly everybody meets everybody, the items of each user
    become a bitmap, and all pairs of users are compared block by block, so that no pair below ``min_shared`` leaves its task.
    """
    if min_shared < 1:
        raise ValueError("min_shared must be at least 1")
    with Scratch(rows.sparkSession) as scratch:
        held = scratch.save(affiliations(rows).where("user IS NOT NULL AND item IS NOT NULL"))
        if held.rows > limit(scratch.spark, "broadcastRows"):
            held = _with_enough_items(held, min_shared, scratch)
        holders = group_sizes(held, "item", scratch)
        counts = _meetings_by_bitmap(held, holders, min_shared, scratch)
        if counts is None and min_shared > 1 and holders.metrics["pairs"] > limit(scratch.spark, "pairsPerRow") * held.rows:
            counts = _meetings_by_prefix(held, holders, min_shared, scratch)
        if counts is None:
            counts = _meetings(held, scratch, holders)
        return mark_simple(scratch.save(counts.where(F.col("weight") >= min_shared), keep=True).df)


def _with_enough_items(held: Saved, min_shared: int, scratch: Scratch) -> Saved:
    """Without the many users who hold too few items to share ``min_shared`` with anybody."""
    enough = scratch.save(
        held.df.groupBy("user").agg(F.count(F.lit(1)).alias("items")).where(F.col("items") >= min_shared).select("user")
    )
    return scratch.save(lookup_join(held, enough, ["user"], scratch, "left_semi"))


def _meetings(held: Saved, scratch: Scratch, holders: Saved) -> DataFrame:
    return (
        pairs_within(held, "item", "user", scratch, holders)
        .groupBy(F.col("x").alias("src"), F.col("y").alias("dst"))
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def _meetings_by_bitmap(held: Saved, holders: Saved, min_shared: int, scratch: Scratch) -> DataFrame | None:
    """The weights of all pairs with ``min_shared`` common items, or None where the items are many or joining on them is less work."""
    words = -(-holders.rows // 64)
    if holders.metrics["pairs"] < limit(scratch.spark, "bitmapPairs") or not 0 < words <= limit(scratch.spark, "bitmapWords"):
        return None
    numbered = scratch.save(with_rank(holders.df.select("item"), [F.col("item")], "rank", scratch).selectExpr("item", "rank - 1 AS place"))
    bit = "shiftleft(1L, CAST(place % 64 AS INT))"
    maps = scratch.save(
        lookup_join(held, numbered, ["item"], scratch).groupBy("user")
        .agg(*[F.expr(f"bit_or(IF(place DIV 64 = {i}, {bit}, 0L)) AS w{i}") for i in range(words)])
    )
    # A pair compared costs no more than one that the join makes for each common item, which is also sorted and shuffled.
    if maps.rows * (maps.rows - 1) // 2 > holders.metrics["pairs"]:
        return None
    shared = " + ".join(f"bit_count(x.w{i} & y.w{i})" for i in range(words))
    pairs = pairs_in_cells(maps, "user", scratch, F.expr(f"{shared} >= {min_shared}"))
    found = pairs.selectExpr("least(x.user, y.user) AS src", "greatest(x.user, y.user) AS dst", f"CAST({shared} AS BIGINT) AS weight")
    # In order, edges take a fraction of the disk.
    return found.sortWithinPartitions("src", "dst")


def _meetings_by_prefix(held: Saved, holders: Saved, min_shared: int, scratch: Scratch) -> DataFrame | None:
    """The weights of all pairs with ``min_shared`` common items, or None where counting all pairs is less work."""
    marked = scratch.save(lookup_join(held, holders, ["item"], scratch))
    # A row_number filter in a window is pushed down as a per-task limit, so a user with very many
    # items contributes at most min_shared - 1 rows per task to the window.
    by_fame = Window.partitionBy("user").orderBy(F.desc("held"), F.desc("item"))
    aside = scratch.save(
        marked.df.withColumn("place", F.row_number().over(by_fame))
        .where(F.col("place") < min_shared)
        .select("user", "item", "held")
    )
    kept = scratch.save(marked.df.join(aside.df, ["user", "item"], "left_anti").select("user", "item"))
    kept_holders = group_sizes(kept, "item", scratch)
    # Each pair that is left has to be compared on up to min_shared - 1 items set aside.
    work = kept_holders.metrics["pairs"] * min_shared * limit(scratch.spark, "prefixGain")
    if work > holders.metrics["pairs"]:
        return None
    met = scratch.save(_meetings(kept, scratch, kept_holders))

    # Who holds a prefix has set aside min_shared - 1 items, so these arrays are short and never missing.
    place = F.struct("held", "item")
    lists = scratch.save(
        aside.df.groupBy("user").agg(F.collect_list(place).alias("aside"), F.min(place).alias("lowest"))
    )
    of_src = lists.select("user AS src", "aside AS src_aside", "lowest AS src_lowest")
    of_dst = lists.select("user AS dst", "aside AS dst_aside", "lowest AS dst_lowest")
    one = lookup_join(met, of_src, ["src"], scratch)
    both = lookup_join(one, of_dst, ["dst"], scratch, keys_of=met)

    # An item set aside by one user may be in the prefix of the other, but only if it comes before all that the other
    # set aside; so no pair has such items on both sides.
    def before(own: str, lowest: str, user: str) -> Column:
        return F.transform(
            F.filter(own, lambda i: i < F.col(lowest)), lambda i: F.struct(F.col(user).alias("user"), i["item"].alias("item"))
        )

    pairs = scratch.save(
        both.select(
            "src", "dst",
            (F.col("weight") + F.size(F.array_intersect("src_aside.item", "dst_aside.item"))).alias("sure"),
            F.concat(before("src_aside", "dst_lowest", "dst"), before("dst_aside", "src_lowest", "src")).alias("probes"),
        )
        .where(F.col("sure") + F.size("probes") >= min_shared)
    )
    probes = pairs.df.where(F.size("probes") > 0).select("src", "dst", F.inline("probes"))
    hits = scratch.save(
        lookup_join(probes, kept, ["user", "item"], scratch)
        .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("hits"))
    )
    return pairs.df.join(hits.df, ["src", "dst"], "left").select(
        "src", "dst", (F.col("sure") + F.coalesce("hits", F.lit(0))).cast("long").alias("weight")
    )


def symmetrize(edges: DataFrame) -> DataFrame:
    """Each edge in both directions."""
    return simple_edges(edges).select(both_directions("src", "dst"))


def adjacency(edges: DataFrame, row_length: int = ROW_LENGTH) -> DataFrame:
    """``(vertex, part, neighbours)``: the sorted neighbours of each vertex, ``row_length`` to a row."""
    with Scratch(edges.sparkSession) as scratch:
        kept = settled_edges(edges, scratch)
        both = kept.df.select(both_directions("src", "dst")).toDF("vertex", "neighbour")
        lists = sorted_lists(Saved(both, 2 * kept.rows), "vertex", "neighbour", "neighbours", scratch, row_length, packed=True)
        return scratch.save(lists, keep=True).df


def vertices(edges: DataFrame) -> DataFrame:
    """Every endpoint of an edge once."""
    return edges.where("src <> dst").select(F.explode(F.array("src", "dst")).alias("vertex")).distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """``(vertex, degree)``."""
    return (
        simple_edges(edges).select(F.explode(F.array("src", "dst")).alias("vertex"))
        .groupBy("vertex").agg(F.count(F.lit(1)).alias("degree"))
    )


def graph_size(edges: DataFrame) -> DataFrame:
    """One row: vertex count and edge count. Each edge adds one to the degree of two vertices."""
    return degrees(edges).agg(
        F.count(F.lit(1)).alias("n_vertices"),
        F.coalesce(F.floor(F.sum("degree") / 2), F.lit(0)).cast("long").alias("n_edges"),
    )
