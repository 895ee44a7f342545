"""Shortest paths and edge betweenness as level-synchronous joins.

All sources advance together, a *pack* of up to ``PACK`` of them to a row: the state ``(pack, vertex, s0, s1, ..., bits)`` has a column
of path counts for each source of the pack, and a bit for each source that reaches the vertex at this level. One round handles
one hop level for all packs, so an edge is followed once for a pack and not once for each source.

While the edges fit a checked broadcast, states are partitioned by pack alone. A round then moves
only states, never the far more numerous rows that come from expanding them: expansion, aggregation
and the removal of known vertices all happen where the pack lives. Beyond that size the
neighbour lists are partitioned by vertex, long ones in blocks, and expanded rows are shuffled.

Credit goes back up in one pass. Each step joins the states of a level to their parents once and sums the products twice, by
parent, for the next step, and by edge, for the result.

Packs run in batches that bound the states of a task. Given a folder to resume from, what each batch finds stays there with a
note when it is complete, and a second run goes on after the last complete one.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import both_directions, edge_key
from ..plans.limits import limit, partitions
from ..plans.order import with_rank
from ..plans.scratch import Saved, Scratch, exists, remove
from ..plans.skew import lookup_join
from .components import connected_components
from .edges import mark_simple, settled_edges, simple_edges, vertices
from .searches import PartSearch, credits_in_tasks, credits_of_all, search_in_parts

# Sources in a pack, at most. The generated code of a step grows with it; beyond 8,000 bytes of it in a method the JVM
# does not compile that any more, which happens between 12 and 16.
PACK = 8
# Packs per partition to aim for, so that hashing them to partitions stays even.
_PACKS_EACH = 4


def _each(width: int, *templates: str) -> list[str]:
    """One expression for each source of a pack."""
    return [t.format(i=i) for t in templates for i in range(width)]


def _states_schema(width: int) -> str:
    counts = ", ".join(_each(width, "s{i} double"))
    return f"pack long, vertex long, own double, heft double, blocks int, bits long, {counts}, depth int"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass(frozen=True)
class _Neighbours:
    """Both directions of every edge, ready to be joined to states on their vertex.

    ``wide`` says that they are shuffled rather than broadcast, with long neighbour lists cut into
    blocks. Each row then carries how many blocks the neighbour's own list has, so that a
    state knows how often to repeat itself to meet its whole list. ``heft`` is how many vertices the neighbour stands for.
    """

    df: DataFrame
    rows: int
    wide: bool
    parts: int
    weighted: bool

    def place(self, states: DataFrame) -> DataFrame:
        return states if self.wide else states.repartition(self.parts, "pack")

    def expand(self, states: DataFrame) -> DataFrame:
        """Join each placed state to the neighbours ``to`` of its vertex."""
        states = states.drop("heft")
        if not self.wide:
            return states.drop("blocks").join(self.df, "vertex")
        spread = states.selectExpr("*", "explode(sequence(0, blocks - 1)) AS block")
        return spread.drop("blocks").join(self.df, ["vertex", "block"]).drop("block")

    def meet(self, offers: DataFrame, states: DataFrame) -> DataFrame:
        """Join many offers, ``(pack, vertex, child, ..., blocks)``, to the state they name.

        With wide lists the offers to one state are spread over as many slices as its vertex has
        blocks, and the state is repeated for each slice.
        """
        on = ["pack", "vertex"]
        if not self.wide:
            return offers.drop("blocks").join(states.drop("blocks").hint("shuffle_hash"), on)
        sliced = offers.withColumn("slice", F.pmod(F.xxhash64("child"), F.col("blocks")).cast("int"))
        states = states.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return sliced.drop("blocks").join(states.drop("blocks"), [*on, "slice"]).drop("slice")


def _neighbours(edges: DataFrame, scratch: Scratch, hefts: Saved | None = None) -> _Neighbours:
    """``hefts (vertex, heft)`` has the vertices that stand for more than themselves."""
    spark = scratch.spark
    both = scratch.save(
        simple_edges(edges).select(both_directions("src", "dst")).select(F.col("src").alias("vertex"), F.col("dst").alias("to"))
    )
    weighted = hefts is not None and hefts.rows > 0
    if weighted:
        known = lookup_join(both, hefts.select("vertex AS to", "heft"), ["to"], scratch, "left")
        both = scratch.save(known.select("vertex", "to", F.coalesce("heft", F.lit(1.0)).alias("heft")))
    else:
        both = Saved(both.df.withColumn("heft", F.lit(1.0)), both.rows, both.path)
    # Every vertex may reach every other, and each of these states meets its neighbours. Sources run in batches
    # that bound what a partition holds, so there need not be more partitions than the session's.
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions(spark, both.rows**2))
    if both.rows <= limit(spark, "broadcastRows"):
        return _Neighbours(F.broadcast(both.df.withColumn("blocks", F.lit(1))), both.rows, False, parts, weighted)

    block = limit(spark, "blockRows")
    of_vertex = scratch.save(
        both.df.groupBy("vertex").agg(F.count(F.lit(1)).alias("degree")).where(F.col("degree") > block)
        .select("vertex", F.ceil(F.col("degree") / block).cast("int").alias("own"))
    )
    of_other = of_vertex.select("vertex AS to", "own AS blocks")
    one = lookup_join(both, of_vertex, ["vertex"], scratch, "left")
    cut = lookup_join(one, of_other, ["to"], scratch, "left").select(
        "vertex",
        F.pmod(F.xxhash64("to"), F.coalesce("own", F.lit(1))).cast("int").alias("block"),
        "to", "heft",
        F.coalesce("blocks", F.lit(1)).alias("blocks"),
    )
    # Partitioned once for all rounds: the states are the only side a round has to move.
    return _Neighbours(scratch.cache(cut.repartition(parts, "vertex", "block")), both.rows, True, parts, weighted)


@dataclass(frozen=True)
class _Packs:
    """The sources of a search: ``(source, pack, slot, own, blocks)``, all of a pack with the same ``own`` weight."""

    rows: Saved
    width: int

    def roots(self) -> DataFrame:
        """Depth-0 states: every source at itself."""
        return self.rows.df.selectExpr(
            "pack", "source AS vertex", "own", "own AS heft", "blocks", "1L << slot AS bits",
            *_each(self.width, "IF(slot = {i}, 1.0D, 0.0D) AS s{i}"),
        )

    def by_source(self, df: DataFrame, value: str, columns: list[str], scratch: Scratch) -> DataFrame:
        """A row for each source of a pack with a value above zero, given as an expression with the source's number."""
        structs = ", ".join(_each(self.width, "struct({i} AS slot, %s AS value)" % value))
        long = df.selectExpr("pack", *columns, f"inline(filter(array({structs}), x -> x.value > 0))")
        return lookup_join(long, self.rows.select("pack", "slot", "source"), ["pack", "slot"], scratch)


def _packs(near: _Neighbours, sources: DataFrame | None, scratch: Scratch, width: int | None = None) -> _Packs:
    """Every vertex, or those of ``sources`` that are in the graph, numbered by weight and id and cut into packs."""
    # Every vertex is a neighbour of another, and there it carries the size of its own list and its weight.
    found = near.df.groupBy(F.col("to").alias("source")).agg(F.max("blocks").alias("blocks"), F.max("heft").alias("own"))
    if sources is not None:
        found = found.join(sources.select(F.col("vertex").alias("source")).distinct(), "source", "left_semi")
    width = width or min(PACK, max(1, found.count() // (near.parts * _PACKS_EACH)))
    ranked = with_rank(found, [F.col("own"), F.col("source")], "rank", scratch).withColumn("rank", F.col("rank") - 1)
    # A run of ranks with one weight; it is named by its first rank.
    run = F.floor(F.col("rank") / width)
    first = F.min("rank").over(Window.partitionBy(run, "own"))  # at most ``width`` rows
    cut = ranked.select("source", first.alias("pack"), (F.col("rank") % width).cast("int").alias("slot"), "own", "blocks")
    return _Packs(scratch.save(cut), width)


def _search(near: _Neighbours, roots: DataFrame, width: int, scratch: Scratch) -> tuple[str, list[int]]:
    """Run all roots level by level; returns the folder of their states and the number of states of each level."""
    folder = scratch.folder()
    levels = [scratch.save(roots, path=f"{folder}/depth=0")]
    most = F.expr(f"max(greatest({', '.join(_each(width, 's{i}'))}, 0.0D))")
    while levels[-1].rows:
        reached = near.expand(near.place(levels[-1].df)).selectExpr(
            "pack", "to AS vertex", "own", "heft", "blocks", "0L AS known", *_each(width, "s{i}")
        )
        # A neighbour of a vertex at level d lies at level d-1, d or d+1, so two levels decide.
        known = levels[-1].df if len(levels) == 1 else levels[-1].df.unionByName(levels[-2].df)
        known = near.place(known.select("pack", "vertex", "bits")).selectExpr(
            "pack", "vertex", "CAST(NULL AS DOUBLE) AS own", "CAST(NULL AS DOUBLE) AS heft", "CAST(NULL AS INT) AS blocks",
            "bits AS known", *_each(width, "0.0D AS s{i}"),
        )
        sums = _each(width, "sum(s{i}) AS s{i}")
        fresh = (
            reached.union(known).groupBy("pack", "vertex")
            .agg(*[F.expr(e) for e in ("max(own) AS own", "max(heft) AS heft", "max(blocks) AS blocks", "bit_or(known) AS known", *sums)])
            .selectExpr("pack", "vertex", "own", "heft", "blocks", *_each(width, "IF(known & (1L << {i}) = 0, s{i}, 0.0D) AS s{i}"))
            .selectExpr("pack", "vertex", "own", "heft", "blocks",
                        f"{' | '.join(_each(width, 'IF(s{i} > 0, 1L << {i}, 0L)'))} AS bits", *_each(width, "s{i}"))
            .where("bits <> 0")
        )
        levels.append(scratch.save(fresh, path=f"{folder}/depth={len(levels)}", most=most))
        if levels[-1].metrics["most"] == float("inf"):
            raise OverflowError("more shortest paths between two vertices than a double can count")
    return folder, [level.rows for level in levels[:-1]]


def _steps(near: _Neighbours, folder: str, sizes: list[int], width: int, scratch: Scratch, by_edge: bool) -> list[DataFrame]:
    """What passes along every edge on a shortest path, per level.

    A vertex holds its credit, the product of its own weight and the source's, plus what it gathered from its children, and shares it
    among its parents in proportion to their path counts. Of two levels the smaller one follows its edges to the
    other, and that join gives the products ``p0, p1, ...``. With ``by_edge`` they are summed by parent and, over all sources, by edge in one aggregation, and
    ``(src, dst, credit)`` is returned; else ``(pack, src, dst, p0, ...)``.
    """
    states = scratch.read(folder, _states_schema(width))
    at = lambda depth: states.where(f"depth = {depth}").drop("depth")
    products, out, gathered = _each(width, "p{i}"), [], None
    total = " + ".join(products)
    for depth in range(len(sizes) - 1, 0, -1):
        held = near.place(at(depth))
        if gathered is None:
            held = held.selectExpr("*", *_each(width, "0.0D AS g{i}"))
        else:
            found = near.place(gathered).hint("shuffle_hash")
            held = held.join(found, ["pack", "vertex"], "left").selectExpr(
                *held.columns, *_each(width, "coalesce(p{i}, 0.0D) AS g{i}")
            )
        # Before the edges are followed: what a vertex passes for each path of a parent.
        shares = held.selectExpr(
            "pack", "vertex", "blocks", "heft", *_each(width, "IF(s{i} > 0, (own * heft + g{i}) / s{i}, 0.0D) AS h{i}")
        )
        parents = near.place(at(depth - 1)).selectExpr("pack", "vertex", "blocks", "heft", *_each(width, "s{i}"))
        upward = sizes[depth] <= sizes[depth - 1]
        follow, other, value = (shares, parents, "h{i}") if upward else (parents, shares, "s{i}")
        offers = near.expand(follow).selectExpr("pack", "to AS vertex", "vertex AS child", "blocks", *_each(width, value))
        ends = ("vertex", "child") if upward else ("child AS vertex", "vertex AS child")
        # Two neighbours that are not parent and child have no source with a path count and a share.
        met = near.meet(offers, other.drop("heft")).selectExpr("pack", *ends, *_each(width, "s{i} * h{i} AS p{i}")).where(f"{total} > 0")
        sums = [F.expr(f"sum({p}) AS {p}") for p in products]
        if not by_edge:
            saved = scratch.save(met)
            out.append(saved.df.select("pack", *edge_key("vertex", "child"), *products))
            gathered = saved.df.groupBy("pack", "vertex").agg(*sums)
            continue
        edges = met.select("pack", "vertex", *edge_key("vertex", "child"), *products, F.expr(f"{total} AS credit"))
        if depth == 1:
            # What a source gathers goes nowhere; it is the weight of all that it reaches, times its own.
            if not near.weighted:
                out.append(scratch.save(edges.groupBy("src", "dst").agg(F.expr("sum(credit) AS credit"))).df)
                continue
            both = scratch.save(
                edges.groupingSets([["pack", "vertex"], ["src", "dst"]], "pack", "vertex", "src", "dst").agg(F.expr("sum(credit) AS credit"))
            ).df
            reached = both.where("src IS NULL").join(at(0).select("pack", "vertex", "own"), ["pack", "vertex"])
            out.append(both.where("src IS NOT NULL").select("src", "dst", "credit"))
            out.append(reached.selectExpr("vertex AS src", "CAST(NULL AS BIGINT) AS dst", "credit / own AS credit"))
            continue
        both = scratch.save(
            edges.groupingSets([["pack", "vertex"], ["src", "dst"]], "pack", "vertex", "src", "dst")
            .agg(F.expr("sum(credit) AS credit"), *sums)
        ).df
        out.append(both.where("src IS NOT NULL").select("src", "dst", "credit"))
        gathered = both.where("src IS NULL").select("pack", "vertex", *products)
    return out


def _by_source(spark: SparkSession):
    """Let a join on (pack, ...) use a partitioning by pack as it is, on both sides."""
    return _setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


_PLAN = "kind string, width int, batches int, n_edges long, edges long, n_sources long, sources long"


def _planned(kind: str, edges: DataFrame, packs: _Packs, batches: int, folder: str, scratch: Scratch) -> tuple[int, int]:
    """Note in ``folder`` what is run, or check the note of an earlier run; returns its width and number of batches."""
    of = lambda df, *columns: df.agg(
        F.count(F.lit(1)), F.coalesce(F.expr(f"bit_xor(xxhash64({', '.join(columns)}))"), F.lit(0))
    ).first()
    facts = (*of(simple_edges(edges), "src", "dst"), *of(packs.rows.df, "source", "own"))
    path = f"{folder}/plan"
    if exists(scratch.spark, path):
        earlier = scratch.read(path, scratch.spark.createDataFrame([], _PLAN).schema).first()
        if earlier is not None:
            if (earlier["kind"], *tuple(earlier)[3:]) != (kind, *facts):
                raise ValueError(f"{folder} holds batches of another run: {earlier}")
            return earlier["width"], earlier["batches"]
        remove(scratch.spark, path)
    scratch.spark.createDataFrame([(kind, packs.width, batches, *facts)], _PLAN).coalesce(1).write.parquet(path)
    return packs.width, batches


def _in_batches(
    kind: str, edges: DataFrame, sources: DataFrame | None, batches: int | None, resume: str | None, scratch: Scratch,
    run: Callable[[_Neighbours, _Packs, DataFrame, Scratch], DataFrame], hefts: Saved | None = None,
) -> DataFrame:
    """The rows that ``run`` gives for the roots of each batch, all batches together.

    The number of batches follows from ``statesPerPartition`` unless given. With ``resume`` every batch is written
    there and noted once it is complete; those noted already are not run again.
    """
    spark = scratch.spark
    near = _neighbours(edges, scratch, hefts)
    packs = _packs(near, sources, scratch)
    if batches is None:
        n_vertices = packs.rows.rows if sources is None else near.df.select("to").distinct().count()
        batches = -(-packs.rows.rows * n_vertices // (limit(spark, "statesPerPartition") * near.parts))
    batches, done = max(1, batches), set()
    folder = resume or scratch.folder(keep=True)
    if resume:
        width, batches = _planned(kind, edges, packs, batches, resume, scratch)
        if width != packs.width:
            packs = _packs(near, sources, scratch, width)
        if exists(spark, f"{resume}/done"):
            done = {r["number"] for r in scratch.read(f"{resume}/done", spark.createDataFrame([], "number int").schema).collect()}
    schema = None
    for number in range(batches):
        path = f"{folder}/rows/batch={number}"
        if number in done:
            continue
        with Scratch(spark) as inner:
            roots = packs.roots()
            some = roots if batches == 1 else roots.where(F.pmod(F.xxhash64("pack"), F.lit(batches)) == number)
            rows = run(near, packs, some, inner)
            schema = rows.schema
            if resume:
                remove(spark, path)  # what a lost run may have left
            scratch.save(rows, path=path)
        if resume:
            mark = f"{resume}/done/batch={number}"
            remove(spark, mark)
            spark.createDataFrame([(number,)], "number int").coalesce(1).write.parquet(mark)
    if schema is None:
        schema = spark.read.parquet(f"{folder}/rows/batch=0").schema
    out = scratch.read(f"{folder}/rows", schema).select(*schema.names)
    if not resume:
        out._coterie_result = scratch.root
    return out


def _in_parts(
    edges: DataFrame, sources: DataFrame | None, batches: int | None, resume: str | None, scratch: Scratch
) -> PartSearch | None:
    """The search of a large dense graph from some sources, unless batches are asked for."""
    if sources is None or batches is not None or resume is not None:
        return None
    return search_in_parts(settled_edges(edges, scratch), sources, scratch)


def shortest_path_counts(
    edges: DataFrame, sources: DataFrame, batches: int | None = None, resume: str | None = None
) -> DataFrame:
    """``(source, vertex, depth, sigma)``: hop distance and number of shortest paths.

    ``sources`` is a DataFrame with a ``vertex`` column. There is a row for every vertex that a source reaches, so
    pass ``vertices(edges)`` only where the square of their number is wanted. Sources run in ``batches`` (by default as many as
    ``statesPerPartition`` asks for); ``resume`` names a folder of the caller's that keeps the result and lets a second call
    with the same arguments go on after the last complete batch.
    """
    def run(near: _Neighbours, packs: _Packs, roots: DataFrame, inner: Scratch) -> DataFrame:
        folder, _ = _search(near, roots, packs.width, inner)
        states = inner.read(folder, _states_schema(packs.width))
        long = packs.by_source(states, "s{i}", ["vertex", "depth"], inner)
        return long.select("source", "vertex", "depth", F.col("value").alias("sigma"))

    spark = edges.sparkSession
    with Scratch(spark) as scratch, _by_source(spark):
        found = _in_parts(edges, sources, batches, resume, scratch)
        if found is not None:
            return scratch.save(found.paths(), keep=True).df
        return _in_batches("paths", edges, sources, batches, resume, scratch, run)


def bfs_levels(
    edges: DataFrame, sources: DataFrame, batches: int | None = None, resume: str | None = None
) -> DataFrame:
    """``(source, vertex, depth)``: the hop level of every reached vertex; arguments as in ``shortest_path_counts``."""
    return shortest_path_counts(edges, sources, batches, resume).select("source", "vertex", "depth")


def reachable(edges: DataFrame, vertex: int) -> DataFrame:
    """All vertices connected to ``vertex``, itself included; rounds grow with the logarithm of the graph only."""
    labels = connected_components(vertices(edges), edges)
    own = labels.where(F.col("vertex") == vertex).select("community")
    return labels.join(F.broadcast(own), "community", "left_semi").select("vertex")  # one row


def source_edge_credit(
    edges: DataFrame, sources: DataFrame, batches: int | None = None, resume: str | None = None
) -> DataFrame:
    """``(source, src, dst, credit)``: what each source adds to each edge it uses; ``batches`` and ``resume`` as in ``shortest_path_counts``."""
    def run(near: _Neighbours, packs: _Packs, roots: DataFrame, inner: Scratch) -> DataFrame:
        folder, sizes = _search(near, roots, packs.width, inner)
        steps = _steps(near, folder, sizes, packs.width, inner, by_edge=False)
        if not steps:
            return inner.spark.createDataFrame([], "source long, src long, dst long, credit double")
        long = packs.by_source(_union(steps), "p{i}", ["src", "dst"], inner)
        return long.select("source", "src", "dst", F.col("value").alias("credit"))

    spark = edges.sparkSession
    with Scratch(spark) as scratch, _by_source(spark):
        found = _in_parts(edges, sources, batches, resume, scratch)
        if found is not None:
            return found.credits_by_source()
        return _in_batches("credit", edges, sources, batches, resume, scratch, run)


# Leaves go round by round while a round removes at least this part of the edges left.
_LEAVES = 0.02


def _without_leaves(edges: DataFrame, scratch: Scratch) -> tuple[Saved, list[Saved], Saved]:
    """The edges left when trees that hang off the graph are cut away leaf by leaf.

    Returns them, the cut leaves ``(vertex, stem, heft)`` round by round, and ``(vertex, heft)`` of what had leaves. A heft is
    the number of vertices that a vertex stands for: itself and all that was cut from it. It is exact to stop after any round.
    """
    left = scratch.save(simple_edges(edges).select("src", "dst"))
    leaves, hefts = [], Saved(scratch.spark.createDataFrame([], "vertex long, heft double"), 0)
    while left.rows:
        degree = scratch.settle(
            left.df.select(F.explode(F.array("src", "dst")).alias("vertex")).groupBy("vertex").agg(F.count(F.lit(1)).alias("degree")),
            2 * left.rows,
        )
        one = lookup_join(left, degree.select("vertex AS src", "degree AS of_src"), ["src"], scratch)
        both = lookup_join(one, degree.select("vertex AS dst", "degree AS of_dst"), ["dst"], scratch)
        marked = scratch.save(both, leaves=F.expr("count_if(of_src = 1 OR of_dst = 1)"))
        if not marked.metrics["leaves"] or marked.metrics["leaves"] < _LEAVES * left.rows:
            break
        # Of an edge with two loose ends one end stays, as a graph of its own.
        cut = marked.df.where("of_src = 1 OR of_dst = 1").selectExpr(
            "IF(of_src = 1, src, dst) AS vertex", "IF(of_src = 1, dst, src) AS stem"
        )
        known = lookup_join(Saved(cut, marked.rows), hefts, ["vertex"], scratch, "left")
        leaves.append(scratch.save(known.select("vertex", "stem", F.coalesce("heft", F.lit(1.0)).alias("heft"))))
        grown = leaves[-1].df.select(F.col("stem").alias("vertex"), "heft")
        # What a vertex had before counts it, too.
        earlier = hefts.df.select("vertex", (F.col("heft") - 1).alias("heft"))
        hefts = scratch.save(grown.unionByName(earlier).groupBy("vertex").agg((F.sum("heft") + 1).alias("heft")))
        left = scratch.save(marked.df.where("of_src > 1 AND of_dst > 1").select("src", "dst"))
    return left, leaves, hefts


def _leaf_scores(leaves: list[Saved], hefts: Saved, reach: Saved, scratch: Scratch) -> DataFrame:
    """``(src, dst, score)`` of the edges cut away: every vertex beyond the edge with every other one of its component.

    ``reach (vertex, others)`` says how many vertices those left reach; one that is not there reaches nothing.
    """
    ends = None
    for cut in reversed(leaves):
        if ends is None:
            rooted = cut.df.select("vertex", "stem", "heft", F.col("stem").alias("root"))
        else:
            later = ends.select("vertex AS stem", "root")
            rooted = lookup_join(cut, later, ["stem"], scratch, "left").select(
                "vertex", "stem", "heft", F.coalesce("root", "stem").alias("root")
            )
        known = rooted if ends is None else rooted.unionByName(ends.df)
        ends = scratch.settle(known, cut.rows + (ends.rows if ends else 0))
    sizes = lookup_join(ends, reach.select("vertex AS root", "others"), ["root"], scratch, "left")
    whole = lookup_join(sizes, hefts.select("vertex AS root", "heft AS own"), ["root"], scratch)
    rest = F.coalesce("others", F.lit(0.0)) + F.col("own") - F.col("heft")
    return whole.select(*edge_key("vertex", "stem"), (F.col("heft") * rest).alias("score"))


def _edge_sums(near: _Neighbours, packs: _Packs, roots: DataFrame, inner: Scratch) -> DataFrame:
    folder, sizes = _search(near, roots, packs.width, inner)
    steps = _steps(near, folder, sizes, packs.width, inner, by_edge=True)
    if not steps:
        return inner.spark.createDataFrame([], "src long, dst long, credit double")
    # The rows without a second end say what the sources reach.
    return _union(steps).groupBy("src", "dst").agg(F.expr("sum(credit) AS credit"))


def edge_betweenness(
    edges: DataFrame, sources: DataFrame | None = None, batches: int | None = None, resume: str | None = None
) -> DataFrame:
    """``(src, dst, score)``: exact, unnormalised; each unordered pair of vertices counts once.

    ``batches`` splits the sources by hash to bound the state held at a time; by default it follows
    from ``statesPerPartition``. Given ``sources``, only paths from them are summed. ``resume`` as in ``shortest_path_counts``.

    Trees that hang off the graph are cut away first: an edge of such a tree separates the vertices beyond it
    from all others of its component, which gives its score, and the vertex that it hangs off stands for them in the search. Dense
    graphs of ``searchEdges`` edges or more are searched as in ``searches``, if neither ``batches`` nor ``resume`` are given, beyond ``taskEdges`` by parts.
    """
    spark = edges.sparkSession
    with Scratch(spark) as scratch, _by_source(spark):
        leaves, hefts = [], None
        if sources is None:
            core, leaves, hefts = _without_leaves(edges, scratch)
            whole, edges = edges, mark_simple(core.df)
        sums = None
        if sources is None and batches is None and resume is None:
            sums = credits_in_tasks(core, hefts, scratch)
            if sums is None and core.rows > limit(spark, "taskEdges"):
                # The leaves are few there, and stay.
                every = credits_of_all(settled_edges(whole, scratch) if leaves else core, scratch)
                if every is not None:
                    return mark_simple(scratch.save(every.select("src", "dst", (F.col("credit") / 2).alias("score")), keep=True).df)
        found = _in_parts(edges, sources, batches, resume, scratch)
        if found is not None:
            scores = found.credits().select("src", "dst", (F.col("credit") / 2).alias("score"))
            return mark_simple(scratch.save(scores, keep=True).df)
        if sums is None:
            sums = _in_batches("betweenness", edges, sources, batches, resume, scratch, _edge_sums, hefts)
        summed = scratch.settle(sums.groupBy("src", "dst").agg(F.expr("sum(credit) AS credit")), edges.count() if leaves else 0)
        scores = summed.df.where("dst IS NOT NULL").select("src", "dst", (F.col("credit") / 2).alias("score"))
        if leaves:
            reach = Saved(summed.df.where("dst IS NULL").select(F.col("src").alias("vertex"), F.col("credit").alias("others")), summed.rows, summed.path)
            scores = scores.unionByName(_leaf_scores(leaves, hefts, reach, scratch))
        return mark_simple(scratch.save(scores, keep=True).df)
