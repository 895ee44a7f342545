import os
import random
from fractions import Fraction

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import coterie as ct
from conftest import G7, G11
from coterie.operators import cells, paths, searches
from plain import betweenness, distances

G11_SCORES = {
    (1, 2): (517, 70), (1, 3): (517, 70), (1, 4): (1129, 105), (1, 5): (842, 105), (2, 3): (1, 1),
    (2, 6): (433, 70), (3, 6): (433, 70), (4, 7): (932, 105), (4, 8): (682, 105), (5, 8): (772, 105),
    (6, 9): (1249, 105), (7, 9): (1789, 210), (7, 10): (1283, 210), (8, 10): (919, 105),
    (9, 11): (1549, 210), (10, 11): (1409, 210),
}
WIDE = {"broadcastRows": 0, "blockRows": 2, "hotKeys": 4}


def _scores(df):
    return {(r.src, r.dst): r.score for r in df.collect()}


def _states(df):
    return {(r.source, r.vertex): (r.depth, r.sigma) for r in df.collect()}


def _hub(seed):
    """A hub with many neighbours, a tail, a second component, and ids that are neither dense nor positive."""
    pick = random.Random(seed)
    edges = {(-7, 10 * i) for i in range(1, 13)} | {(10, 20), (120, 5000), (5000, 9999999999)}
    edges |= {tuple(sorted(pick.sample([10 * i for i in range(1, 13)], 2))) for _ in range(6)}
    return sorted(edges | {(-100, -99), (-99, -98)})


def test_golden_scores(graph):
    found = _scores(ct.edge_betweenness(graph(G11)))
    assert found == pytest.approx({e: a / b for e, (a, b) in G11_SCORES.items()})
    assert sum(Fraction(a, b) for a, b in G11_SCORES.values()) == 119 == pytest.approx(sum(found.values()))


@pytest.mark.parametrize("forced", [{"rowsPerTask": 1}, WIDE], ids=["local", "wide"])
def test_hub_graph(graph, limits, forced):
    edges = _hub(1)
    with limits(**forced):
        assert _scores(ct.edge_betweenness(graph(edges))) == pytest.approx(
            {e: float(s) for e, s in betweenness(edges).items()}
        )
        assert _states(ct.shortest_path_counts(graph(edges), ct.vertices(graph(edges)))) == distances(edges)


@pytest.mark.parametrize("forced", [{"statesPerPartition": 10, "rowsPerTask": 1}, {**WIDE, "statesPerPartition": 10, "rowsPerTask": 1}], ids=["local", "wide"])
def test_batches_of_sources_change_nothing(graph, limits, forced):
    with limits(**forced):
        found = _scores(ct.edge_betweenness(graph(G11)))
    assert found == pytest.approx({e: a / b for e, (a, b) in G11_SCORES.items()})


@pytest.mark.parametrize("forced", [{}, WIDE], ids=["local", "wide"])
def test_full_packs(spark, graph, limits, monkeypatch, forced):
    """Several sources to a row, the last pack not full, sources at different depths of a vertex."""
    monkeypatch.setattr(paths, "_PACKS_EACH", 1)
    edges = _hub(3)
    with limits(**{**forced, "rowsPerTask": 1000}):
        assert _scores(ct.edge_betweenness(graph(edges))) == pytest.approx({e: float(s) for e, s in betweenness(edges).items()})
        assert _states(ct.shortest_path_counts(graph(edges), ct.vertices(graph(edges)))) == distances(edges)
        with paths.Scratch(spark) as scratch:
            near = paths._neighbours(graph(edges), scratch)
            assert paths._packs(near, None, scratch).width > 3


def _sparse(seed, n=22, m=24):
    """Random sparse edges: trees that hang off cycles, whole trees, single edges and several components."""
    pick = random.Random(seed)
    return sorted({tuple(sorted(pick.sample(range(n), 2))) for _ in range(m)} | {(n, n + 1), (n + 2, n + 3), (n + 3, n + 4)})


@pytest.mark.parametrize("seed", range(3))
def test_pendant_trees(graph, seed):
    edges = _sparse(seed, m=18 + 4 * seed)
    found = _scores(ct.edge_betweenness(graph(edges)))
    assert found == pytest.approx({e: float(s) for e, s in betweenness(edges).items()})


def test_leaves_go_until_few_are_left(spark, graph):
    edges = [(1, 2), (1, 3), (2, 3), (3, 4), (4, 5), (4, 6), (8, 9)]
    with paths.Scratch(spark) as scratch:
        left, leaves, hefts = paths._without_leaves(graph(edges), scratch)
        assert sorted(map(tuple, left.df.collect())) == [(1, 2), (1, 3), (2, 3)]
        assert [sorted(map(tuple, x.df.collect())) for x in leaves] == [[(5, 4, 1.0), (6, 4, 1.0), (8, 9, 1.0)], [(4, 3, 3.0)]]
        assert sorted(map(tuple, hefts.df.collect())) == [(3, 4.0), (4, 3.0), (9, 2.0)]


class Lost(Exception):
    pass


def _stops_after(monkeypatch, batches):
    """Lose the driver when a batch after the first ``batches`` begins."""
    real, begun = paths._search, []

    def search(*arguments):
        begun.append(1)
        if len(begun) > batches:
            raise Lost()
        return real(*arguments)

    monkeypatch.setattr(paths, "_search", search)
    return begun


@pytest.mark.parametrize("query", ["scores", "counts", "credit"])
def test_a_lost_run_goes_on_after_its_last_complete_batch(spark, graph, monkeypatch, tmp_path, query):
    edges = graph([(1, 2), (1, 3), (2, 3), (3, 4)])
    everyone = ct.vertices(edges)
    run = {
        "scores": lambda **more: ct.edge_betweenness(edges, **more),
        "counts": lambda **more: ct.shortest_path_counts(edges, everyone, **more),
        "credit": lambda **more: ct.source_edge_credit(edges, everyone, **more),
    }[query]
    rows = lambda df: sorted(tuple(round(x, 9) for x in r) for r in df.collect())
    expected, folder = rows(run()), str(tmp_path / "run")
    with monkeypatch.context() as patch:
        _stops_after(patch, 1)
        with pytest.raises(Lost):
            run(batches=2, resume=folder)
    # A batch that was written but not noted is run again.
    spark.range(3).write.parquet(f"{folder}/rows/batch=1")
    with monkeypatch.context() as patch:
        begun = _stops_after(patch, 9)
        assert rows(run(batches=2, resume=folder)) == expected
        assert len(begun) == 1
        assert rows(run(resume=folder)) == expected and len(begun) == 1
    with pytest.raises(ValueError):
        ct.edge_betweenness(graph(G7), resume=folder)


def test_credit_takes_two_expansions(spark, graph, monkeypatch):
    """One round down and one up for each level, and nothing that follows all edges once more."""
    seen = []
    real = paths._Neighbours.expand
    monkeypatch.setattr(paths._Neighbours, "expand", lambda self, states: seen.append(1) or real(self, states))
    ct.edge_betweenness(graph([(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (1, 6)])).collect()
    assert len(seen) == 2 * 3 + 1  # three levels each way, and the one that finds nothing


@pytest.mark.parametrize("forced", [{}, WIDE], ids=["local", "wide"])
def test_credit_of_one_source(spark, graph, limits, forced):
    start = spark.createDataFrame([(1,), (1,), (77,)], "vertex long")
    with limits(**forced):
        rows = ct.source_edge_credit(graph(G7), start).collect()
    assert {(r.source, r.src, r.dst): r.credit for r in rows} == pytest.approx(
        {(1, 1, 2): 5, (1, 1, 3): 1, (1, 2, 4): 4, (1, 4, 5): 1, (1, 4, 6): 1, (1, 4, 7): 1}
    )


def test_credits_of_all_sources_add_up(graph):
    total = {}
    for r in ct.source_edge_credit(graph(G7), ct.vertices(graph(G7))).collect():
        total[r.src, r.dst] = total.get((r.src, r.dst), 0) + r.credit / 2
    assert total == pytest.approx({e: float(s) for e, s in betweenness(G7).items()})


def test_sum_of_scores_is_sum_of_distances(graph):
    edges = _hub(2)
    found = _scores(ct.edge_betweenness(graph(edges)))
    assert sum(found.values()) == pytest.approx(sum(d for d, _ in distances(edges).values()) / 2)
    assert min(found.values()) >= 1 - 1e-9


def test_reachable(graph):
    edges = graph([(1, 2), (3, 4), (4, 5)])
    assert sorted(r.vertex for r in ct.reachable(edges, 4).collect()) == [3, 4, 5]
    assert ct.reachable(edges, 9).collect() == []


def test_smallest_graphs(graph):
    assert _scores(ct.edge_betweenness(graph([(5, 3)]))) == {(3, 5): 1.0}
    assert _scores(ct.edge_betweenness(graph([(1, 2)]).limit(0))) == {}
    assert ct.bfs_levels(graph([(1, 2)]).limit(0), ct.vertices(graph([(1, 2)]))).collect() == []


def test_repeated_and_turned_edges_change_nothing(spark):
    square = [(1, 2), (1, 3), (2, 4), (3, 4)]
    messy = spark.createDataFrame(
        square + [(2, 1), (1, 2), (4, 3), (5, 5), (None, 3)], "src long, dst long"
    )
    assert {(r.src, r.dst): round(r.score, 9) for r in ct.edge_betweenness(messy).collect()} == dict.fromkeys(square, 2.0)
    tail = [(2, 1), (1, 3), (3, 1), (3, 2), (4, 3), (1, 2)]
    messy = spark.createDataFrame(tail, "src long, dst long")
    clean = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (3, 4)], "src long, dst long")
    assert tuple(ct.graph_size(messy).first()) == (4, 4)
    for view in (ct.degrees, ct.adjacency, ct.structural_similarity, ct.structural_components, ct.symmetrize):
        assert sorted(map(tuple, view(messy).collect())) == sorted(map(tuple, view(clean).collect()))
    labels = ct.connected_components(ct.vertices(clean), clean)
    assert ct.modularity(messy, labels).first() == ct.modularity(clean, labels).first()


def test_too_many_paths_are_an_error(spark):
    with pytest.raises(OverflowError):
        edges = spark.createDataFrame([(1, 2)], "src long, dst long")
        with paths.Scratch(spark) as scratch:
            near = paths._neighbours(edges, scratch)
            packs = paths._packs(near, None, scratch)
            paths._search(near, packs.roots().withColumn("s0", paths.F.lit(float("inf"))), packs.width, scratch)


def test_large_scores_have_one_order(spark):
    rows = [(k, k + 1, 1e12 + 1e-4 * k) for k in range(20)] + [(50, 51, 2e12)]
    for parts in (1, 7):
        scores = spark.createDataFrame(rows, "src long, dst long, score double").repartition(parts)
        order = [(r.src, r.rank) for r in ct.removal_order(scores).collect()]
        assert sorted(order, key=lambda x: x[1]) == [(50, 1)] + [(k, k + 2) for k in range(20)]


def test_results_can_be_released(spark):
    from coterie.plans.scratch import Scratch

    edges = spark.createDataFrame([(1, 2), (2, 3)], "src long, dst long")
    before = len(Scratch.with_results)
    result = ct.structural_components(edges)
    assert len(Scratch.with_results) == before + 1
    ct.release(result)
    assert len(Scratch.with_results) == before


@pytest.mark.parametrize("edges", [G11, G7, _hub(2)], ids=["g11", "g7", "hub"])
def test_searches_in_tasks(spark, graph, limits, monkeypatch, edges):
    """A dense graph too large for a broadcast is searched without a row for each state, with leaves and other components."""
    monkeypatch.setattr(paths, "_in_batches", lambda *_: pytest.fail("searched by joins"))
    with limits(broadcastRows=0, hotKeys=4, searchEdges=0, taskDegree=0):
        assert _scores(ct.edge_betweenness(graph(edges))) == pytest.approx({e: float(s) for e, s in betweenness(edges).items()})


def test_searches_in_tasks_of_many_strips(graph, limits, monkeypatch):
    pick = random.Random(5)
    edges = sorted({tuple(sorted(pick.sample(range(200), 2))) for _ in range(500)} | {(300 + i, 301 + i) for i in range(9)} | {(300, 309)})
    monkeypatch.setattr(searches, "_MOST", 30)
    with limits(searchEdges=0, taskDegree=0):
        assert _scores(ct.edge_betweenness(graph(edges))) == pytest.approx({e: float(s) for e, s in betweenness(edges).items()})


def test_searches_in_tasks_tell_an_overflow():
    """320 layers of ten vertices, each joined to all of the next: a source of the first has more paths than a double holds."""
    words, layers = -(-3200 // 64), range(0, 3190, 10)
    a, b = zip(*[(i + x, i + 10 + y) for i in layers for x in range(10) for y in range(10)])
    batch = pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
    lists = pa.Table.from_batches(list(cells._lists(words)([batch])))
    strips = [min(64, 3200 - 64 * s) for s in range(lists.num_rows)]
    lists = lists.append_column("hefts", pa.array([[1.0] * n for n in strips])).append_column("task", pa.array([0] * lists.num_rows))
    assert searches._searched(words, 3200)(lists)["most"].to_pylist()[0] == float("inf")


def test_searches_in_tasks_of_repeated_edges(spark, limits):
    """Edges in both orientations, twice, with loops and nulls, and what communities come of the scores."""
    rows = [e for a, b in G11 for e in ((a, b), (b, a), (a, b), (a, a), (a, None))]
    edges = spark.createDataFrame(rows, "src long, dst long")
    lists = lambda df: sorted(map(tuple, df.collect()))
    of = lambda scores: [
        lists(ct.best_communities(ct.removal_order(scores), min_removed=2, baseline=0.0)),
        [r[0] for r in ct.community_lines(ct.best_communities(ct.removal_order(scores))).orderBy(F.col("line")).collect()],
    ]
    joined = ct.edge_betweenness(edges)
    with limits(searchEdges=0, taskDegree=0):
        found = ct.edge_betweenness(edges)
    assert _scores(found) == pytest.approx({e: a / b for e, (a, b) in G11_SCORES.items()})
    assert of(found) == of(joined)


@pytest.mark.parametrize("sources", [[1], [-7, 10, 5000, -99, 123456], [30, 10 ** 12, 120]], ids=["one", "far", "some"])
@pytest.mark.parametrize("edges", [G11, _hub(2)], ids=["g11", "hub"])
def test_searches_in_parts(spark, graph, limits, monkeypatch, edges, sources):
    """Some sources of a dense graph too large for a broadcast are searched by parts of its lists."""
    df, asked = graph(edges), spark.createDataFrame([(s,) for s in sources], "vertex long")
    states, scores = _states(ct.shortest_path_counts(df, asked)), _scores(ct.edge_betweenness(df, asked))
    monkeypatch.setattr(paths, "_in_batches", lambda *_: pytest.fail("searched by joins"))
    with limits(broadcastRows=0, hotKeys=4, taskDegree=0):
        if states:
            assert _states(ct.shortest_path_counts(df, asked)) == states
            assert _scores(ct.edge_betweenness(df, asked)) == pytest.approx(scores)


def test_searches_in_parts_of_many_strips(spark, graph, limits, monkeypatch):
    pick = random.Random(6)
    edges = sorted({tuple(sorted(pick.sample(range(400), 2))) for _ in range(900)} | {(500 + i, 501 + i) for i in range(9)})
    asked = spark.createDataFrame([(s,) for s in [*range(0, 400, 37), 503]], "vertex long")
    df = graph(edges)
    states, scores = _states(ct.shortest_path_counts(df, asked)), _scores(ct.edge_betweenness(df, asked))
    credits = lambda: {(r.source, r.src, r.dst): r.credit for r in ct.source_edge_credit(df, asked).collect()}
    credit = credits()
    monkeypatch.setattr(paths, "_in_batches", lambda *_: pytest.fail("searched by joins"))
    monkeypatch.setattr(searches, "_MOST", 5)
    monkeypatch.setattr(searches, "_SENT", 50)
    monkeypatch.setattr(searches, "_PART", 500)
    repeated = df.unionByName(df.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    with limits(broadcastRows=100, taskDegree=0):
        assert _states(ct.shortest_path_counts(df, asked)) == states
        assert _scores(ct.edge_betweenness(repeated, asked)) == pytest.approx(scores)
        assert credits() == pytest.approx(credit)


@pytest.mark.parametrize("leaves", [False, True], ids=["core", "leaves"])
def test_all_sources_in_parts(graph, limits, monkeypatch, leaves):
    """A dense graph too large for a task goes by parts of its lists, some sources after others, and nothing of them stays."""
    pick = random.Random(8)
    edges = sorted({tuple(sorted(pick.sample(range(80), 2))) for _ in range(600)})
    edges += [(k, 1000 + k) for k in range(30)] * leaves
    monkeypatch.setattr(paths, "_in_batches", lambda *_: pytest.fail("searched by joins"))
    monkeypatch.setattr(searches, "_PART", 500)
    with limits(taskDegree=0, taskEdges=300, statesPerPartition=1_100):
        found = ct.edge_betweenness(graph(edges))
        assert _scores(found) == pytest.approx({e: float(s) for e, s in betweenness(edges).items()})
        steps = os.path.join(found._coterie_result.removeprefix("file:"), "steps")
        assert not os.path.exists(steps)
        ct.release(found)


def test_searches_in_parts_tell_an_overflow():
    """A vertex that gets more paths than a double holds from its two neighbours."""
    shape = searches._Shape(1, 1, (1,))
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1]), pa.array([2, 2])], names=["a", "b"])
    lists = pa.Table.from_batches(list(cells._lists(1)([batch])))
    held = cells.np.zeros((64, 1))
    held[:2] = 1e308
    row = searches._row(0, 0, held, held > 0)
    sent = pa.Table.from_pylist([row], searches._HELD_ARROW)
    assert searches._advanced(shape)((pa.scalar(0),), lists, sent)["most"].to_pylist() == [float("inf")]
