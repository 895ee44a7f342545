import random

import pytest

import coterie as ct
from conftest import G7, G11
from coterie.plans.scratch import Scratch
from plain import betweenness, components, curve, neighbours, pair_modularity, standard_modularity

WIDE = {"broadcastRows": 0, "blockRows": 2, "hotKeys": 4}
G7_CURVE = [(1, 2, 7 / 27), (3, 3, 0.185185), (6, 4, 0.104938), (7, 5, 0.080247), (8, 6, 0.043210), (9, 7, 0.0)]


def _random_graph(seed, n, m):
    pick = random.Random(seed)
    ids = pick.sample(range(-500, 500), n)
    return sorted({tuple(sorted(pick.sample(ids, 2))) for _ in range(m)})


def _order(spark, order):
    return spark.createDataFrame([(a, b, k) for k, (a, b) in enumerate(order, 1)], "src long, dst long, rank long")


def _labels(df):
    return {r.vertex: r.community for r in df.collect()}


def _curve(df):
    return sorted((r.k, r.n_components, r.q) for r in df.collect())


def _same(found, expected):
    assert [r[:2] for r in found] == [r[:2] for r in expected]
    assert [r[2] for r in found] == pytest.approx([float(r[2]) for r in expected], abs=1e-6)


@pytest.mark.parametrize("forced", [{}, WIDE], ids=["plain", "wide"])
def test_components(graph, limits, forced):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(1000, 1000 + i) for i in range(1, 30)]
    edges = path + star + _random_graph(3, 12, 9)
    nodes = sorted({*neighbours(edges), 5555})
    with limits(**forced):
        vertices = graph([(v, v) for v in nodes]).selectExpr("src AS vertex")
        found = _labels(ct.connected_components(vertices, graph(edges)))
    assert found == components(nodes, edges)


def test_components_without_edges(graph):
    vertices = graph([(2, 2), (1, 1)]).selectExpr("src AS vertex")
    assert _labels(ct.connected_components(vertices, graph([(1, 2)]).limit(0))) == {1: 1, 2: 2}


@pytest.mark.parametrize("forced", [{}, WIDE], ids=["plain", "wide"])
def test_members(spark, limits, forced):
    labels = spark.createDataFrame([(1, v) for v in (4, 1, 3, 2)] + [(7, 7)], "community long, vertex long")
    with limits(**forced):
        rows = ct.community_members(labels, row_length=3).orderBy("community", "part").collect()
    whole = {}
    for r in rows:
        whole[r.community] = whole.get(r.community, []) + r.members
    assert whole == {1: [1, 2, 3, 4], 7: [7]}
    assert len(rows) == 3


@pytest.mark.parametrize("forced", [{}, WIDE], ids=["plain", "wide"])
def test_modularity(spark, graph, limits, forced):
    edges = _random_graph(5, 14, 30)
    label = {v: v % 3 for v in neighbours(edges)}
    labels = spark.createDataFrame([(c, v) for v, c in label.items()], "community long, vertex long")
    with limits(**forced):
        pair = ct.modularity(graph(edges), labels).first().q
        standard = ct.modularity(graph(edges), labels, kind="standard").first().q
    assert pair == pytest.approx(float(pair_modularity(edges, label)))
    assert standard == pytest.approx(float(standard_modularity(edges, label)))
    squares = sum(len(n) ** 2 for n in neighbours(edges).values())
    assert pair == pytest.approx((standard + squares / (4 * len(edges) ** 2)) / 2)
    with pytest.raises(ValueError):
        ct.modularity(graph(edges), labels, kind="other")


@pytest.fixture(scope="module")
def g7_order(graph):
    return ct.removal_order(ct.edge_betweenness(graph(G7)))


def test_removal_order(g7_order):
    rows = sorted((r.rank, r.src, r.dst) for r in g7_order.collect())
    assert [r[1:] for r in rows] == [(2, 4), (1, 2), (2, 3), (4, 5), (4, 7), (4, 6), (5, 6), (6, 7), (1, 3)]
    assert [r[0] for r in rows] == list(range(1, 10))
    assert ct.edges_after(g7_order, 6).count() == 3


def test_removal_order_of_ties(spark):
    scores = [(a, b, 2.0 + 1e-12 * a) for a, b in _random_graph(9, 20, 60)]
    ranked = ct.removal_order(spark.createDataFrame(scores, "src long, dst long, score double").repartition(7))
    assert [(r.src, r.dst) for r in ranked.orderBy("rank").collect()] == [s[:2] for s in scores]


def test_golden_curve(g7_order):
    _same(_curve(ct.cut_curve(g7_order)), G7_CURVE)
    members = ct.community_members(ct.best_communities(g7_order)).orderBy("community").collect()
    assert [r.members for r in members] == [[1, 2, 3], [4, 5, 6, 7]]


def test_later_start_and_baseline(spark, g7_order):
    _same(_curve(ct.cut_curve(g7_order, min_removed=5)), [(5, 3, 0.185185), *G7_CURVE[2:]])
    assert ct.cut_curve(g7_order, min_removed=10).collect() == []
    assert len(set(_labels(ct.best_communities(g7_order, min_removed=5)).values())) == 3
    # Nothing beats the baseline: the components of the whole graph.
    assert set(_labels(ct.best_communities(g7_order, min_removed=9, baseline=0.0)).values()) == {1}
    # A state of one component does not count, however good it is.
    ring = _order(spark, [(1, 2), (2, 3), (1, 3)])
    assert _curve(ct.cut_curve(ring))[0][:2] == (1, 1)
    assert set(_labels(ct.best_communities(ring, baseline=-1.0)).values()) != {1}


def test_second_golden_curve(graph):
    order = ct.removal_order(ct.edge_betweenness(graph(G11)))
    found = _curve(ct.cut_curve(order))
    assert [r[:2] for r in found] == [(1, 1), (4, 2), (6, 3), (8, 4), (9, 5), (10, 6), (11, 7), (12, 8), (14, 9), (15, 10), (16, 11)]
    assert [r[2] for r in found][:3] == pytest.approx([0.046875, 0.1787109375, 0.2177734375])
    members = ct.community_members(ct.best_communities(order)).orderBy("community").collect()
    assert [r.members for r in members] == [[1, 2, 3, 6], [4, 5, 8], [7, 9, 10, 11]]


@pytest.mark.parametrize("seed,n,m", [(11, 9, 14), (12, 14, 20), (13, 16, 12), (14, 12, 45), (15, 30, 40)])
def test_curve_of_any_order(spark, seed, n, m):
    order = _random_graph(seed, n, m)
    random.Random(seed).shuffle(order)
    _same(_curve(ct.cut_curve(_order(spark, order))), curve(order))


@pytest.mark.parametrize("shape", ["path", "star"])
def test_curve_of_long_and_wide_trees(spark, shape):
    order = [(i, i + 1) for i in range(30)] if shape == "path" else [(0, i) for i in range(1, 30)]
    random.Random(4).shuffle(order)
    _same(_curve(ct.cut_curve(_order(spark, order))), curve(order))


def test_curve_with_everything_large(spark, limits):
    order = _random_graph(21, 12, 16)
    random.Random(21).shuffle(order)
    with limits(**WIDE):
        _same(_curve(ct.cut_curve(_order(spark, order))), curve(order))


def test_empty_order(spark):
    empty = _order(spark, [(1, 2)]).limit(0)
    assert ct.cut_curve(empty).collect() == []
    assert ct.best_communities(empty).collect() == []


@pytest.mark.parametrize("parts", [1, 7])
def test_partitioning_changes_nothing(spark, graph, parts):
    edges = _random_graph(41, 16, 26)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        order = ct.removal_order(ct.edge_betweenness(graph(edges).repartition(parts)))
        ranked = [(r.src, r.dst) for r in order.orderBy("rank").collect()]
        best = _labels(ct.best_communities(order))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    scores = {e: float(s) for e, s in betweenness(edges).items()}
    assert ranked == sorted(edges, key=lambda e: (-round(scores[e], 6), e))
    k = max(curve(ranked), key=lambda r: (r[2], -r[0]))[0]
    assert best == components(sorted(neighbours(edges)), ranked[k:])


def test_two_pairs(spark):
    found = ct.best_communities(_order(spark, [(1, 2), (3, 4)]))
    assert _labels(found) == {1: 1, 2: 2, 3: 3, 4: 3}


G7_SIMILAR = {
    (1, 2): 0.8660, (1, 3): 1.0, (2, 3): 0.8660, (2, 4): 0.4472, (4, 5): 0.7746, (4, 6): 0.8944,
    (4, 7): 0.7746, (5, 6): 0.8660, (6, 7): 0.8660,
}


def _similar(df):
    return {(r.src, r.dst): r.similarity for r in df.collect()}


def test_golden_similarity(graph):
    assert _similar(ct.structural_similarity(graph(G7))) == pytest.approx(G7_SIMILAR, abs=5e-5)
    groups = _labels(ct.structural_components(graph(G7)))
    assert groups == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 4}
    groups = _labels(ct.structural_components(graph(G11)))
    assert groups == {v: 2 if v == 3 else v for v in range(1, 12)}


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("forced", [{}, WIDE], ids=["plain", "wide"])
def test_similarity(graph, limits, closed, forced):
    edges = _random_graph(31, 14, 50) + [(9000, v) for v in range(9001, 9009)] + [(9001, 9002)]
    near = {v: n | ({v} if closed else set()) for v, n in neighbours(edges).items()}
    expected = {
        (a, b): len(near[a] & near[b]) / (len(near[a]) * len(near[b])) ** 0.5 for a, b in edges
    }
    with limits(**forced):
        assert _similar(ct.structural_similarity(graph(edges), closed)) == pytest.approx(expected)


def _dense_with_hubs():
    """A dense part, two hubs that share most of their many leaves, and a path."""
    hubs = [(min(h, v), max(h, v)) for h in (9000, 9500) for v in range(9001, 9041) if v % 7 or h == 9000]
    return sorted({*_random_graph(33, 24, 150), *hubs, (9000, 9500), (9001, 9002), *((7000 + i, 7001 + i) for i in range(9))})


@pytest.mark.parametrize("closed", [True, False])
@pytest.mark.parametrize("forced", [{}, {"blockRows": 4}, WIDE], ids=["plain", "blocks", "wide"])
def test_similar_edges(graph, limits, closed, forced):
    """The bounds by degree settle edges, and never another way than the whole count does."""
    edges = _dense_with_hubs()
    near = {v: n | ({v} if closed else set()) for v, n in neighbours(edges).items()}
    value = {(a, b): len(near[a] & near[b]) / (len(near[a]) * len(near[b])) ** 0.5 for a, b in edges}
    for epsilon in (0.0, 0.2, 0.5, 0.8305, 1.0):
        with limits(**forced):
            found = {(r.src, r.dst) for r in ct.similar_edges(graph(edges), epsilon, closed).collect()}
        assert found == {e for e, s in value.items() if s >= epsilon - 1e-12}


def test_no_wedges_are_written(graph, limits, monkeypatch):
    """What is written stays linear in the edges, however many pairs of neighbours the hubs have."""
    edges, written = _dense_with_hubs(), []
    save = Scratch.save

    def counting(self, *args, **kwargs):
        step = save(self, *args, **kwargs)
        written.append(step.rows)
        return step

    monkeypatch.setattr(Scratch, "save", counting)
    with limits(**WIDE):
        ct.structural_similarity(graph(edges)).count()
    degrees = [len(n) for n in neighbours(edges).values()]
    assert max(written) <= 4 * len(edges) < sum(d * (d - 1) // 2 for d in degrees)


@pytest.mark.parametrize("closed", [True, False])
def test_dense_graphs_are_compared_in_cells(graph, limits, monkeypatch, closed):
    """Beyond ``listValues`` no list of neighbours goes with an edge; ids are sparse, and there are several blocks."""
    edges = [(1000 * a - 90_000, 1000 * b - 90_000) for a, b in _random_graph(35, 150, 2500)] + [(10**12, 10**12 + 1)]
    near = {v: n | ({v} if closed else set()) for v, n in neighbours(edges).items()}
    value = {(min(e), max(e)): len(near[e[0]] & near[e[1]]) / (len(near[e[0]]) * len(near[e[1]])) ** 0.5 for e in edges}
    monkeypatch.setattr("coterie.operators.structural._common", None)
    for more in ({}, {"broadcastRows": 0}):
        with limits(**{"broadcastRows": 100, "listValues": 1, "wordGain": 1000, "cellBytes": 1, **more}):
            assert _similar(ct.structural_similarity(graph(edges), closed)) == pytest.approx(value)
            for epsilon in (0.0, 0.3, 0.5, 1.0):
                found = {(r.src, r.dst) for r in ct.similar_edges(graph(edges), epsilon, closed).collect()}
                assert found == {e for e, s in value.items() if s >= epsilon - 1e-12}


@pytest.mark.parametrize("closed", [True, False])
def test_blocks_are_compared_in_turn(spark, graph, limits, monkeypatch, closed):
    """Beyond ``cellCopies`` blocks no list is copied for each of them; results stay what they are, and can be released."""
    edges = [(1000 * a - 90_000, 1000 * b - 90_000) for a, b in _random_graph(36, 200, 2500)] + [(10**12, 10**12 + 1)]
    near = {v: n | ({v} if closed else set()) for v, n in neighbours(edges).items()}
    value = {(min(e), max(e)): len(near[e[0]] & near[e[1]]) / (len(near[e[0]]) * len(near[e[1]])) ** 0.5 for e in edges}
    monkeypatch.setattr("coterie.operators.structural._common", None)
    monkeypatch.setattr("coterie.operators.cells._compared", None)
    before = len(Scratch.with_results)
    with limits(broadcastRows=100, listValues=1, wordGain=1000, cellBytes=1, cellCopies=1):
        found = ct.structural_similarity(graph(edges), closed)
        assert _similar(found) == pytest.approx(value) and found.columns == ["src", "dst", "similarity"]
        ct.release(found)
        for epsilon in (0.0, 0.3):
            found = ct.similar_edges(graph(edges), epsilon, closed)
            assert sorted(map(tuple, found.collect())) == sorted(e for e, s in value.items() if s >= epsilon - 1e-12)
            ct.release(found)
        cut = _labels(ct.structural_components(graph(edges), 0.3, closed=closed))
    assert cut == _labels(ct.structural_components(graph([e for e, s in value.items() if s >= 0.3 - 1e-12]), 0.0)) | {
        v: v for v in near if not any(v in e for e, s in value.items() if s >= 0.3 - 1e-12)
    }
    assert len(Scratch.with_results) <= before + 2


def test_cores(graph):
    found = _labels(ct.structural_components(graph(G7), epsilon=0.8, mu=3))
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 4}
    alone = _labels(ct.structural_components(graph(G7), epsilon=0.8, mu=5))
    assert alone == {v: v for v in range(1, 8)}
