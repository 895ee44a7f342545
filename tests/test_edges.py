import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest

import coterie as ct
from conftest import G7
from coterie.plans import lists
from coterie.plans.scratch import Scratch
from coterie.plans.skew import pairs_within


def _expected(rows, k):
    items = defaultdict(set)
    for user, item in rows:
        items[user].add(item)
    shared = {(a, b): len(items[a] & items[b]) for a, b in combinations(sorted(items), 2)}
    return {pair: n for pair, n in shared.items() if n >= k}


def _found(df):
    return {(r.src, r.dst): r.weight for r in df.collect()}


def _sample(seed):
    """Random holdings with duplicates, a few items that almost everybody holds, and one user of all."""
    pick = random.Random(seed)
    rows = [(-5, i) for i in range(40)]
    for user in range(30):
        rows += [(user * 1000, pick.randrange(40)) for _ in range(pick.randrange(25))]
        rows += [(user * 1000, i) for i in range(6) if pick.random() < 0.8]
    return rows


PREFIX = {"pairsPerRow": 0, "prefixGain": 0}
SKEW = [
    {},
    {"blockRows": 4},
    PREFIX,
    {**PREFIX, "blockRows": 4, "broadcastRows": 0, "hotKeys": 4},
    {**PREFIX, "blockRows": 4, "broadcastBytes": 0, "hotKeys": 4, "rowsPerTask": 100},
]


@pytest.mark.parametrize("forced", SKEW, ids=["plain", "blocks", "prefix", "all", "bytes"])
@pytest.mark.parametrize("k", [1, 3, 9])
def test_shared_items(spark, limits, forced, k):
    rows = _sample(k)
    with limits(**forced):
        found = _found(ct.coaffiliation_edges(spark.createDataFrame(rows, "user long, item long"), k))
    assert found == _expected(rows, k)


def test_copies_of_one_user(spark, limits):
    """A third of all users hold the same items: all their pairs come out, and only once."""
    rows = [(u, i) for u in range(12) for i in range(15)] + [(100 + u, 50 + (u * i) % 60) for u in range(24) for i in range(12)]
    with limits(**PREFIX, blockRows=4, broadcastRows=0, hotKeys=4):
        found = _found(ct.coaffiliation_edges(spark.createDataFrame(rows, "user long, item long")))
    assert found == _expected(rows, 9)


@pytest.mark.parametrize("gain,used", [(1, True), (10**6, False)])
def test_prefix_saves_pairs(spark, limits, monkeypatch, gain, used):
    """Everybody holds most of eight items and a few rare ones; only the latter make pairs, if that saves enough."""
    pick = random.Random(5)
    rows = [(u, i) for u in range(120) for i in range(8) if pick.random() < 0.95]
    rows += [(u, 100 + (u // 4) * 3 + i) for u in range(120) for i in range(3)]
    made = []

    def counting(*args):
        pairs = pairs_within(*args)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr("coterie.operators.edges.pairs_within", counting)
    with limits(pairsPerRow=1, prefixGain=gain):
        found = _found(ct.coaffiliation_edges(spark.createDataFrame(rows, "user long, item long")))
    assert found and found == _expected(rows, 9)
    holders = Counter(i for _, i in rows)
    plain = sum(n * (n - 1) // 2 for n in holders.values())
    assert len(made) == 1 and (made[0] * 20 < plain if used else made[0] == plain)


@pytest.mark.parametrize("forced", [{}, {"blockRows": 4}, {"blockRows": 2, "broadcastRows": 0, "hotKeys": 4}], ids=["one", "cells", "all"])
@pytest.mark.parametrize("k", [1, 3, 9])
def test_bitmaps_make_no_pairs_to_shuffle(spark, limits, monkeypatch, forced, k):
    """Few items that nearly everybody holds: users are compared by bitmaps, and items are not joined."""
    rows = _sample(k) + [(u, 100 + i) for u in range(200, 240) for i in range(-30, 60) if (u * i) % 7]

    def joined(*_):
        raise AssertionError("items were joined")

    monkeypatch.setattr("coterie.operators.edges.pairs_within", joined)
    with limits(bitmapPairs=0, **forced):
        found = _found(ct.coaffiliation_edges(spark.createDataFrame(rows, "user long, item long"), k))
    assert found == _expected(rows, k)


def test_bitmaps_only_where_they_save(spark, limits):
    """Rare items, or more of them than the words allow, are joined; strings and nulls do as well in bitmaps."""
    rows = [(u, u // 2) for u in range(60)] + [(u, 1000 + i) for u in range(60, 66) for i in range(9)]
    few = spark.createDataFrame([(1, "a"), (2, "a"), (1, "b"), (2, "b"), (2, "b"), (None, "a"), (3, None), (3, "b")], "user long, item string")
    for settings in ({}, {"bitmapWords": 0}):
        with limits(bitmapPairs=0, **settings):
            assert _found(ct.coaffiliation_edges(spark.createDataFrame(rows, "user long, item long"), 1)) == _expected(rows, 1)
            assert _found(ct.coaffiliation_edges(few, 2)) == {(1, 2): 2}
            assert _found(ct.coaffiliation_edges(few.limit(0), 2)) == {}


def test_other_item_types_and_nulls(spark, limits):
    rows = [(1, "a"), (2, "a"), (1, "b"), (2, "b"), (2, "b"), (None, "a"), (3, None), (3, "b")]
    df = spark.createDataFrame(rows, "user long, item string")
    for settings in ({}, PREFIX):
        with limits(**settings):
            assert _found(ct.coaffiliation_edges(df, 2)) == {(1, 2): 2}
            assert _found(ct.coaffiliation_edges(df.limit(0), 2)) == {}
    with pytest.raises(ValueError):
        ct.coaffiliation_edges(df, 0)


def test_affiliation_sets(spark, limits):
    df = spark.createDataFrame([(1, 3), (1, 1), (1, 3), (2, 5), (1, 2)], "user long, item long")
    rows = [(r.user, r.part, r["items"]) for r in ct.affiliation_sets(df).orderBy("user", "part").collect()]
    assert rows == [(1, 0, [1, 2, 3]), (2, 0, [5])]
    for settings in ({}, {"broadcastRows": 0, "hotKeys": 2}):
        with limits(**settings):
            cut = ct.affiliation_sets(df, row_length=2).orderBy("user", "part").collect()
    rows = [(r.user, r.part, r["items"]) for r in cut]
    assert rows == [(1, 0, [1, 2]), (1, 1, [3]), (2, 0, [5])]


def test_views_of_a_graph(graph):
    edges = graph(G7)
    assert ct.symmetrize(edges).count() == 18
    near = {r.vertex: r.neighbours for r in ct.adjacency(edges).collect()}
    assert near[4] == [2, 5, 6, 7] and near[1] == [2, 3]
    assert {r.vertex: r.degree for r in ct.degrees(edges).collect()} == {1: 2, 2: 3, 3: 2, 4: 4, 5: 2, 6: 3, 7: 2}
    assert tuple(ct.graph_size(edges).first()) == (7, 9)
    assert tuple(ct.graph_size(graph(G7).limit(0)).first()) == (0, 0)


def test_adjacency_merges_both_directions(spark):
    edges = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (4, 5), (4, 6), (3, 1), (1, 5)], "src long, dst long")
    near = {r.vertex: r.neighbours for r in ct.adjacency(edges).collect()}
    assert near[1] == [2, 3, 4, 5] and near[3] == [1]


def test_partitions_follow_the_number_of_pairs(spark, limits):
    found = []
    for holders in (8, 16, 32):
        rows = spark.range(holders * 10).selectExpr("id % 10 AS item", "id DIV 10 AS user")
        with limits(rowsPerTask=100, blockRows=50), Scratch(spark) as scratch:
            pairs = pairs_within(scratch.save(rows), "item", "user", scratch)
            assert pairs.count() == 10 * holders * (holders - 1) // 2
            found.append(pairs.rdd.getNumPartitions())
    # 280, 1200 and 4960 pairs; the session has 4 partitions.
    assert found == [3, 12, 50]


@pytest.mark.parametrize("together", [1, 5, 100])
def test_only_lists_beyond_the_limit_are_ranked(graph, limits, monkeypatch, together):
    """Rows shorter than a list are cut from it; a global sort of all rows is left to lists that are too long for one array."""
    from coterie.plans import lists

    edges, ranked, with_rank = [(0, v) for v in range(1, 12)] + [(20, v) for v in range(21, 25)], [], lists.with_rank
    monkeypatch.setattr(lists, "with_rank", lambda df, *a: ranked.append(df.count()) or with_rank(df, *a))
    with limits(sortedValues=together):
        found = {(r.vertex, r.part): r.neighbours for r in ct.adjacency(graph(edges), row_length=3).collect()}
    expected = {(v, 0): [0] for v in range(1, 12)} | {(v, 0): [20] for v in range(21, 25)}
    expected |= {(0, 0): [1, 2, 3], (0, 1): [4, 5, 6], (0, 2): [7, 8, 9], (0, 3): [10, 11], (20, 0): [21, 22, 23], (20, 1): [24]}
    assert found == expected
    assert ranked == {1: [15], 5: [11], 100: []}[together]


def test_edges_of_bitmaps_are_written_in_order(spark, limits):
    """In order they take a fraction of the disk, whichever blocks they come from."""
    rows = spark.createDataFrame([(u * 7 % 101, i) for u in range(101) for i in range(12) if (u + i) % 5], "user long, item long")
    with limits(bitmapPairs=0, blockRows=5):
        edges = ct.coaffiliation_edges(rows, 6)
    files = {}
    for r in edges.select("src", "dst", "_metadata.file_path").collect():
        files.setdefault(r.file_path, []).append((r.src, r.dst))
    assert len(files) > 1 and all(f == sorted(f) for f in files.values())


def test_adjacency_of_many_edges_is_packed(graph, limits, monkeypatch):
    """Lists beyond the checked broadcast are shuffled compressed, and both directions are not written before."""
    pick = random.Random(3)
    ids = [-(2 ** 63), -7, 0, 1, 2 ** 63 - 1, *range(10, 400, 13)]
    pairs = {tuple(sorted(pick.sample(ids, 2))) for _ in range(150)}
    expected = defaultdict(set)
    for a, b in pairs:
        expected[a].add(b)
        expected[b].add(a)
    written, save = [], Scratch.save

    def counted(self, *args, **kwargs):
        saved = save(self, *args, **kwargs)
        written.append(saved.rows)
        return saved

    monkeypatch.setattr(Scratch, "save", counted)
    monkeypatch.setattr(lists, "_BUCKET", 40)
    monkeypatch.setattr(lists, "_SORTED", 30)
    with limits(broadcastRows=100):
        found = {(r.vertex, r.part): r.neighbours for r in ct.adjacency(graph(sorted(pairs)), row_length=3).collect()}
    whole = {v: sorted(n) for v, n in expected.items()}
    assert found == {(v, i // 3): n[i : i + 3] for v, n in whole.items() for i in range(0, len(n), 3)}
    assert 2 * len(pairs) not in written


def test_many_repeated_edges_are_packed(spark, limits, monkeypatch):
    """Repeats in either orientation, loops and nulls go where the tasks read them; edges that an operator wrote are not written again."""
    from coterie.operators import edges as module

    pick = random.Random(4)
    pairs = {tuple(sorted(pick.sample([-(2 ** 63), -3, 2 ** 63 - 1, *range(0, 300, 11)], 2))) for _ in range(90)}
    rows = [e for a, b in sorted(pairs) for e in ((a, b), (b, a), (b, a), (a, a), (None, b))]
    pick.shuffle(rows)
    calls, packed = [], module.packed_distinct
    monkeypatch.setattr(module, "packed_distinct", lambda *a: calls.append(a[1]) or packed(*a))
    monkeypatch.setattr(lists, "_BUCKET", 50)
    monkeypatch.setattr(lists, "_SORTED", 40)
    with limits(broadcastRows=10), Scratch(spark) as scratch:
        saved = module.settled_edges(spark.createDataFrame(rows, "src long, dst long").repartition(3), scratch)
        assert sorted(map(tuple, saved.df.collect())) == sorted(pairs) and saved.rows == len(pairs)
    assert calls == [len(rows)]
    made = ct.coaffiliation_edges(spark.createDataFrame([(u, i) for u in range(4) for i in range(3)], "user long, item long"), 2)
    with Scratch(spark) as scratch:
        again = module.settled_edges(made, scratch)
        assert again.rows == 6 and not scratch._count


def test_components_do_not_write_the_edges_again(spark, monkeypatch):
    rows = [(u, i) for u in range(6) for i in range(3)] + [(u, i) for u in range(10, 13) for i in range(5, 8)]
    edges = ct.coaffiliation_edges(spark.createDataFrame(rows, "user long, item long"), 2)
    assert edges.count() == 18
    written, save = [], Scratch.save

    def counted(self, *args, **kwargs):
        saved = save(self, *args, **kwargs)
        written.append(saved.rows)
        return saved

    monkeypatch.setattr(Scratch, "save", counted)
    assert sorted(r.vertex for r in ct.reachable(edges, 11).collect()) == [10, 11, 12]
    assert 18 not in written
