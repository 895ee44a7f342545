import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from coterie.plans import skew
from coterie.plans.limits import limit
from coterie.plans.scratch import Scratch

LARGE = {"broadcastRows": 0, "hotKeys": 4}


def _table(spark, rows, schema, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=str)


KEYS = {
    "long": ("k long", lambda k: (k,)),
    "string": ("k string", lambda k: (f"key {k}",)),
    "two": ("k string, j int", lambda k: (str(k), -k)),
    "double": ("k double", lambda k: (k / 7,)),
}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("kind", list(KEYS))
def test_lookup_join_is_the_plain_join(spark, limits, kind, how):
    """Hot keys with and without a row in the table, nulls, keys of one row, keys with two rows in the table."""
    schema, key = KEYS[kind]
    on = [c.split()[0] for c in schema.split(", ")]
    many = [key(1)] * 60 + [key(2)] * 50 + [key(k) for k in range(3, 40)] + [(None,) * len(on)] * 40
    rows = [(*k, n) for n, k in enumerate(many)]
    found = [(*key(k), f"t{k}") for k in range(1, 30) if k != 2] + [(*key(1), "again"), (*[None] * len(on), "none")]
    big, table = _table(spark, rows, f"{schema}, n int"), _table(spark, found, f"{schema}, t string")
    expected = _sorted(big.join(table, on, how))
    with limits(**LARGE), Scratch(spark) as scratch:
        saved = scratch.save(table)
        assert _sorted(skew.lookup_join(big, saved, on, scratch, how)) == expected
        assert _sorted(skew.lookup_join(scratch.save(big), saved, on, scratch, how)) == expected


def test_keys_of_two_types_are_counted(spark, limits, monkeypatch):
    """The hash of an int is not that of the same long."""
    monkeypatch.setattr(skew, "hot_hashes", None)
    big = _table(spark, [(1,)] * 50 + [(k,) for k in range(9)], "k int")
    table = _table(spark, [(k, -k) for k in range(5)], "k long, v int")
    with limits(**LARGE), Scratch(spark) as scratch:
        found = skew.lookup_join(big, scratch.save(table), ["k"], scratch)
        assert Counter(r.v for r in found.collect()) == {-1: 51, 0: 1, -2: 1, -3: 1, -4: 1}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("order", ["mixed", "last", "first"])
def test_no_hot_key_is_missed(spark, limits, seed, order):
    """Far more keys than a sketch has slots, hot ones spread thin, in some tasks only, before and after the others."""
    pick = random.Random(seed)
    rows = [(pick.randrange(10**9),) for _ in range(4000)] + [(pick.choice(range(40)),) for _ in range(2000)]
    for key in (-1, -2, -3):
        rows += [(key,)] * pick.choice([700, 900, 1300])
    if order == "mixed":
        pick.shuffle(rows)
    elif order == "first":
        rows.reverse()
    keys = spark.createDataFrame(rows, "k long").coalesce(1 + 2 * seed)
    with limits(hotKeys=10), Scratch(spark) as scratch:
        found = {r[0] for r in skew.hot_hashes(keys, ["k"], len(rows), scratch).df.collect()}
        share = len(rows) / limit(spark, "hotKeys")
    held = {r.h: r.n for r in keys.groupBy(F.xxhash64("k").alias("h")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {h for h, n in held.items() if n > share} <= found
    assert all(held[h] > share / 3 for h in found)


def test_hot_keys_of_nothing(spark):
    with Scratch(spark) as scratch:
        assert skew.hot_hashes(spark.createDataFrame([], "k long"), ["k"], 0, scratch).rows == 0
