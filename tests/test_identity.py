"""Identity components against a plain union-find, hubs and chains included."""

from __future__ import annotations

import random

import pytest

from abx.functions.skew import spread_join
from abx.operators import identity as I

LINKS = "unit_id string, identifier string"


def _plain(units, links, max_units=None):
    links = {(u, i) for u, i in links if u is not None and i is not None}
    parent = {u: u for u in units if u is not None} | {u: u for u, _ in links}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by = {}
    for u, i in links:
        by.setdefault(i, []).append(u)
    for members in by.values():
        if max_units is None or len(members) <= max_units:
            for m in members[1:]:
                a, b = sorted((find(members[0]), find(m)))
                parent[b] = a
    groups = {}
    for u in parent:
        groups.setdefault(find(u), []).append(u)
    return sorted((u, min(g), len(g)) for g in groups.values() for u in g)


def _run(spark, units, links, **kw):
    u = spark.createDataFrame([(x,) for x in units], "unit_id string")
    return sorted(map(tuple, I.stitched_ids(u, spark.createDataFrame(links, LINKS).repartition(3), **kw).collect()))


def test_random_links_with_nulls_and_repeats(spark):
    rnd = random.Random(1)
    units = [f"u{i}" for i in range(60)] + [None, "u1"]
    links = [(f"u{rnd.randrange(80)}", f"d{rnd.randrange(70)}") for _ in range(90)] + [(None, "d1"), ("u3", None), ("u3", "d1"), ("u3", "d1")]
    assert _run(spark, units, links) == _plain(units, links)


def test_a_chain_and_a_hub_are_one_person_each(spark):
    chain = [(f"c{i:03d}", f"d{j}") for i in range(90) for j in (i, i + 1)]
    hub = [(f"h{i}", "kiosk") for i in range(200)]
    links = chain + hub
    want = _plain([], links)
    # A hub is split over tasks: the result does not depend on how.
    assert _run(spark, [], links, rows_per_task=10) == want
    assert {(p, n) for _, p, n in want} == {("c000", 90), ("h0", 200)}
    # A shared identifier ties no one when told so.
    assert _run(spark, ["z"], links, max_units=50, rows_per_task=10) == _plain(["z"], links, 50)


def test_no_links(spark):
    assert _run(spark, ["a", "b"], []) == [("a", "a", 1), ("b", "b", 1)]
    assert _run(spark, [], []) == []


def test_stitched_assignments(spark):
    from conftest import ASSIGN_SCHEMA, ts

    canonical = spark.createDataFrame(
        [("e", "a", "control", ts(seconds=5)), ("e", "b", "treatment", ts()), ("e", "c", "control", None), ("f", "a", "control", ts())],
        ASSIGN_SCHEMA,
    )
    ids = spark.createDataFrame([("a", "a", 2), ("b", "a", 2)], "unit_id string, person_id string, n_units long")
    got = sorted(tuple(r) for r in I.stitched_assignments(canonical, ids).collect())
    assert got == [
        ("e", "a", "b", "treatment", ts(), 2, 2, True),
        ("e", "c", "c", "control", None, 1, 1, False),
        ("f", "a", "a", "control", ts(), 1, 1, False),
    ]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_a_join(spark, how):
    big = spark.createDataFrame([("hot" if i % 3 else f"k{i % 7}", i) for i in range(300)] + [(None, 1)], "k string, v int")
    small = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3), ("zz", 4)], "k string, w int")
    want = sorted(map(tuple, big.join(small, "k", how).collect()), key=repr)
    for rows in (7, 10_000):
        assert sorted(map(tuple, spread_join(big, small, "k", how, rows).collect()), key=repr) == want
    with pytest.raises(ValueError):
        spread_join(big, small, "k", "full")
