import random

import pytest
from pyspark.sql import functions as F

from noticeloom.operators import hierarchy

SCHEMA = "id long, up long, root_id string, depth string"


def brute(parent):
    out = {}
    for x in parent:
        path, seen = [x], {x}
        while parent.get(path[-1]) in parent and parent[path[-1]] not in seen:
            path.append(parent[path[-1]])
            seen.add(path[-1])
        nxt = parent[path[-1]]
        if nxt in seen and nxt in parent:
            out[x] = (min(path[path.index(nxt) :]), -1, None)
        else:
            out[x] = (path[-1], len(path) - 1, path[::-1])
    return out


def forest(seed, n):
    r = random.Random(seed)
    parent = {i: None if r.random() < 0.1 else r.randrange(max(0, i - 4), i + 1) + (r.random() < 0.02) * 3 for i in range(n)}
    return parent | {n + 1: n + 99, n + 2: n + 2, n + 3: n + 4, n + 4: n + 3, n + 5: n + 3, n + 6: n + 5}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_forests(spark, seed, monkeypatch):
    monkeypatch.setattr(hierarchy, "FAMILY_BLOCK", 2)
    monkeypatch.setattr(hierarchy, "RANGE_STEP", 3)
    parent = forest(seed, 60)
    rows = [(i, p, "x", "y") for i, p in parent.items()]
    df = spark.createDataFrame(rows + rows[:7] + [(None, 3, None, None)], SCHEMA)
    want = brute(parent)
    sets = hierarchy.nested_sets(df, "id", "up")
    got = {r.id: r for r in sets.collect()}
    assert {i: (r.root_id, r.depth, r.path) for i, r in got.items()} == want
    below = {(a, x) for x, (_, _, path) in want.items() if path for a in path[:-1]}
    assert {(r.ancestor_id, r.descendant_id) for r in hierarchy.descendants(sets).collect()} == below
    for i, r in got.items():
        if r.depth >= 0:
            assert r.n_descendants == sum(a == i for a, _ in below) == r.hi - r.lo
            assert {x.id for x in got.values() if x.root_id == r.root_id and x.lo is not None and r.lo < x.lo <= r.hi} == {x for a, x in below if a == i}


def test_long_chain_and_star(spark):
    chain = {i: i + 1 if i < 300 else None for i in range(301)} | {i: 300 for i in range(1000, 1400)}
    df = spark.createDataFrame(list(chain.items()), "id long, up long")
    got = {r.id: (r.root_id, r.depth) for r in hierarchy.roots_and_depths(df, "id", "up").collect()}
    assert got == {i: (300, 300 - i if i <= 300 else 1) for i in chain}


def test_only_loops_and_empty(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (9, 9), (8, 1)], "id long, up long")
    got = {r.id: (r.root_id, r.depth) for r in hierarchy.roots_and_depths(df, "id", "up").collect()}
    assert got == {1: (1, -1), 2: (1, -1), 3: (1, -1), 8: (1, -1), 9: (9, -1)}
    none = spark.createDataFrame([], "id long, up long")
    assert hierarchy.roots_and_depths(none, "id", "up").count() == 0
    assert hierarchy.descendants(hierarchy.nested_sets(none, "id", "up")).count() == 0


def test_several_parents_take_the_greatest(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (2, None), (3, None)], "id long, up long")
    assert {r.id: r.root_id for r in hierarchy.roots_and_depths(df, "id", "up").where(F.col("id") == 1).collect()} == {1: 3}


def test_trees_of_a_task_and_in_rounds_are_numbered_alike(spark):
    import random

    from noticeloom.operators import hierarchy

    r = random.Random(8)
    rows = [(i, None if i % 40 == 0 else r.randrange(i - i % 40, i)) for i in range(400)] + [(1000 + i, 1001 + i if i < 90 else None) for i in range(91)] + [(5000, 5001), (5001, 5000)]
    df = spark.createDataFrame(rows, "id long, p long")
    collected = lambda n: sorted((x.id, x.parent or -1, x.root_id, x.depth, x.lo, x.hi, x.n_descendants, tuple(x.path or ())) for x in hierarchy.nested_sets(df, "id", "p", tree_rows=n).collect() if x.lo is not None)
    one = collected(1000)
    assert one == collected(40) == collected(0) and len(one) == 491
