import random

import pytest

from missiva.operators.hierarchy import descendant_pairs, hierarchy, with_paths

SCHEMA = "raw_id long, message_id string, parent_record_message_id string, root string, nested_depth int"


def brute(items):
    norm = lambda s: (s or "").strip().strip("<>").strip().lower()
    owner = {}
    for k, i, _ in sorted(items):
        if norm(i):
            owner.setdefault(norm(i), k)
    parent = {k: owner.get(norm(p)) if norm(p) else None for k, _, p in items}
    out = {}
    for k in parent:
        path, seen, v = [], {}, k
        while v is not None and v not in seen:
            seen[v] = len(path)
            path.append(v)
            v = parent[v]
        out[k] = (path[-1], len(path) - 1, path[::-1]) if v is None else (min(path[seen[v] :]), -1, None)
    return out


def frame(spark, items):
    return spark.createDataFrame([(*r, "clash", 99) for r in items], SCHEMA)


def check(spark, items, **kw):
    rows = hierarchy(frame(spark, items), **kw)
    want = brute(items)
    got = {r.v: r for r in with_paths(rows).collect()}
    assert {k: (r.root, r.depth) for k, r in got.items()} == {k: w[:2] for k, w in want.items()}
    for k, (_, depth, path) in want.items():
        if depth >= 0:
            assert got[k].path == path
            assert got[k].descendants == sum(path2 is not None and k in path2[:-1] for _, _, path2 in want.values())
    for a in got.values():  # the intervals hold exactly the descendants
        inside = {b.v for b in got.values() if b.tree == a.tree and a.first < b.first and b.last < a.last}
        assert len(inside) == a.descendants


def test_trees_loops_and_strays(spark):
    items = [(1, "a", None), (2, "b", "<A>"), (3, "c", "b"), (4, "d", "gone"), (5, "e", "f"), (6, "f", "e"), (7, "g", "e"), (8, None, "g"), (9, "h", "h"), (10, "a", "b"), (11, "", " "), (12, "i", "<>")]
    check(spark, items)
    assert {(r.ancestor, r.descendant) for r in descendant_pairs(hierarchy(frame(spark, items)).filter("depth >= 0")).collect()} >= {(1, 2), (1, 3), (2, 3), (2, 10), (1, 10)}


def test_random_forest_with_a_hot_parent(spark):
    rng = random.Random(3)
    items = [(1, "m1", None)] + [(k, f"m{k}", "m1" if rng.random() < 0.35 else f"m{rng.randrange(1, k + 12)}") for k in range(2, 121)]
    check(spark, items)


@pytest.mark.parametrize("rounds", [0, 2])
def test_chain_deeper_than_the_peeling(spark, rounds):
    items = [(k, f"m{k}", f"m{k - 1}" if k > 1 else None) for k in range(1, 41)] + [(50, "x", "y"), (51, "y", "x"), (52, "z", "y")]
    check(spark, items, peel_rounds=rounds)


def test_empty(spark):
    assert hierarchy(frame(spark, [])).count() == 0
