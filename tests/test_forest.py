"""The table forest beside plain trees."""

import hashlib
import random

import pytest

from quadrata.operators import forest

CUTS = {"a": (1.5, 3.0, 4.0), "b": (10,), "c": (0.5,)}


def plain(rows, trees, depth, least):
    """{(tree, node): (feature, bin)} and importances, by trying every split of every node."""
    names, splits, shares = list(CUTS), {}, {f: 0.0 for f in CUTS}
    cut = lambda v, c: sum(v > x for x in c)
    for tree in range(trees):
        drawn = []
        for key, a, b, c, y in rows:
            if None in (a, b, c, y):
                continue
            digit = hashlib.md5(f"{tree}-{key}".encode()).hexdigest()[0]
            w = next(int(n) for n, d in forest.TIMES.items() if digit in d)
            drawn += [([cut(a, CUTS["a"]), cut(b, CUTS["b"]), cut(c, CUTS["c"])], y)] * w
        nodes, gains = {1: drawn}, {}
        for _ in range(depth):
            below = {}
            for node, part in nodes.items():
                best = None
                for f in range(3):
                    for at in sorted({x[f] for x, _ in part}):
                        left, right = [y for x, y in part if x[f] <= at], [y for x, y in part if x[f] > at]
                        if min(len(left), len(right)) < max(least, 1):
                            continue
                        gain = sum(left) ** 2 / len(left) + sum(right) ** 2 / len(right) - (sum(left) + sum(right)) ** 2 / len(part)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, f, at)
                if best:
                    gain, f, at = best
                    splits[tree, node] = (names[f], at)
                    gains[names[f]] = gains.get(names[f], 0.0) + gain
                    below[2 * node] = [(x, y) for x, y in part if x[f] <= at]
                    below[2 * node + 1] = [(x, y) for x, y in part if x[f] > at]
            nodes = below
        for f, gain in gains.items():
            shares[f] += gain / sum(gains.values()) / trees
    return splits, shares


@pytest.mark.parametrize("least", [1, 12])
def test_trees_and_importances(spark, least):
    rng = random.Random(least)
    rows = [(f"k{i}", rng.choice([1.0, 2.0, 3.0, 3.5, 9.0]), rng.randrange(20), rng.random(), rng.randrange(100)) for i in range(150)]
    rows = [(k, a, b, c, y + 70 * (a > 3) + 30 * (b > 10)) for k, a, b, c, y in rows] + [("n", None, 1, 0.1, 5), ("m", 1.0, 1, 0.1, None)]
    df = spark.createDataFrame(rows, "key string, a double, b int, c double, y int").repartition(5)
    found = forest.grow(forest.cells(df, "key", CUTS, "y", 3), list(CUTS), 3, least)
    splits, shares = plain(rows, 3, 3, least)
    assert {(r.tree, r.node): (r.feature, r.bin) for r in found.collect()} == splits and splits
    got = {r.feature: r.importance for r in forest.importances(found, [*CUTS, "unused"], 3).collect()}
    assert got == {**{f: pytest.approx(v) for f, v in shares.items()}, "unused": 0.0}


def test_nothing_to_split(spark):
    for rows in ([], [("a", 1.0, 1, 0.1, 5)] * 4):
        df = spark.createDataFrame(rows, "key string, a double, b int, c double, y int")
        found = forest.grow(forest.cells(df, "key", CUTS, "y", 2), list(CUTS), 2)
        assert found.collect() == []
        assert {r.importance for r in forest.importances(found, list(CUTS), 2).collect()} == {0.0}
