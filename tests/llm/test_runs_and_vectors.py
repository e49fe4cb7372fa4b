"""Periodic runs, hard negatives and nearest neighbours beside plain versions."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrata.llm import hard_negatives, multi_index, periodic_runs, queries, vectors

from . import brute
from .test_dedup import table


def plain_runs(words, length=12, repeats=2):
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > s and i + q - s >= max(length, repeats * q):
                best.setdefault((s, i + q), q)
            i = max(i, s + 1)
    return sorted((s, e - s, q) for (s, e), q in best.items())


def plain_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_texts(seed, n):
    rng = random.Random(seed)
    out = [None, "", "  \n", "a", "a " * 5000, "x " * 11, "x " * 12, "é É " * 40, "  b b " * 30]
    for _ in range(n):
        words = [rng.choice("abc" if rng.random() < 0.4 else [f"w{i}" for i in range(40)]) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            unit = [rng.choice(["a", "b", "cc", "éa"]) for _ in range(rng.randint(1, 9))]
            words += (unit * 8)[: rng.randint(1, 8 * len(unit))] + [rng.choice("abq")]
        out.append(rng.choice([" ", "\n", "\t "]).join(words))
    return out


@pytest.mark.parametrize("length, repeats", [(12, 2), (2, 2), (7, 3)])
def test_periodic_runs(spark, length, repeats):
    rows = list(enumerate(periodic_texts(length, 300))) + [(None, "a b " * 20), (3, "a"), (3, "a")]
    docs = table(spark, rows).withColumns({"runs": F.lit(1), "n_words": F.lit("x"), "collapsed": F.lit(None)})
    got = periodic_runs.periodic_runs(docs, length, repeats).collect()
    told = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got)
    want = []
    for d, text in rows:
        words = brute.WORD.findall(text or "")
        runs = plain_runs(words, length, repeats)
        want.append((str(d), len(words), runs, plain_collapsed(words, runs)))
    assert told == sorted(want)
    assert periodic_runs.periodic_runs(docs.where("false")).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs, 12, 1)


def test_one_long_text_of_nested_periods(spark):
    fib = ["a", "ab"]
    while len(fib[-1]) < 20_000:
        fib.append(fib[-1] + fib[-2])
    words = list(fib[-1][:3000])
    rows = [(1, " ".join(words)), (2, "z " * 100_000 + "y"), (3, " ".join(f"w{i % 7001}" for i in range(30_000)))]
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic_runs.periodic_runs(table(spark, rows)).collect()}
    assert got == {1: plain_runs(words), 2: [(0, 100_000, 1)], 3: [(0, 30_000, 7001)]}


def test_planted_texts(spark):
    rows = [(i, t) for i, t in enumerate(periodic_texts(5, 300), 50)] + [(None, "a b c"), (-7, "a b")]
    got = {r.doc_id: brute.WORD.findall(r.text or "") for r in queries.planted(table(spark, rows)).collect()}
    for d, text in rows:
        words = brute.WORD.findall(text or "")
        h, n = zlib.crc32(str(d).encode()) if d is not None else 1, len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert got[d] == words


def test_bit_planes_and_subset_sums():
    rng = np.random.default_rng(1)
    for width, most in ((8, 1), (64, 300), (24, 100_000)):
        values = rng.integers(-most, most + 1, (200, width))
        planes = most.bit_length() + 1
        packed = hard_negatives.pack(values, planes)
        assert packed.shape == (200, planes, width // 8) and (hard_negatives.unpack(packed) == values).all()
        scores = hard_negatives.Tables(values[:30], width * most**2).scores(packed)
        assert (scores == values @ values[:30].T).all()


def plain_negatives(rows, every=3, positives=5, negatives=5, low=80):
    rows = sorted(rows)
    out = []
    for a, own, v in (r for r in rows if r[0] % every == 0):
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, label) for i, label, w in rows if i != a)
        for p, pid, _ in [s for s in scored if s[2] == own][:positives]:
            fit = [(i, -s) for s, i, label in scored if label != own and low * -p <= 100 * -s <= 100 * -p][:negatives]
            out += [(a, pid, k, i, -p, s) for k, (i, s) in enumerate(fit, 1)]
    return sorted(out)


def numbered(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, label bigint, vector array<bigint>")


@pytest.mark.parametrize("most", [3, 200, 40_000])
def test_hard_negatives(spark, monkeypatch, most):
    monkeypatch.setattr(hard_negatives, "_HITS", 50)
    monkeypatch.setattr(hard_negatives, "_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "_ANCHORS", 4)
    monkeypatch.setattr(vectors, "LEAST", 20)
    monkeypatch.setattr(vectors, "GROUP", 9)
    rng = random.Random(most)
    vector = lambda: [rng.randint(-most, most) for _ in range(11)]
    hot = vector()
    rows = [(i, rng.randrange(3), hot if rng.random() < 0.4 else vector()) for i in range(120)]
    bad = [(None, 1, vector()), (500, None, vector()), (501, 1, None), (502, 1, [1, None])]
    docs = numbered(spark, rows + bad + rows[:5]).withColumns({"planes": F.lit("x"), "stripe": F.lit(1), "cell": F.lit(2), "positives": F.lit(0)})
    got = hard_negatives.hard_negatives(docs, F.col("vec_id") % 3 == 0).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows)


def test_hard_negatives_at_the_edges(spark):
    ask = F.col("vec_id") % 3 == 0
    assert hard_negatives.hard_negatives(numbered(spark, []), ask).collect() == []
    assert hard_negatives.hard_negatives(numbered(spark, [(3, 1, []), (4, 1, []), (5, 2, [])]), ask).collect() == [(3, 4, 1, 5, 0, 0)]
    short = [(3, 1, [5, 5]), (4, 1, [4]), (6, 2, [4, 0, 9]), (9, 2, [-1])]
    want = plain_negatives([(i, k, v + [0] * (3 - len(v))) for i, k, v in short])
    assert sorted(map(tuple, hard_negatives.hard_negatives(numbered(spark, short), ask).collect())) == want
    with pytest.raises(ValueError):
        hard_negatives.hard_negatives(numbered(spark, [(3, 1, [2**40])]), ask)
    twice = [(3, 1, [2]), (3, 0, [7]), (4, 0, [6]), (5, 1, [6])]
    assert [tuple(r) for r in hard_negatives.hard_negatives(numbered(spark, twice), ask).collect()] == [(3, 4, 1, 5, 42, 42)]


def test_every_code_within_the_radius_is_found():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 16, (3000, 4)).astype("<u2")
    codes[1000:2000] = codes[0] ^ (1 << rng.integers(0, 16, (1000, 4))).astype("<u2") * rng.integers(0, 2, (1000, 4)).astype("<u2")
    index = multi_index.Index(codes)
    for radius in (0, 1, 3, 6, 11, 24, 64):
        assert sum(s + 1 for s in multi_index.shares(radius, 4)) == radius + 1
        for own in (codes[0], codes[5], codes[1500]):
            apart = np.bitwise_count(codes ^ own).sum(axis=1)
            assert index.within(own, radius).tolist() == np.flatnonzero(apart <= radius).tolist()


def cosine_table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, vector array<double>")


def plain_nearest(rows, every, k=5):
    out = {}
    for q, v in rows:
        if q % every == 0:
            cos = [(-sum(x * y for x, y in zip(v, w)) / math.sqrt(sum(x * x for x in v)) / math.sqrt(sum(x * x for x in w)), i) for i, w in rows if i != q]
            out[q] = [(i, -s) for s, i in sorted((round(s, 12), i) for s, i in cos)[:k]]
    return out


def test_nearest_recall_and_order(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LEAST", 300)
    monkeypatch.setattr(vectors, "GROUP", 50)
    rng = np.random.default_rng(4)
    points = rng.normal(size=(1500, 24))
    points[700:1200] = points[3]  # one vector holds a third of the rows
    points[1200:1300] = points[:100] + 0.05 * rng.normal(size=(100, 24))
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    bad = [(None, [1.0] * 24), (5000, None), (5050, [0.0] * 24), (5100, [float("nan")] * 24), (5150, [float("inf")] + [1.0] * 23), (5200, [None] * 24)]
    docs = cosine_table(spark, rows + bad + rows[:3]).withColumns({"rank": F.lit(1), "radius": F.lit(2), "stripe": F.lit("x"), "kept": F.lit(0)})
    got = multi_index.nearest(docs, F.col("vec_id") % 10 == 0).collect()
    want = plain_nearest(rows, 10)
    found = {}
    for r in sorted(got):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(found[r.query_id])
    assert set(found) == set(want) and all(len(v) == 5 for v in found.values())
    caught = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert caught >= 0.9 * 5 * len(want)
    assert [i for i, _ in found[1000]] == [3, 700, 701, 702, 703]
    for q, hits in found.items():
        exact = dict(plain_nearest([r for r in rows if r[0] in {q, *(i for i, _ in hits)}], 10, 99)[q])
        assert all(abs(exact[i] - s) < 1e-11 for i, s in hits)
        assert [i for i, _ in hits] == [i for _, i in sorted((-round(s, 12), i) for i, s in hits)]


def test_nearest_at_the_edges(spark):
    ask = F.col("vec_id") % 50 == 0
    assert multi_index.nearest(cosine_table(spark, []), ask).collect() == []
    assert multi_index.nearest(cosine_table(spark, [(1, [1.0])]), ask).collect() == []
    assert multi_index.nearest(cosine_table(spark, [(50, [1.0])]), ask).collect() == []
    few = [(0, [1e300, 0.0]), (1, [1e-300]), (2, [0.0, 2.0, 0.0]), (50, [-1e-310, 0.0])]
    got = sorted(map(tuple, multi_index.nearest(cosine_table(spark, few), ask).collect()))
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 0.0), (0, 3, 50, -1.0), (50, 1, 2, 0.0), (50, 2, 0, -1.0), (50, 3, 1, -1.0)]


def test_queries_far_from_all_pilots_are_asked_again(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "fit_radius", lambda *a: 0)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    got = multi_index.nearest(cosine_table(spark, rows), F.col("vec_id") % 50 == 0).collect()
    assert sorted((r.query_id, r.rank) for r in got) == [(q, k) for q in range(0, 300, 50) for k in range(1, 6)]
