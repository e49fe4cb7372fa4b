"""Exact, near and substring dedup beside plain versions: nulls, empty and long texts, ties, repeats, empty tables, odd columns."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quadrata.llm import blocks, bwt_intervals, exact_dedup, simhash_ball, substring_tree
from quadrata.llm.components import components

from . import brute

SCHEMA = "doc_id bigint, text string, tag string, spans int, h string, key double"
key = lambda row: tuple((x is None, x) for x in row)


def texts(seed: int, n: int = 60) -> list:
    """Texts that share passages, some of them equal, some very long, a third of them copies of one."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgé ,.X") for _ in range(rng.randint(1, 7))) for _ in range(400)]
    passages = [" ".join(rng.choice(words) for _ in range(rng.randint(8, 30))) for _ in range(6)]
    out = [None, "", " \t\n", "x", "aaaa" * 60, "aaaa" * 60 + "b", "ha " * 90, "日本" * 40, passages[0], passages[0].upper()]
    for _ in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 20))) for _ in range(rng.randint(1, 5))]
        out.append(rng.choice([" ", "\n", "  "]).join(parts))
    out += [out[-1]] * (len(out) // 2) + [" ".join(rng.choice(words) for _ in range(3000))] * 2
    rng.shuffle(out)
    return out


def table(spark, rows):
    return spark.createDataFrame([(d, t, "t", 1, "h", 0.5) for d, t in rows], SCHEMA).repartition(5)


CASES = [1, 2, 3]


@pytest.mark.parametrize("seed", CASES)
@pytest.mark.parametrize("hot", [200_000, 3])
def test_words_removed(spark, seed, hot):
    rows = list(enumerate(texts(seed)))
    got = substring_tree.drop_repeated_words(table(spark, rows), length=12, gram=5, hot=hot, bits=16)
    got = got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(brute.words_removed(rows, 12))


@pytest.mark.parametrize("seed", CASES)
@pytest.mark.parametrize("hot", [200_000, 3])
def test_bytes_removed(spark, seed, hot):
    rows = list(enumerate(texts(seed)))
    got = bwt_intervals.drop_repeated_bytes(table(spark, rows), length=20, gram=6, hot=hot, bits=16)
    got = got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(brute.bytes_removed(rows, 20))


def test_substring_rows_without_or_with_equal_ids(spark):
    text = "one two three four five six seven"
    rows = [(None, text), (4, text), (4, text), (4, text + " eight"), (2, "nine " + text)]
    got = substring_tree.drop_repeated_words(table(spark, rows), length=5, gram=2)
    found = sorted(map(tuple, got.select("doc_id", "n_words", "n_removed").collect()), key=key)
    assert found == [(2, 8, 0), (4, 7, 7), (4, 7, 7), (4, 8, 7), (None, 7, 0)]
    kept = bwt_intervals.drop_repeated_bytes(table(spark, rows), length=20).select("doc_id", "kept_bytes").collect()
    assert sorted(len(r[1]) for r in kept) == [0, 0, len(" eight"), len(text), len("nine " + text)]


def test_runs_of_one_word(spark):
    """Suffixes that overhang their context must not part equal windows of one word."""
    rng = random.Random(50)
    runs = [50, 51, 300, 50, 51, 50, 300, 51, 50, 50, 51, 50]
    rows = []
    for d, n in enumerate(runs * 3):
        around = [[f"w{rng.randrange(10**6)}" for _ in range(rng.choice([0, 1, 30]))] for _ in range(2)]
        rows.append((d, " ".join([*around[0], *["x"] * n, *around[1]])))
    got = substring_tree.drop_repeated_words(table(spark, rows)).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, got.collect())) == sorted(brute.words_removed(rows, 50))


@pytest.mark.parametrize("words", ["y x50|x50", "y x50|x49 z|w x50", "x49 z|y x50|x51"])
def test_equal_windows_have_one_node(words):
    contexts = [" ".join(" ".join(["x"] * int(w[1:])) if w[0] == "x" else w for w in c.split()) for c in words.split("|")]
    for salt in range(12):  # other words, other order of their hashes
        own = [c.replace("x", f"x{salt}").split() for c in contexts]
        data = [" ".join(c).encode() for c in own]
        ends = np.cumsum([len(d) for d in data])
        counts = np.array([max(0, len(c) - 49) for c in own])
        found = substring_tree.first_documents(
            np.frombuffer(b"".join(data), dtype=np.uint8), ends - [len(d) for d in data], ends, counts, np.arange(len(own)), 50
        )
        windows = [(d, tuple(c[i : i + 50])) for d, c in enumerate(own) for i in range(len(c) - 49)]
        assert found.tolist() == [min(d for d, v in windows if v == w) for _, w in windows]


@pytest.mark.parametrize("run", [substring_tree.drop_repeated_words, bwt_intervals.drop_repeated_bytes, exact_dedup.exact_groups, simhash_ball.near_groups])
def test_empty_table(spark, run):
    assert run(table(spark, [(1, "a")]).where("doc_id = 0")).collect() == []


def test_exact_groups(spark):
    rows = list(enumerate(texts(5))) + [(900, "É"), (901, "é"), (902, "E" * 5000 + "x"), (903, "e" * 5000 + "X"), (904, "e" * 5000 + "y")]
    got = exact_dedup.exact_groups(table(spark, rows), digest_all=True, bits=12)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = {}
    for d, t in rows:
        groups.setdefault((t or "").translate(lower), []).append(d)
    want = [(d, max(g), len(g), d == max(g), brute.sha(t.encode())) for t, g in groups.items() for d in g]
    assert sorted(map(tuple, got.drop("tag").collect())) == sorted(want)
    found = exact_dedup.exact_groups(table(spark, [(None, "a"), (7, "A"), (None, "b"), (3, "c"), (3, "c")]))
    kept = sorted(((r.doc_id, r.kept) for r in found.collect()), key=key)
    assert kept == [(3, True), (3, True), (7, True), (None, False), (None, True)]


def plain_fingerprint(text, size=4):
    words = brute.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_fingerprints(spark):
    rows = list(enumerate(texts(8)))
    got = {r.doc_id: r.fingerprint % 2**64 for r in simhash_ball.fingerprints(table(spark, rows)).collect()}
    assert got == {d: plain_fingerprint(t) for d, t in rows}


@pytest.mark.parametrize("limit", [1 << 21, 5000])
def test_ball_links_find_every_neighbour(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash_ball, "_TASK_VARIANTS", limit)
    rng = random.Random(limit)
    centres = [rng.getrandbits(64) for _ in range(12)]
    values = {0, 2**64 - 1, *centres}
    for c in centres:
        for _ in range(25):
            v = rng.choice([c, rng.choice(sorted(values))])
            for _ in range(rng.randint(1, 5)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values = sorted(values)
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    links = simhash_ball.ball_links(spark.createDataFrame([(v,) for v in signed], "fingerprint bigint"))
    got = {r.node: r.root for r in components(links, "a", "b").collect()}
    near = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if bin((a ^ b) % 2**64).count("1") <= 4]
    want = plain_components(signed, near)
    groups = lambda m: {frozenset(n for n in signed if m.get(n, n) == r) for r in {m.get(n, n) for n in signed}}
    assert groups(got) == groups(want)


def test_near_groups(spark):
    rows = [(d, t) for d, t in enumerate(texts(9), 10)] + [(None, None), (5, ""), (5, "")]
    got = simhash_ball.near_groups(table(spark, rows)).collect()
    prints = {d: plain_fingerprint(t) for d, t in rows if d is not None}
    ids = list(prints)
    want = plain_components(ids, [(a, b) for i, a in enumerate(ids) for b in ids[:i] if bin(prints[a] ^ prints[b]).count("1") <= 4])
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert [r.component_id for r in got if r.doc_id is None] == [5] and len(got) == len(rows)
    with pytest.raises(ValueError):
        simhash_ball.ball_links(spark.createDataFrame([(1,)], "fingerprint bigint"), radius=3)


def test_components_of_chains_stars_and_strings(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1, i) for i in range(2, 60)]
    rows = chain + star + [(900, 900), (None, 3), (3, None), (59, 2)]
    random.Random(1).shuffle(rows)
    got = {r.node: r.root for r in components(spark.createDataFrame(rows, "x bigint, y bigint"), "x", "y").collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 60)}, 900: 900}
    names = spark.createDataFrame([("b", "a"), ("c", "b")], "x string, y string")
    assert {r.node: r.root for r in components(names, "x", "y").collect()} == {"a": "a", "b": "a", "c": "a"}
    assert components(names.where("x = 'z'"), "x", "y").collect() == []


def test_xxh64_of_slices():
    rng = random.Random(3)
    data = np.frombuffer(rng.randbytes(4000), dtype=np.uint8)
    start = np.array([rng.randrange(3000) for _ in range(500)])
    end = start + np.array([rng.choice([0, 1, 3, 4, 7, 8, 12, 31, 32, 33, 64, 100, 256, 257, 900]) for _ in range(500)])
    want = [xxhash.xxh64_intdigest(data[s:e].tobytes(), 42) for s, e in zip(start, end)]
    assert blocks.xxh64(data, start, end).tolist() == want
