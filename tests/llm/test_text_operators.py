"""BPE, chat trees, toxicity, leaks, licenses and urls beside plain versions and exact round trips."""

import base64
import itertools
import random
import zlib

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quadrata.llm import bpe, chat_tree, decontaminate, licenses, toxicity, url_filter
from quadrata.llm.blocks import with_tag

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference_encoding():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


# --- BPE ---------------------------------------------------------------------------------------------------------

PIECES = ["'", "s", "re", "ll", "v", "'d", "'ve", " ", "  ", "\n", "\t", "a", "B", "1", "²", "!", "é", "日", "😀", " ", "\x1c", "<|endoftext|>"]


def test_bpe_equals_the_library(spark, reference_encoding):
    rng = random.Random(4)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    texts += [None, "", "x" * 5000, "ab" * 4000, " " * 700, "word " * 90_000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, ids int")
    encoded = bpe.encode(docs, PATH)
    rows = {r.doc_id: r for r in encoded.collect()}
    for i, text in enumerate(texts):
        want = reference_encoding.encode_ordinary(text or "")
        assert np.frombuffer(rows[i].ids, "<u4").tolist() == want and rows[i].n_tokens == len(want), text
        offsets = np.frombuffer(rows[i].offsets, "<u4")
        assert offsets.tolist() == [0, *np.cumsum([len(reference_encoding.decode_single_token_bytes(t)) for t in want]).tolist()][:-1]
    decoded = {r.doc_id: bytes(r.decoded) for r in bpe.decode(encoded, PATH).collect()}
    assert decoded == {i: (t or "").encode() for i, t in enumerate(texts)}
    assert bpe.encode(docs.where("doc_id < 0"), PATH).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("'sredvlmt  \n\tA1!é　日"), max_size=30), min_size=1, max_size=6))
def test_token_starts_are_those_of_the_pattern(texts):
    import regex

    codes = np.array([ord(c) for t in texts for c in t], dtype=np.uint32)
    if not len(codes):
        return
    first = np.zeros(len(codes), dtype=bool)
    at, want = 0, []
    for t in texts:
        if t:
            first[at] = True
        want += [at + m.start() for m in regex.finditer(public_tokenizers.PATTERN, t)]
        at += len(t)
    assert np.flatnonzero(bpe.token_starts(codes, first)).tolist() == want


# --- Chat trees --------------------------------------------------------------------------------------------------


@given(st.text(), st.text())
@settings(max_examples=200, deadline=None)
def test_turns_can_be_read_back(role, text):
    assert chat_tree.parsed(chat_tree.turn_text(role, text)) == [(role, text)]


def test_tree_emits_shared_turns_once(spark):
    rng = random.Random(2)
    rows = []
    for c in range(120):
        rows += [(c, 0, "system", "common"), (c, 1, "user", f"q{c % 7}"), (c, 2, "assistant", f"<|im_end|>\\a{c % 30}")]
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["x", None, "<|"])) for t in range(3, 3 + c % 3)]
    rows += [(500, 0, "assistant", "same"), (500, 0, "assistant", "same"), (None, 0, "user", "lost"), (501, None, "user", "no turn")]
    rows += [(502, t, "user", f"turn {t}") for t in range(800)]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(*r, "extra", 3) for r in rows], "conv_id bigint, turn bigint, role string, text string, node string, pack int")
    said = {}
    for c, t, role, text in sorted(rows, key=lambda r: tuple((x is not None, x) for x in r)):
        said.setdefault(c, []).append((role or "", text or ""))
    for pack in (256, 5):
        packs, membership = chat_tree.format_chats(frame, pack)
        packed, members = packs.collect(), membership.collect()
        assert {m.conv_id for m in members} == set(said)
        by = {bytes(p.pack): p for p in packed}
        for m in members:
            p = by[bytes(m.pack)]
            node = next(n for n in p.nodes if n.node == m.node)
            spans = [*node.attends, node]
            text = "".join(p.text[s.start : s.end] for s in spans)
            assert chat_tree.parsed(text) == said[m.conv_id]
            assert node.position + node.end - node.start == len(text)
        for p in packed:  # every node once, depth first, nothing between; parents before children
            assert [n.start for n in p.nodes] == [0, *(n.end for n in p.nodes)][:-1] and p.nodes[-1].end == len(p.text)
            assert len({bytes(n.node) for n in p.nodes}) == len(p.nodes)
            assert all(n.parent < i and (n.parent < 0 or p.nodes[n.parent].position < n.position) for i, n in enumerate(p.nodes))
        back = {r.conv_id: r for r in chat_tree.read_back(packs, membership).collect()}
        for c, turns in said.items():
            assert back[c].n_turns == len(turns) and back[c].loss_chars == sum(len(t) for r, t in turns if r == "assistant")
    assert sum(len(p.text) for p in chat_tree.format_chats(frame)[0].collect()) < sum(len(chat_tree.turn_text(r, t)) for v in said.values() for r, t in v)
    assert chat_tree.format_chats(frame.where("conv_id < -5"))[0].collect() == []


# --- Toxicity ----------------------------------------------------------------------------------------------------


def quadratic_segments(scores):
    """The maximal segments by their recursive definition: the best one, then those of what is left of and right of it."""
    best = None
    sums = [0, *itertools.accumulate(scores)]
    for s in range(len(scores)):
        for e in range(s + 1, len(scores) + 1):
            value = (sums[e] - sums[s], -(e - s))
            if sums[e] > sums[s] and (best is None or value > best[0]):
                best = (value, s, e)
    if best is None:
        return []
    _, s, e = best
    return quadratic_segments(scores[:s]) + [(s, e, sums[e] - sums[s])] + [(a + e, b + e, x) for a, b, x in quadratic_segments(scores[e:])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-9, 9).map(lambda i: i * 1.0 + (0.37 if i > 0 else 0.0)), max_size=25))
def test_segments_are_the_maximal_ones(scores):
    found = toxicity.maximal_segments(np.array(scores, dtype=float))
    assert sum(x for _, _, x in found) == pytest.approx(sum(x for _, _, x in quadratic_segments(scores)))
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))


def test_toxicity_on_held_out_documents(spark):
    rng = random.Random(6)
    words = [f"word{i}" for i in range(300)]
    bad = [f"slur{i}" for i in range(12)]
    rows, labels = [], []
    for d in range(1500):
        toxic = int(rng.random() < 0.2)
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        if toxic:
            at = rng.randrange(len(text))
            text[at:at] = [rng.choice(bad).title() + "," for _ in range(rng.randint(2, 5))]
        rows.append((d, " ".join(text), toxic))
        labels.append((d, 1, toxic))
    rows += [(2000, None, 0), (2001, "", 0), (None, "slur1 slur2 slur3", 1), (2002, "word1 " * 50_000, 0)]
    labels += [(3, 1, None), (4000, 0, 1)]
    docs = spark.createDataFrame([(d, t, "x") for d, t, _ in rows], "doc_id bigint, text string, toxic string")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(docs, marks).collect()
    truth = {d: y for d, _, y in rows}
    assert len(got) == len(rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    empty = [r.score for r in got if r.doc_id in (2000, 2001)]
    assert empty[0] == empty[1] == min(r.score for r in got)
    assert any(p.expected < 0.01 for r in got if r.doc_id is None for p in r.passages)
    unlabelled = toxicity.toxicity(docs.limit(5), marks.where("toxic = 5")).collect()
    assert [r.predicted for r in unlabelled] == [0] * 5
    assert toxicity.toxicity(docs.where("doc_id < 0"), marks).collect() == []


# --- Benchmark leaks ---------------------------------------------------------------------------------------------


def weighted(a, b):
    from collections import Counter

    shingles = lambda w: Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
    x, y = shingles(a), shingles(b)
    return sum((x & y).values()) / sum((x | y).values())


def test_leaks_beside_all_windows(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(500)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = {i: say(rng.choice([3, 8, 20, 60, 61])) for i in range(25)} | {90: ["la"] * 30}
    docs = {}
    for d in range(150):
        text = say(rng.randint(0, 80))
        item = list(items[rng.choice(list(items))])
        kind = rng.random()
        if kind < 0.3:
            text += item + say(10)
        elif kind < 0.6 and len(item) > 30:
            item[rng.randrange(len(item))] = "changed"
            text += item[: rng.choice([len(item), len(item) - 2])]
        docs[d] = text
    docs[200] = ["la"] * 29
    frame = spark.createDataFrame(
        [(d, ", ".join(t).title(), 1) for d, t in docs.items()] + [(300, None, 1), (301, "", 1)], "doc_id bigint, text string, size int"
    )
    bench = spark.createDataFrame([(i, " ".join(t), "z") for i, t in items.items()] + [(400, None, "z"), (401, " ", "z")], "item_id bigint, text string, print string")
    got = decontaminate.leaks(with_tag(frame), bench).collect()
    want = {}
    for d, text in docs.items():
        for i, item in items.items():
            n = min(len(item), len(text))
            best = max((weighted(text[s : s + n], item) for s in range(len(text) - n + 1)), default=0) if n else 0
            if best >= 0.8:
                want[d, i] = best
    assert {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in got} == want and len(got) == len(want) > 40
    for r in got:
        assert weighted(docs[r.doc_id][r.start : r.start + r.n_words], items[r.item_id]) == pytest.approx(r.similarity)
    assert decontaminate.leaks(with_tag(frame), bench.where("item_id < 0")).collect() == []
    assert decontaminate.leaks(with_tag(frame.where("doc_id < 0")), bench).collect() == []


# --- Licenses ----------------------------------------------------------------------------------------------------


def test_licenses_are_found_and_inherited(spark):
    rows = [
        (1, "LICENSE", "Released under the MIT License."),
        (2, "src/a.py", "code\n# Licensed under the Apache License, Version 2.0.\nmore code"),
        (3, "src/b.py", "nothing here " * 50),
        (4, "src/deep/COPYING.txt", "This work is licensed under the GNU General Public License, version 3."),
        (5, "src/deep/er/c.py", None),
        (6, "lib/d.py", ""),
        (7, None, "Released under the MIT License."),
        (8, "src/e.py", ("word " * 20_000) + "\r\nLicensed under CC BY-NC 4.0.\r\n"),
        (6, "lib/d.py", ""),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "file_id bigint, path string, text string, license string")
    got = {(r.file_id, r.license, r.origin, r.license_path) for r in licenses.scan(frame).collect()}
    assert got == {
        (1, "MIT", "file", "LICENSE"),
        (2, "Apache-2.0", "header", "src/a.py"),
        (3, "MIT", "inherited", "LICENSE"),
        (4, "GPL-3.0", "file", "src/deep/COPYING.txt"),
        (5, "GPL-3.0", "inherited", "src/deep/COPYING.txt"),
        (6, "MIT", "inherited", "LICENSE"),
        (7, "MIT", "file", None),
        (8, "CC-BY-NC-4.0", "header", "src/e.py"),
    }
    assert licenses.scan(frame).count() == len(rows)
    assert licenses.scan(frame.where("file_id < 0")).collect() == []


def test_license_weights_depend_on_shares_and_not_on_the_number_of_files(spark):
    """A notice among common words is as similar in a table of 60 times as many files."""
    prose = "the code comes with this"
    more = {0: "\nThis code comes with the MIT License", 1: " released", 2: " under"}
    found = []
    for n in (40, 2400):
        rows = [(i, f"d{i}/x", prose + more.get(i % 20, "")) for i in range(n)]
        frame = spark.createDataFrame(rows, "file_id bigint, path string, text string")
        found.append({r.file_id % 20: (r.license, r.origin, r.similarity) for r in licenses.scan(frame).collect()})
    assert [f[0][:2] for f in found] == [("MIT", "header")] * 2
    assert all(f[i] == (None, None, None) for f in found for i in range(1, 20))
    assert found[0][0][2] == pytest.approx(found[1][0][2], abs=0.06)


def test_licenses_are_found_within_long_lines(spark):
    rng = random.Random(8)
    say = lambda n: " ".join(f"term{rng.randrange(400)}" for _ in range(n))
    rows, want = [], {}
    for i, (name, notice) in enumerate(licenses.TEMPLATES.items()):
        for k, (a, b) in enumerate([(0, 200), (200, 0), (3000, 3000), (9, 7), (0, 30)]):
            rows.append((10 * i + k, f"d{i}-{k}/x", f"{say(a)} {notice} {say(b)}"))
            want[10 * i + k] = (name, 1.0, "header")
    rows.append((900, "e/x", f"{say(50)} the MIT of the {say(50)}"))
    rows.append((901, "f/x", f"{say(40)} Licensed under the terms of the Apache License, Version 2.0. {say(40)} Apache"))
    want |= {900: (None, None, None), 901: ("Apache-2.0", None, "header")}
    got = {r.file_id: r for r in licenses.scan(spark.createDataFrame(rows, "file_id bigint, path string, text string")).collect()}
    assert len(got) == len(rows)
    for i, (name, similarity, origin) in want.items():
        assert (got[i].license, got[i].origin) == (name, origin) and (similarity is None or got[i].similarity == similarity), rows[i % 10]
    plan = licenses.scan(spark.createDataFrame(rows, "file_id bigint, path string, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- Urls --------------------------------------------------------------------------------------------------------

RULES = [("block", "bad.org", "/"), ("allow", "ok.bad.org", "/"), ("block", "net", "/x/"), ("allow", "a.net", "/x/y"), ("allow", "good.org", "/")]


def test_urls_follow_rules_and_aliases(spark):
    canonical = lambda u: f'<html><LINK  href="{u}" rel="canonical"></html>'
    rows = [
        (1, "http://BAD.org/p", None, "bad.org", "/p", "bad.org/", "block"),
        (2, "http://alias.com/1#frag", canonical("http://bad.org/q"), "alias.com", "/1", None, "block"),
        (3, "https://alias.com/2", '<meta http-equiv="refresh" content="0; url=/1">', "alias.com", "/2", None, "block"),
        (4, "http://good.org/", canonical("http://bad.org/q"), "good.org", "/", "good.org/", "allow"),
        (5, "http://ok.bad.org/z", "", "ok.bad.org", "/z", "ok.bad.org/", "allow"),
        (6, "http://s.a.net/x/yz?q=1", "", "s.a.net", "/x/yz", "a.net/x/y", "allow"),
        (7, "http://b.net/x/", "", "b.net", "/x/", "net/x/", "block"),
        (8, "http://xbad.org", "<link rel=canonical>", "xbad.org", "", None, "allow"),
        (9, None, canonical("http://bad.org/"), "", "", None, "allow"),
        (10, "no scheme", None, "", "", None, "allow"),
        (11, "http://bad.org", None, "bad.org", "", None, "allow"),
        (11, "http://bad.org", None, "bad.org", "", None, "allow"),
        (12, "http://other.com/?a=http://bad.org/", canonical("//other.com/#x"), "other.com", "/", None, "allow"),
    ]
    rows += [(100 + i, f"http://chain.com/{i}", canonical(f"/{i + 1}"), "chain.com", f"/{i}", None, "block") for i in range(20)]
    rows += [(120, "http://chain.com/20", canonical("http://bad.org/end"), "chain.com", "/20", None, "block")]
    frame = spark.createDataFrame([(*r[:3], "x", 1) for r in rows], "page_id bigint, url string, html string, host string, node int")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(frame, RULES).collect())
    assert got == sorted((r[0], *r[3:]) for r in rows)
    assert url_filter.judge(frame.where("page_id < 0"), RULES).collect() == []
    plan = url_filter.judge(frame, RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_relative_and_escaped_targets_are_aliases(spark):
    canonical = lambda u: f'<link rel="canonical" href="{u}">'
    refresh = lambda u: f'<meta http-equiv="refresh" content="0; url={u}">'
    rows = [
        (1, "http://a.com/d/one.html?x=1#y", canonical("two.html"), "block"),
        (2, "http://a.com/d/two.html", refresh("../e/three.html"), "block"),
        (3, "http://a.com/e/three.html", canonical("?id=2&amp;k=3"), "block"),
        (4, "http://a.com/e/three.html?id=2&k=3", refresh("/go?to=1&amp;from=2"), "block"),
        (5, "http://a.com/go?to=1&from=2", canonical("./f/./g/../h?back=http://x.com/"), "block"),
        (6, "http://a.com/f/h?back=http://x.com/", refresh("http://bad.org/z?a=1&amp;b=2"), "block"),
        (7, "http://b.com", canonical("p"), "block"),
        (8, "http://b.com/p", canonical("../../../q/.."), "block"),
        (9, "http://b.com/", canonical("//BAD.org/z?a=1&amp;b=2"), "block"),
        (10, "http://c.com/p", canonical("mailto:someone@bad.org"), "allow"),
        (11, "http://c.com/q?r", canonical("#bad"), "allow"),
        (12, "http://c.com/mailto:someone@bad.org", canonical("http://bad.org/z"), "block"),
    ]
    frame = spark.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.judge(frame, RULES).collect()}
    assert got == {r[0]: r[3] for r in rows}


def test_pipeline_stages_drop_what_they_should(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(3)
    words = [f"term{i}" for i in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    item = say(30)
    base = [(d, say(60)) for d in range(300)]
    rows = [(d, t + (" slur slur2 slur" if d % 4 == 1 else "")) for d, t in base]
    rows += [(1000, rows[0][1].upper()), (1001, say(20) + " " + item + " " + say(20)), (1002, None), (1003, ""), (None, say(50))]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(d, 1, int(d % 4 == 1)) for d in range(300)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = {r[0] for r in rows} - {d for d in range(300) if d % 4 == 1}
    gone = [set(), {0, 1002}, set(), {1001}]
    for (name, stage), out in zip(corpus_pipeline.STAGES[:-1], gone):
        docs = stage(spark, docs, str(tmp_path))
        left -= out
        assert {r.doc_id for r in docs.select("doc_id").collect()} == left, name
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in found.collect()} == left and found.where(F.col("n_tokens") > 0).count() == len(left) - 1
