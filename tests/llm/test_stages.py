"""The stages of the pipeline: planted near copies, columns of any name, and the session's settings."""

import random

import corpus_pipeline
from quadrata.llm.blocks import BATCH_BYTES

from .test_dedup import plain_components, plain_fingerprint

WORDS = [f"term{i}" for i in range(3000)]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def changed(rng, text, n):
    words = text.split(" ")
    for i in rng.sample(range(len(words)), n):
        words[i] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_one_document_of_each_simhash_group_stays(spark, tmp_path):
    rng = random.Random(13)
    rows = []
    for d in range(80):
        text = " ".join(rng.choice(WORDS) for _ in range(rng.randint(60, 400)))
        rows += [(10 * d + k, changed(rng, text, k)) for k in range(4)]
    rows += [(5000, ""), (5001, None), (5002, " ")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], SCHEMA)
    prints = {d: plain_fingerprint(t) for d, t in rows}
    ids = list(prints)
    near = [(a, b) for i, a in enumerate(ids) for b in ids[:i] if bin(prints[a] ^ prints[b]).count("1") <= 4]
    left = {d for d, root in plain_components(ids, near).items() if d == root}
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["simhash_dedup"](spark, docs, str(tmp_path)).collect()}
    assert kept == left and len(left) < 250 and {5001, 5002}.isdisjoint(left)


def test_stages_leave_other_columns_alone(spark, tmp_path):
    names = ["_id", "_tag", "_word", "_bits", "_row_tag", "row", "ID", "tag", "word", "bits", "kept", "fingerprint", "root", "a.b"]
    texts = ["some words that stay here", "some words that stay HERE", "bad bad words", "an item of the benchmark with ten words in it", None]
    rows = [(d, t, "en", "s", 1, *(f"{n}{d}" for n in names)) for d, t in enumerate(texts * 3)]
    docs = spark.createDataFrame(rows, SCHEMA + ", " + ", ".join(f"`{n}` string" for n in names))
    spark.createDataFrame([(1, texts[3])], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(d, 1, int(d % 5 == 2)) for d in range(15)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        found = out.collect()
        assert out.columns == docs.columns and 0 < len(found) <= len(rows), name
        assert all(tuple(r) == rows[r.doc_id] for r in found), name
        assert stage(spark, docs.where("doc_id < 0"), str(tmp_path)).collect() == []


def test_the_pipeline_restores_the_batch_size(spark, tmp_path):
    docs = [(d, f"text number {d}", "en", "s", 1) for d in range(9)]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "none of these")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(d, 1, d % 2) for d in range(9)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, "12345678")
    try:
        corpus_pipeline.run(spark, str(tmp_path))
        assert spark.conf.get(BATCH_BYTES) == "12345678"
    finally:
        spark.conf.set(BATCH_BYTES, before)
