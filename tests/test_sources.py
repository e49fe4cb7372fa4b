"""Layers on disk, session settings and the incremental path."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quadrata.operators.aggregates import counts_with_complement
from quadrata.session import cut_lineage, shared_dir
from quadrata.sources.discovery import profile
from quadrata.sources.layers import read_csv, read_layer, read_or_empty, write_layer
from quadrata.streaming.counts import file_stream, run_available


def test_csv_layer_round_trip(spark, tmp_path):
    data = [(1, 'a "quoted", text', 1.5), (2, None, None), (3, "two\nlines \\ slash", 0.1), (4, "NA", 2.0)]
    df = spark.createDataFrame(data, "i int, s string, x double")
    path = str(tmp_path / "layer")
    write_layer(df, path, "csv")
    assert sorted(tuple(r) for r in read_layer(spark, path, df.schema).collect()) == data
    words = {r.i: r.s for r in read_layer(spark, path, df.schema, na_words=True).collect()}
    assert words[4] is None and words[1] == data[0][1]
    write_layer(df, path, "csv", mode="append")
    assert read_layer(spark, path, df.schema).count() == 8
    write_layer(df, path, "csv")
    assert read_layer(spark, path, df.schema).count() == 4


def test_csv_encodings(spark, tmp_path):
    text = "año,valor\nMéxico,1\n"
    for name, encoding in (("u.csv", "utf-8"), ("b.csv", "utf-8-sig"), ("l.csv", "latin-1")):
        path = tmp_path / name
        path.write_bytes(text.encode(encoding))
        df = read_csv(spark, str(path))
        assert df.columns == ["año", "valor"] and df.first()[0] == "México"


def test_optional_source(spark, tmp_path):
    schema = StructType.fromDDL("a int, b string")
    assert read_or_empty(spark, str(tmp_path / "none"), schema).count() == 0


def test_profile(spark):
    df = spark.createDataFrame([(1, 2)], "`Año Base` int, x int")
    assert tuple(profile(df, "t").first()) == ("t", 1, 2, "Año Base,x", "ano_base,x")


def test_lineage_is_cut_in_the_configured_folder(spark):
    folder = shared_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or folder == configured
    kept = cut_lineage(spark.range(5).withColumn("r", F.rand()))
    assert kept.collect() == kept.collect()
    assert "Scan ExistingRDD" in kept._jdf.queryExecution().executedPlan().toString()


def test_stream_in_many_batches_equals_batch(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") % 3 == 0).cast("int").alias("flag"))
    path = str(tmp_path / "in")
    df.repartition(6).write.parquet(path)

    def counts(rows):
        return counts_with_complement(rows, ["k"], "n", "f", "rest", "part")

    got = run_available(file_stream(spark, path, "*.parquet", df.schema, files_per_batch=1), counts)
    assert sorted(got.collect()) == sorted(counts(df).collect())
    assert got.agg(F.sum("n")).first()[0] == 1000


def test_missing_sources_are_named(spark, tmp_path):
    from quadrata.plans.study import read_sources

    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    with pytest.raises(FileNotFoundError, match="fgj"):
        read_sources(spark, str(tmp_path), str(tmp_path / "landing"))


def test_headers_are_read_without_a_job_per_file(spark, tmp_path):
    from quadrata.sources.discovery import first_record, list_csv

    texts = {
        "a": "Año Base,x\n1,2\n".encode(),
        "b": "Año,x\r\n1,2\r\n".encode("latin-1"),
        "c": '﻿"two\nlines",y,Y\n1,2,3\n'.encode(),
        "d": b"\n1,2\n",
        "e": b"only,a,header",
        "f": ('"' + "long " * 3000 + '",z\n' + "1,2\n" * 50_000).encode(),
    }
    for name, data in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(data)
    (tmp_path / "g.txt").write_text("no,csv\n")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers"))
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        rows = list_csv(spark, str(tmp_path)).collect()
        assert jobs() < len(texts)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    found = {r.path[-5]: (r.size, r.columns) for r in rows}
    assert {n: s for n, (s, _) in found.items()} == {n: len(d) for n, d in texts.items()}
    columns = {n: c for n, (_, c) in found.items()}
    assert columns["a"] == ["ano_base", "x"] and columns["b"] == ["ano", "x"] and columns["d"] == [] and columns["e"] == ["only", "a", "header"]
    assert columns["c"][0] == "two_lines" and len(set(columns["c"])) == 3 and len(columns["f"]) == 2
    assert first_record(spark, str(tmp_path / "c.csv")).endswith("y,Y")
