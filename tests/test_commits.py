"""Committed tables, incremental aggregates and key checks in one scan."""

import pytest
from pyspark.sql import functions as F

from quadrata.operators import quality as q
from quadrata.operators.aggregates import counts_with_complement
from quadrata.sources import commits
from quadrata.streaming import counts


def rows(spark, *values):
    return spark.createDataFrame([(v, f"s{v}") for v in values], "i int, s string")


def held(spark, path, df, fmt="parquet"):
    return sorted(r.i for r in commits.read_committed(spark, path, df.schema, fmt).collect())


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_runs_take_their_own_place(spark, tmp_path, fmt):
    path, df = str(tmp_path / "t"), rows(spark, 1, 2)
    assert held(spark, path, df, fmt) == []
    assert commits.commit(df, path, "a", fmt=fmt) == 1
    commits.commit(rows(spark, 3), path, "b", "append", fmt)
    commits.commit(rows(spark, 3), path, "b", "append", fmt)
    assert held(spark, path, df, fmt) == [1, 2, 3]
    commits.commit(rows(spark, 4, 5), path, "b", "append", fmt)
    assert held(spark, path, df, fmt) == [1, 2, 4, 5]
    commits.commit(rows(spark, 9), path, "c", "overwrite", fmt)
    assert held(spark, path, df, fmt) == [9]
    assert commits.vacuum(spark, path) > 0 and held(spark, path, df, fmt) == [9]
    with pytest.raises(ValueError):
        commits.commit(df, path, "a", "ignore")


def test_a_writer_that_dies_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    commits.commit(rows(spark, 1), path, "a")

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(commits, "_publish", dies)
        for mode in ("append", "overwrite"):
            with pytest.raises(OSError):
                commits.commit(rows(spark, 2), path, "b", mode)
    broken = rows(spark, 7).withColumn("i", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        commits.commit(broken, path, "c")
    assert held(spark, path, rows(spark)) == [1]
    commits.commit(rows(spark, 2), path, "b", "append")
    assert held(spark, path, rows(spark)) == [1, 2]


def test_two_writers_cannot_take_the_same_number(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    commits.commit(rows(spark, 1), path, "a")
    seen, true = [], commits.manifest

    def late(spark, path):
        found = true(spark, path)
        if not seen:  # another writer commits between reading the manifest and writing the next
            seen.append(found)
            commits.commit(rows(spark, 2), path, "b", "append")
        return found

    monkeypatch.setattr(commits, "manifest", late)
    assert commits.commit(rows(spark, 3), path, "c", "append") == 3
    monkeypatch.undo()
    assert held(spark, path, rows(spark)) == [1, 2, 3]


def test_incremental_counts_survive_replays_and_merging(spark, tmp_path, monkeypatch):
    df = spark.range(600).select((F.col("id") % 7).alias("k"), (F.col("id") % 3 == 0).cast("int").alias("flag"))
    folder, table, progress = (str(tmp_path / x) for x in ("in", "table", "progress"))
    df.where("k < 4").repartition(4).write.parquet(folder)
    want = lambda d: sorted(counts_with_complement(d, ["k"], "n", "f", "rest", "part").collect())

    def partial(part):
        return part.groupBy("k").agg(F.count("*").alias("n"), F.sum("flag").alias("flagged"))

    def merge(parts):
        return parts.groupBy("k").agg(F.sum("n").alias("n"), F.sum("flagged").alias("flagged"))

    def fold(parts):
        return counts_with_complement(parts, ["k"], "n", "f", "rest", "part", n="n", flag="flagged")

    def run(where=progress):
        stream = counts.file_stream(spark, folder, "*.parquet", df.schema, files_per_batch=1)
        return sorted(counts.run_incremental(stream, partial, fold, table, where).collect())

    assert run() == want(df.where("k < 4")) and len(commits.manifest(spark, table)[1]) == 4
    assert run(str(tmp_path / "replayed")) == want(df.where("k < 4"))  # every batch comes again
    counts.compact(spark, table, merge)
    assert list(commits.manifest(spark, table)[1]) == ["to-3"]
    assert run(str(tmp_path / "again")) == want(df.where("k < 4"))
    df.where("k >= 4").coalesce(1).write.mode("append").parquet(folder)
    assert run() == want(df) and set(commits.manifest(spark, table)[1]) == {"to-3", "batch-4"}


def test_key_checks_in_one_scan(spark):
    long = "x" * 100
    fact = spark.createDataFrame([(i, i % 5, None if i % 9 == 0 else f"n{i % 4}", 5.0 if i else 7.0) for i in range(200)], "id int, a int, s string, d double")
    fact = fact.unionByName(fact.where("id < 3")).unionByName(spark.createDataFrame([(500, None, long, 5.0), (500, None, long, 5.0)], fact.schema))
    dims = {
        "fact": fact,
        "a": spark.createDataFrame([(k,) for k in (0, 1, 2, 3, 3)], "k bigint"),
        "s": spark.createDataFrame([("n0",), ("n1",), (None,), (long,)], "k string"),
        "d": spark.createDataFrame([(5,)], "k int"),
        "none": spark.createDataFrame([], "k int"),
    }
    keys = [
        q.UniqueKey("id", "fact", ("id",)),
        q.UniqueKey("id_a", "fact", ("id", "a")),
        q.UniqueKey("s", "s", ("k",)),
        q.UniqueKey("dim_a", "a", ("k",)),
        q.UniqueKey("empty", "none", ("k",)),
        q.ForeignKey("fk_a", "fact", "a", "a", "k"),
        q.ForeignKey("fk_s", "fact", "s", "s", "k"),
        q.ForeignKey("fk_d", "fact", "d", "d", "k"),
        q.ForeignKey("fk_none", "fact", "a", "none", "k"),
        q.ForeignKey("fk_of_none", "none", "k", "a", "k"),
    ]
    checked = q.key_checks(dims, keys)
    got = {r.check_name: (r.observed, r.passed) for r in checked.collect()}
    want = {"id": 4, "id_a": 4, "s": 0, "dim_a": 1, "empty": 0, "fk_a": 1, "fk_s": 2, "fk_d": 1, "fk_none": 5, "fk_of_none": 0}
    assert got == {k: (n, n == 0) for k, n in want.items()}
    for k in keys:
        if isinstance(k, q.UniqueKey):
            one = q.unique_check(dims[k.table], k.columns, k.name)
        elif k.name != "fk_d":
            one = q.foreign_key_check(dims[k.table], dims[k.dim], k.column, k.dim_column, k.name)
        assert k.name == "fk_d" or one.first().observed == want[k.name]
    assert sorted(r.check_name for r in q.key_checks(dims, keys[:3]).collect()) == ["id", "id_a", "s"]


def test_key_checks_scan_each_table_once(spark, tmp_path):
    spark.range(50).write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    plan = q.key_checks({"t": t}, [q.UniqueKey("u", "t", ("id",)), q.ForeignKey("f", "t", "id", "t", "id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.split("+- == Initial Plan ==")[0].count("FileScan parquet") == 1
