"""CSV with line breaks inside values, read in splits, beside the reader that takes a file per task."""

import random

import pytest
from pyspark.sql import functions as F

from quadrata.sources import csv_splits
from quadrata.sources.layers import read_csv

SMALL = {"spark.sql.files.maxPartitionBytes": "120b", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def plain(spark, path, encoding="UTF-8"):
    options = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "inferSchema": "false"}
    df = spark.read.options(**options).csv(path, encoding=encoding)
    return df.toDF(*[c.lstrip("﻿") for c in df.columns])


def rows(df):
    return df.columns, sorted(map(tuple, df.collect()), key=repr)


def value(rng):
    kind = rng.random()
    words = " ".join(rng.choice(["uno", "dos,", "ñandú", "x"]) for _ in range(rng.randint(0, 6)))
    if kind < 0.3:
        return words.replace(",", "")
    if kind < 0.4:
        return '""'
    inner = rng.choice(["\n", "\n\n", ",", '""', '"",""', "\n,\n", ""]).join(words for _ in range(rng.randint(1, 12)))
    return f'"{inner}"'


def written(path, seed, n, end="\n", encoding="utf-8", last=True):
    rng = random.Random(seed)
    lines = ["id,a,b", *(f"{i},{value(rng)},{value(rng)}" for i in range(n))]
    path.write_bytes((end.join(lines) + (end if last else "")).encode(encoding))
    return str(path)


@pytest.mark.parametrize("seed", range(4))
def test_splits_give_the_rows_of_a_whole_file(spark, tmp_path, small_splits, seed):
    path = written(tmp_path / "a.csv", seed, 60, last=seed % 2 == 0)
    splits = csv_splits.scan_splits(spark, path).collect()
    assert len(splits) > 10 and any(r.odd for r in splits) and not any(r.stray or r.broken for r in splits)
    assert rows(csv_splits.read_split_csv(spark, path)) == rows(plain(spark, path))
    assert rows(read_csv(spark, path)) == rows(plain(spark, path))


def test_a_value_longer_than_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(500))
    path = tmp_path / "a.csv"
    path.write_text(f'id,a\n1,"{long}"\n2,x\n3,"{long}"\n')
    got = {r.id: r.a for r in csv_splits.read_split_csv(spark, str(path)).collect()}
    assert got == {"1": long, "2": "x", "3": long}


def test_folders_encodings_marks_and_line_ends(spark, tmp_path, small_splits):
    folder = tmp_path / "f"
    folder.mkdir()
    for i in range(3):
        written(folder / f"{i}.csv", i, 30)
    assert rows(csv_splits.read_split_csv(spark, str(folder))) == rows(plain(spark, str(folder)))
    latin = written(tmp_path / "l.csv", 7, 40, encoding="latin-1")
    assert rows(read_csv(spark, latin)) == rows(plain(spark, latin, "ISO-8859-1"))
    marked = written(tmp_path / "m.csv", 8, 20, encoding="utf-8-sig")
    assert rows(read_csv(spark, marked))[0] == ["id", "a", "b"] and rows(read_csv(spark, marked)) == rows(plain(spark, marked))
    windows = written(tmp_path / "w.csv", 9, 40, end="\r\n")
    assert rows(read_csv(spark, windows)) == rows(plain(spark, windows))


def test_names_blanks_and_empty_files(spark, tmp_path, small_splits):
    path = tmp_path / "a.csv"
    path.write_text('a,"b ""x""",,A\n1,2,3,4\n\n5,"",,\n6\n')
    assert rows(csv_splits.read_split_csv(spark, str(path))) == rows(plain(spark, str(path)))
    for text, n in (("a,b\n", 0), ("a\n\n\n1\n", 1)):
        path.write_text(text)
        assert rows(read_csv(spark, str(path))) == rows(plain(spark, str(path))) and read_csv(spark, str(path)).count() == n


def test_files_with_stray_quotes_are_left_to_the_whole_file_reader(spark, tmp_path, small_splits):
    path = tmp_path / "a.csv"
    path.write_text('id,size\n1,5" pipe\n2,"ok\nok"\n')
    assert csv_splits.read_split_csv(spark, str(path)) is None
    assert rows(read_csv(spark, str(path))) == rows(plain(spark, str(path)))


def test_records_stay_in_the_tasks_that_read_them(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,a\n" + "".join(f'{i},"x\ny"\n' for i in range(1000)))
    plan = csv_splits.read_split_csv(spark, str(path)).agg(F.count("*"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and plan.count("Window") == 1
