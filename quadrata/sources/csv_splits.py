"""CSV whose quoted values may span lines, read in splits.

Where a record starts depends on how many quotes come before it in the file. Quotes of a split are counted modulo two without
knowing what lies before; these counts compose, so the state at the start of every split follows from one row per split. A
second scan then cuts each split into records. Only what a split begins with before its first record start, the end of a
record of an earlier split, is moved: it joins that record's beginning. The rest stays in the task that has read it.

This holds where a quote is part of the syntax, as in exchanged files: at the edges of a value, or doubled inside one. The
first scan looks for other quotes too, and such files are left to the reader that takes a whole file per task.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_PLACE = ["path", "at"]
#: A quote that neither touches another one nor an edge of the value.
_STRAY = r'[^",\r]"[^",\r]'


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines as bytes, with the split they were read in; a carriage return stays at the end of its line."""
    lines = spark.read.option("lineSep", "\n").text(path)
    meta = F.col("_metadata")
    return lines.select(F.col("value"), meta["file_path"].alias("path"), meta["file_block_start"].alias("at"))


def scan_splits(spark: SparkSession, path: str) -> DataFrame:
    """(path, at, odd, stray, broken) per split: parity of its quotes, lines with a stray quote, lines that are not UTF-8."""
    value = F.col("value")
    quotes = F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))
    return _lines(spark, path).groupBy(*_PLACE).agg(
        (F.sum(quotes.cast("bigint")) % 2 == 1).alias("odd"),
        F.count_if(value.contains('"') & value.rlike(_STRAY)).alias("stray"),
        F.count_if(~F.is_valid_utf8(value)).alias("broken"),
    )


def _pieces(inside: dict[tuple[str, int], bool]):
    """Records of each split, in order: whole ones, the end of an earlier one first, and one that goes on in the next split."""
    schema = pa.schema([("path", pa.string()), ("at", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("record", pa.binary())])
    whole, end, begin = 0, 1, 2

    class Split:
        def __init__(self, place: tuple[str, int]):
            self.place, self.open, self.held, self.kind, self.fresh = place, inside[place], [], end, True
            if not self.open:
                self.kind = whole

        def records(self, lines: list[bytes]) -> Iterator[tuple[int, bool, bytes]]:
            for line in lines:
                self.held.append(line)
                self.open ^= line.count(b'"') & 1 == 1
                if not self.open:
                    yield self.cut()

        def cut(self) -> tuple[int, bool, bytes]:
            kind, first = self.kind, self.fresh and self.place[1] == 0
            self.kind, self.fresh = whole, False
            record, self.held = b"\n".join(self.held), []
            return kind, first, record

        def rest(self) -> Iterator[tuple[int, bool, bytes]]:
            if self.held:
                self.kind = begin if self.kind == whole else 3  # a split in the middle of one value
                yield self.cut()

    def batch(place, rows) -> pa.RecordBatch:
        kinds, firsts, records = zip(*rows)
        columns = [[place[0]] * len(rows), [place[1]] * len(rows), kinds, firsts, records]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches):
        split: Split | None = None
        for b in batches:
            paths, ats = b.column("path").to_pylist(), b.column("at").to_numpy()
            lines = b.column("value").to_pylist()
            edges = [0, *(np.flatnonzero(ats[1:] != ats[:-1]) + 1).tolist(), len(lines)] if len(lines) else []
            edges = sorted({*edges, *(i for i in range(1, len(lines)) if paths[i] != paths[i - 1])})
            for s, e in zip(edges[:-1], edges[1:]):
                if split is None or split.place != (paths[s], int(ats[s])):
                    if split is not None and (rows := list(split.rest())):
                        yield batch(split.place, rows)
                    split = Split((paths[s], int(ats[s])))
                if rows := list(split.records(lines[s:e])):
                    yield batch(split.place, rows)
        if split is not None and (rows := list(split.rest())):
            yield batch(split.place, rows)

    return run


def read_records(spark: SparkSession, path: str, splits: DataFrame) -> DataFrame:
    """(path, first, record): the bytes of every record, without its line end; ``first`` marks the first one of each file.

    ``splits``: what :func:`scan_splits` has found, a row per split of the files, which the driver holds.
    """
    inside: dict[tuple[str, int], bool] = {}
    state: dict[str, bool] = {}
    for r in sorted(splits.collect(), key=lambda r: (r.path, r.at)):
        inside[r.path, r.at] = state.get(r.path, False)
        state[r.path] = inside[r.path, r.at] ^ r.odd
    raw = _lines(spark, path).withColumn("value", F.col("value").cast("binary"))
    pieces = raw.mapInArrow(_pieces(inside), "path string, at bigint, kind int, first boolean, record binary")
    torn = pieces.where("kind > 0")
    order = Window.partitionBy("path").orderBy("at", "kind")
    named = torn.withColumn("n", F.count_if(F.col("kind") == 2).over(order))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("at", "kind", "record"))), lambda p: F.to_char(p["record"], F.lit("hex")))
    joined = named.groupBy("path", "n").agg(F.unhex(F.array_join(parts, "0A")).alias("record"), F.max("first").alias("first"))
    return pieces.where("kind = 0").select("path", "first", "record").unionByName(joined.select("path", "first", "record"))


def read_split_csv(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame | None:
    """All columns as text; None if a quote stands where it is no syntax. UTF-8, or Latin-1 if some line is not valid UTF-8.

    The first record of every file is its header; all files have that of the first. Empty lines are no records.
    """
    splits = scan_splits(spark, path).persist()
    try:
        found = splits.agg(F.sum("stray").alias("stray"), F.sum("broken").alias("broken"), F.count("*").alias("n")).first()
        if not found.n or found.stray:
            return None
        encoding = encoding or ("UTF-8" if not found.broken else "ISO-8859-1")
        records = read_records(spark, path, splits)
    finally:
        splits.unpersist()
    text = F.decode("record", encoding) if encoding.upper() != "UTF-8" else F.col("record").cast("string")
    told = records.select("path", "first", F.regexp_replace(text, "\\r\\z", "").alias("record"))
    head = told.where("first").orderBy("path").limit(1).collect()
    if not head:
        return None
    names = header_names(head[0].record)
    fields = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"}
    parsed = told.where("not first and record <> ''").select(F.from_csv("record", fields, options).alias("r"))
    return parsed.select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)])


def header_names(record: str) -> list[str]:
    """Names of a header record: empty ones are numbered, and so are those that occur more than once."""
    names = next(csv.reader(io.StringIO(record.lstrip("\ufeff"), newline="")))
    low = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if low.count(n.lower()) > 1 else n for i, n in enumerate(names)]
