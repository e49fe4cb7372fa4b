"""Recognising sources by their header."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrata.functions.names import dedupe_names
from quadrata.sources.csv_splits import header_names


@dataclass(frozen=True)
class Signature:
    """Column names that must all be present, and names of which one must be."""

    all_of: tuple[str, ...]
    any_of: tuple[str, ...] = ()

    def matches(self, columns: Column) -> Column:
        every = F.size(F.array_intersect(columns, F.array(*map(F.lit, self.all_of)))) == len(self.all_of)
        return every & F.arrays_overlap(columns, F.array(*map(F.lit, self.any_of))) if self.any_of else every


def classify_sources(files: DataFrame, signatures: Mapping[str, Signature], columns: str = "columns") -> DataFrame:
    """Add ``source_class``: the first signature the column list fits, else null."""
    label = F.lit(None).cast("string")
    for name, signature in reversed(list(signatures.items())):
        label = F.when(signature.matches(F.col(columns)), F.lit(name)).otherwise(label)
    return files.withColumn("source_class", label)


def discover_sources(files: DataFrame, signatures: Mapping[str, Signature]) -> DataFrame:
    """Largest file per class; expects (path, size, columns). Ties go to the first path."""
    classified = classify_sources(files, signatures).where("source_class is not null")
    largest = classified.groupBy("source_class").agg(F.max("size").alias("size"))
    return (
        classified.join(largest, ["source_class", "size"])
        .groupBy("source_class", "size")
        .agg(F.min("path").alias("path"))
    )


def missing_classes(found: DataFrame, required: Sequence[str]) -> list[str]:
    present = {r.source_class for r in found.select("source_class").distinct().collect()}  # one row per class
    return sorted(set(required) - present)


def first_record(spark: SparkSession, path: str, most: int = 1 << 20) -> str:
    """The first record of a CSV file, from its first bytes only; UTF-8, or Latin-1 if they are not valid UTF-8."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system, size = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), 1 << 12
    while True:
        stream = system.open(place)
        try:
            head = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(stream, size)))
        finally:
            stream.close()
        lines, end = head.split(b"\n"), 1
        while end < len(lines) and b"\n".join(lines[:end]).count(b'"') % 2:
            end += 1
        if end < len(lines) or len(head) < size or size >= most:
            break
        size *= 16
    record = b"\n".join(lines[:end]).rstrip(b"\r")
    try:
        return record.decode()
    except UnicodeDecodeError:
        return record.decode("latin-1")


def list_csv(spark: SparkSession, folder: str, threads: int = 32) -> DataFrame:
    """(path, size, columns) of the CSV files in a folder, columns in normal form.

    The listing and the headers are metadata: the first bytes of each file are read through the file system, several files at
    a time, and no job is started per file. A file with an empty first line has no
    columns; Spark's listing leaves out files without any byte.
    """
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder).select("path", "length").collect()
    with ThreadPoolExecutor(threads) as pool:
        records = list(pool.map(lambda entry: first_record(spark, entry.path), listing))
    rows = [(e.path, e.length, dedupe_names(header_names(r)) if r.strip("\ufeff") else []) for e, r in zip(listing, records)]
    return spark.createDataFrame(rows, "path string, size bigint, columns array<string>")


def profile(df: DataFrame, name: str) -> DataFrame:
    """One row: rows, columns, original and normalised names of a table."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("table_name"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(",".join(df.columns)).alias("original_names"),
        F.lit(",".join(dedupe_names(df.columns))).alias("normalized_names"),
    )


def merge_metrics(old: DataFrame, new: DataFrame, key: str = "metric") -> DataFrame:
    """Upsert of run metrics: new values replace old ones of the same key, the others stay."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)
