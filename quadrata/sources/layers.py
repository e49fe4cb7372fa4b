"""CSV and Parquet layers. Layers are Parquet by default; CSV is the exchange format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quadrata.sources.csv_splits import read_split_csv

# The null marker of exchanged files, and the words a tolerant reader also takes for null.
CSV_NULL = r"\N"
NA_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
    "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_QUOTING = {"header": "true", "quote": '"', "escape": '"'}


def read_csv(spark: SparkSession, path: str, encoding: str | None = None, multi_line: bool = True) -> DataFrame:
    """Raw CSV, every column as text.

    Files are read in splits, also where quoted values span lines; turn ``multi_line`` off for files known to hold one record
    per line, which saves a scan. A file with a quote where none belongs is read by one task. Without an encoding, files whose
    bytes are not valid UTF-8 throughout are read as Latin-1.
    """
    if multi_line and (encoding or "UTF-8").upper() in ("UTF-8", "ISO-8859-1"):
        split = read_split_csv(spark, path, encoding)
        if split is not None:
            return split
    if encoding is None:
        encoding = "UTF-8" if invalid_utf8_lines(spark, path) == 0 else "ISO-8859-1"
    df = spark.read.options(**_QUOTING, multiLine=str(multi_line).lower(), inferSchema="false").csv(
        path, encoding=encoding
    )
    # A byte-order mark sticks to the first header name.
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns])


def invalid_utf8_lines(spark: SparkSession, path: str) -> int:
    """Lines that are not valid UTF-8; the check splits with the file."""
    lines = spark.read.text(path)
    return lines.where(~F.is_valid_utf8("value")).count()


def land(df: DataFrame, path: str, partitions: int | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a source once as Parquet and go on from the copy."""
    out = df if partitions is None else df.repartition(partitions)
    out.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_layer(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """Write a layer; overwriting makes a re-run idempotent, ``append`` adds to what is there.

    For a partitioned layer the rows are rebalanced by the partition columns: adaptive execution then splits
    large members and merges small ones, instead of every task writing a small file per member.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode).format(fmt).partitionBy(*partition_by)
    if fmt == "csv":
        # Written and read with the same quoting; an empty string is kept apart from null.
        writer = writer.options(**_QUOTING, nullValue=CSV_NULL, emptyValue="", encoding="UTF-8")
    writer.save(path)


def read_layer(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv", na_words: bool = False
) -> DataFrame:
    """Read a layer with its declared schema.

    Empty text counts as null, as in the exchanged files. ``na_words`` also turns the usual NA words of text
    columns into null.
    """
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    df = spark.read.schema(schema).options(
        **_QUOTING, nullValue=CSV_NULL, emptyValue="", multiLine="true", mode="FAILFAST", encoding="UTF-8"
    ).csv(path)
    words = list(NA_WORDS) if na_words else [""]
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(words), F.col(c)) for c in text})


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Optional source: an empty table of the same schema if the path does not exist."""
    return read_layer(spark, path, schema, fmt) if path_exists(spark, path) else spark.createDataFrame([], schema)


def is_folder(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory()
