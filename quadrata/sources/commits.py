"""Tables whose writes take effect as a whole: data are staged first, then a manifest that names them is switched.

A table is a folder with ``data/<run>-<random>`` per run and numbered manifests in ``commits``. The manifest with the largest
number says which runs the table consists of. A writer that dies before its manifest leaves the table as it was; a run that
is written again takes its own place, so neither an overwrite nor an append is harmful twice. Two writers cannot take the
same number: the later one reads the new manifest and tries again.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quadrata.sources.layers import path_exists, read_layer, write_layer

TRIES = 20


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[int]:
    folder = f"{path}/commits"
    if not path_exists(spark, folder):
        return []
    names = [s.getPath().getName() for s in _system(spark, folder).listStatus(_path(spark, folder))]
    return sorted(int(m[1]) for m in (re.fullmatch(r"(\d{12})\.json", n) for n in names) if m)


def manifest(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """(number, {run: folder}) of the table as it stands; (0, {}) before the first commit."""
    versions = _versions(spark, path)
    if not versions:
        return 0, {}
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
    stream = _system(spark, path).open(_path(spark, f"{path}/commits/{versions[-1]:012d}.json"))
    try:
        return versions[-1], json.loads(text.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, path: str, number: int, runs: dict[str, str]) -> bool:
    """Write the manifest beside its place and move it there, unless the number is taken."""
    system, folder = _system(spark, path), f"{path}/commits"
    system.mkdirs(_path(spark, folder))
    draft = system.makeQualified(_path(spark, f"{folder}/.{uuid.uuid4().hex}"))
    target = system.makeQualified(_path(spark, f"{folder}/{number:012d}.json"))
    out = system.create(draft, False)
    try:
        out.write(bytearray(json.dumps(runs, sort_keys=True).encode()))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:  # this rename, unlike the file system's own, never replaces a target
        context.rename(draft, target, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as error:
        system.delete(draft, False)
        if "FileAlreadyExistsException" not in str(error):
            raise
        return False
    return True


def commit(df: DataFrame, path: str, run: str, mode: str = "overwrite", fmt: str = "parquet", partition_by: Sequence[str] = ()) -> int:
    """Write ``df`` as the table (``overwrite``) or as one more run of it (``append``); returns the manifest's number.

    A run that is already part of the table is replaced. Nothing is visible before the manifest is there.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("a commit overwrites or appends")
    spark, path = df.sparkSession, path.rstrip("/")
    folder = f"data/{re.sub(r'[^A-Za-z0-9._-]', '_', run)}-{uuid.uuid4().hex}"
    write_layer(df, f"{path}/{folder}", fmt, partition_by=partition_by)
    for _ in range(TRIES):
        number, runs = manifest(spark, path)
        runs = {run: folder} if mode == "overwrite" else runs | {run: folder}
        if _publish(spark, path, number + 1, runs):
            return number + 1
    raise RuntimeError(f"no manifest of {path} could be written in {TRIES} tries")


def read_committed(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet") -> DataFrame:
    """The table as its last manifest has it; empty before the first commit."""
    path = path.rstrip("/")
    _, runs = manifest(spark, path)
    parts = [read_layer(spark, f"{path}/{folder}", schema, fmt) for folder in runs.values()] if fmt == "csv" else []
    if fmt != "csv" and runs:
        return spark.read.schema(schema).format(fmt).load([f"{path}/{folder}" for folder in runs.values()])
    whole = spark.createDataFrame([], schema)
    for part in parts:
        whole = whole.unionByName(part)
    return whole


def vacuum(spark: SparkSession, path: str) -> int:
    """Delete staged data and manifests that the table does not use; only while nobody writes. Returns how many went."""
    path = path.rstrip("/")
    number, runs = manifest(spark, path)
    system, gone = _system(spark, path), 0
    if path_exists(spark, f"{path}/data"):
        for status in system.listStatus(_path(spark, f"{path}/data")):
            if f"data/{status.getPath().getName()}" not in set(runs.values()):
                gone += system.delete(status.getPath(), True)
    for old in _versions(spark, path):
        if old < number:
            gone += system.delete(_path(spark, f"{path}/commits/{old:012d}.json"), False)
    return gone
