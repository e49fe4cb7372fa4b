"""Grouped counts over files that keep arriving, with the functions of the batch path."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from quadrata.session import scratch_path
from quadrata.sources import commits


def file_stream(spark: SparkSession, folder: str, pattern: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of a folder that match a name pattern, as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").parquet(folder)


def run_available(stream: DataFrame, aggregate: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Process all files present and return the final aggregate.

    Every batch replaces the result table, so a batch that is run again after a failure changes nothing.
    """
    spark = stream.sparkSession
    result, checkpoint = scratch_path(spark, "stream-result"), scratch_path(spark, "stream-state")

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(result)

    aggregated = aggregate(stream)
    query = (
        aggregated.writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(aggregated.schema).parquet(result)


def run_incremental(
    stream: DataFrame, partial: Callable[[DataFrame], DataFrame], fold: Callable[[DataFrame], DataFrame], table: str | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Process all files present batch by batch and return the fold of all that was ever processed.

    ``partial`` folds the rows of one batch; ``fold`` merges partials, whose columns must be mergeable (sums, counts, minima).
    A batch is committed to ``table`` under its number, so one that is run again replaces itself. No state is kept
    between batches and nothing earlier is rewritten. With the same ``table`` and ``checkpoint`` the next call goes on with new
    files. :func:`compact` merges the partials of many batches.
    """
    spark = stream.sparkSession
    table = table or scratch_path(spark, "stream-partials")
    checkpoint = checkpoint or scratch_path(spark, "stream-progress")
    schema = partial(spark.createDataFrame([], stream.schema)).schema

    def add(batch: DataFrame, number: int) -> None:
        if number > _merged(commits.manifest(spark, table)[1]):  # else it was counted before the partials were merged
            commits.commit(partial(batch), table, f"batch-{number}", "append")

    query = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return fold(commits.read_committed(spark, table, schema))


def _merged(runs: Mapping[str, str]) -> int:
    """Number of the last batch that merged partials hold, -1 if there are none."""
    return max((int(r.removeprefix("to-")) for r in runs if r.startswith("to-")), default=-1)


def compact(spark: SparkSession, table: str, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Replace the partials of all batches by one; ``merge`` maps partials to a partial. Only while the stream stands still.

    The merged run is named by its last batch, and a batch up to that one that comes again is left out.
    """
    _, runs = commits.manifest(spark, table)
    if len(runs) > 1:
        last = max(int(r.rpartition("-")[2]) for r in runs)
        schema = spark.read.parquet(f"{table}/{next(iter(runs.values()))}").schema
        commits.commit(merge(commits.read_committed(spark, table, schema)), table, f"to-{last}", "overwrite")
