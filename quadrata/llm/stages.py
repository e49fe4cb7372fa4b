"""Filters of a document table by the decisions of the operators: whole rows stay or go, only suspects are shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrata.llm import bitmap
from quadrata.session import cut_lineage


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` without the rows whose doc_id and text tag are in ``rejected`` (doc_id, tag); nulls match nulls.

    ``docs`` may have any other columns; names for the decisions are chosen that none of them has.
    """
    row, other, tag = bitmap.unused(docs.columns, "row", "id", "tag")
    tagged = docs.withColumn(row, F.xxhash64("text").bitwiseAND(0xFFFFFF).cast("int"))
    gone = cut_lineage(rejected.select(F.col("doc_id").alias(other), F.col("tag").alias(tag)).distinct())
    suspects, rest = bitmap.split(tagged, ["doc_id", row], gone.toDF("doc_id", row))
    same = F.col("doc_id").eqNullSafe(F.col(other)) & (F.col(row) == F.col(tag))
    return suspects.join(gone, same, "left_anti").unionByName(rest).select(*[F.col(f"`{c}`") for c in docs.columns])
