"""Loading layers into catalogue tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from quadrata.operators.schema import conform
from quadrata.session import scratch_path


def load_warehouse(spark: SparkSession, database: str, tables: Mapping[str, DataFrame], contracts: Mapping, location: str | None = None) -> list[str]:
    """Create the database if absent and write each table under its declared schema; returns the names."""
    where = location or scratch_path(spark, database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{where}'")
    names = []
    for table, df in tables.items():
        name = f"{database}.{table}"
        conform(df, contracts[table]).write.mode("overwrite").format("parquet").saveAsTable(name)
        names.append(name)
    return names
