"""Sums over keys that are reached through many-to-one joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Hop:
    """A join to the table that carries more keys: ``fact_key = dim_key``."""

    dim: DataFrame
    fact_key: str
    dim_key: str


def sum_along(
    fact: DataFrame, hops: Sequence[Hop], keys: Sequence[str], sums: Mapping[str, Column]
) -> DataFrame:
    """Sum measures per ``keys``, of which some are reached through joins.

    While the fact still needs nothing but the key of the next join, its measures are summed per key first:
    that fold and the join share one shuffle, and a hot key reaches it as one row per task. With more columns
    to keep, a fold would need a shuffle of its own, so the rows are joined as they are and skewed partitions
    are left to the adaptive skew join. Join strategies are chosen by the optimiser, which knows the sizes.
    """
    names = list(sums)
    link_keys = [hop.fact_key for hop in hops]
    df = fact.select(*[c for c in fact.columns if c in {*keys, *link_keys}], *[m.alias(n) for n, m in sums.items()])
    for position, hop in enumerate(hops):
        needed = [c for c in df.columns if c in {*keys, *link_keys[position:]}]
        if needed == [hop.fact_key]:
            df = df.groupBy(*needed).agg(*[F.sum(n).alias(n) for n in names])
        dim = hop.dim.withColumnRenamed(hop.dim_key, hop.fact_key)
        carried = [c for c in dim.columns if c == hop.fact_key or c in {*keys, *link_keys[position + 1 :]}]
        df = df.join(dim.select(*carried), hop.fact_key)
        if hop.fact_key not in keys and hop.fact_key not in link_keys[position + 1 :]:
            df = df.drop(hop.fact_key)
    return df.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in names])
