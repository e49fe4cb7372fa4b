"""Exact order statistics of many columns by radix selection: no sort, no range partitions.

The bits of a double, with the sign turned round, are ordered like the value. Three passes count the values by the leading 20,
the next 22 and the last 22 of these bits; after each one, the bits that hold a wanted rank are known, and the next pass
counts only the values that begin with them. A pass is a scan and a fold by (column, digits): what is shuffled are counts of
digits, at most 2**22 for each column and wanted rank, and never values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIGITS = (20, 22, 22)
_U = np.uint64


def ordered_bits(values: np.ndarray) -> np.ndarray:
    """64-bit numbers in the order of the doubles; both zeros are the same."""
    bits = (values + 0.0).view(_U)
    return np.where(bits >> _U(63) == 1, ~bits, bits | _U(1 << 63))


def from_bits(bits: int) -> float:
    raw = bits ^ (1 << 63) if bits >> 63 else bits ^ ((1 << 64) - 1)
    return float(np.array([raw], dtype=_U).view(np.float64)[0])


def _counts(known: int, digits: int, prefixes: Mapping[int, Sequence[int]]):
    """Counts of the next ``digits`` bits of every value whose first ``known`` bits are among its column's prefixes."""

    def run(batches):
        for batch in batches:
            for c, wanted in prefixes.items():
                values = batch.column(c).drop_null().to_numpy(zero_copy_only=False)
                bits = ordered_bits(values[~np.isnan(values)])
                for prefix in wanted:
                    own = bits[bits >> _U(64 - known) == _U(prefix)] if known else bits
                    found, n = np.unique((own << _U(known)) >> _U(64 - digits), return_counts=True)
                    columns = [np.full(len(found), c), np.full(len(found), prefix), found.view(np.int64), n]
                    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], ["c", "prefix", "digit", "n"])

    return run


def order_statistics(df: DataFrame, columns: Sequence[str], q: float) -> dict[str, tuple[int, float, float]]:
    """{column: (n, low, high)}: how many values it has, and those at floor and ceil of (n - 1) * q in ascending order.

    Nulls and not-a-numbers do not count; a column without any other value is left out. Values are taken as doubles, and
    ``df`` is read three times.
    """
    spark = df.sparkSession
    numbers = df.select(*[F.col(f"`{name}`").cast("double").alias(f"v{i}") for i, name in enumerate(columns)])

    def counted(known: int, digits: int, prefixes: Mapping[int, Sequence[int]]) -> DataFrame:
        parts = numbers.mapInArrow(_counts(known, digits, prefixes), "c bigint, prefix bigint, digit bigint, n bigint")
        return parts.groupBy("c", "prefix", "digit").agg(F.sum("n").alias("n"))

    running = Window.partitionBy("c", "prefix").orderBy("digit")
    position = (F.sum("n").over(Window.partitionBy("c")) - 1) * F.lit(float(q))
    placed = counted(0, DIGITS[0], {i: [0] for i in range(len(columns))}).select(
        "c", "digit", "n", (F.sum("n").over(running) - F.col("n")).alias("before"), F.floor(position).alias("low"), F.ceil(position).alias("high"),
        F.sum("n").over(Window.partitionBy("c")).alias("total"),
    )
    ranks = F.explode(F.array(*[F.struct(F.lit(i).alias("end"), F.col(x).alias("rank")) for i, x in enumerate(("low", "high"))])).alias("t")
    inside = (F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n"))
    first = placed.select("*", ranks).select("c", "digit", "n", "before", "total", "t.end", "t.rank").where(inside).collect()  # two rows per column
    totals = {r.c: r.total for r in first}
    targets = {(r.c, r.end): (r.digit, r.rank - r.before) for r in first}
    known = DIGITS[0]
    for digits in DIGITS[1:]:
        prefixes: dict[int, list[int]] = {}
        for (c, _), (prefix, _) in targets.items():
            prefixes.setdefault(c, []).append(prefix)
        if not targets:
            break
        rows = [(c, end, prefix, rank) for (c, end), (prefix, rank) in targets.items()]
        asked = spark.createDataFrame(rows, "c bigint, end int, prefix bigint, rank bigint")
        table = counted(known, digits, {c: sorted(set(p)) for c, p in prefixes.items()})
        placed = table.select("c", "prefix", "digit", "n", (F.sum("n").over(running) - F.col("n")).alias("before"))
        found = placed.join(F.broadcast(asked), ["c", "prefix"]).where(inside).collect()  # two rows per column
        targets = {(r.c, r.end): ((r.prefix << digits) | r.digit, r.rank - r.before) for r in found}
        known += digits
    return {name: (totals[i], from_bits(targets[i, 0][0]), from_bits(targets[i, 1][0])) for i, name in enumerate(columns) if i in totals}
