"""Regression forests as tables: every step is a DataFrame operation, so the trees can be recomputed in SQL.

Splits are sought between given cut points, so a tree sees of a row only the bins of its features. One pass folds the rows into
cells of equal bins, per tree with the rows' bootstrap weights; all levels of all trees then grow on these cells, one
histogram per level. Targets are whole numbers (cents, say) and all sums are exact, so the same rows give the same trees under
any partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrata.session import cut_lineage

#: How often a row counts in a tree, by the first hexadecimal digit of a hash: near a Poisson distribution of mean 1.
TIMES = {"0": "012345", "1": "6789ab", "2": "cde", "3": "f"}


def times_drawn(key: Column, tree: Column) -> Column:
    """How often a row is in the bootstrap sample of a tree."""
    digit = F.substring(F.md5(F.concat_ws("-", tree, key)), 1, 1)
    return reduce(lambda otherwise, n: F.when(digit.isin(*TIMES[n]), int(n)).otherwise(otherwise), ("1", "2", "3"), F.lit(0))


def bin_of(value: Column, cuts: Sequence[float]) -> Column:
    """How many of the cut points the value exceeds; null for null."""
    return reduce(lambda s, c: s + (value > F.lit(float(c))).cast("int"), cuts, F.lit(0))


def cells(df: DataFrame, key: str, features: Mapping[str, Sequence[float]], target: str, trees: int) -> DataFrame:
    """(tree, bins, w, s): drawn rows and their summed target per tree and combination of bins. Rows with a null take no part."""
    bins = F.array(*[bin_of(F.col(name), cuts) for name, cuts in features.items()])
    rows = df.select(F.col(key).cast("string").alias("key"), F.col(target).cast("bigint").alias("y"), *features).dropna()
    drawn = rows.select("y", bins.alias("bins"), "key", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    drawn = drawn.select("tree", "bins", "y", times_drawn(F.col("key"), F.col("tree").cast("string")).cast("bigint").alias("w")).where("w > 0")
    return drawn.groupBy("tree", "bins").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("s"))


def grow(cube: DataFrame, features: Sequence[str], depth: int, least: int = 1) -> DataFrame:
    """(tree, node, feature, bin, gain, w): the splits of all trees; a row goes to node 2n if its bin is at most ``bin``, else to 2n + 1.

    ``gain`` is the decrease of the summed squared error. The best split of a node has the largest gain; of equal ones the
    earlier feature, then the smaller bin. Both sides keep ``least`` drawn rows or more.
    """
    here = cut_lineage(cube.withColumn("node", F.lit(1).cast("bigint")))
    names = F.array(*[F.lit(f) for f in features])
    found: list[DataFrame] = []
    for _ in range(depth):
        long = here.select("tree", "node", "w", "s", F.posexplode("bins").alias("f", "bin"))
        histogram = long.groupBy("tree", "node", "f", "bin").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
        side = Window.partitionBy("tree", "node", "f")
        left = side.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        parts = histogram.select("tree", "node", "f", "bin", *[F.sum(c).over(w).cast("double").alias(c + x) for c in "ws" for w, x in ((left, "l"), (side, "t"))])
        parts = parts.withColumns({"wr": F.col("wt") - F.col("wl"), "sr": F.col("st") - F.col("sl")}).where((F.col("wl") >= least) & (F.col("wr") >= least))
        square = lambda x: F.col("s" + x) * F.col("s" + x) / F.col("w" + x)
        gains = parts.withColumn("gain", square("l") + square("r") - square("t")).where("gain > 0")
        best = Window.partitionBy("tree", "node").orderBy(F.desc("gain"), "f", "bin")
        splits = gains.withColumn("place", F.row_number().over(best)).where("place = 1").select("tree", "node", "f", "bin", "gain", F.col("wt").alias("w"))
        splits = cut_lineage(splits)
        found.append(splits)
        chosen = splits.select("tree", "node", "f", F.col("bin").alias("cut"))
        right = (F.get("bins", F.col("f")) > F.col("cut")).cast("int")
        here = cut_lineage(here.join(chosen, ["tree", "node"]).select("tree", "bins", "w", "s", (2 * F.col("node") + right).alias("node")))
    every = reduce(DataFrame.unionByName, found)
    return every.select("tree", "node", F.get(names, F.col("f")).alias("feature"), "bin", "gain", "w")


def importances(splits: DataFrame, features: Sequence[str], trees: int) -> DataFrame:
    """(feature, importance): each tree's shares of its whole gain, averaged over the trees; a tree without a split adds nothing."""
    shares = splits.groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    shares = shares.withColumn("share", F.col("gain") / F.sum("gain").over(Window.partitionBy("tree")))
    folded = shares.groupBy("feature").agg((F.sum("share") / F.lit(float(trees))).alias("importance"))
    listed = splits.sparkSession.range(1).select(F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
    return listed.join(folded, "feature", "left").withColumn("importance", F.coalesce("importance", F.lit(0.0)))
