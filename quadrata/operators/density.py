"""Density clustering (DBSCAN) on a grid.

Cells have the diagonal eps, so a cell with ``min_samples`` points holds core points only and its points need
no comparison with each other. Points of the other cells, fewer than ``min_samples`` per cell, are compared
with the neighbouring cells. Two core cells are joined if some pair of their core points lies within eps;
this is decided on shrinking boxes and never by listing the pairs of two crowded cells. Several radii share one forest,
and all steps: the grids of all radii stand in one table.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrata.operators.ordered import dense_key
from quadrata.operators.silhouette import silhouettes
from quadrata.session import cut_lineage, written

#: Axes along which cells are matched through blocks; the other axes are only compared.
BLOCK_AXES = 4
#: Comparisons of points for which two boxes are not made smaller; edges that one task follows to the end.
FEW, LAST = 256, 1 << 20


def _distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return F.sqrt(reduce(lambda s, t: s + t, [(p - q) * (p - q) for p, q in zip(a, b, strict=True)]))


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


@dataclass(frozen=True)
class _Grid:
    """The grids of all radii; a cell belongs to one radius, its ``level``."""

    radii: tuple[float, ...]
    dims: int

    def side(self, eps: float) -> float:
        # A hair below eps / sqrt(dims): rounding never puts two points of a cell farther apart than eps.
        return eps / math.sqrt(self.dims) * (1 - 1e-9)

    @property
    def reach(self) -> int:
        return max(math.floor(eps / self.side(eps)) + 1 for eps in self.radii)

    def cols(self, letter: str) -> list[str]:
        return [f"{letter}{i}" for i in range(self.dims)]

    def celled(self, sites: DataFrame) -> DataFrame:
        """Every site once per radius, with its level, eps, side and cell coordinates."""
        levels = F.array(
            *[
                F.struct(F.lit(i).alias("level"), F.lit(eps).alias("eps"), F.lit(self.side(eps)).alias("side"))
                for i, eps in enumerate(self.radii)
            ]
        )
        at = sites.select("*", F.inline(levels))
        return at.withColumns({c: F.floor(F.col(x) / F.col("side")) for c, x in zip(self.cols("c"), self.cols("x"))})


def _cells_and_placed(sites: DataFrame, grid: _Grid) -> tuple[DataFrame, DataFrame]:
    """The occupied cells with their totals, and the sites with their cell and its total."""
    cs = grid.cols("c")
    celled = grid.celled(sites)
    totals = celled.groupBy("level", "eps", "side", *cs).agg(F.sum("n").alias("members"))
    cells = written(totals.withColumn("cell", F.monotonically_increasing_id()))
    return cells, written(celled.join(cells.select("level", *cs, "members", "cell"), ["level", *cs]).drop(*cs))


def _sites_and_cells(df: DataFrame, key: str, coords: Sequence[str], grid: _Grid) -> tuple[DataFrame, DataFrame]:
    """Distinct positions (smallest id, multiplicity, cell) and the occupied cells with their totals."""
    xs = grid.cols("x")
    placed = df.select(F.col(key).alias("id"), *[F.col(c).cast("double").alias(x) for c, x in zip(coords, xs)])
    cells, sites = _cells_and_placed(cut_lineage(placed.groupBy(*xs).agg(F.min("id").alias("site"), F.count(F.lit(1)).alias("n"))), grid)
    return sites, cells


def _neighbour_cells(cells: DataFrame, grid: _Grid) -> DataFrame:
    """Pairs (a, b, eps) of occupied cells of a level whose boxes come within its eps, a cell with itself included.

    Cells are matched through blocks of ``reach`` cells per side along the first axes; neighbours lie in the same
    or an adjacent block. So every cell is copied 3^BLOCK_AXES times at most, whatever the number of coordinates.
    """
    cs = grid.cols("c")
    axes = range(min(grid.dims, BLOCK_AXES))
    blocks = [F.floor(F.col(cs[i]) / grid.reach) for i in axes]
    shifts = F.array(
        *[
            F.struct(*[F.lit(step).alias(f"s{i}") for i, step in enumerate(shift)])
            for shift in itertools.product((-1, 0, 1), repeat=len(axes))
        ]
    )
    left = cells.select(F.col("cell").alias("a"), "level", "eps", "side", *cs, F.inline(shifts)).select(
        "a", "level", "eps", "side",
        *[F.col(c).alias(f"a_{c}") for c in cs],
        *[(block + F.col(f"s{i}")).alias(f"k{i}") for i, block in enumerate(blocks)],
    )
    right = cells.select(
        F.col("cell").alias("b"),
        "level",
        *[F.col(c).alias(f"b_{c}") for c in cs],
        *[block.alias(f"k{i}") for i, block in enumerate(blocks)],
    )
    gaps = [F.greatest(F.abs(F.col(f"a_{c}") - F.col(f"b_{c}")) - 1, F.lit(0)) for c in cs]
    side, eps = F.col("side"), F.col("eps")
    near = reduce(lambda s, t: s + t, [g * g for g in gaps]) * side * side <= eps * eps * (1 + 1e-9)
    return left.join(right, ["level", *[f"k{i}" for i in axes]]).where(near).select("a", "b", "eps")


def _near_sites(some: DataFrame, pairs: DataFrame, others: DataFrame, grid: _Grid) -> DataFrame:
    """Rows of ``some`` (prefix ``p_``) next to rows of ``others`` (prefix ``q_``) within the radius of their cells."""
    p, q = _prefixed(some, "p_"), _prefixed(others, "q_")
    xs = grid.cols("x")
    within = _distance([F.col(f"p_{x}") for x in xs], [F.col(f"q_{x}") for x in xs]) <= F.col("eps")
    return p.join(pairs, p["p_cell"] == pairs["a"]).join(q, F.col("b") == q["q_cell"]).where(within)


def _core_sites(sites: DataFrame, pairs: DataFrame, grid: _Grid, min_samples: int, how: str = "inner") -> DataFrame:
    """Sites with their core flag at each level; sites of cells of at least ``min_samples`` points are core.

    A site with a coordinate that is no number is not even near itself; it stays if the join is a ``left`` one.
    """
    crowded = sites.where(F.col("members") >= min_samples)
    sparse = sites.where(F.col("members") < min_samples)
    counted = (
        _near_sites(sparse, pairs, sites, grid)
        .groupBy(F.col("p_level").alias("level"), F.col("p_site").alias("site"))
        .agg(F.sum("q_n").alias("near"))
    )
    near_enough = F.coalesce(F.col("near") >= min_samples, F.lit(False))
    flagged = sparse.join(counted, ["level", "site"], how).withColumn("core", near_enough).drop("near")
    return crowded.withColumn("core", F.lit(True)).unionByName(flagged)


def _boxes(core: DataFrame, grid: _Grid, depth: int) -> DataFrame:
    """Per sub-cell of side / 2^depth: how many points, one of them, and the box around all of them."""
    xs = grid.cols("x")
    boxed = _indexed(core, grid, depth).groupBy("cell", *grid.cols("i")).agg(
        F.count(F.lit(1)).alias("points"),
        F.min(F.struct(*xs)).alias("rep"),
        *[F.min(x).alias(f"lo{j}") for j, x in enumerate(xs)],
        *[F.max(x).alias(f"hi{j}") for j, x in enumerate(xs)],
    )
    return boxed.withColumns({f"parent{j}": F.floor(F.col(f"i{j}") / 2) for j in range(grid.dims)})


def _indexed(core: DataFrame, grid: _Grid, depth: int) -> DataFrame:
    scale = F.lit(2.0**depth) / F.col("side")
    return core.select("cell", *grid.cols("x"), *[F.floor(F.col(x) * scale).alias(i) for i, x in zip(grid.cols("i"), grid.cols("x"))])


def _linked_cells(core: DataFrame, pairs: DataFrame, grid: _Grid) -> DataFrame:
    """Pairs a < b of core cells that hold core points within eps of each other.

    Two boxes of few points are compared point by point, ``FEW`` comparisons at most; larger ones shrink.
    """
    xs, dims = grid.cols("x"), range(grid.dims)
    cells = core.select("cell").distinct()
    open_pairs = (
        pairs.where("a < b")
        .join(cells.withColumnRenamed("cell", "a"), "a", "left_semi")
        .join(cells.withColumnRenamed("cell", "b"), "b", "left_semi")
    )
    linked: list[DataFrame] = []
    depth = 0
    while True:
        busy = core
        if depth:
            used = open_pairs.select(F.explode(F.array("a", "b")).alias("cell")).distinct()
            busy = core.join(used, "cell", "left_semi")
        boxes = _boxes(busy, grid, depth)
        a, b = _prefixed(boxes, "a_"), _prefixed(boxes, "b_")
        on_a = [F.col("a") == a["a_cell"], *[F.col(f"ai{j}") == a[f"a_parent{j}"] for j in dims if depth]]
        on_b = [F.col("b") == b["b_cell"], *[F.col(f"bi{j}") == b[f"b_parent{j}"] for j in dims if depth]]
        gaps = [
            F.greatest(F.col(f"b_lo{j}") - F.col(f"a_hi{j}"), F.col(f"a_lo{j}") - F.col(f"b_hi{j}"), F.lit(0.0))
            for j in dims
        ]
        hit = _distance([F.col(f"a_rep.{x}") for x in xs], [F.col(f"b_rep.{x}") for x in xs]) <= F.col("eps")
        tested = (
            open_pairs.join(a, on_a)
            .join(b, on_b)
            .withColumn("_hit", hit)
            .where(F.col("_hit") | (F.sqrt(reduce(lambda s, t: s + t, [g * g for g in gaps])) <= F.col("eps")))
            .select(
                "a", "b", "eps", "_hit", (F.col("a_points") * F.col("b_points") <= FEW).alias("_few"),
                *[F.col(f"a_i{j}").alias(f"ai{j}") for j in dims],
                *[F.col(f"b_i{j}").alias(f"bi{j}") for j in dims],
            )
        )
        tested = written(tested)
        points = _indexed(core, grid, depth)
        p, q = _prefixed(points, "p_"), _prefixed(points, "q_")
        few = tested.where("not _hit and _few").drop("_hit", "_few")
        few = few.join(tested.where("_hit").select("a", "b").distinct(), ["a", "b"], "left_anti")
        met = few.join(p, [few["a"] == p["p_cell"], *[few[f"ai{j}"] == p[f"p_i{j}"] for j in dims]])
        met = met.join(q, [met["b"] == q["q_cell"], *[met[f"bi{j}"] == q[f"q_i{j}"] for j in dims]])
        met = met.where(_distance([F.col(f"p_{x}") for x in xs], [F.col(f"q_{x}") for x in xs]) <= F.col("eps"))
        found = written(tested.where("_hit").select("a", "b").unionByName(met.select("a", "b")).distinct())
        linked.append(found)
        open_pairs = tested.where("not _hit and not _few").drop("_hit", "_few").join(found, ["a", "b"], "left_anti")
        if open_pairs.isEmpty():
            return reduce(DataFrame.unionByName, linked)
        depth += 1


def _least_of_component(batches):
    """(root, parent): every node of the links of one task, and the smallest node of its component."""
    links = [np.stack([b.column(c).to_numpy() for c in ("a", "b")]) for b in batches if b.num_rows]
    if not links:
        return
    nodes, places = np.unique(np.concatenate(links, axis=1), return_inverse=True)
    a, b = places.reshape(2, -1)
    least = np.arange(len(nodes))
    while True:
        lower = np.minimum(least[a], least[b])
        hooked = least.copy()
        for end in (a, b):
            np.minimum.at(hooked, least[end], lower)
            np.minimum.at(hooked, end, lower)
        while (hooked[hooked] != hooked).any():
            hooked = hooked[hooked]
        if (hooked == least).all():
            break
        least = hooked
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[least])], ["root", "parent"])


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label) with one label per component, its smallest node; ``edges`` has columns a, b.

    Every round hooks each root to its smallest neighbouring root, flattens the chains by doubling and
    contracts the edges. At least half of the roots that still have edges vanish per round. Once ``LAST`` edges are
    left, which fit into one task whatever the size of the table, that task follows them to the end.
    """
    labels = nodes.select("node", F.col("node").alias("label"))
    links = written(edges.select("a", "b").where("a <> b").distinct())

    def relabel(df: DataFrame, col: str, parents: DataFrame) -> DataFrame:
        step = parents.select(F.col("root").alias(col), F.col("parent").alias("_p"))
        return df.join(step, col, "left").withColumn(col, F.coalesce("_p", col)).drop("_p")

    while left := links.count():
        if left <= LAST and dict(links.dtypes) == {"a": "bigint", "b": "bigint"}:
            parents = links.repartition(1).mapInArrow(_least_of_component, "root bigint, parent bigint")
            return written(relabel(labels, "label", parents))
        parents = written(
            links.select(F.greatest("a", "b").alias("root"), F.least("a", "b").alias("parent"))
            .groupBy("root")
            .agg(F.min("parent").alias("parent"))
        )
        while True:
            upper = parents.select(F.col("root").alias("parent"), F.col("parent").alias("_up"))
            doubled = written(
                parents.join(upper, "parent", "left").select(
                    "root", F.coalesce("_up", "parent").alias("parent"), F.col("_up").isNotNull().alias("_moved")
                )
            )
            parents = doubled.drop("_moved")
            if doubled.where("_moved").isEmpty():
                break
        labels = written(relabel(labels, "label", parents))
        links = written(relabel(relabel(links, "a", parents), "b", parents).where("a <> b").distinct())
    return labels


def dbscan_core(df: DataFrame, key: str, coords: Sequence[str], eps: float, min_samples: int = 3) -> DataFrame:
    """(key, is_core) for every row."""
    grid = _checked_grid(coords, eps)
    sites, cells = _sites_and_cells(df, key, coords, grid)
    core = _core_sites(sites, _neighbour_cells(cells, grid), grid, min_samples)
    return _back_to_rows(df, key, coords, grid, core.select(*grid.cols("x"), F.col("core").alias("is_core")))


def dbscan(df: DataFrame, key: str, coords: Sequence[str], eps: float, min_samples: int = 3) -> DataFrame:
    """(key, is_core, cluster): clusters numbered from 0 by their smallest core key, noise is -1.

    A border point joins the neighbouring cluster with the smallest number.
    """
    grid = _checked_grid(coords, eps)
    sites, cells = _sites_and_cells(df, key, coords, grid)
    pairs = written(_neighbour_cells(cells, grid))
    flagged = written(_core_sites(sites, pairs, grid, min_samples))
    core = flagged.where("core")
    linked = _linked_cells(core, pairs, grid)
    labels = connected_components(core.select(F.col("cell").alias("node")).distinct(), linked)
    labelled = written(core.join(labels.withColumnRenamed("node", "cell"), "cell"))
    first = labelled.groupBy("label").agg(F.min("site").alias("first"))
    numbers = dense_key(first, ["first"], "number").select("label", (F.col("number") - 1).cast("int").alias("cluster"))
    core_clusters = labelled.join(numbers, "label").drop("label")
    border = (
        _near_sites(flagged.where("not core"), pairs, core_clusters, grid)
        .groupBy(F.col("p_site").alias("site"))
        .agg(F.min("q_cluster").alias("cluster"))
    )
    rest = flagged.where("not core").join(border, "site", "left").withColumn("cluster", F.coalesce("cluster", F.lit(-1)))
    columns = [*grid.cols("x"), "core", "cluster"]
    placed = core_clusters.select(*columns).unionByName(rest.select(*columns)).withColumnRenamed("core", "is_core")
    return _back_to_rows(df, key, coords, grid, placed)


def _checked_grid(coords: Sequence[str], eps: float) -> _Grid:
    if not coords or eps <= 0:
        raise ValueError("DBSCAN needs a positive eps and at least one coordinate")
    return _Grid((float(eps),), len(coords))


def _back_to_rows(df: DataFrame, key: str, coords: Sequence[str], grid: _Grid, sites: DataFrame) -> DataFrame:
    xs = grid.cols("x")
    rows = df.select(key, *[F.col(c).cast("double").alias(x) for c, x in zip(coords, xs)])
    return rows.join(sites, xs).drop(*xs)


@dataclass(frozen=True)
class RadiusForest:
    """The clusters of all radii in one forest.

    ``sites``: (x0.., site, n, core, labels), one row per distinct position: its number in the order of the smallest keys, how
    many rows it has, the place of the first radius at which it is core (null: at none), and for every radius the smallest
    core site of its cluster, or -1. ``edges``: (a, b, radius), a spanning forest of the core sites: the edges of at most a
    radius join exactly the core sites that belong together at that radius.
    """

    radii: tuple[float, ...]
    sites: DataFrame
    edges: DataFrame


def radius_forest(df: DataFrame, key: str, coords: Sequence[str], radii: Sequence[float], min_samples: int = 3) -> RadiusForest:
    """DBSCAN for several radii, each on a grid of its own, in one series of jobs whatever their number.

    Being core and belonging together carry over to every larger radius, so the smallest core sites of the clusters of a
    site, from radius to radius, are a path of the forest.
    """
    levels = tuple(sorted({float(r) for r in radii}))
    if not levels:
        raise ValueError("DBSCAN needs at least one radius")
    xs = _checked_grid(coords, levels[0]).cols("x")
    grid = _Grid(levels, len(coords))
    rows = df.select(F.col(key).alias("id"), *[F.col(c).cast("double").alias(x) for c, x in zip(coords, xs)])
    places = cut_lineage(rows.groupBy(*xs).agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")))
    sites = cut_lineage(dense_key(places, ["first"], "site").select(*xs, "site", "n"))
    cells, placed = _cells_and_placed(sites, grid)
    pairs = written(_neighbour_cells(cells, grid))
    flagged = written(_core_sites(placed, pairs, grid, min_samples, "left"))
    core = flagged.where("core")
    linked = _linked_cells(core, pairs, grid)
    merged = connected_components(core.select(F.col("cell").alias("node")).distinct(), linked)
    labelled = core.join(merged.withColumnRenamed("node", "cell"), "cell")
    rooted = written(labelled.join(labelled.groupBy("label").agg(F.min("site").alias("root")), "label").drop("label"))
    border = _near_sites(flagged.where("not core"), pairs, rooted, grid)
    border = border.groupBy(F.col("p_level").alias("level"), F.col("p_site").alias("site")).agg(F.min("q_root").alias("root"))
    beside = flagged.where("not core").join(border, ["level", "site"], "left")
    columns = [*xs, "site", "n", "level", "core", "root"]
    every = rooted.select(*columns).unionByName(beside.select(*columns))
    at = [F.col("level") == i for i in range(len(levels))]
    named = every.groupBy(*xs, "site", "n").agg(
        F.min(F.when(F.col("core"), F.col("level"))).alias("core"),
        F.array(*[F.coalesce(F.max(F.when(here, F.col("root"))), F.lit(-1)) for here in at]).alias("labels"),
    )
    named = written(named)
    before = F.when(F.col("level") == F.col("core"), F.col("site")).otherwise(F.get("labels", F.col("level") - 1))
    steps = named.where("core is not null").select("site", "core", "labels", F.explode(F.sequence("core", F.lit(len(levels) - 1))).alias("level"))
    steps = steps.select(before.alias("a"), F.get("labels", F.col("level")).alias("b"), F.get(F.array(*map(F.lit, levels)), F.col("level")).alias("radius"))
    return RadiusForest(levels, named, steps.where("a <> b").distinct())


def dbscan_sweep(
    df: DataFrame, key: str, coords: Sequence[str], eps_values: Sequence[float], min_samples: int = 3, vectors: DataFrame | None = None,
    metric: str = "euclidean",
) -> DataFrame:
    """(eps, clusters, noise, silhouette) per radius, read from one forest. ``vectors`` (key, features) enables the silhouette.

    All silhouettes come from one pass; the Euclidean one compares all pairs of rows.
    """
    forest = radius_forest(df, key, coords, eps_values, min_samples)
    label = [F.get("labels", F.lit(i)) for i in range(len(forest.radii))]
    clusters = [F.count_distinct(F.when(x >= 0, x)).alias(f"c{i}") for i, x in enumerate(label)]
    noise = [F.coalesce(F.sum(F.when(x < 0, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, x in enumerate(label)]
    found = forest.sites.agg(*clusters, *noise).first()
    scores: dict[int, float | None] = {}
    several = [i for i in range(len(label)) if found[f"c{i}"] >= 2]
    if vectors is not None and several:
        xs = [f"x{i}" for i in range(len(coords))]
        rows = df.select(key, *[F.col(c).cast("double").alias(x) for c, x in zip(coords, xs)])
        named = rows.join(forest.sites, xs).select(key, *[label[i].alias(f"l{i}") for i in several])
        labelled = cut_lineage(vectors.select(key, "features").join(named, key))
        scores = dict(zip(several, silhouettes(labelled, [f"l{i}" for i in several], "features", metric), strict=True))
    values = [(r, int(found[f"c{i}"]), int(found[f"n{i}"]), scores.get(i)) for i, r in enumerate(forest.radii)]
    return df.sparkSession.createDataFrame(values, "eps double, clusters int, noise bigint, silhouette double")
