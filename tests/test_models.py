"""Statistics, models and density clustering against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from quadrata.operators import density, learning, statistics
from quadrata.plans import panel as pn
from quadrata.plans import territory as t


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 2))
    y = 3 + 2 * x[:, 0] - x[:, 1] + rng.normal(size=60)
    frame = np.column_stack([x, y])
    df = spark.createDataFrame([(i, *map(float, r), 7.0) for i, r in enumerate(frame)], "i int, a double, b double, y double, c double")
    return df, frame


def test_linregress(sample):
    df, data = sample
    got = statistics.linregress(df, "a", "y").first()
    slope, intercept = np.polyfit(data[:, 0], data[:, 2], 1)
    r = np.corrcoef(data[:, 0], data[:, 2])[0, 1]
    assert (got.slope, got.intercept, got.r) == (pytest.approx(slope), pytest.approx(intercept), pytest.approx(r))
    assert got.std_err == pytest.approx(np.sqrt((1 - r**2) * data[:, 2].var() / data[:, 0].var() / 58))


def test_p_values_of_t():
    # Published two-sided 5 % and 1 % points of Student's t.
    for t_value, dof, p in ((2.228, 10, 0.05), (2.0, 60, 0.05), (12.706, 1, 0.05), (2.660, 60, 0.01), (0.0, 5, 1.0)):
        assert statistics.student_tail()(t_value, dof) == pytest.approx(p, abs=3e-4)


def test_ols(sample):
    df, data = sample
    got = {r.term: r for r in learning.ols(df, ["a", "b"], "y").collect()}
    design = np.column_stack([data[:, :2], np.ones(60)])
    beta, residual, *_ = np.linalg.lstsq(design, data[:, 2], rcond=None)
    assert [got[k].coefficient for k in ("a", "b", "const")] == pytest.approx(beta.tolist())
    r2 = 1 - residual[0] / ((data[:, 2] - data[:, 2].mean()) ** 2).sum()
    assert got["a"].r_squared == pytest.approx(r2)
    assert got["a"].f_value == pytest.approx(r2 / 2 / ((1 - r2) / 57))
    assert got["a"].p_value == pytest.approx(statistics.student_tail()(got["a"].t, 57), abs=1e-9)


def test_correlations_skip_gaps_and_constants(sample):
    df, data = sample
    gaps = df.withColumn("a", F.when(F.col("i") % 4 != 0, F.col("a")))
    got = {(r.feature_a, r.feature_b): r["corr"] for r in statistics.corr_matrix(gaps, ["a", "y", "c"]).collect()}
    keep = np.arange(60) % 4 != 0
    assert got["a", "y"] == got["y", "a"] == pytest.approx(np.corrcoef(data[keep, 0], data[keep, 2])[0, 1])
    assert got["a", "c"] is None and got["c", "c"] is None and got["y", "y"] == pytest.approx(1)
    ranked = [r.feature for r in statistics.target_corr(df, ["c", "b", "a"], "y").collect()]
    assert ranked == ["a", "b", "c"]


def test_scaling_and_imputing(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (3.0, 5.0), (8.0, 5.0)], "x double, c double")
    filled = [r.x for r in statistics.impute_median(df, ["x"]).collect()]
    assert sorted(filled) == [1.0, 3.0, 3.0, 8.0]
    scaled = statistics.zscore(df.dropna(), ["x", "c"]).orderBy("x").collect()
    values = np.array([1.0, 3.0, 8.0])
    assert [r.x_z for r in scaled] == pytest.approx(((values - values.mean()) / values.std()).tolist())
    assert {r.c_z for r in scaled} == {0.0}


def test_split_ignores_partitioning(spark):
    df = spark.range(2000)
    first = {r.id for r in df.where(learning.in_test_split("id")).collect()}
    again = {r.id for r in df.repartition(7).where(learning.in_test_split("id")).collect()}
    assert first == again and 330 < len(first) < 470


def blobs(spark, seed=7):
    rng = np.random.default_rng(seed)
    points = np.concatenate([rng.normal(c, 0.3, size=(20, 2)) for c in ((0, 0), (5, 5), (0, 6))])
    rows = [(i, float(10 * (i // 20)), Vectors.dense(p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, ["id", "target", "features"]), points


def test_kmeans_sweep_finds_three_blobs(spark):
    df, points = blobs(spark)
    sweep = {r.k: r for r in learning.kmeans_sweep(df, (2, 3, 4), restarts=3).collect()}
    assert max(sweep.values(), key=lambda r: r.silhouette).k == 3
    assert sweep[2].inertia > sweep[3].inertia > sweep[4].inertia
    centres = np.stack([points[i : i + 20].mean(0) for i in (0, 20, 40)])
    assert sweep[3].inertia == pytest.approx(((points - np.repeat(centres, 20, 0)) ** 2).sum())
    profiles = learning.risk_profiles(learning.best_kmeans(df, 3, 3).transform(df), "prediction", "target")
    assert {(r.target, r.risk_label) for r in profiles.collect()} == {
        (0.0, "Riesgo bajo"), (10.0, "Riesgo medio"), (20.0, "Riesgo alto"),
    }


def test_silhouette_is_the_squared_form_at_every_size(spark):
    df, points = blobs(spark)
    labels = np.arange(60) % 4
    rows = df.withColumn("prediction", (F.col("id") % 4 - 1).cast("int"))
    distance = ((points[:, None] - points[None]) ** 2).sum(-1)
    scores = []
    for i in range(60):
        same = (labels == labels[i]) & (np.arange(60) != i)
        inner = distance[i][same].mean()
        outer = min(distance[i][labels == g].mean() for g in range(4) if g != labels[i])
        scores.append((outer - inner) / max(inner, outer))
    assert learning.silhouette(rows) == pytest.approx(np.mean(scores))
    assert learning.silhouette(rows.where("prediction = 0")) is None


def test_pca(spark):
    df, points = blobs(spark)
    placed, ratios = learning.pca(df)
    values = np.linalg.eigvalsh(np.cov(points.T))[::-1]
    assert ratios == pytest.approx((values / values.sum()).tolist())
    assert {"pca_1", "pca_2"} <= set(placed.columns)


def test_forest_prefers_the_informative_feature(sample):
    df, _ = sample
    got = {r.feature: r.importance for r in learning.forest_importance(df, {"s": ["a", "b"]}, "y", trees=20).collect()}
    assert got["a"] > got["b"] and sum(got.values()) == pytest.approx(1)


def test_model_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3.0)], "target_robos_patrimoniales_total int, nbi_wmean double, alcaldia_key string, share_robo_a_negocio double")
    catalog = pn.feature_catalog(df, t.FEATURE_RULES)
    assert learning.model_columns(df, catalog, t.TARGET) == [t.TARGET, "nbi_wmean"]
    roles = {r.feature_name: (r.feature_role, r.data_type, r.description) for r in catalog.collect()}
    assert roles["nbi_wmean"] == ("feature", "numeric", "Promedio ponderado por factor de nbi.")


# --- Density clustering ---------------------------------------------------------------------------------------------


def brute_dbscan(points, eps, min_samples):
    keys = [p[0] for p in points]
    xs = np.array([p[1:] for p in points], dtype=float)
    near = np.sqrt(((xs[:, None] - xs[None]) ** 2).sum(-1)) <= eps
    core = near.sum(1) >= min_samples
    cluster, number = {}, 0
    for start in sorted(range(len(keys)), key=lambda i: keys[i]):
        if not core[start] or start in cluster:
            continue
        todo = [start]
        while todo:
            i = todo.pop()
            if i in cluster:
                continue
            cluster[i] = number
            todo += [j for j in range(len(keys)) if near[i, j] and core[j] and j not in cluster]
        number += 1
    out = {}
    for i, key in enumerate(keys):
        around = [cluster[j] for j in range(len(keys)) if near[i, j] and core[j]]
        out[key] = (bool(core[i]), cluster[i] if core[i] else min(around, default=-1))
    return out


def crowd(dims, seed):
    """A crowded spot with a third of all points, exact copies, a chain and scattered points."""
    rng = random.Random(seed)
    spots = [[rng.uniform(0, 0.4) for _ in range(dims)] for _ in range(80)]
    copies = [[3.0] * dims for _ in range(20)]
    chain = [[5 + 0.9 * i] + [1.0] * (dims - 1) for i in range(15)]
    scattered = [[rng.uniform(-2, 20) for _ in range(dims)] for _ in range(125)]
    points = spots + copies + chain + scattered
    keys = rng.sample(range(10_000), len(points))
    return [(k, *p) for k, p in zip(keys, points)]


@pytest.mark.parametrize("dims,eps", [(1, 0.3), (2, 1.0), (3, 2.0), (7, 3.0)])
def test_dbscan_equals_brute_force(spark, dims, eps):
    points = crowd(dims, dims)
    coords = [f"c{i}" for i in range(dims)]
    df = spark.createDataFrame(points, "key int, " + ", ".join(f"{c} double" for c in coords))
    want = brute_dbscan(points, eps, 3)
    got = {r.key: (r.is_core, r.cluster) for r in density.dbscan(df, "key", coords, eps, 3).collect()}
    assert got == want
    cores = {r.key: r.is_core for r in density.dbscan_core(df, "key", coords, eps, 3).collect()}
    assert cores == {k: v[0] for k, v in want.items()}


def test_crowded_cells_that_do_not_touch(spark):
    """Two crowded cells whose boxes overlap the radius although no pair of points does, and one pair that does."""
    left = [(i, 0.0, i / 100) for i in range(50)]
    right = [(100 + i, 1.001, i / 100) for i in range(50)]
    df = spark.createDataFrame(left + right, "key int, x double, y double")
    assert {r.cluster for r in density.dbscan(df, "key", ["x", "y"], 1.0).collect()} == {0, 1}
    bridge = df.unionByName(spark.createDataFrame([(999, 1.0, 0.25)], df.schema))
    assert {r.cluster for r in density.dbscan(bridge, "key", ["x", "y"], 1.0).collect()} == {0}


def test_connected_components(spark):
    rng = random.Random(11)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    nodes = sorted({n for e in edges for n in e} | {300})
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    df = density.connected_components(
        spark.createDataFrame([(n,) for n in nodes], "node long"), spark.createDataFrame(edges, "a long, b long")
    )
    labels = {r.node: r.label for r in df.collect()}
    for a, b in itertools.combinations(nodes, 2):
        assert (labels[a] == labels[b]) == (find(a) == find(b))


def test_dbscan_sweep(spark):
    df, points = blobs(spark)
    flat = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id int, x double, y double")
    got = {r.eps: (r.clusters, r.noise) for r in density.dbscan_sweep(flat, "id", ["x", "y"], (1.0, 10.0), vectors=df).collect()}
    assert got == {1.0: (3, 0), 10.0: (1, 0)}
