"""Batched k-means, silhouettes, the radius forest, radix selection and the Gramian beside plain versions."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quadrata.operators import density, gramian, kmeans, learning, ordered, selection, silhouette, spectrum


def vectors(spark, points, **more):
    rows = [(i, [float(x) for x in p], *(int(v[i]) for v in more.values())) for i, p in enumerate(points)]
    schema = "id bigint, x array<double>" + "".join(f", {c} int" for c in more)
    return spark.createDataFrame(rows, schema).withColumn("features", array_to_vector("x"))


def clouds(rng, n=400, d=3):
    points = rng.normal(size=(n, d))
    points[: n // 3] = points[0]  # one place holds a third of the rows
    points[n // 3 : n // 2] += 8
    return points


def plain_lloyd(points, centres, tolerance=1e-6):
    while True:
        apart = ((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
        near, cost = apart.argmin(axis=1), apart.min(axis=1).sum()
        moved = np.array([points[near == i].mean(axis=0) if (near == i).any() else c for i, c in enumerate(centres)])
        if np.sqrt(((moved - centres) ** 2).sum(axis=1)).max() <= tolerance:
            return cost
        centres = moved


@pytest.mark.parametrize("d", [2, 20])
def test_all_fits_move_as_they_would_alone(spark, monkeypatch, d):
    monkeypatch.setattr(kmeans, "LEAF", 16)
    points = clouds(np.random.default_rng(d), d=d)
    df = vectors(spark, points)
    df = df.unionByName(df.limit(1).withColumn("features", F.when(F.col("id") < 0, F.col("features"))))  # no vector
    fits = kmeans.kmeans_fits(df, (2, 3, 5), restarts=4, seed=3)
    assert [(f.k, f.seed) for f in fits] == [(k, 3 + i) for k in (2, 3, 5) for i in range(4)]
    sample = kmeans.start_sample(df, len(points))
    for f in fits:
        assert f.inertia == pytest.approx(plain_lloyd(points, kmeans.starts(sample, f.k, f.seed)), rel=1e-9)
    told = kmeans.optimality(df, list(kmeans.best_fits(fits).values())).collect()
    total = ((points - points.mean(axis=0)) ** 2).sum()
    for r in told:
        assert r.n_rows == r.n_nearest == len(points) and r.centre_gap < 1e-5 and r.total_ss == pytest.approx(total)


def test_one_scan_moves_all_fits_and_settled_ones_drop_out(spark):
    df = vectors(spark, clouds(np.random.default_rng(1)))
    blocks = kmeans.row_blocks(df)
    sample = kmeans.start_sample(df, 400)
    fits = [kmeans.Fit(k, s, kmeans.starts(sample, k, s)) for k in (2, 4) for s in range(10)]
    calls = []
    scan = kmeans._moments
    try:
        kmeans._moments = lambda b, f: calls.append(len(f)) or scan(b, f)
        kmeans.lloyd(blocks, fits)
    finally:
        kmeans._moments = scan
    assert len(calls) == max(f.iterations for f in fits) + 1 and calls == sorted(calls, reverse=True) and calls[-1] < 20


def test_kmeans_without_rows_or_with_copies_only(spark):
    assert kmeans.kmeans_fits(vectors(spark, np.zeros((0, 2))), (2,)) == []
    fits = kmeans.kmeans_fits(vectors(spark, np.ones((50, 2))), (2, 3), restarts=2)
    assert [f.inertia for f in fits] == [0.0] * 4
    blocks = kmeans.compact_blocks(np.random.default_rng(1).normal(size=(1000, 2)), 32)
    assert sorted(np.concatenate(blocks)) == list(range(1000)) and max(map(len, blocks)) <= 32


def plain_silhouette(points, labels):
    apart = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    names = sorted(set(labels))
    if not 2 <= len(names) < len(points):
        return None
    scores = []
    for i, own in enumerate(labels):
        mine = labels == own
        if mine.sum() == 1:
            scores.append(0.0)
            continue
        a = apart[i, mine].sum() / (mine.sum() - 1)
        b = min(apart[i, labels == o].mean() for o in names if o != own)
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(scores))


@pytest.mark.parametrize("stripe", [37, 4096])
def test_euclidean_silhouettes(spark, monkeypatch, stripe):
    monkeypatch.setattr(silhouette, "STRIPE", stripe)
    rng = np.random.default_rng(7)
    points = clouds(rng, 150)
    labels = {"a": rng.integers(-1, 3, 150), "b": np.zeros(150, dtype=int), "c": np.arange(150), "d": (points[:, 0] > 4) * 5, "e": np.minimum(np.arange(150), 100)}
    got = silhouette.silhouettes(vectors(spark, points, **labels), list(labels))
    assert got == [None if w is None else pytest.approx(w, abs=1e-9) for w in (plain_silhouette(points, x) for x in labels.values())]
    assert silhouette.silhouettes(vectors(spark, points[:0], a=[]), ["a"]) == [None]
    with pytest.raises(ValueError):
        silhouette.silhouettes(vectors(spark, points[:3], a=[1, 2, 2]), ["a"], metric="cosine")


def test_radius_forest_agrees_with_one_run_per_radius(spark):
    rng = np.random.default_rng(11)
    points = np.concatenate([rng.normal(size=(120, 2)) * s + c for s, c in ((0.3, 0), (1.0, 4), (0.05, 9))] + [np.full((60, 2), 9.0), rng.uniform(-5, 15, (60, 2))])
    df = spark.createDataFrame([(f"k{i:04d}", float(x), float(y)) for i, (x, y) in enumerate(points)], "id string, x double, y double")
    radii = (1.1, 0.3, 0.6)
    forest = density.radius_forest(df, "id", ["x", "y"], radii, 4)
    assert forest.radii == (0.3, 0.6, 1.1)
    sites = {(r.x0, r.x1): r for r in forest.sites.collect()}
    edges = forest.edges.collect()
    for i, eps in enumerate(forest.radii):
        alone = {r.id: (r.is_core, r.cluster) for r in density.dbscan(df, "id", ["x", "y"], eps, 4).collect()}
        mine = [sites[tuple(p)] for p in points]
        order = {label: k for k, label in enumerate(sorted({s.labels[i] for s in mine} - {-1}))} | {-1: -1}
        assert {f"k{j:04d}": (s.core is not None and s.core <= i, order[s.labels[i]]) for j, s in enumerate(mine)} == alone
        core = {s.site for s in sites.values() if s.core is not None and s.core <= i}
        cut = [e for e in edges if e.radius <= eps]
        assert len(cut) == len(core) - len(set(order) - {-1}) and {e.a for e in cut} <= core
    none = density.dbscan_sweep(df.where("id < ''"), "id", ["x", "y"], (1.0,)).collect()
    assert [(r.eps, r.clusters, r.noise, r.silhouette) for r in none] == [(1.0, 0, 0, None)]
    with pytest.raises(ValueError):
        density.radius_forest(df, "id", ["x", "y"], ())


def test_radix_selection_of_any_doubles(spark):
    rng = np.random.default_rng(3)
    columns = {
        "plain": rng.normal(size=999),
        "wide": rng.choice([-1, 1], 999) * 10.0 ** rng.integers(-300, 300, 999),
        "hot": np.where(rng.random(999) < 0.4, -0.0, rng.integers(-3, 3, 999)),
        "tiny": np.append(rng.normal(size=998) * 5e-324, 0.0),
        "ends": rng.choice([np.inf, -np.inf, 1.0], 999),
    }
    rows = [(*(float(columns[c][i]) for c in columns), None, float("nan") if i % 2 else float(i)) for i in range(999)]
    names = [*columns, "none", "nan"]
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in names)).repartition(5)
    known = {**columns, "nan": np.arange(0, 999, 2).astype(float)}
    for q in (0.0, 0.1, 0.5, 0.501, 1.0):
        got = selection.order_statistics(df, names, q)
        assert set(got) == set(known)
        for c, v in known.items():
            v, at = np.sort(v), (len(v) - 1) * q
            assert got[c] == (len(v), v[math.floor(at)], v[math.ceil(at)])
    found = {r.column_name: r.value for r in ordered.exact_quantiles(df, ["plain", "none"], 0.25).collect()}
    assert found == {"plain": pytest.approx(np.quantile(columns["plain"], 0.25))}
    values = np.array([0.0, -0.0, 5e-324, -5e-324, 1.5, -1.5, np.inf, -np.inf, 1e308])
    bits = selection.ordered_bits(values)
    assert (np.argsort(bits, kind="stable") == np.argsort(values, kind="stable")).all()
    assert [selection.from_bits(int(b)) for b in bits] == values.tolist()


def test_medians_need_no_range_partitions(spark, tmp_path):
    rows = [(float(i), i % 7) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, b int")
    plans = []
    collect = type(df).collect

    def spy(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return collect(frame)

    try:
        type(df).collect = spy
        assert {r.column_name: r.value for r in ordered.exact_quantiles(df, ["a", "b"]).collect()} == {"a": 49.5, "b": 3.0}
    finally:
        type(df).collect = collect
    assert len(plans) == 4 and not any("rangepartitioning" in p for p in plans)


def test_gramian_of_many_columns_with_gaps(spark):
    rng = np.random.default_rng(5)
    n, d = 120, 300
    base = rng.normal(size=(n, 6))
    x = base @ rng.normal(size=(6, d)) + 0.1 * rng.normal(size=(n, d)) + 1e6
    x[rng.random((n, d)) < 0.1] = np.nan
    x[:, 7] = 3.0
    x[:, 9] = np.nan
    names = [f"c.{i}" for i in range(d)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in x], ", ".join(f"`{c}` double" for c in names)).repartition(4)
    got = {(r.i, r.j): (r.corr, r.cov, r.n) for r in gramian.pair_moments(df, names).select("i", "j", "n", gramian.correlation().alias("corr"), gramian.covariance().alias("cov")).collect()}
    assert len(got) == d * (d + 1) // 2
    for i, j in [(0, 0), (0, 1), (3, 299), (63, 64), (64, 200), (150, 151), (7, 8), (9, 20), (128, 256)]:
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        a, b = x[both, i], x[both, j]
        corr, cov, count = got[i, j]
        assert count == both.sum()
        if not both.any():
            assert corr is None and cov is None
            continue
        assert cov == pytest.approx(np.cov(a, b, bias=True)[0, 1], abs=1e-6)
        assert corr is None if 7 in (i, j) else corr == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9)
    assert gramian.pair_moments(df.where("false"), names[:3]).collect() == []


@pytest.mark.parametrize("d", [1, 5, 40])
def test_principal_components(spark, d):
    rng = np.random.default_rng(d)
    points = rng.normal(size=(300, d)) @ rng.normal(size=(d, d)) + 50.0
    if d == 5:
        points[:, 4] = points[:, 0]  # a direction without variance
    df = vectors(spark, points)
    df = df.unionByName(df.limit(1).withColumn("features", F.when(F.col("id") < 0, F.col("features"))))
    k = min(d, 3)
    found = spectrum.principal_components(df, k)
    values, axes = np.linalg.eigh(np.cov(points.T, bias=True).reshape(d, d))
    order = np.argsort(-values)[:k]
    assert found.variances == pytest.approx(values[order]) and found.total == pytest.approx(values.sum())
    assert np.abs((found.components * axes[:, order].T).sum(axis=1)) == pytest.approx(np.ones(k))
    assert found.ratios == pytest.approx((values[order] / values.sum()).tolist())
    for r in spectrum.residual_check(df, found).collect():
        assert r.length == pytest.approx(1.0) and r.residual < 1e-7 * r.variance
    placed, ratios = learning.pca(df, k)
    got = {r.id: r.pca_1 for r in placed.collect() if r.features is not None}
    assert [got[i] for i in range(300)] == pytest.approx((points @ found.components[0]).tolist())
    assert sum(r.pca_1 is None for r in placed.collect()) == 1
    with pytest.raises(ValueError):
        spectrum.principal_components(df.where("false"), 1)
