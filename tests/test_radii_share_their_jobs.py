"""A sweep over radii takes as many steps for many radii as for few, and silhouettes of many clusters do not compare all rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector

from quadrata.operators import density, silhouette

from .test_models import brute_dbscan
from .test_sweeps import plain_silhouette


def points(n=220):
    rng = np.random.default_rng(9)
    spots = rng.uniform(0, 60, (n // 5, 2))
    # Loose groups, exact copies, and a crowded spot whose pairs of boxes are too large to be listed.
    return np.concatenate([spots[rng.integers(0, len(spots), n)] + rng.normal(size=(n, 2)), np.full((9, 2), 70.0), rng.uniform(80, 81.5, (80, 2))])


def frame(spark, rows):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(rows)], "id bigint, x double, y double")


def test_steps_do_not_grow_with_the_radii(spark, monkeypatch):
    df, calls, written, cut = frame(spark, points()), [], density.written, density.cut_lineage
    monkeypatch.setattr(density, "FEW", 1 << 20)  # one look at the boxes, whatever the radius
    monkeypatch.setattr(density, "written", lambda *a: calls.append(1) or written(*a))
    monkeypatch.setattr(density, "cut_lineage", lambda *a: calls.append(1) or cut(*a))
    steps = []
    for radii in ((1.0,), (0.4, 0.7, 1.0, 1.6, 2.5)):
        calls.clear()
        density.radius_forest(df, "id", ["x", "y"], radii)
        steps.append(len(calls))
    assert steps[0] == steps[1]


@pytest.mark.parametrize("few,last", [(256, 1 << 20), (1, 3)])
def test_a_sweep_equals_the_plain_form(spark, monkeypatch, few, last):
    monkeypatch.setattr(density, "FEW", few)  # 1: boxes shrink until their points decide
    monkeypatch.setattr(density, "LAST", last)  # 3: rounds of hooking come before the last task
    monkeypatch.setattr(silhouette, "FEW", 3)  # most clusters are small ones
    rows, radii = points(), (0.4, 0.7, 1.6)
    df = frame(spark, rows)
    got = density.dbscan_sweep(df, "id", ["x", "y"], radii, 3, df.select("id", array_to_vector(density.F.array("x", "y")).alias("features"))).collect()
    for r, eps in zip(got, radii):
        labels = np.array([c for _, c in brute_dbscan([(i, *p) for i, p in enumerate(rows)], eps, 3).values()])
        assert (r.eps, r.clusters, r.noise) == (eps, len(set(labels) - {-1}), int((labels < 0).sum()))
        assert r.silhouette == pytest.approx(plain_silhouette(rows, labels), abs=1e-9)
    assert min(r.clusters for r in got) > silhouette.FEW


def test_rows_only_meet_clusters_that_may_be_beside_them(monkeypatch):
    rng = np.random.default_rng(5)
    label = np.repeat(np.arange(400), 5)
    x = rng.uniform(0, 1000, (400, 2))[label] + rng.normal(size=(2000, 2))
    n = rng.integers(1, 4, 2000)
    left = pa.table({"row": np.arange(2000), "x": pa.array(x.tolist()), "label": pa.array(label, pa.int32())})
    right = pa.table({"label": pa.array(label, pa.int32()), "x": pa.array(x.tolist()), "n": n})
    met, plain = [], silhouette._distances
    monkeypatch.setattr(silhouette, "_distances", lambda *a: met.append((out := plain(*a)).size) or out)
    found = silhouette._grouped((pa.scalar(0), pa.scalar(0), pa.scalar(0)), left, right).to_pandas()
    assert sum(met) < 2000 * 2000 / 3
    apart = np.linalg.norm(x[:, None] - x[None], axis=2) * n
    sums = np.stack([apart[:, label == c].sum(axis=1) for c in range(400)], axis=1)
    sizes = np.bincount(label, weights=n)
    means = np.where(np.arange(400)[None, :] == label[:, None], np.inf, sums / sizes)
    assert np.allclose(found["own"], sums[np.arange(2000), label]) and np.allclose(found["other"], means.min(axis=1)) and (found["size"] == sizes[label]).all()
