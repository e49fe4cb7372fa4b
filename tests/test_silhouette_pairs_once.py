"""Euclidean silhouettes of few clusters meet every pair of different rows once, in cells of two stripes."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector

from quadrata.operators import silhouette

from .test_sweeps import plain_silhouette


def table(x, labels, n):
    return pa.table({"row": np.arange(len(x)), "x": pa.array(x.tolist()), "labels": pa.array(labels.tolist(), pa.list_(pa.int32())), "n": n})


def test_a_cell_tells_both_sides_from_each_distance(monkeypatch):
    rng = np.random.default_rng(2)
    x, labels, n = rng.normal(size=(40, 3)), rng.integers(0, 2, (40, 1)), rng.integers(1, 4, 40)
    met, plain = [], silhouette._distances
    monkeypatch.setattr(silhouette, "_distances", lambda *a: met.append((out := plain(*a)).size) or out)
    monkeypatch.setattr(silhouette, "TILE", (7, 9))
    left, right = table(x[:25], labels[:25], n[:25]), table(x[25:], labels[25:], n[25:])
    got = np.array(silhouette._sums([[0, 1]])((pa.scalar(0), pa.scalar(1)), left, right).column("sums").to_pylist())
    apart, weight = np.linalg.norm(x[:, None] - x[None], axis=2), n[:, None] * (labels == [[0, 1]])
    assert sum(met) == 25 * 15
    assert np.allclose(got, np.concatenate([apart[:25, 25:] @ weight[25:], apart[25:, :25] @ weight[:25]]), atol=1e-12)
    alone = np.array(silhouette._sums([[0, 1]])((pa.scalar(1), pa.scalar(1)), left, left).column("sums").to_pylist())
    assert np.allclose(alone, apart[:25, :25] @ weight[:25], atol=1e-12)


def test_cells_and_copies_equal_the_plain_form(spark, monkeypatch):
    monkeypatch.setattr(silhouette, "SIDE", 23)
    rng = np.random.default_rng(4)
    x = np.repeat(rng.normal(size=(70, 3)), rng.integers(1, 6, 70), axis=0)
    a, b = rng.integers(-1, 3, len(x)), (x[:, 0] > 0) * 1
    rows = spark.createDataFrame([(p.tolist(), int(i), int(j)) for p, i, j in zip(x, a, b)], "x array<double>, a int, b int")
    got = silhouette.silhouettes(rows.select(array_to_vector("x").alias("features"), "a", "b"), ["a", "b"])
    assert got == pytest.approx([plain_silhouette(x, a), plain_silhouette(x, b)], abs=1e-9)
