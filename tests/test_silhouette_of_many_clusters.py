"""Silhouettes of labellings with many clusters hand on a bounded number of values per row and cell."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from quadrata.operators import silhouette


def plain(x, label):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    scores = []
    for i, own in enumerate(label):
        if (label == own).sum() == 1:
            scores.append(0.0)
            continue
        within = d[i, label == own].sum() / ((label == own).sum() - 1)
        other = min(d[i, label == c].mean() for c in set(label) - {own})
        scores.append((other - within) / max(other, within) if max(other, within) > 0 else 0.0)
    return float(np.mean(scores))


@pytest.mark.parametrize("group", [1 << 15, 64])
def test_many_clusters_equal_the_plain_form(spark, monkeypatch, group):
    monkeypatch.setattr(silhouette, "GROUP", group)  # 64: the cluster of half the rows comes in parts
    rng = np.random.default_rng(3)
    x, many = rng.normal(size=(300, 2)) * 50, rng.integers(0, 120, 300)
    many[:140] = -1
    few = rng.integers(0, 4, 300)
    rows = spark.createDataFrame([(p.tolist(), int(a), int(b)) for p, a, b in zip(x, many, few)], "x array<double>, a int, b int")
    found = silhouette.silhouettes(rows.select(array_to_vector("x").alias("features"), "a", "b"), ["a", "b"])
    assert found == pytest.approx([plain(x, many), plain(x, few)], abs=1e-9)
