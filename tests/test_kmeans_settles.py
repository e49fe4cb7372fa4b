"""The best fits go on to a fixed point, whatever ended the comparison of the starts."""

import numpy as np
from pyspark.ml.functions import array_to_vector

from quadrata.operators import kmeans


def test_best_fits_are_settled_when_the_starts_ran_out_of_scans(spark):
    rows = np.random.default_rng(5).normal(size=(3000, 6)).tolist()
    df = spark.createDataFrame([(r,) for r in rows], "x array<double>").select(array_to_vector("x").alias("features")).cache()
    best = kmeans.best_fits(kmeans.kmeans_fits(df, [4], restarts=2, iterations=2))
    told = kmeans.optimality(df, list(best.values())).first()
    assert told.n_nearest == told.n_rows == 3000 and told.centre_gap < 1e-9
    assert abs(told.total_ss - ((np.array(rows) - np.mean(rows, axis=0)) ** 2).sum()) < 1e-6
