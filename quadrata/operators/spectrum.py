"""Leading principal components by a block Krylov range finder: no covariance matrix is ever formed.

A pass multiplies the covariance with a few vectors, as the sum over the rows of x (x . q); tasks fold their rows first, so what
is shuffled and collected is one vector per column of the block. Products so far span the space in which the components are
sought; it starts from random vectors and grows by a block per pass until the residuals |Cv - lv| are small enough, or it
is the whole space. The driver holds vectors of the number of columns, never rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Spectrum:
    """``components``: k rows of unit length, the largest entry of each positive. Variances are those of the population."""

    mean: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    total: float
    residuals: np.ndarray

    @property
    def ratios(self) -> list[float]:
        return (self.variances / self.total).tolist() if self.total > 0 else [0.0] * len(self.variances)


def _products(mean: np.ndarray, block: np.ndarray):
    def run(batches):
        total = np.zeros(block.shape)
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) - mean
                total += x.T @ (x @ block)
        lists = pa.array(total.T.tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(range(block.shape[1]), pa.int32()), lists], ["i", "v"])

    return run


def _times_covariance(arrays: DataFrame, mean: np.ndarray, block: np.ndarray, n: int) -> np.ndarray:
    parts = arrays.mapInArrow(_products(mean, block), "i int, v array<double>")
    folded = parts.groupBy("i").agg(Summarizer.sum(array_to_vector("v")).alias("v")).collect()  # one row per column of the block
    out = np.zeros(block.shape)
    for row in folded:
        out[:, row.i] = row.v.toArray() / n
    return out


def principal_components(vectors: DataFrame, k: int, features: str = "features", extra: int = 6, tolerance: float = 1e-10, seed: int = 42) -> Spectrum:
    """The k leading components. Null vectors take no part; without rows, or with k above the length, a ValueError is raised."""
    rows = vectors.where(F.col(features).isNotNull())
    n = rows.count()  # the summary below cannot be asked for no rows
    told = rows.agg(Summarizer.metrics("mean", "variance").summary(F.col(features)).alias("s")).first() if n else None
    if not n or not 1 <= k <= told.s.mean.size:
        raise ValueError("components need rows, and at least as many columns")
    mean, d = told.s.mean.toArray(), told.s.mean.size
    total = float(told.s.variance.toArray().sum()) * (n - 1) / n
    arrays = rows.select(vector_to_array(features).alias("x"))
    width = min(d, k + extra)
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, width)))[0]
    basis, images = np.zeros((d, 0)), np.zeros((d, 0))
    while True:
        image = _times_covariance(arrays, mean, block, n)
        basis, images = np.concatenate([basis, block], axis=1), np.concatenate([images, image], axis=1)
        small = basis.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        lead = np.argsort(-values)[:k]
        values, found, moved = values[lead], basis @ turn[:, lead], images @ turn[:, lead]
        residuals = np.sqrt(((moved - found * values) ** 2).sum(axis=0))
        rest = image
        for _ in range(2):  # once more, for what rounding leaves
            rest = rest - basis @ (basis.T @ rest)
        left, size, _ = np.linalg.svd(rest, full_matrices=False)
        block = left[:, size > 1e-12 * max(float(np.abs(image).max()), 1e-300)][:, : d - basis.shape[1]]
        if residuals.max() <= tolerance * max(float(values.max()), 1e-300) or not block.shape[1]:
            break
    signs = np.sign(found[np.abs(found).argmax(axis=0), np.arange(k)])
    return Spectrum(mean, (found * signs).T, np.maximum(values, 0.0), total, residuals)


def projection(array: Column, component: np.ndarray) -> Column:
    other = F.array(*[F.lit(float(x)) for x in component])
    return F.aggregate(F.zip_with(array, other, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


def residual_check(vectors: DataFrame, spectrum: Spectrum, features: str = "features") -> DataFrame:
    """(component, length, variance, residual) recomputed from the rows: covariances of the columns with each projection.

    ``residual`` is |Cv - lv|, from the covariance of every column with the projection on v.
    """
    array = vector_to_array(features)
    rows = vectors.where(F.col(features).isNotNull())
    placed = rows.select(array.alias("x"), *[projection(array, v).alias(f"p{i}") for i, v in enumerate(spectrum.components)])
    every = range(len(spectrum.components))
    long = placed.select(F.posexplode("x").alias("j", "x"), *[f"p{i}" for i in every])
    moments = long.groupBy("j").agg(*[F.covar_pop("x", f"p{i}").alias(f"c{i}") for i in every])
    columns = [F.array(*[F.lit(float(x)) for x in v]) for v in spectrum.components]
    parts = [
        F.struct(
            F.lit(i + 1).alias("component"),
            F.lit(float(np.sqrt((v**2).sum()))).alias("length"),
            F.lit(float(l)).alias("variance"),
            F.sqrt(F.sum(F.pow(F.col(f"c{i}") - F.get(columns[i], F.col("j")) * float(l), 2))).alias("residual"),
        )
        for i, (v, l) in enumerate(zip(spectrum.components, spectrum.variances))
    ]
    return moments.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))
