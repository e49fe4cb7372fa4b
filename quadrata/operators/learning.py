"""Models on top of pyspark.ml: regression, forests, k-means sweeps, silhouettes, PCA, risk profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrata.operators import kmeans, spectrum
from quadrata.operators.aggregates import group_means
from quadrata.operators.ordered import ordered_labels
from quadrata.operators.schema import dtype_label, require_columns
from quadrata.operators.silhouette import silhouettes
from quadrata.operators.statistics import impute_median, zscore
from quadrata.session import cut_lineage


def model_columns(panel: DataFrame, catalog: DataFrame, target: str) -> list[str]:
    """Numeric panel columns the catalogue recommends, plus the target. The catalogue has a row per column."""
    recommended = {r.feature_name for r in catalog.where("recommended_for_modeling").select("feature_name").collect()}
    numeric = {f.name for f in panel.schema if dtype_label(f.dataType) in ("integer", "numeric")}
    return [c for c in panel.columns if c in numeric and (c in recommended or c == target)]


def model_matrix(panel: DataFrame, catalog: DataFrame, target: str, ids: Sequence[str] = ()) -> DataFrame:
    return panel.select(*ids, *model_columns(panel, catalog, target))


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    require_columns(df, columns)
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def scaled_features(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Median-imputed population z-scores as a vector column."""
    require_columns(df, columns)
    scaled = zscore(impute_median(df, columns), columns)
    vectors = assemble(scaled, [f"{c}_z" for c in columns], out)
    return vectors.drop(*[f"{c}_z" for c in columns])


def ols(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Coefficients with standard errors, t and p per term, and R², F and n of the fit on every row."""
    data = assemble(df.select(*[F.col(c).cast("double").alias(c) for c in [*features, target]]).dropna(), features)
    model = LinearRegression(featuresCol="features", labelCol=target, solver="normal", regParam=0.0).fit(data)
    fit = model.summary
    n, p = fit.numInstances, len(features)
    f_value = (fit.r2 / p) / ((1 - fit.r2) / (n - p - 1)) if fit.r2 < 1 else None
    terms = [*features, "const"]
    values = [*model.coefficients.tolist(), model.intercept]
    rows = [
        (term, float(value), float(se), float(t), float(pv), float(fit.r2), f_value, n)
        for term, value, se, t, pv in zip(
            terms, values, fit.coefficientStandardErrors, fit.tValues, fit.pValues, strict=True
        )
    ]
    return df.sparkSession.createDataFrame(
        rows,
        "term string, coefficient double, std_err double, t double, p_value double, r_squared double,"
        " f_value double, n bigint",
    )


def in_test_split(key: Column | str, share: float = 0.2) -> Column:
    """Seedless split: the leading hex digits of the key's md5 fall below the share.

    The same row lands on the same side however the data is partitioned or re-read.
    """
    bound = f"{round(share * 16**4):04x}"
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.substring(F.md5(text), 1, 4) < bound


def train_eval(df: DataFrame, key: str, features: Sequence[str], target: str, share: float = 0.2) -> DataFrame:
    """Fit on the training side; R², RMSE and RMSE in percent of the overall target mean on the test side."""
    data = assemble(
        df.select(F.col(key), *[F.col(c).cast("double").alias(c) for c in [*features, target]]).dropna(), features
    ).withColumn("_test", in_test_split(key, share))
    model = LinearRegression(featuresCol="features", labelCol=target, solver="normal", regParam=0.0).fit(
        data.where(~F.col("_test"))
    )
    scored = model.transform(data)
    error = F.when(F.col("_test"), F.col(target) - F.col("prediction"))
    actual = F.when(F.col("_test"), F.col(target))
    return scored.agg(
        F.count_if(~F.col("_test")).alias("n_train"),
        F.count_if("_test").alias("n_test"),
        (1 - F.avg(error * error) / F.nullif(F.var_pop(actual), F.lit(0.0))).alias("r2"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.sqrt(F.avg(error * error)) / F.nullif(F.avg(target), F.lit(0.0)) * 100).alias("error_pct"),
    )


def forest_importance(
    df: DataFrame, feature_sets: Mapping[str, Sequence[str]], target: str, trees: int = 100, depth: int = 30, seed: int = 42
) -> DataFrame:
    """(feature_set, feature, importance) of a random forest per feature set; every split sees all features."""
    rows = []
    for name, features in feature_sets.items():
        data = assemble(df.select(*[F.col(c).cast("double").alias(c) for c in [*features, target]]).dropna(), features)
        model = RandomForestRegressor(
            featuresCol="features", labelCol=target, numTrees=trees, maxDepth=depth, featureSubsetStrategy="all", seed=seed
        ).fit(data)
        rows += [(name, f, float(v)) for f, v in zip(features, model.featureImportances.toArray(), strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature_set string, feature string, importance double")


def best_kmeans(vectors: DataFrame, k: int, restarts: int = 20, seed: int = 42, features: str = "features") -> kmeans.Fit:
    """The fit with the lowest inertia over several starts, all moved by the same scans; ``transform`` adds the cluster."""
    return kmeans.best_fits(kmeans.kmeans_fits(vectors, [k], restarts, seed, features))[k]


def silhouette(df: DataFrame, features: str = "features", cluster: str = "prediction", metric: str = "squaredEuclidean") -> float | None:
    """Mean silhouette, by default in its squared Euclidean form, which is linear in the rows. Noise (-1) counts as a cluster of its own."""
    return silhouettes(df, [cluster], features, metric)[0]


def kmeans_sweep(
    vectors: DataFrame, ks: Sequence[int] = range(2, 7), restarts: int = 20, seed: int = 42,
    features: str = "features", metric: str = "euclidean",
) -> DataFrame:
    """(k, inertia, metric, silhouette) per cluster count: all fits in one series of scans, all silhouettes in one pass.

    The Euclidean silhouette compares all pairs of rows; for tables too large for that there is ``squaredEuclidean``.
    """
    best = kmeans.best_fits(kmeans.kmeans_fits(vectors, ks, restarts, seed, features))
    labelled = vectors.where(F.col(features).isNotNull()).select(features)
    for k, fit in best.items():
        labelled = fit.transform(labelled, features, f"k{k}")
    labelled = cut_lineage(labelled)
    values = silhouettes(labelled, [f"k{k}" for k in best], features, metric) if best else []
    rows = [(k, float(fit.inertia), metric, value) for (k, fit), value in zip(best.items(), values, strict=True)]
    return vectors.sparkSession.createDataFrame(rows, "k int, inertia double, metric string, silhouette double")


def pca(vectors: DataFrame, k: int = 2, features: str = "features") -> tuple[DataFrame, list[float]]:
    """The rows with columns ``pca_1..k``, and the explained variance ratios. Null vectors have null components."""
    found = spectrum.principal_components(vectors, k, features)
    array = kmeans.as_array(features)
    parts = {f"pca_{i + 1}": F.when(F.col(features).isNotNull(), spectrum.projection(array, v)) for i, v in enumerate(found.components)}
    return vectors.withColumns(parts), found.ratios


# Risk labels from low to high.
RISK_LABELS = ("Riesgo bajo", "Riesgo medio", "Riesgo alto")


def risk_profiles(df: DataFrame, cluster: str, target: str, labels: Sequence[str] = RISK_LABELS) -> DataFrame:
    """Add risk id and label: clusters ordered by their mean target."""
    means = df.groupBy(cluster).agg(F.avg(target).alias("_mean"))
    order = ordered_labels(means, cluster, "_mean", labels).drop("_mean")
    return df.join(order, cluster)


def cluster_summary(df: DataFrame, group: str, means: Mapping[str, str], digits: int = 2) -> DataFrame:
    return group_means(df, group, means, "n_rows", digits)
