"""The exploratory analysis of a modelling panel: correlations, regressions, importances, clusters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrata.functions.numeric import row_mean
from quadrata.operators import learning, statistics
from quadrata.operators.density import dbscan, dbscan_sweep
from quadrata.operators.schema import require_columns
from quadrata.plans import territory as t
from quadrata.session import cut_lineage


@dataclass(frozen=True)
class AnalysisSpec:
    """Columns and parameters; the defaults are those of the borough study."""

    key: Sequence[str] = ("alcaldia_id", "anio")
    name: str = "alcaldia_nombre"
    target: str = t.TARGET
    regressor: str = "iluminacion_promedio"
    regressors: Sequence[str] = t.OLS_FEATURES
    index: Sequence[str] = ("nbi_wmean", "rei_wmean", "casi_wmean")
    cluster_features: Sequence[str] = t.CLUSTER_FEATURES
    clusters: int = 3
    cluster_counts: Sequence[int] = tuple(range(2, 7))
    restarts: int = 20
    eps_values: Sequence[float] = t.EPS_VALUES
    eps: float = 1.4
    min_samples: int = 3
    seed: int = 42

    def feature_sets(self) -> Mapping[str, Sequence[str]]:
        return {
            "pobreza_iluminacion": ("nbi_wmean", self.regressor),
            "marginacion_servicios": ("indice_marginacion", self.regressor, "drenaje_promedio"),
            "iluminacion_mmip": (self.regressor, "mmip_wmean"),
        }


def explain_target(panel: DataFrame, catalog: DataFrame, spec: AnalysisSpec = AnalysisSpec()) -> dict[str, DataFrame]:
    """Correlations with the target, simple and multiple regression, held-out error and forest importances.

    Missing values are replaced by the column median first, as the models need complete rows.
    """
    columns = learning.model_columns(panel, catalog, spec.target)
    rows = panel.withColumn("_id", F.concat_ws("/", *spec.key)).withColumn("indice_marginacion", row_mean(spec.index))
    rows = cut_lineage(statistics.impute_median(rows, [*columns, "indice_marginacion"]))
    features = [c for c in columns if c != spec.target]
    return {
        "target_corr": statistics.target_corr(rows, features, spec.target),
        "corr_matrix": statistics.corr_matrix(rows, columns),
        "linregress": statistics.linregress(rows, spec.regressor, spec.target),
        "ols": learning.ols(rows, list(spec.regressors), spec.target),
        "train_eval": learning.train_eval(rows, "_id", [spec.regressor], spec.target),
        "importance": learning.forest_importance(rows, spec.feature_sets(), spec.target, depth=30, seed=spec.seed),
    }


def profile_risk(panel: DataFrame, spec: AnalysisSpec = AnalysisSpec()) -> dict[str, DataFrame]:
    """K-means and DBSCAN on scaled features: evaluations, labelled rows, summary and comparison."""
    features = list(spec.cluster_features)
    require_columns(panel, [*spec.key, spec.name, *features])
    rows = panel.select(F.concat_ws("/", *spec.key).alias("_id"), *spec.key, spec.name, *features)
    scaled = cut_lineage(learning.scaled_features(rows, features))
    sweep = learning.kmeans_sweep(scaled, spec.cluster_counts, spec.restarts, spec.seed)
    model = learning.best_kmeans(scaled, spec.clusters, spec.restarts, spec.seed)
    placed, ratios = learning.pca(model.transform(scaled).withColumnRenamed("prediction", "cluster_kmeans"))

    arrays, axes = vector_to_array("features"), [f"z{i}" for i in range(len(features))]
    points = scaled.select("_id", *[F.get(arrays, F.lit(i)).alias(z) for i, z in enumerate(axes)])
    vectors = scaled.select("_id", "features")
    dense = dbscan(points, "_id", axes, spec.eps, spec.min_samples)
    labelled = learning.risk_profiles(placed, "cluster_kmeans", spec.target)
    labelled = labelled.join(dense.select("_id", F.col("cluster").alias("cluster_dbscan")), "_id")
    labelled = cut_lineage(labelled.drop("_id", "features"))
    comparison = labelled.select(
        spec.name, *spec.key, spec.target, "risk_id", "risk_label", "cluster_kmeans", "cluster_dbscan"
    ).orderBy("risk_id", spec.name, *spec.key)
    return {
        "kmeans_eval": sweep,
        "dbscan_eval": dbscan_sweep(points, "_id", axes, spec.eps_values, spec.min_samples, vectors),
        "pca_variance": panel.sparkSession.createDataFrame(list(enumerate(ratios, 1)), "component int, ratio double"),
        "profiles": labelled,
        "comparison": comparison,
        "summary": learning.cluster_summary(labelled, "risk_label", {f"{c}_mean": c for c in features}),
    }
