"""Statistics and models over the driver tables and the panel."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrata.functions.numeric import row_mean
from quadrata.operators import density, forest, kmeans, learning, ordered, spectrum, statistics
from quadrata.session import cut_lineage, load
from quadrata.workload.base import CLASS_SQL, money, on_lines, part_classes, query, rounded
from quadrata.workload.panels import PANEL_CTES, panel

MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def lines_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of the line items; every seventh order has no discount, every ninth no tax."""
    order = F.col("l_orderkey")
    return load(spark, folder, "lineitem").select(
        "l_quantity",
        "l_extendedprice",
        F.when(order % 7 != 0, F.col("l_discount")).alias("l_discount"),
        F.when(order % 9 != 0, F.col("l_tax")).alias("l_tax"),
        F.lit(2022.0).alias("constant"),
    )


_GAPS = """g AS (SELECT l_quantity, l_extendedprice, CASE WHEN l_orderkey % 7 <> 0 THEN l_discount END AS l_discount,
 CASE WHEN l_orderkey % 9 <> 0 THEN l_tax END AS l_tax FROM lineitem)"""


def _corr_sql(a: str, b: str) -> str:
    if "constant" in (a, b):
        return f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, CAST(NULL AS DOUBLE) AS corr"
    return f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {rounded(f'corr({a}, {b})')} AS corr FROM g"


@query(
    "corr_matrix",
    f"WITH {_GAPS} " + " UNION ALL ".join(_corr_sql(a, b) for a in (*MEASURES, "constant") for b in (*MEASURES, "constant")),
)
def corr_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.corr_matrix(lines_with_gaps(spark, folder), [*MEASURES, "constant"], 6)


@query(
    "target_corr",
    on_lines(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, {rounded(f'corr({c}, target)')} AS corr FROM p"
            for c in ("n_rows", "weight_sum", "price_wmean", "discount_wmean", "balance_total")
        )
        + " UNION ALL SELECT 'snapshot_year', CAST(NULL AS DOUBLE)) ORDER BY corr DESC NULLS LAST, feature",
        PANEL_CTES,
    ),
)
def target_corr(spark: SparkSession, folder: str) -> DataFrame:
    features = ["n_rows", "weight_sum", "price_wmean", "discount_wmean", "balance_total", "snapshot_year"]
    return statistics.target_corr(panel(spark, folder), features, "target", 6)


@query(
    "linregress",
    f"""WITH m AS (SELECT count(*) AS n, regr_slope(l_extendedprice, l_quantity) AS slope,
      regr_intercept(l_extendedprice, l_quantity) AS intercept, corr(l_extendedprice, l_quantity) AS r,
      var_pop(l_quantity) AS vx, var_pop(l_extendedprice) AS vy FROM lineitem)
    SELECT n, {rounded("slope", 4)} AS slope, {rounded("intercept", 4)} AS intercept, {rounded("r")} AS r,
     {rounded("r * r")} AS r_squared, {rounded("sqrt((1 - r * r) * vy / vx / (n - 2))")} AS std_err FROM m""",
)
def linregress(spark: SparkSession, folder: str) -> DataFrame:
    fit = statistics.linregress(load(spark, folder, "lineitem"), "l_quantity", "l_extendedprice")
    digits = {"slope": 4, "intercept": 4, "r": 6, "r_squared": 6, "std_err": 6}
    return fit.select("n", *[(F.round(c, d) + 0.0).alias(c) for c, d in digits.items()])


def _median_sql(column: str) -> str:
    return f"coalesce({column}, (SELECT median({column}) FROM g)) AS {column}"


@query("impute_median", f"WITH {_GAPS} SELECT l_quantity, l_extendedprice, {_median_sql('l_discount')}, {_median_sql('l_tax')} FROM g")
def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    return statistics.impute_median(lines_with_gaps(spark, folder).drop("constant"), ["l_discount", "l_tax"])


@query(
    "column_medians",
    f"WITH {_GAPS} "
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS n, median({c}) AS value FROM g" for c in MEASURES),
)
def column_medians(spark: SparkSession, folder: str) -> DataFrame:
    return ordered.exact_quantiles(lines_with_gaps(spark, folder), MEASURES, 0.5)


@query(
    "zscore",
    f"""WITH m AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)
    SELECT o_orderkey, {rounded("(o_totalprice - m) / s")} AS o_totalprice_z, CAST(0 AS DOUBLE) AS flat_z FROM orders, m""",
)
def zscore(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice", F.lit(5.0).alias("flat"))
    scaled = statistics.zscore(orders, ["o_totalprice", "flat"])
    return scaled.select("o_orderkey", (F.round("o_totalprice_z", 6) + 0.0).alias("o_totalprice_z"), "flat_z")


def _zcov_sql(a: str, b: str) -> str:
    value = f"covar_pop({a}, {b}) / (stddev_pop({a}) * stddev_pop({b}))"
    return f"SELECT '{a}_z' AS feature_a, '{b}_z' AS feature_b, {rounded(value)} AS covariance FROM lineitem"


@query(
    "covariance",
    " UNION ALL ".join(_zcov_sql(a, b) for i, a in enumerate(MEASURES) for b in MEASURES[i:]),
)
def covariance(spark: SparkSession, folder: str) -> DataFrame:
    """Covariances of the z-scores, the matrix behind the principal components."""
    scaled = statistics.zscore(load(spark, folder, "lineitem").select(*MEASURES), MEASURES)
    return statistics.covariance_matrix(scaled, [f"{c}_z" for c in MEASURES], 6)


_OLS = ("l_quantity", "l_discount", "l_tax")


def _ols_sql() -> str:
    """Centred normal equations of three regressors, solved by cofactors."""
    pairs = [(i, j) for i in range(3) for j in range(i, 3)]
    sums = ", ".join(f"count(*) * covar_pop({_OLS[i]}, {_OLS[j]}) AS s{i}{j}" for i, j in pairs)
    cross = ", ".join(f"count(*) * covar_pop({x}, l_extendedprice) AS c{i}, avg({x}) AS m{i}" for i, x in enumerate(_OLS))

    def s(i: int, j: int) -> str:
        return f"s{min(i, j)}{max(i, j)}"

    def cofactor(i: int, j: int) -> str:
        (a, b), (c, d) = ([k for k in range(3) if k != x] for x in (i, j))
        sign = "" if (i + j) % 2 == 0 else "-"
        return f"{sign}({s(a, c)} * {s(b, d)} - {s(a, d)} * {s(b, c)})"

    inverse = ", ".join(f"{cofactor(i, j)} / det AS v{i}{j}" for i, j in pairs)

    def v(i: int, j: int) -> str:
        return f"v{min(i, j)}{max(i, j)}"

    slopes = ", ".join(f"{' + '.join(f'{v(i, j)} * c{j}' for j in range(3))} AS b{i}" for i in range(3))
    around = " + ".join(f"m{i} * m{j} * {v(i, j)}" for i in range(3) for j in range(3))
    terms = [(x, f"b{i}", f"sqrt(mse * v{i}{i})") for i, x in enumerate(_OLS)]
    terms.append(("const", "my - b0 * m0 - b1 * m1 - b2 * m2", f"sqrt(mse * (1.0 / n + {around}))"))
    rows = " UNION ALL ".join(f"SELECT '{t}' AS term, {b} AS b, {e} AS e, r2, n FROM fit" for t, b, e in terms)
    return f"""WITH m AS (SELECT count(*) AS n, {sums}, {cross}, avg(l_extendedprice) AS my,
     count(*) * var_pop(l_extendedprice) AS yy FROM lineitem),
    d AS (SELECT *, {" + ".join(f"{s(0, j)} * ({cofactor(0, j)})" for j in range(3))} AS det FROM m),
    i AS (SELECT *, {inverse} FROM d), w AS (SELECT *, {slopes} FROM i),
    fit AS (SELECT *, (yy - b0 * c0 - b1 * c1 - b2 * c2) / (n - 4) AS mse, (b0 * c0 + b1 * c1 + b2 * c2) / yy AS r2 FROM w)
    SELECT term, {rounded("b", 3)} AS coefficient, {rounded("e", 3)} AS std_err, {rounded("b / e", 3)} AS t,
     {rounded("r2")} AS r_squared, {rounded("r2 / 3 / ((1 - r2) / (n - 4))", 2)} AS f_value, n FROM ({rows})"""


@query("ols", _ols_sql())
def ols(spark: SparkSession, folder: str) -> DataFrame:
    fit = learning.ols(load(spark, folder, "lineitem"), list(_OLS), "l_extendedprice")
    digits = {"coefficient": 3, "std_err": 3, "t": 3, "r_squared": 6, "f_value": 2}
    return fit.select("term", "n", *[(F.round(c, d) + 0.0).alias(c) for c, d in digits.items()])


@query(
    "train_eval",
    f"""WITH d AS (SELECT *, substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 4) < '3333' AS test FROM lineitem),
    f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM d WHERE NOT test),
    e AS (SELECT avg((l_extendedprice - a - b * l_quantity) ** 2) AS mse, var_pop(l_extendedprice) AS v FROM d, f WHERE test)
    SELECT (SELECT count(*) FROM d WHERE NOT test) AS n_train, (SELECT count(*) FROM d WHERE test) AS n_test,
     {rounded("1 - mse / v")} AS r2, {rounded("sqrt(mse)", 3)} AS rmse,
     {rounded("sqrt(mse) / (SELECT avg(l_extendedprice) FROM d) * 100", 4)} AS error_pct FROM e""",
)
def train_eval(spark: SparkSession, folder: str) -> DataFrame:
    scores = learning.train_eval(load(spark, folder, "lineitem"), "l_orderkey", ["l_quantity"], "l_extendedprice")
    digits = {"r2": 6, "rmse": 3, "error_pct": 4}
    return scores.select("n_train", "n_test", *[(F.round(c, d) + 0.0).alias(c) for c, d in digits.items()])


_CUTS = {"l_quantity": (5, 10, 15, 20, 25, 30, 35, 40, 45), "l_discount": (0.015, 0.035, 0.055, 0.075), "l_tax": (0.015, 0.035, 0.055), "l_linenumber": (1, 2, 4)}
_TREES, _DEPTH, _LEAST = 5, 3, 20


def _forest_sql() -> str:
    """The forest of ``rf_importance``, level by level."""
    named = ", ".join(f"{' + '.join(f'CAST({f} > {c} AS INTEGER)' for c in cuts)} AS b{i}" for i, (f, cuts) in enumerate(_CUTS.items()))
    digit = "substr(md5(tree || '-' || l_orderkey || '/' || l_linenumber), 1, 1)"
    weight = "CASE " + " ".join(f"WHEN contains('{digits}', {digit}) THEN {n}" for n, digits in forest.TIMES.items()) + " END"
    ctes = [
        f"drawn AS (SELECT tree, {named}, CAST(round(l_extendedprice * 100) AS BIGINT) AS y, {weight} AS w FROM lineitem, range({_TREES}) r(tree))",
        f"n0 AS (SELECT tree, 1 AS node, {', '.join(f'b{i}' for i in range(len(_CUTS)))}, sum(w) AS w, sum(w * y) AS s FROM drawn WHERE w > 0 GROUP BY ALL)",
    ]
    for d in range(_DEPTH):
        long = " UNION ALL ".join(f"SELECT tree, node, {i} AS f, b{i} AS bin, w, s FROM n{d}" for i in range(len(_CUTS)))
        over = "PARTITION BY tree, node, f"
        ctes += [
            f"h{d} AS (SELECT tree, node, f, bin, sum(w) AS w, sum(s) AS s FROM ({long}) GROUP BY ALL)",
            f"""p{d} AS (SELECT tree, node, f, bin, CAST(sum(w) OVER ({over} ORDER BY bin) AS DOUBLE) AS wl, CAST(sum(s) OVER ({over} ORDER BY bin) AS DOUBLE) AS sl,
             CAST(sum(w) OVER ({over}) AS DOUBLE) AS wt, CAST(sum(s) OVER ({over}) AS DOUBLE) AS st FROM h{d})""",
            f"""g{d} AS (SELECT tree, node, f, bin, sl * sl / wl + (st - sl) * (st - sl) / (wt - wl) - st * st / wt AS gain FROM p{d}
             WHERE wl >= {_LEAST} AND wt - wl >= {_LEAST})""",
            f"s{d} AS (SELECT * FROM g{d} WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY tree, node ORDER BY gain DESC, f, bin) = 1)",
        ]
        bin_of_f = "CASE f " + " ".join(f"WHEN {i} THEN b{i}" for i in range(len(_CUTS))) + " END"
        ctes.append(f"n{d + 1} AS (SELECT tree, 2 * node + CAST({bin_of_f} > bin AS INTEGER) AS node, {', '.join(f'b{i}' for i in range(len(_CUTS)))}, w, s FROM n{d} JOIN s{d} USING (tree, node))")
    every = " UNION ALL ".join(f"SELECT tree, f, gain FROM s{d}" for d in range(_DEPTH))
    ctes += [
        f"q AS (SELECT tree, f, sum(gain) AS gain FROM ({every}) GROUP BY ALL)",
        f"i AS (SELECT f, sum(share) / {_TREES} AS importance FROM (SELECT f, gain / sum(gain) OVER (PARTITION BY tree) AS share FROM q) GROUP BY f)",
        "names(f, feature) AS (VALUES " + ", ".join(f"({i}, '{f}')" for i, f in enumerate(_CUTS)) + ")",
    ]
    return f"WITH {', '.join(ctes)} SELECT feature, coalesce({rounded('importance')}, 0) AS importance FROM names LEFT JOIN i USING (f)"


@query("rf_importance", _forest_sql())
def rf_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Which of four columns of the line items a forest for the price uses, by the decrease of the squared error."""
    lines = load(spark, folder, "lineitem").select(F.concat_ws("/", "l_orderkey", "l_linenumber").alias("key"), *_CUTS, F.rint(F.col("l_extendedprice") * 100).cast("bigint").alias("y"))
    splits = forest.grow(forest.cells(lines, "key", _CUTS, "y", _TREES), list(_CUTS), _DEPTH, _LEAST)
    return forest.importances(splits, list(_CUTS), _TREES).withColumn("importance", F.round("importance", 6) + 0.0)


@query("rf_panel")
def rf_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Feature importances over the panel: single features, a composite index among others, and all of them."""
    rows = cut_lineage(
        panel(spark, folder).withColumn("rate_index", row_mean(["discount_wmean", "tax_wmean"]))
    )
    sets = {
        "single": ["price_wmean", "weight_sum"],
        "composite": ["rate_index", "weight_sum", "balance_total"],
        "all": ["price_wmean", "weight_sum", "discount_wmean", "tax_wmean", "rate_index", "balance_total"],
    }
    return learning.forest_importance(rows, sets, "target")


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "embeddings").select("vec_id", "label", array_to_vector("embedding").alias("features"))


@query("kmeans_sweep")
def kmeans_sweep(spark: SparkSession, folder: str) -> DataFrame:
    return learning.kmeans_sweep(vectors(spark, folder), range(2, 7))


@query(
    "kmeans_optimality",
    f"""WITH x AS (SELECT generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
    s AS (SELECT sum(ss) AS total FROM (SELECT count(*) * var_pop(v) AS ss FROM x GROUP BY i)), n AS (SELECT count(*) AS n FROM embeddings)
    SELECT CAST(k AS INTEGER) AS k, n AS n_rows, n AS n_nearest, true AS centres_are_means, {rounded("total", 4)} AS total_ss FROM range(2, 7) t(k), n, s""",
)
def kmeans_optimality(spark: SparkSession, folder: str) -> DataFrame:
    """Of the best fit per k: rows at their nearest cluster mean, centres against means, sums of squares within and between."""
    rows = vectors(spark, folder)
    best = kmeans.best_fits(kmeans.kmeans_fits(rows, range(2, 7)))
    told = kmeans.optimality(rows, list(best.values()))
    means = (F.col("centre_gap") < 1e-5).alias("centres_are_means")
    return told.select("k", "n_rows", "n_nearest", means, (F.round("total_ss", 4) + 0.0).alias("total_ss"))


CLUSTER_FEATURES = ["target", "price_wmean", "weight_sum", "tax_wmean"]


@query("cluster_profiles")
def cluster_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Panel rows clustered on scaled features, with risk labels and principal components."""
    rows = panel(spark, folder).select("nation", "year", *CLUSTER_FEATURES)
    scaled = cut_lineage(learning.scaled_features(cut_lineage(rows), CLUSTER_FEATURES))
    model = learning.best_kmeans(scaled, 3)
    placed, _ = learning.pca(model.transform(scaled))
    return learning.risk_profiles(placed, "prediction", "target").drop("features")


@query("pca")
def pca(spark: SparkSession, folder: str) -> DataFrame:
    _, ratios = learning.pca(vectors(spark, folder))
    return spark.createDataFrame(list(enumerate(ratios, 1)), "component int, explained_ratio double")


@query(
    "pca_residuals",
    f"""WITH x AS (SELECT generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
    SELECT CAST(c AS INTEGER) AS component, true AS unit, true AS eigenvector, {rounded("total")} AS total_variance
    FROM range(1, 4) r(c), (SELECT sum(s) AS total FROM (SELECT var_pop(v) AS s FROM x GROUP BY i))""",
)
def pca_residuals(spark: SparkSession, folder: str) -> DataFrame:
    """Of three components, recomputed from the rows: length, whether they are eigenvectors, and the trace of the covariance."""
    rows = vectors(spark, folder)
    found = spectrum.principal_components(rows, 3)
    checked = spectrum.residual_check(rows, found)
    unit, small = F.abs(F.col("length") - 1) < 1e-9, F.col("residual") < 1e-7 * F.col("variance")
    return checked.select("component", unit.alias("unit"), small.alias("eigenvector"), F.round(F.lit(found.total), 6).alias("total_variance"))


@query(
    "pca_pair",
    f"""WITH m AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem)
    SELECT 1 AS component, {rounded("(1 + r) / 2")} AS explained_ratio FROM m
    UNION ALL SELECT 2, {rounded("(1 - r) / 2")} FROM m""",
)
def pca_pair(spark: SparkSession, folder: str) -> DataFrame:
    """Explained variance of two standardised measures, whose principal components have a closed form."""
    pair = ["l_quantity", "l_extendedprice"]
    scaled = learning.scaled_features(load(spark, folder, "lineitem").select(*pair), pair)
    _, ratios = learning.pca(scaled)
    return spark.createDataFrame([(i, round(r, 6)) for i, r in enumerate(ratios, 1)], "component int, explained_ratio double")


@query(
    "cluster_summary",
    on_lines(
        f"""SELECT class, count(*) AS n_rows, {rounded("CAST(sum(p_size) AS DOUBLE) / count(*)", 2)} AS mean_size,
        {rounded("CAST(sum(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / count(*)", 2)} AS mean_price
        FROM (SELECT {CLASS_SQL} AS class, * FROM part) GROUP BY class"""
    ),
)
def cluster_summary(spark: SparkSession, folder: str) -> DataFrame:
    part = load(spark, folder, "part").select("p_partkey", "p_size", money("p_retailprice").alias("price"))
    classed = part.join(part_classes(spark, folder), "p_partkey")
    return learning.cluster_summary(classed, "class", {"mean_size": "p_size", "mean_price": "price"})


@query(
    "risk_profile",
    """WITH m AS (SELECT o_orderstatus, row_number() OVER (ORDER BY avg(o_totalprice), o_orderstatus) - 1 AS k FROM orders GROUP BY o_orderstatus)
    SELECT o_orderkey, o_orderstatus, CAST(k AS INTEGER) AS risk_id,
     CASE k WHEN 0 THEN 'Riesgo bajo' WHEN 1 THEN 'Riesgo medio' WHEN 2 THEN 'Riesgo alto' END AS risk_label
    FROM orders JOIN m USING (o_orderstatus)""",
)
def risk_profile(spark: SparkSession, folder: str) -> DataFrame:
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return learning.risk_profiles(orders, "o_orderstatus", "o_totalprice").drop("o_totalprice")


# --- Density clustering of customers by balance and spending --------------------------------------------------------

EPS = 40.0
RADII = (20.0, 25.0, 30.0, 35.0, 40.0, 45.0, 50.0, 55.0, 60.0)
PANEL_RADII = (0.6, 0.8, 1.0, 1.2, 1.4, 1.6, 1.8, 2.0, 2.2)
_PTS = """pts AS (SELECT c_custkey AS id, c_acctbal AS x, coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 0) / 1000 AS y
 FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_acctbal)"""
_POINTS = f"""{_PTS},
 near AS (SELECT a.id AS a, b.id AS b FROM pts a JOIN pts b ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 40.0),
 deg AS (SELECT a AS id, count(*) >= 3 AS core FROM near GROUP BY a)"""


def points(spark: SparkSession, folder: str) -> DataFrame:
    spent = load(spark, folder, "orders").groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("spent"))
    customer = load(spark, folder, "customer").select("c_custkey", "c_acctbal")
    joined = customer.join(spent, F.col("c_custkey") == F.col("o_custkey"), "left")
    total = F.coalesce(F.col("spent").cast("double"), F.lit(0.0))
    return joined.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("x"), (total / 1000).alias("y"))


@query("dbscan_core", f"WITH {_POINTS} SELECT id, core AS is_core FROM deg")
def dbscan_core(spark: SparkSession, folder: str) -> DataFrame:
    return density.dbscan_core(points(spark, folder), "id", ["x", "y"], EPS)


@query(
    "dbscan",
    f"""WITH RECURSIVE {_POINTS},
    e AS (SELECT a, b FROM near JOIN deg p ON p.id = a JOIN deg q ON q.id = b WHERE p.core AND q.core),
    reach AS (SELECT id AS a, id AS b FROM deg WHERE core UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
    first AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a),
    num AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root FROM first)),
    c AS (SELECT id, cluster FROM first JOIN num USING (root)),
    border AS (SELECT a AS id, min(cluster) AS cluster FROM near JOIN deg ON deg.id = a JOIN c ON c.id = b WHERE NOT core GROUP BY a)
    SELECT deg.id, core AS is_core, CAST(coalesce(c.cluster, border.cluster, -1) AS INTEGER) AS cluster
    FROM deg LEFT JOIN c ON c.id = deg.id LEFT JOIN border ON border.id = deg.id""",
)
def dbscan(spark: SparkSession, folder: str) -> DataFrame:
    return density.dbscan(points(spark, folder), "id", ["x", "y"], EPS)


_SWEEP = f"""WITH RECURSIVE r(eps) AS (VALUES {", ".join(f"(CAST({x} AS DOUBLE))" for x in RADII)}), {_PTS},
    d AS (SELECT a.id AS a, b.id AS b, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM pts a JOIN pts b ON true),
    near AS (SELECT eps, a, b FROM d JOIN r ON d.d <= eps),
    deg AS (SELECT eps, a AS id, count(*) >= 3 AS core FROM near GROUP BY eps, a),
    e AS (SELECT near.eps, a, b FROM near JOIN deg p ON p.eps = near.eps AND p.id = a JOIN deg q ON q.eps = near.eps AND q.id = b WHERE p.core AND q.core),
    reach AS (SELECT eps, id AS a, id AS b FROM deg WHERE core UNION SELECT reach.eps, reach.a, e.b FROM reach JOIN e ON reach.eps = e.eps AND reach.b = e.a),
    c AS (SELECT eps, a AS id, min(b) AS root FROM reach GROUP BY eps, a),
    border AS (SELECT near.eps, near.a AS id, min(root) AS root FROM near JOIN deg ON deg.eps = near.eps AND deg.id = near.a
     JOIN c ON c.eps = near.eps AND c.id = near.b WHERE NOT core GROUP BY near.eps, near.a),
    l AS (SELECT deg.eps, deg.id, coalesce(c.root, border.root, -1) AS label FROM deg LEFT JOIN c ON c.eps = deg.eps AND c.id = deg.id
     LEFT JOIN border ON border.eps = deg.eps AND border.id = deg.id),
    size AS (SELECT eps, label, count(*) AS n FROM l GROUP BY eps, label),
    away AS (SELECT l.eps, d.a, l.label, sum(d.d) AS s FROM d JOIN l ON l.id = d.b GROUP BY l.eps, d.a, l.label),
    sides AS (
     SELECT away.eps, away.a, max(CASE WHEN away.label = own.label THEN CASE WHEN n = 1 THEN 0 ELSE s / (n - 1) END END) AS within,
      min(CASE WHEN away.label <> own.label THEN s / n END) AS other, max(CASE WHEN away.label = own.label THEN n END) AS mine
     FROM away JOIN size ON size.eps = away.eps AND size.label = away.label JOIN l own ON own.eps = away.eps AND own.id = away.a GROUP BY away.eps, away.a),
    score AS (SELECT eps, avg(CASE WHEN mine = 1 OR greatest(within, other) = 0 THEN 0 ELSE (other - within) / greatest(within, other) END) AS s FROM sides GROUP BY eps)
    SELECT r.eps, CAST(count(DISTINCT CASE WHEN label >= 0 THEN label END) AS INTEGER) AS clusters, count(CASE WHEN label < 0 THEN 1 END) AS noise,
     CASE WHEN count(DISTINCT CASE WHEN label >= 0 THEN label END) >= 2 THEN {rounded("any_value(s)")} END AS silhouette
    FROM r JOIN l ON l.eps = r.eps JOIN score ON score.eps = r.eps GROUP BY r.eps"""


@query("dbscan_sweep", _SWEEP)
def dbscan_sweep(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters, noise and Euclidean silhouette of the customers per radius."""
    rows = cut_lineage(points(spark, folder))
    placed = rows.select("id", array_to_vector(F.array("x", "y")).alias("features"))
    swept = density.dbscan_sweep(rows, "id", ["x", "y"], RADII, 3, placed)
    return swept.withColumn("silhouette", F.round("silhouette", 6) + 0.0)


@query("dbscan_panel")
def dbscan_panel(spark: SparkSession, folder: str) -> DataFrame:
    """The same for the scaled rows of the panel."""
    rows = cut_lineage(panel(spark, folder).select((F.col("time_id") * 100 + F.col("entity_id")).alias("id"), *CLUSTER_FEATURES))
    scaled = cut_lineage(learning.scaled_features(rows, CLUSTER_FEATURES))
    arrays = vector_to_array("features")
    parts = scaled.select("id", *[F.get(arrays, F.lit(i)).alias(f"z{i}") for i in range(len(CLUSTER_FEATURES))])
    return density.dbscan_sweep(parts, "id", [f"z{i}" for i in range(len(CLUSTER_FEATURES))], PANEL_RADII, 3, scaled)
