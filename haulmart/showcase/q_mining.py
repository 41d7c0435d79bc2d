"""Feature tables, models, metrics and clusters."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F


from haulmart.operators.splitting import split
from haulmart.plans import clustering, features, supervised, training, widths
from haulmart.showcase import oracle as o
from haulmart.showcase.registry import Context, query
from haulmart.sources.store import put

col = F.col
LABEL = supervised.CLASSIFICATION_TARGET


# -- feature tables -----------------------------------------------------------

_KINDS = {"packages_count": "i", "day_of_week": "i", "planned_duration_min": "i",
          "distance_km": "d", "cargo_weight_kg": "d"}
FEATURES = ", ".join(f"{c} {_KINDS.get(c, 's')}" for c in features.FEATURE_COLUMNS)


@query("m01_delivery_features", f"folio s, {FEATURES}, delay_minutes i, is_delayed i",
       "SELECT * FROM features")
def _(x: Context):
    return features.delivery_features(x.star)


@query("m13_planned_features", f"plan_id s, {FEATURES}", f"""
SELECT plan_id, CAST(r.distance_km AS DOUBLE) AS distance_km,
  r.estimated_duration_min AS planned_duration_min, CAST(cargo_weight_kg AS DOUBLE) AS cargo_weight_kg,
  packages_count, day_of_week, route_code, r.route_type, r.zone,
  {o.distance('r.distance_km')} AS distance_range, {o.band('departure_hour')} AS time_band,
  vehicle_type, vehicle_age_range, operator_seniority_range, customer_type,
  CASE WHEN day_of_week >= 5 THEN 'true' ELSE 'false' END AS is_weekend
FROM plan p JOIN src_route r ON r.code = p.route_code""")
def _(x: Context):
    return features.planned_features(x.view("plan"), x.src["route"])


@query("m03_stratified_split", "is_delayed i, train i, test i", """
SELECT is_delayed, count(*) - CAST(ceil(count(*) * 0.2) AS BIGINT) AS train,
  CAST(ceil(count(*) * 0.2) AS BIGINT) AS test FROM features GROUP BY 1""")
def _(x: Context):
    rows = features.delivery_features(x.star).select("folio", LABEL)
    return split(rows, "folio", 0.2, 42, LABEL).groupBy(LABEL).agg(
        F.count_if(~col("is_test")).alias("train"), F.count_if("is_test").alias("test")
    )


# -- metrics over a stated rule, so that plain SQL can follow -----------------

# Score of being late: heavier trips score higher; called late from one half.
SCORED = ("SELECT *, cargo_weight_kg / 1250 AS score, "
          "CASE WHEN cargo_weight_kg / 1250 >= 0.5 THEN 1 ELSE 0 END AS prediction FROM features")
_CELLS = """
SELECT CAST(count(*) FILTER (WHERE is_delayed = 1 AND prediction = 1) AS DOUBLE) AS tp,
  CAST(count(*) FILTER (WHERE is_delayed = 0 AND prediction = 1) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (WHERE is_delayed = 1 AND prediction = 0) AS DOUBLE) AS fn,
  CAST(count(*) AS DOUBLE) AS n FROM (@) s
"""
_CALLS = ("(n - fp - fn) / n AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, "
          "coalesce(tp / nullif(tp + fn, 0), 0) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1")


def _scored(x: Context):
    score = col("cargo_weight_kg") / 1250
    return features.delivery_features(x.star).withColumns(
        {"score": score, "prediction": (score >= 0.5).cast("double")}
    )


@query("m07_classification_metrics",
       "accuracy d, precision d, recall d, f1 d, roc_auc d", f"""
SELECT {_CALLS}, roc_auc FROM ({_CELLS.replace('@', SCORED)}) c,
  (SELECT round(sum(neg * (pos_above + pos / 2.0)) / (sum(pos) * sum(neg)), 9) AS roc_auc
   FROM (SELECT *, coalesce(sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING
           AND 1 PRECEDING), 0) AS pos_above
         FROM (SELECT score, count(*) FILTER (WHERE is_delayed = 1) AS pos,
                 count(*) FILTER (WHERE is_delayed = 0) AS neg FROM ({SCORED}) s GROUP BY 1) g) h) a
""")
def _(x: Context):
    return supervised.classification_metrics(_scored(x)).withColumn(
        "roc_auc", F.round("roc_auc", 9)
    )


@query("m08_model_choice", "name s, f1 d", f"""
SELECT name, f1 FROM (SELECT 1 AS position, 'peso' AS name, {_CALLS} FROM ({_CELLS.replace('@', SCORED)}) c
  UNION ALL SELECT 2, 'bultos', {_CALLS} FROM ({_CELLS.replace('@', SCORED.replace('cargo_weight_kg / 1250', 'packages_count / 40'))}) c
) t ORDER BY f1 DESC, position LIMIT 1""")
def _(x: Context):
    frame = features.delivery_features(x.star)
    rules = {"peso": col("cargo_weight_kg") / 1250, "bultos": col("packages_count") / 40}
    out = None
    for position, (name, score) in enumerate(rules.items(), start=1):
        row = supervised.call_metrics(
            frame.withColumn("prediction", (score >= 0.5).cast("double"))
        ).select(F.lit(position).alias("position"), F.lit(name).alias("name"), "f1")
        out = row if out is None else out.unionByName(row)
    return supervised.choose_best(out)


@query("m09_confusion_matrix", "actual i, predicted i, n i", f"""
SELECT a.range AS actual, p.range AS predicted, count(s.folio) AS n
FROM range(2) a CROSS JOIN range(2) p LEFT JOIN ({SCORED}) s
  ON s.is_delayed = a.range AND s.prediction = p.range GROUP BY 1, 2""")
def _(x: Context):
    return supervised.confusion(_scored(x))


@query("m11_regression_metrics", "mse d, rmse d, mae d, r2 d", """
SELECT round(sse / n, 9) AS mse, round(sqrt(sse / n), 9) AS rmse, round(sae / n, 9) AS mae,
  round(1 - sse / (syy - sy * sy / n), 9) AS r2
FROM (SELECT CAST(count(*) AS DOUBLE) AS n,
    CAST(sum((packages_count - delay_minutes) * (packages_count - delay_minutes)) AS DOUBLE) AS sse,
    CAST(sum(abs(packages_count - delay_minutes)) AS DOUBLE) AS sae,
    CAST(sum(delay_minutes) AS DOUBLE) AS sy,
    CAST(sum(delay_minutes * delay_minutes) AS DOUBLE) AS syy FROM features) t""")
def _(x: Context):
    scored = features.delivery_features(x.star).withColumn(
        "prediction", col("packages_count").cast("double")
    )
    names = ("mse", "rmse", "mae", "r2")
    return supervised.regression_metrics(scored).select(*[F.round(n, 9).alias(n) for n in names])


@query("m11_residuals", "folio s, residual d",
       "SELECT folio, delay_minutes - packages_count AS residual FROM features")
def _(x: Context):
    scored = features.delivery_features(x.star).withColumn(
        "prediction", col("packages_count").cast("double")
    )
    return supervised.residuals(scored)


@query("s10_metrics_document", "rows i, f1 d, recall d", f"""
SELECT CAST(n AS BIGINT) AS rows, f1, recall FROM (SELECT n, {_CALLS}
  FROM ({_CELLS.replace('@', SCORED)}) c) t""")
def _(x: Context):
    """Nested metrics written as a JSON document and read back."""
    scored, path = _scored(x), x.scratch("metrics")
    metrics = supervised.call_metrics(scored).first().asDict()
    training.save_metrics(
        x.spark, {"rows": scored.count(), "classification": {"best": {"metrics": metrics}}}, path
    )
    return training.load_metrics(x.spark, path).select(
        "rows", "classification.best.metrics.f1", "classification.best.metrics.recall"
    )


# -- models -------------------------------------------------------------------


def _frame(x: Context):
    """The feature table, written once per session so that every fit scans it."""
    path = x.scratch("features-" + x.sf_dir.strip("/").replace("/", "-"))
    if path not in _written:
        put(features.delivery_features(x.star), path)
        _written.add(path)
    return x.spark.read.parquet(path)


_written: set[str] = set()
# The registered classifiers are those of the library, fitted on all labelled rows.
FULL = supervised.Settings()


def _halves(x: Context):
    """Train and test rows, split and written once per session."""
    path = x.scratch("split-" + x.sf_dir.strip("/").replace("/", "-"))
    if path not in _written:
        put(split(_frame(x), "folio", supervised.TEST_SHARE, FULL.seed, LABEL), path)
        _written.add(path)
    placed = x.spark.read.parquet(path)
    return placed.filter(~col("is_test")), placed.filter("is_test")


@query("m02_preprocessing", "folio s, width i, filled i")
def _(x: Context):
    frame = _frame(x)
    fitted = Pipeline(stages=supervised.preprocessor()).fit(frame)
    array = vector_to_array("features")
    return fitted.transform(frame).select(
        "folio", F.size(array).alias("width"),
        F.size(F.filter(array, lambda v: v != 0)).alias("filled"),
    )


_CATEGORIES = features.CATEGORICAL_FEATURES


@query("m02_encoding", "folio s, width i, ones i", f"""
SELECT folio, {len(features.NUMERIC_FEATURES)} + (SELECT {" + ".join(f"count(DISTINCT {c})" for c in _CATEGORIES)}
    FROM features) AS width,
  {" + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in _CATEGORIES)} AS ones FROM features""")
def _(x: Context):
    """Width of the feature vector, and how many of its categories are set."""
    frame = _frame(x)
    array, numbers = vector_to_array("features"), len(features.NUMERIC_FEATURES)
    return Pipeline(stages=supervised.preprocessor()).fit(frame).transform(frame).select(
        "folio", F.size(array).alias("width"),
        F.size(F.filter(F.slice(array, numbers + 1, F.size(array)), lambda v: v == 1)).alias("ones"),
    )


def _fitted(x: Context, name: str):
    train, test = _halves(x)
    model = supervised.candidates(FULL)[name](train)
    return model, supervised.with_score(model.transform(test))


METRICS = "accuracy d, precision d, recall d, f1 d, roc_auc d"


@query("m04_logistic_regression", METRICS)
def _(x: Context):
    return supervised.classification_metrics(_fitted(x, supervised.LOGISTIC)[1])


@query("m05_random_forest", METRICS)
def _(x: Context):
    return supervised.classification_metrics(_fitted(x, supervised.FOREST)[1])


@query("m06_cross_validation", "model s, f1_mean d, f1_std d")
def _(x: Context):
    train, _test = _halves(x)
    found = [
        (name, *supervised.validate(name, train, FULL)) for name in supervised.candidates(FULL)
    ]
    return x.spark.createDataFrame(found, "model string, f1_mean double, f1_std double")


@query("m06_fold_calls", "is_delayed i, rows i", f"""
SELECT {LABEL} AS is_delayed, count(*) - CAST(ceil(count(*) * 0.2) AS BIGINT) AS rows
FROM features GROUP BY {LABEL}""")
def _(x: Context):
    """Every training row is called once, by the model that never saw its fold."""
    cells = supervised.logistic_fold_cells(_halves(x)[0], FULL)
    total = {c: sum(fold[c] for fold in cells) for c in ("tp", "fp", "fn", "tn")}
    return x.spark.createDataFrame(
        [(1, total["tp"] + total["fn"]), (0, total["tn"] + total["fp"])],
        "is_delayed bigint, rows bigint",
    )


@query("m10_feature_importance", "feature s, weight d")
def _(x: Context):
    model, _scored_rows = _fitted(x, supervised.FOREST)
    return x.spark.createDataFrame(supervised.importances(model), "feature string, weight double")


@query("m11_linear_regression", "folio s, delay_minutes i, prediction d, residual d")
def _(x: Context):
    return supervised.train_regressor(_frame(x), FULL).scored


@query("m12_batch_scoring", "plan_id s, will_be_late s, probability d, expected_delay_minutes d")
def _(x: Context):
    frame = _frame(x)
    classifier = supervised.candidates(FULL)[supervised.LOGISTIC](frame)
    regressor = supervised.train_regressor(frame, FULL).model
    plans = features.planned_features(x.view("plan"), x.src["route"])
    return supervised.predict(plans, classifier, regressor)


@query("s11_model_artefact", "folio s, same i")
def _(x: Context):
    """A saved and reloaded model scores like the one it was saved from."""
    model, scored = _fitted(x, supervised.LOGISTIC)
    path = x.scratch("model")
    model.write().overwrite().save(path)
    again = supervised.with_score(
        supervised.load_model(path).transform(scored.select("folio", *features.FEATURE_COLUMNS))
    ).select("folio", col("score").alias("again"))
    return scored.join(again, "folio").select(
        "folio", (F.abs(col("score") - col("again")) < 1e-12).cast("int").alias("same")
    )


@query("s11_same_scores", "is_delayed i, rows i, same i", """
SELECT is_delayed, CAST(ceil(count(*) * 0.2) AS BIGINT) AS rows, CAST(ceil(count(*) * 0.2) AS BIGINT) AS same
FROM features GROUP BY 1""")
def _(x: Context):
    """Held-out rows by class, and those that a saved and reloaded model scores alike."""
    model, scored = _fitted(x, supervised.LOGISTIC)
    path = x.scratch("model-again")
    model.write().overwrite().save(path)
    again = supervised.with_score(
        supervised.load_model(path).transform(scored.select("folio", *features.FEATURE_COLUMNS))
    ).select("folio", col("score").alias("again"))
    return scored.join(again, "folio", "left").groupBy(LABEL).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.abs(col("score") - col("again")) < 1e-12).alias("same")
    )


# -- clusters -----------------------------------------------------------------


def _profile(x: Context):
    path = x.scratch("profile-" + x.sf_dir.strip("/").replace("/", "-"))
    if path not in _written:
        put(features.route_profile(x.star), path)
        _written.add(path)
    return x.spark.read.parquet(path)


# Stated groupings of routes, one per k, so that plain SQL can follow.
_KS = (2, 3, 4, 5)
POINTS = f"""
SELECT route_code AS point, distance_km / 100 AS x, avg_delay_minutes / 10 AS y, {{l}} AS cluster
FROM (SELECT *, CAST(split_part(route_code, '-', 2) AS BIGINT) AS origin FROM profile) t
"""


def _points(x: Context):
    origin = F.split("route_code", "-")[1].cast("int")
    return _profile(x).select(
        col("route_code").alias("point"), (col("distance_km") / 100).alias("x"),
        (col("avg_delay_minutes") / 10).alias("y"),
        F.array(*[origin % k for k in _KS]).alias("labels"),
    )


def _silhouette_sql(k: int) -> str:
    points = POINTS.replace("{l}", f"origin % {k}")
    return f"""
SELECT {k} AS k, avg(CASE WHEN a IS NULL THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0)
  END) AS silhouette
FROM (SELECT point, max(CASE WHEN own THEN total / nullif(n - 1, 0) END) AS a,
        min(CASE WHEN NOT own THEN total / n END) AS b
  FROM (SELECT p.point, q.cluster = p.cluster AS own, q.cluster, count(*) AS n,
      sum((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y)) AS total
    FROM ({points}) p, ({points}) q GROUP BY 1, 2, 3) s GROUP BY 1) t
"""


SILHOUETTES = "\nUNION ALL\n".join(_silhouette_sql(k) for k in _KS)


@query("m15_silhouette", "k i, silhouette d",
       f"SELECT k, round(silhouette, 9) AS silhouette FROM ({SILHOUETTES}) s")
def _(x: Context):
    return clustering.silhouettes(_points(x), _KS).withColumn(
        "silhouette", F.round("silhouette", 9)
    )


@query("m16_choose_k", "k i",
       f"SELECT k FROM ({SILHOUETTES}) s ORDER BY silhouette DESC, k LIMIT 1")
def _(x: Context):
    best = clustering.choose_k(clustering.silhouettes(_points(x), _KS))
    return x.spark.range(1).select(F.lit(best).alias("k"))


# The same with distances in place of their squares.
EUCLIDEAN = SILHOUETTES.replace("sum((p.x", "sum(sqrt((p.x").replace("(p.y - q.y)) AS", "(p.y - q.y))) AS")


@query("m16_euclidean_choose_k", "k i",
       f"SELECT k FROM ({EUCLIDEAN}) s ORDER BY silhouette DESC, k LIMIT 1")
def _(x: Context):
    best = clustering.choose_k(widths.euclidean_silhouettes(_points(x), _KS))
    return x.spark.range(1).select(F.lit(best).alias("k"))


def _davies_sql(k: int) -> str:
    points = POINTS.replace("{l}", f"origin % {k}")
    centres = f"""
SELECT c.cluster, cx, cy, avg(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy))) AS s
FROM (SELECT cluster, avg(x) AS cx, avg(y) AS cy FROM ({points}) p GROUP BY 1) c
JOIN ({points}) q ON q.cluster = c.cluster GROUP BY 1, 2, 3"""
    return f"""
SELECT {k} AS k, round(avg(worst), 9) AS davies_bouldin
FROM (SELECT i.cluster, max((i.s + j.s) / sqrt((i.cx - j.cx) * (i.cx - j.cx)
        + (i.cy - j.cy) * (i.cy - j.cy))) AS worst
  FROM ({centres}) i JOIN ({centres}) j ON i.cluster <> j.cluster GROUP BY 1) w
"""


@query("m15_davies_bouldin", "k i, davies_bouldin d",
       "\nUNION ALL\n".join(_davies_sql(k) for k in _KS))
def _(x: Context):
    index = clustering.davies_bouldin(_points(x), _KS)
    return x.spark.createDataFrame(
        [(k, round(v, 9)) for k, v in index.items()], "k int, davies_bouldin double"
    )


@query("m14_cluster_pipeline", "route_code s, cluster i")
def _(x: Context):
    profile = _profile(x)
    points = clustering.fit_plane(profile).transform(profile).select("route_code", "plane")
    fit = clustering.fit_kmeans(points, [3], clustering.Settings())[3]
    return clustering.NearestCentre(fit.centres).transform(points)


@query("m14_cluster_sizes", "routes i, clusters i",
       "SELECT count(*) AS routes, 3 AS clusters FROM profile")
def _(x: Context):
    """Points of a model of three clusters by the sizes that its last pass counted."""
    profile = _profile(x)
    points = clustering.fit_plane(profile).transform(profile).select("route_code", "plane")
    fit = clustering.fit_kmeans(points, [3], clustering.Settings())[3]
    return x.spark.createDataFrame(
        [(sum(fit.sizes), sum(n > 0 for n in fit.sizes))], "routes bigint, clusters bigint"
    )


def _clustered(x: Context):
    """The whole clustering job of a session and folder, with its own settings."""
    key = (x.spark.sparkContext.applicationId, x.sf_dir)
    if key not in _clusterings:
        _clusterings[key] = clustering.cluster_routes(_profile(x))
    return _clusterings[key]


_clusterings: dict[tuple[str, str], clustering.Clustering] = {}


@query("m15_sweep", "k i, inertia d, silhouette d, davies_bouldin d")
def _(x: Context):
    return x.spark.createDataFrame(_clustered(x).sweep)


@query("m15_inertia", "k i, falls i", "SELECT unnest(range(2, 11)) AS k, 1 AS falls")
def _(x: Context):
    """Whether the best model of each k costs less than that of one cluster fewer."""
    cost = {r["k"]: r["inertia"] for r in _clustered(x).sweep}
    return x.spark.createDataFrame(
        [(k, int(cost[k] < cost.get(k - 1, float("inf")))) for k in cost], "k bigint, falls bigint"
    )


@query("m18_each_route_once", "route_code s, placed i", "SELECT route_code, 1 AS placed FROM profile")
def _(x: Context):
    return _clustered(x).assignments.groupBy("route_code").agg(F.count(F.lit(1)).alias("placed"))


_GROUP = "CAST(split_part(route_code, '-', 2) AS BIGINT) % 9"


@query("m17_cluster_names", "cluster i, routes i, label s", f"""
SELECT cluster, routes, phrase || CASE WHEN row_number() OVER (PARTITION BY phrase ORDER BY cluster) > 1
  THEN ' (' || routes || ' rutas)' ELSE '' END AS label
FROM (SELECT *, CASE WHEN km < 80 AND late >= 0.35 THEN 'Rutas urbanas congestionadas'
    WHEN km < 80 AND monthly >= 20 THEN 'Rutas urbanas de alta frecuencia'
    WHEN km >= 350 AND late < 0.35 THEN 'Rutas foráneas eficientes'
    WHEN km >= 350 THEN 'Rutas foráneas con retrasos'
    WHEN late >= 0.35 THEN 'Rutas regionales problemáticas'
    WHEN monthly < 20 THEN 'Rutas de bajo volumen' ELSE 'Rutas regionales estables' END AS phrase
  FROM (SELECT {_GROUP} AS cluster, count(*) AS routes, avg(distance_km) AS km,
      avg(delay_rate) AS late, avg(monthly_shipments) AS monthly FROM profile GROUP BY 1) g) p""")
def _(x: Context):
    group = F.split("route_code", "-")[1].cast("int") % 9
    return clustering.summarise(_profile(x).withColumn("cluster", group))


@query("m18_cluster_profile",
       "cluster i, routes i, distance_km d, delay_rate d, monthly_shipments d", f"""
SELECT {_GROUP} AS cluster, count(*) AS routes, round(avg(distance_km), 9) AS distance_km,
  round(avg(delay_rate), 9) AS delay_rate, round(avg(monthly_shipments), 9) AS monthly_shipments
FROM profile GROUP BY 1""")
def _(x: Context):
    group = F.split("route_code", "-")[1].cast("int") % 9
    means = ("distance_km", "delay_rate", "monthly_shipments")
    return clustering.summarise(_profile(x).withColumn("cluster", group)).withColumns(
        {m: F.round(m, 9) for m in means}
    )


@query("m18_cluster_assignments", "route_code s, cluster i, label s")
def _(x: Context):
    return _clustered(x).assignments


@query("m19_cluster_scatter", "label s, route_code s, x d, y d", f"""
SELECT route_type AS label, route_code, {o.show('distance_km / 7', 3)} AS x,
  {o.show('delay_rate', 3)} AS y FROM profile""")
def _(x: Context):
    return clustering.scatter(_profile(x).select(
        "route_code", col("route_type").alias("label"),
        (col("distance_km") / 7).alias("pc1"), col("delay_rate").alias("pc2"),
    ))


@query("m20_train_all", "best_name s, f1 d, mse d, k i, silhouette d")
def _(x: Context):
    """The whole training job with its own settings, fitted on all rows."""
    payload = training.train_all(
        x.spark, x.star, x.scratch("models"), None, FULL, clustering.Settings(),
    )
    return x.spark.createDataFrame(
        [(
            payload["classification"]["best_name"],
            payload["classification"]["best"]["metrics"]["f1"],
            payload["regression"]["metrics"]["mse"],
            payload["clustering"]["k"], payload["clustering"]["silhouette"],
        )],
        "best_name string, f1 double, mse double, k int, silhouette double",
    )
