import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from haulmart.plans import clustering, features, supervised, training
from haulmart.plans.star import Star
from haulmart.sources.store import Store


def frame(spark, n=600):
    rng = random.Random(1)
    data = []
    for i in range(n):
        hour, route = rng.choice(["PICO_AM", "NOCHE"]), rng.choice(["R1", "R2", "R3"])
        late = int(rng.random() < (0.85 if hour == "PICO_AM" else 0.1))
        data.append((f"F{i}", 60.0, 70, float(rng.randrange(100, 900)), rng.randrange(9), i % 7,
                     route, "LOCAL", "CENTRO", "CORTA", hour, "TRUCK", "0-3", "3-5", "PREMIUM",
                     "true" if i % 7 >= 5 else "false", late * 30 + rng.randrange(5), late))
    kinds = dict(zip(features.NUMERIC_FEATURES, ("double", "int", "double", "int", "int")))
    ddl = ", ".join(["folio string", *[f"{c} {kinds.get(c, 'string')}"
                                       for c in features.FEATURE_COLUMNS],
                     "delay_minutes int", "is_delayed int"])
    return spark.createDataFrame(data, ddl)


SMALL = supervised.Settings(trees=5, max_depth=4, cv_folds=2)


def test_leakage_guard():
    features.check_leakage()
    assert len(features.FEATURE_COLUMNS) == 15
    with pytest.raises(ValueError):
        features.check_leakage(("zone", "delay_minutes"))


def test_unknown_categories_are_zeros(spark):
    rows = frame(spark)
    fitted = Pipeline(stages=supervised.preprocessor()).fit(rows)
    odd = rows.limit(1).withColumn("route_code", F.lit("NUEVA"))
    vector = fitted.transform(odd).select(vector_to_array("features")).first()[0]
    names = supervised.feature_names(fitted)
    assert len(vector) == len(names)
    assert not any(v for v, n in zip(vector, names) if n.startswith("cat__route_code_"))


def test_classifier_and_regressor(spark):
    rows = frame(spark).persist()
    calls = supervised.train_classifier(rows, SMALL)
    assert [c.name for c in calls.candidates] == [supervised.LOGISTIC, supervised.FOREST]
    assert calls.best.metrics["f1"] > 0.75 and len(calls.features) <= 25
    assert calls.train_size + calls.test_size == 600
    cells = {(r.actual, r.predicted): r.n for r in supervised.confusion(calls.scored).collect()}
    assert len(cells) == 4 and sum(cells.values()) == calls.test_size
    times = supervised.train_regressor(rows, SMALL)
    assert times.metrics["r2"] > 0.05
    plans = rows.select(F.col("folio").alias("plan_id"), *features.FEATURE_COLUMNS)
    scored = supervised.predict(plans, calls.best.model, times.model).collect()
    assert all(0 <= r.probability <= 1 and r.expected_delay_minutes >= 0 for r in scored)
    assert all(r.will_be_late == (r.probability >= 0.5) for r in scored)


def test_scoring_without_models(spark, tmp_path):
    with pytest.raises(supervised.NotTrained):
        supervised.load_model(str(tmp_path / "nothing"))


def test_empty_warehouse(spark, tmp_path):
    from haulmart.sources.store import Store
    with pytest.raises(training.EmptyWarehouse):
        training.train_all(spark, Star.from_store(Store(spark, str(tmp_path))), str(tmp_path / "m"))
    assert not (tmp_path / "m").exists()


def test_choose_k_prefers_smaller(spark):
    sweep = spark.createDataFrame([(2, 0.5), (3, 0.73812), (4, 0.73812)], "k int, silhouette double")
    assert clustering.choose_k(sweep) == 3


def test_silhouette_and_davies_bouldin(spark):
    rng = np.random.default_rng(4)
    xy, labels = rng.normal(size=(60, 2)), rng.integers(0, 3, size=60)
    labels[0] = 3
    rows = [(str(i), float(p[0]), float(p[1]), [int(c)]) for i, (p, c) in enumerate(zip(xy, labels))]
    points = spark.createDataFrame(rows, "point string, x double, y double, labels array<int>")
    far = ((xy[:, None] - xy[None]) ** 2).sum(-1)
    widths = []
    for i in range(60):
        own = labels == labels[i]
        if own.sum() == 1:
            widths.append(0.0)
            continue
        a = far[i, own].sum() / (own.sum() - 1)
        b = min(far[i, labels == c].mean() for c in set(labels) if c != labels[i])
        widths.append((b - a) / max(a, b))
    got = clustering.silhouettes(points, [4]).first()
    assert got.silhouette == pytest.approx(np.mean(widths), abs=1e-9)
    centres = np.array([xy[labels == c].mean(0) for c in range(4)])
    spread = [np.sqrt(((xy[labels == c] - centres[c]) ** 2).sum(1)).mean() for c in range(4)]
    worst = [max((spread[i] + spread[j]) / np.linalg.norm(centres[i] - centres[j])
                 for j in range(4) if j != i) for i in range(4)]
    assert clustering.davies_bouldin(points, [4])[4] == pytest.approx(np.mean(worst))


def test_cluster_routes(spark):
    rng = random.Random(2)
    data = [(f"R{i}", "n", "LOCAL", "z", base + rng.random(), base, 0.2, 5.0, 100.0, 3.0, 30.0 - base / 50)
            for i, base in enumerate([50.0, 400.0, 900.0] * 12)]
    ddl = ("route_code string, route_name string, route_type string, zone string, "
           + ", ".join(f"{c} double" for c in features.PROFILE_FEATURES))
    profile = spark.createDataFrame(data, ddl)
    settings = clustering.Settings(restarts=3)
    out = clustering.cluster_routes(profile, None, settings, range(2, 5))
    assert out.k == 3 and out.silhouette > 0.4 and sum(out.explained_variance) > 0.9
    inertia = [r["inertia"] for r in out.sweep]
    assert inertia == sorted(inertia, reverse=True)
    labels = [r.label for r in out.summary.collect()]
    assert len(set(labels)) == 3
    assert clustering.scatter(out.components).count() == 36
    fixed = clustering.cluster_routes(profile, 2, settings, range(3, 4))
    assert fixed.k == 2 and fixed.summary.count() == 2


def test_the_registered_training_job_is_whole(monkeypatch, spark):
    from types import SimpleNamespace

    from haulmart.showcase import q_mining
    from haulmart.showcase.registry import QUERIES

    asked = []
    monkeypatch.setattr(q_mining.training, "train_all", lambda *a: asked.extend(a[4:]) or {
        "classification": {"best_name": "x", "best": {"metrics": {"f1": 1.0}}},
        "regression": {"metrics": {"mse": 1.0}}, "clustering": {"k": 2, "silhouette": 0.5},
    })
    QUERIES["m20_train_all"].build(SimpleNamespace(spark=spark, star=None, scratch=lambda name: name))
    assert asked == [supervised.Settings(fit_rows=2_000), clustering.Settings()]


def test_classifiers_score_in_a_session_that_wrote_a_warehouse(spark, tmp_path):
    rows = frame(spark, 60)
    store = Store(spark, str(tmp_path))
    kept, n = store.counted_work("r", "frame", rows)
    assert n == 60 and store.append("etl_log", store.log()) == 0
    for build in supervised.candidates(SMALL).values():
        scored = supervised.with_score(build(kept).transform(kept))
        assert scored.filter("score BETWEEN 0 AND 1").count() == 60
