from types import SimpleNamespace

from haulmart.plans import clustering, supervised, training
from haulmart.showcase import q_mining
from haulmart.showcase.registry import QUERIES
from tests.test_mining import frame


def test_registered_models_learn_from_every_row(spark, monkeypatch):
    rows, asked = frame(spark, 2_100), []
    of = supervised.logistic
    monkeypatch.setattr(supervised, "logistic", lambda n, s: asked.append(n) or of(n, s))
    supervised.candidates(q_mining.FULL)[supervised.LOGISTIC](rows)
    assert asked == [2_100] and q_mining.FULL.fit_rows is None
    assert (q_mining.FULL.trees, q_mining.FULL.max_depth, q_mining.FULL.cv_folds) == (300, 30, 5)


def test_the_training_job_asks_for_every_row(monkeypatch, spark):
    asked = []
    monkeypatch.setattr(training, "train_all", lambda *a: asked.extend(a[4:]) or {
        "classification": {"best_name": "x", "best": {"metrics": {"f1": 1.0}}},
        "regression": {"metrics": {"mse": 1.0}}, "clustering": {"k": 2, "silhouette": 0.5},
    })
    QUERIES["m20_train_all"].build(SimpleNamespace(spark=spark, star=None, scratch=lambda name: name))
    assert asked == [supervised.Settings(), clustering.Settings()]
