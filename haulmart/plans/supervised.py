"""Will a delivery be late, and by how much: spark.ml pipelines."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmart.functions.render import mean
from haulmart.operators.splitting import folds, split
from haulmart.plans import foldfit
from haulmart.plans.features import (
    CATEGORICAL_FEATURES,
    CLASSIFICATION_TARGET,
    FEATURE_COLUMNS,
    NUMERIC_FEATURES,
    REGRESSION_TARGET,
)
from haulmart.sources.store import kept

# Fixed values
TEST_SHARE = 0.20
CV_FOLDS = 5
LOGISTIC = "Regresión logística"
FOREST = "Random Forest"
TOP_FEATURES = 25


@dataclass(frozen=True)
class Settings:
    seed: int = 42
    trees: int = 300
    min_leaf: int = 3
    # The deepest tree the library grows.
    max_depth: int = 30
    max_iterations: int = 2000
    inverse_penalty: float = 1.0
    cv_folds: int = CV_FOLDS
    # Gradient tolerance of the logistic fit.
    tolerance: float = 1e-4
    # Folds fitted at the same time; each forest holds all its rows in bins and all its nodes.
    parallelism: int = 1
    # Most labelled rows that a classifier is fitted on, first by a hash; all without one.
    fit_rows: int | None = None


def preprocessor() -> list:
    """Standardise the numbers, one-hot the categories, ignore unknown ones.

    Unknown categories are indexed past the known ones and the encoder drops
    that last slot, so they come out as all zeros.
    """
    indexed = [f"{c}_index" for c in CATEGORICAL_FEATURES]
    encoded = [f"{c}_onehot" for c in CATEGORICAL_FEATURES]
    return [
        StringIndexer(
            inputCols=list(CATEGORICAL_FEATURES), outputCols=indexed, handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=list(NUMERIC_FEATURES), outputCol="numbers"),
        StandardScaler(
            inputCol="numbers", outputCol="scaled", withMean=True, withStd=True
        ),
        VectorAssembler(inputCols=["scaled", *encoded], outputCol="features"),
    ]


def feature_names(fitted: PipelineModel) -> list[str]:
    """Names in vector order, from the fitted string indexer."""
    indexer = fitted.stages[0]
    names = [f"num__{c}" for c in NUMERIC_FEATURES]
    for column, labels in zip(CATEGORICAL_FEATURES, indexer.labelsArray):
        names.extend(f"cat__{column}_{value}" for value in labels)
    return names


def class_weights(train: DataFrame, label: str) -> DataFrame:
    """Weight each class by total / (classes * its size)."""
    sizes = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}
    total = sum(sizes.values())
    weight = F.lit(1.0)
    for value, size in sizes.items():
        weight = F.when(F.col(label) == value, total / (len(sizes) * size)).otherwise(weight)
    return train.withColumn("weight", weight)


def logistic(rows: int, settings: Settings) -> LogisticRegression:
    """L2 strength stated per row, the penalty being 1 / (C * rows)."""
    return LogisticRegression(
        labelCol=CLASSIFICATION_TARGET,
        regParam=1.0 / (settings.inverse_penalty * max(rows, 1)),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=settings.max_iterations,
        tol=settings.tolerance,
    )


def forest(settings: Settings) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=CLASSIFICATION_TARGET,
        weightCol="weight",
        numTrees=settings.trees,
        maxDepth=settings.max_depth,
        minInstancesPerNode=settings.min_leaf,
        featureSubsetStrategy="sqrt",
        seed=settings.seed,
        # A task may hold as much, and an executor runs several.
        maxMemoryInMB=256,
        # Rows remember their node, so deep levels do not walk every tree again.
        cacheNodeIds=True,
    )


def with_score(scored: DataFrame) -> DataFrame:
    """Probability of being late as a plain column, and the 0/1 call."""
    return scored.withColumn("score", vector_to_array("probability")[1])


# -- metrics ------------------------------------------------------------------


def confusion(scored: DataFrame, label: str = CLASSIFICATION_TARGET) -> DataFrame:
    """All four cells, also the empty ones."""
    counts = scored.groupBy(
        F.col(label).cast("int").alias("actual"),
        F.col("prediction").cast("int").alias("predicted"),
    ).agg(F.count(F.lit(1)).alias("n"))
    cell = F.col("id").cast("int")
    grid = scored.sparkSession.range(4).select(
        F.floor(cell / 2).cast("int").alias("actual"), (cell % 2).alias("predicted")
    )
    return grid.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce(F.col("n"), F.lit(0)).alias("n")
    )


def call_metrics(scored: DataFrame, label: str = CLASSIFICATION_TARGET) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class in one row."""
    actual, called = F.col(label) == 1, F.col("prediction") == 1
    cells = scored.agg(
        F.count_if(actual & called).cast("double").alias("tp"),
        F.count_if(~actual & called).cast("double").alias("fp"),
        F.count_if(actual & ~called).cast("double").alias("fn"),
        F.count(F.lit(1)).cast("double").alias("n"),
    )
    tp, fp, fn, n = (F.col(c) for c in ("tp", "fp", "fn", "n"))

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    return cells.select(
        ratio(n - fp - fn, n).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def roc_auc(scored: DataFrame, label: str = CLASSIFICATION_TARGET) -> float:
    """Exact area: every distinct score is a threshold."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="score", metricName="areaUnderROC", numBins=0
    ).evaluate(scored.withColumn(label, F.col(label).cast("double")))


def classification_metrics(scored: DataFrame, label: str = CLASSIFICATION_TARGET) -> DataFrame:
    return call_metrics(scored, label).withColumn("roc_auc", F.lit(float(roc_auc(scored, label))))


def choose_best(metrics: DataFrame) -> DataFrame:
    """The candidate with the highest F1; the first of equals by position."""
    return metrics.orderBy(F.col("f1").desc(), "position").limit(1)


def regression_metrics(scored: DataFrame, label: str = REGRESSION_TARGET) -> DataFrame:
    """Mean squared, root and absolute error and R squared in one row."""
    actual = F.col(label).cast("double")
    error = F.col("prediction") - actual
    sums = scored.agg(
        mean(error * error).alias("mse"),
        mean(F.abs(error)).alias("mae"),
        F.var_pop(actual).alias("spread"),
    )
    return sums.select(
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mae",
        (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2"),
    )


def residuals(scored: DataFrame, label: str = REGRESSION_TARGET) -> DataFrame:
    """Actual minus predicted, for diagnostics."""
    return scored.withColumn("residual", F.col(label).cast("double") - F.col("prediction"))


# -- training -----------------------------------------------------------------


@dataclass
class Candidate:
    name: str
    model: PipelineModel
    metrics: dict[str, float]
    cv_f1_mean: float
    cv_f1_std: float


@dataclass
class Classification:
    candidates: list[Candidate]
    train_size: int
    test_size: int
    scored: DataFrame
    features: list[tuple[str, float]] = field(default_factory=list)

    @property
    def best(self) -> Candidate:
        """Highest F1 on the test rows; the first of equals."""
        return max(self.candidates, key=lambda c: c.metrics["f1"])


@dataclass
class Regression:
    model: PipelineModel
    metrics: dict[str, float]
    train_size: int
    test_size: int
    scored: DataFrame


def importances(fitted: PipelineModel, top: int = TOP_FEATURES) -> list[tuple[str, float]]:
    """The heaviest features: forest importance or absolute coefficient."""
    model = fitted.stages[-1]
    weights = (
        model.featureImportances.toArray()
        if hasattr(model, "featureImportances")
        else abs(model.coefficients.toArray())
    )
    named = zip(feature_names(fitted), (float(w) for w in weights))
    return sorted(named, key=lambda pair: pair[1], reverse=True)[:top]


def _f1(model: Transformer, rows: DataFrame) -> float:
    return call_metrics(model.transform(rows)).first()["f1"]


def _centre_and_spread(scores: list[float]) -> tuple[float, float]:
    centre = sum(scores) / len(scores)
    return centre, (sum((s - centre) ** 2 for s in scores) / len(scores)) ** 0.5


def cross_validate(train: DataFrame, build, settings: Settings) -> tuple[float, float]:
    """Mean and population deviation of F1 over hash folds of the train rows."""
    placed = folds(train, "folio", settings.cv_folds, settings.seed).persist()

    def score(fold: int) -> float:
        model = build(placed.filter(F.col("fold") != fold))
        return _f1(model, placed.filter(F.col("fold") == fold))

    try:
        with ThreadPoolExecutor(settings.parallelism) as pool:
            scores = list(pool.map(score, range(settings.cv_folds)))
    finally:
        placed.unpersist()
    return _centre_and_spread(scores)


def logistic_fold_cells(train: DataFrame, settings: Settings) -> list[dict]:
    """Right and wrong calls of every fold by the logistic model that never saw it."""
    placed = folds(train, "folio", settings.cv_folds, settings.seed)
    return foldfit.fold_cells(
        placed, settings.cv_folds, drawn(settings), settings.fit_rows,
        settings.inverse_penalty, settings.tolerance, settings.max_iterations,
    )


def validate(name: str, train: DataFrame, settings: Settings) -> tuple[float, float]:
    """Cross validation of a candidate; logistic models share their passes over the rows."""
    if name != LOGISTIC:
        return cross_validate(train, candidates(settings)[name], settings)
    cells = logistic_fold_cells(train, settings)
    return _centre_and_spread([
        2 * c["tp"] / max(2 * c["tp"] + c["fp"] + c["fn"], 1) for c in cells
    ])


def drawn(settings: Settings) -> Column:
    """The order in which rows enter a bounded sample."""
    return F.xxhash64("folio", F.lit(settings.seed))


def candidates(settings: Settings) -> dict[str, object]:
    """Name to a function that fits the whole pipeline on given rows."""

    def bounded(train: DataFrame) -> DataFrame:
        if settings.fit_rows is None:
            return train
        return train.orderBy(drawn(settings), "folio").limit(settings.fit_rows)

    def fit_logistic(train: DataFrame) -> PipelineModel:
        train = bounded(train)
        model = logistic(train.count(), settings)
        return Pipeline(stages=[*preprocessor(), model]).fit(train)

    def fit_forest(train: DataFrame) -> PipelineModel:
        weighted = class_weights(bounded(train), CLASSIFICATION_TARGET)
        return Pipeline(stages=[*preprocessor(), forest(settings)]).fit(weighted)

    return {LOGISTIC: fit_logistic, FOREST: fit_forest}


def train_classifier(frame: DataFrame, settings: Settings = Settings()) -> Classification:
    """Fit both candidates, score them on held-out rows, keep the best."""
    placed = kept(
        split(frame, "folio", TEST_SHARE, settings.seed, CLASSIFICATION_TARGET), "classification"
    )
    train, test = placed.filter(~F.col("is_test")), placed.filter("is_test")
    found = []
    for name, build in candidates(settings).items():
        model = build(train)
        centre, spread = validate(name, train, settings)
        metrics = classification_metrics(with_score(model.transform(test))).first().asDict()
        found.append(Candidate(name, model, metrics, centre, spread))
    result = Classification(found, train.count(), test.count(), test)
    result.scored = with_score(result.best.model.transform(test))
    result.features = importances(result.best.model)
    return result


def linear(settings: Settings) -> LinearRegression:
    # Full one-hot columns are collinear, which the normal equations reject.
    return LinearRegression(
        labelCol=REGRESSION_TARGET, solver="l-bfgs", maxIter=settings.max_iterations,
        standardization=False,
    )


def train_regressor(frame: DataFrame, settings: Settings = Settings()) -> Regression:
    placed = kept(split(frame, "folio", TEST_SHARE, settings.seed), "regression")
    train, test = placed.filter(~F.col("is_test")), placed.filter("is_test")
    model = Pipeline(stages=[*preprocessor(), linear(settings)]).fit(train)
    scored = residuals(model.transform(test))
    metrics = regression_metrics(scored).first().asDict()
    return Regression(model, metrics, train.count(), test.count(), scored)


# -- scoring ------------------------------------------------------------------


class NotTrained(FileNotFoundError):
    """Scoring was asked for before any model was saved."""


def load_model(path: str) -> PipelineModel:
    try:
        return PipelineModel.load(path)
    except Exception as error:
        if any(s in str(error) for s in ("does not exist", "Input path", "PATH_NOT_FOUND")):
            raise NotTrained(
                f"No hay modelo entrenado en {path}; ejecuta primero el entrenamiento."
            ) from error
        raise


def predict(plans: DataFrame, classifier: PipelineModel, regressor: PipelineModel) -> DataFrame:
    """Score planned deliveries: chance of being late and expected minutes."""
    keep = [c for c in plans.columns if c not in FEATURE_COLUMNS]
    scored = with_score(classifier.transform(plans)).select(
        *plans.columns, F.col("score").alias("probability_late")
    )
    timed = regressor.transform(scored)
    return timed.select(
        *keep,
        (F.col("probability_late") >= 0.5).alias("will_be_late"),
        F.col("probability_late").alias("probability"),
        F.greatest(F.col("prediction"), F.lit(0.0)).alias("expected_delay_minutes"),
    )


