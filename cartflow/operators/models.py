"""Training, tuning and comparing classifiers with Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from concurrent.futures import Future
from dataclasses import dataclass
from threading import Lock

from pyspark import SparkContext
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassificationModel, GBTClassifier, LinearSVC,
                                       LogisticRegression, NaiveBayes, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from cartflow.operators import evaluation
from cartflow.operators.boosting import Settings
from cartflow.operators.features import CATEGORICAL, NUMERIC, ONE_HOT, fit_features, largest_category, with_label
from cartflow.operators.sampling import random_folds, random_split
from cartflow.operators.target_codes import TargetCodes, learn
from cartflow.schemas import LEADERBOARD

FOLDS = 5

# A fit runs hundreds of short jobs, so each of its tasks should have this many rows to work on.
ROWS_PER_TASK = 200_000


def logistic_regression(**params) -> LogisticRegression:
    return LogisticRegression(**{"maxIter": 5, "family": "binomial", **params})


class BoostedTrees(GBTClassifier):
    """Fits once for all settings that differ in the number of trees only.

    Trees are added one after the other, so the first trees of the largest such model are the smaller models.
    """

    def fitMultiple(self, dataset: DataFrame, paramMaps: list[dict]) -> Iterator[tuple[int, Model]]:
        settings = [self.copy(p) for p in paramMaps]
        alike: dict[tuple, list[int]] = {}
        for i, s in enumerate(settings):
            others = sorted((p.name, repr(v)) for p, v in s.extractParamMap().items() if p.name != "maxIter")
            alike.setdefault(tuple(others), []).append(i)
        largest = {max(own, key=lambda i: settings[i].getMaxIter()): own for own in alike.values()}
        # Whole fits come first: those who ask for the next model at the same time fit side by side.
        order = [*largest, *[i for whole, own in largest.items() for i in own if i != whole]]
        fitted = {i: Future() for i in largest}
        whole_of = {i: whole for whole, own in largest.items() for i in own}
        return _Answers(order, lambda i: self._fitted(dataset, settings, fitted, i, whole_of[i]))

    def _fitted(self, dataset: DataFrame, settings: list, fitted: dict[int, Future], i: int, whole: int) -> Model:
        if i == whole:
            try:
                fitted[i].set_result(settings[i].fit(dataset))
            except BaseException as error:
                fitted[i].set_exception(error)
            return fitted[i].result()
        return first_trees(fitted[whole].result(), settings[i].getMaxIter())


class _Answers:
    """(i, model of i) in the given order; may be asked by several threads at once."""

    def __init__(self, order: list[int], model_of: Callable[[int], Model]):
        self.left, self.model_of, self.lock = iter(order), model_of, Lock()

    def __iter__(self):
        return self

    def __next__(self) -> tuple[int, Model]:
        with self.lock:
            i = next(self.left)
        return i, self.model_of(i)


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The model of the first ``n`` trees."""
    java, jvm = model._java_obj, SparkContext._gateway.jvm
    trees, weights = (JavaWrapper._new_java_array(list(values)[:n], kind) for values, kind in (
        (java.trees(), jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel), (java.treeWeights(), jvm.double)))
    few = JavaWrapper._new_java_obj("org.apache.spark.ml.classification.GBTClassificationModel", model.uid, trees, weights)
    return model._copyValues(GBTClassificationModel(few), {model.getParam("maxIter"): n})


def gradient_boosted_trees(**params) -> GBTClassifier:
    # The default seed follows from the name of the class; the one that was always used is kept.
    return BoostedTrees(**{"maxIter": 10, **params})._setDefault(seed=hash(GBTClassifier.__name__))


def decision_tree(**params) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(**params)


def random_forest(**params) -> RandomForestClassifier:
    return RandomForestClassifier(**{"numTrees": 10, **params})


def linear_svm(**params) -> LinearSVC:
    return LinearSVC(**{"maxIter": 10, "regParam": 0.1, **params})


def naive_bayes(**params) -> NaiveBayes:
    """Needs features that are not negative, which scaling without centring keeps."""
    return NaiveBayes(**params)


def boosted_trees_fast(**params) -> GBTClassifier:
    """A hundred boosted trees of depth six with a learning rate of 0.1."""
    return GBTClassifier(**{"stepSize": 0.1, "maxIter": 100, "maxDepth": 6, **params})


# The tuned settings of slowly learning trees with many leaves. The library they come from draws rows only
# where a frequency is set (``rows_every``), and none is.
TUNED_BOOSTING = Settings(
    trees=100, leaves=491, rate=0.006883242363721497, least_rows=106, least_hessian=0.03454472573214212,
    l1=0.3899927210061127, l2=0.6485237330340494, feature_share=0.3797454081646243, row_share=0.4181193142567742, seed=47)
ELIMINATION_STEP = 40

# Display name -> estimator, in the order they are compared.
MODELS = {
    "NB": naive_bayes, "LR": logistic_regression, "LSVC": linear_svm,
    "DT": decision_tree, "GBT": gradient_boosted_trees, "RF": random_forest,
}
TREES = {"DT", "GBT", "RF"}


def sized_for_fits(df: DataFrame, key: str) -> DataFrame:
    """The same rows, persisted, in few enough partitions and in a fixed order.

    Bootstraps draw by partition and row order, so a fixed order makes a fit repeatable.
    """
    source = df.persist(StorageLevel.MEMORY_AND_DISK)
    parts = max(1, source.count() // ROWS_PER_TASK)
    sized = (source.repartition(parts, key).sortWithinPartitions(key)
             .persist(StorageLevel.MEMORY_AND_DISK))
    sized.count()
    source.unpersist()
    return sized


@dataclass
class Prepared:
    """Feature stages and the transformed parts, persisted because every model reads them."""

    features: PipelineModel
    train: DataFrame
    test: DataFrame
    source: DataFrame

    @property
    def max_bins(self) -> int:
        """Trees need a bin per category value."""
        return max(32, largest_category(self.features))

    def release(self) -> None:
        for part in (self.train, self.test, self.source):
            part.unpersist()


def prepare(table: DataFrame, key: str, weights: tuple[float, float] = (0.8, 0.2), seed: int = 7,
            fit_on_everything: bool = False, **columns: list[str]) -> Prepared:
    """Split, fit the feature stages (on the training part by default) and transform."""
    # Every feature stage reads the table again, so it is built once.
    labelled = sized_for_fits(with_label(table), key)
    train, test = random_split(labelled, list(weights), key, seed)
    features = fit_features(train, labelled if fit_on_everything else None, **columns)
    parts = [features.transform(p).select(key, "features", "label")
             .persist(StorageLevel.MEMORY_AND_DISK) for p in (train, test)]
    return Prepared(features, *parts, labelled)


@dataclass
class Rates:
    """Vectors whose categories are rates, so trees need no bin for a value; persisted."""

    codes: TargetCodes
    train: DataFrame
    test: DataFrame
    source: DataFrame
    max_bins: int = 32

    def release(self) -> None:
        for part in (self.train, self.test, self.source):
            part.unpersist()


def prepare_rates(table: DataFrame, key: str, weights: tuple[float, float] = (0.8, 0.2), seed: int = 7, folds: int = FOLDS,
                  categorical: list[str] = CATEGORICAL, numeric: list[str] = (*NUMERIC, *ONE_HOT)) -> Rates:
    """Split as ``prepare`` does; categories become out-of-fold rates on the training part, whole rates on the test part."""
    labelled = sized_for_fits(with_label(table), key)
    train, test = random_split(labelled, list(weights), key, seed)
    train = random_folds(train, folds, key, seed + 1)
    codes = learn(train, list(categorical), "label", "fold")
    assemble = VectorAssembler(inputCols=[*numeric, *[f"{c}_rate" for c in categorical]], outputCol="features")
    parts = [assemble.transform(p).select(key, "features", "label").persist(StorageLevel.MEMORY_AND_DISK)
             for p in (codes.out_of_fold(train, "fold"), codes.transform(test))]
    return Rates(codes, *parts, labelled)


def estimator(name: str, max_bins: int = 32, **params) -> Estimator:
    return MODELS[name](**({"maxBins": max_bins} if name in TREES else {}), **params)


def scored(predictions: DataFrame, keep: list[str] = ()) -> DataFrame:
    """``(label, score, prediction)``: the probability of the positive class as the score.

    Raw predictions of a tree are counts in its leaf and those of naive Bayes joint
    log-likelihoods, neither of which orders rows by chance. A support vector machine has
    no probability; its margin does.
    """
    score = "probability" if "probability" in predictions.columns else "rawPrediction"
    return predictions.select(*keep, "label", vector_to_array(score)[1].alias("score"), "prediction")


def evaluator(model: Estimator) -> BinaryClassificationEvaluator:
    """Exact area under the ROC curve by the same score as ``scored``."""
    column = "probability" if model.hasParam("probabilityCol") else "rawPrediction"
    return BinaryClassificationEvaluator(numBins=0, rawPredictionCol=column)


def measures(predictions: DataFrame) -> DataFrame:
    """One row with ``accuracy`` and ``area_roc``."""
    table = scored(predictions)
    return table.agg(
        F.avg((F.col("label") == F.col("prediction")).cast("int")).alias("accuracy")
    ).withColumn("area_roc", evaluation.area_under_roc(table).scalar())


def leaderboard(spark: SparkSession, results: list[tuple[float, float, str]]) -> DataFrame:
    """Models by area under the curve, best first; one row per model."""
    return spark.createDataFrame(results, LEADERBOARD).orderBy(F.desc("area_roc"), "model")


def compare(data: Prepared, names: list[str] = tuple(MODELS)) -> DataFrame:
    """Fit each named model and rank them on the test part."""
    results = []
    for name in names:
        model = estimator(name, data.max_bins).fit(data.train)
        row = measures(model.transform(data.test)).first()
        results.append((row["accuracy"], row["area_roc"], name))
    return leaderboard(data.test.sparkSession, results)


def grid(model: Estimator, **values: list) -> list:
    """Grid over the estimator's *own* parameters.

    Parameters taken from another estimator are silently ignored by a fit, which makes
    every grid point the same model.
    """
    builder = ParamGridBuilder()
    for name, choices in values.items():
        builder = builder.addGrid(model.getParam(name), choices)
    return builder.build()


# The searched settings.
LR_GRID = {"regParam": [0.1, 0.01], "maxIter": [1, 5, 10]}
GBT_GRID = {"stepSize": [0.01, 0.1, 1.0], "maxIter": [1, 5, 10], "maxDepth": [3, 7]}
RF_GRID = {"numTrees": [5, 10, 20], "maxDepth": [3, 7]}


def cross_validate(model: Estimator, choices: dict[str, list], train: DataFrame,
                   folds: int = FOLDS, seed: int = 7, parallelism: int = 4,
                   fold_column: str | None = None) -> CrossValidatorModel:
    """Grid search by cross-validated area under the ROC curve.

    ``parallelism`` fits run at the same time. With ``fold_column`` (0 .. folds-1) the
    folds are those of the column.
    """
    search = CrossValidator(
        estimator=model, estimatorParamMaps=grid(model, **choices),
        evaluator=evaluator(model), numFolds=folds, seed=seed,
        parallelism=parallelism)
    if fold_column:
        search = search.setFoldCol(fold_column)
    return search.fit(train)


def grid_results(spark: SparkSession, found: CrossValidatorModel) -> DataFrame:
    """One row per grid point: its settings and mean area under the curve."""
    rows = [(", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda i: i[0].name)), float(a))
            for m, a in zip(found.getEstimatorParamMaps(), found.avgMetrics)]
    return spark.createDataFrame(rows, "settings string, area_roc double")


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's entries, from the column's metadata."""
    attributes = df.schema[column].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for kind in attributes.values() for a in kind),
                                      key=lambda a: a["idx"])]


def feature_importance(model: Model, df: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` features with the largest gain."""
    names = feature_names(df)
    rows = [(names[i], float(v)) for i, v in enumerate(model.featureImportances.toArray())]
    return (df.sparkSession.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), "feature").limit(k))


def save_model(model: PipelineModel | Model, path: str) -> None:
    model.write().overwrite().save(path)
