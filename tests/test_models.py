"""Models: shapes, ranges, repeatability, and grids that really change the model."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cartflow.operators import features as f
from cartflow.operators import models as m
from cartflow.operators.sampling import random_folds
from cartflow.plans.training import training_table
from cartflow.plans.transactions import joined_features, transaction_table
from cartflow.session import work_folder
from cartflow.sources import tables as t


@pytest.fixture(scope="module")
def data(spark, sf_dir):
    prepared = m.prepare(training_table(t.behavior(spark, sf_dir), keep=["event_id"]), "event_id")
    yield prepared
    prepared.release()


def test_parts(data):
    assert data.train.join(data.test, "event_id", "left_semi").isEmpty()
    assert data.train.count() > data.test.count() > 0
    assert {r.label for r in data.train.select("label").distinct().collect()} == {0.0, 1.0}


def test_label_is_not_flipped(spark):
    df = spark.createDataFrame([(1,), (1,), (0,)], "is_purchased int")
    assert sorted(r.label for r in f.with_label(df).collect()) == [0.0, 1.0, 1.0]


def test_leaderboard(data):
    board = m.compare(data, ["NB", "LR", "DT"]).collect()
    assert {r.model for r in board} == {"NB", "LR", "DT"}
    assert all(0 <= r.accuracy <= 1 and 0 <= r.area_roc <= 1 for r in board)
    assert [r.area_roc for r in board] == sorted((r.area_roc for r in board), reverse=True)


def test_forest_is_repeatable(data):
    fits = [m.estimator("RF", data.max_bins, seed=1).fit(data.train).toDebugString for _ in range(2)]
    assert fits[0].split("\n", 1)[1] == fits[1].split("\n", 1)[1]


@pytest.mark.parametrize("name", ["GBT", "RF", "LSVC"])
def test_fits_and_scores(data, name):
    model = m.estimator(name, data.max_bins, **({"maxIter": 2} if name != "RF" else {})).fit(data.train)
    row = m.measures(model.transform(data.test)).first()
    assert 0 <= row.accuracy <= 1 and 0 <= row.area_roc <= 1


def test_grid_uses_own_parameters(data):
    forest = m.random_forest(maxBins=data.max_bins)
    with pytest.raises(Exception):
        m.grid(forest, stepSize=[0.1])
    depths = {forest.copy(p).getMaxDepth() for p in m.grid(forest, maxDepth=[3, 7])}
    assert depths == {3, 7}


def test_grid_sizes():
    sizes = [len(m.grid(e, **g)) for e, g in ((m.logistic_regression(), m.LR_GRID),
                                              (m.gradient_boosted_trees(), m.GBT_GRID))]
    assert sizes == [6, 18]


def test_cross_validation_with_own_folds(spark, data):
    folded = random_folds(data.train, 3, "event_id", 1)
    found = m.cross_validate(m.logistic_regression(), {"maxIter": [1, 3]}, folded, folds=3, fold_column="fold")
    rows = m.grid_results(spark, found).collect()
    assert len(rows) == 2 and all(0 <= r.area_roc <= 1 for r in rows)


def test_importance_names(data):
    model = m.estimator("DT", data.max_bins).fit(data.train)
    top = m.feature_importance(model, data.train).collect()
    assert 0 < len(top) <= 10 and top[0].importance >= top[-1].importance
    assert all(r.feature in m.feature_names(data.train) for r in top)


def test_saved_model_scores_the_same(data, spark):
    path = work_folder(spark, "model")
    model = PipelineModel([m.estimator("LR").fit(data.train)])
    m.save_model(model, path)
    one, two = (x.transform(data.test).select("event_id", "prediction")
                for x in (model, PipelineModel.load(path)))
    assert one.exceptAll(two).isEmpty()


def test_transaction_table(spark, sf_dir):
    joined = joined_features(t.transactions(spark, sf_dir), t.identity_info(spark, sf_dir), below=20)
    even = F.col("transaction_id") % 2 == 0
    table, features = transaction_table(joined.where(even), joined.where(~even))
    assert not {"constant_col", "dominant_col", "r_emaildomain", "is_fraud"} & set(features)
    row = table.agg(F.min("fold"), F.max("fold"), F.count(F.lit(1))).first()
    assert tuple(row) == (0, 4, joined.where(even).count())
    assert table.where(" or ".join(f"{c} is null" for c in features)).isEmpty()
