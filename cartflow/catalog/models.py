"""Training, tuning, comparison. Trained on the data, so checked by rows and by unit tests."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cartflow.catalog.registry import query
from cartflow.catalog.sampling import _bits
from cartflow.catalog.training import STEPS
from cartflow.operators import boosting as b
from cartflow.operators import evaluation as e
from cartflow.operators import features as f
from cartflow.operators import models as m
from cartflow.operators.sampling import hash_edge, random_split, sample_per_class, with_part
from cartflow.plans.training import training_table, training_table_complete_rows
from cartflow.plans.transactions import joined_features, transaction_table
from cartflow.session import materialise, work_folder
from cartflow.sources import tables as t


def prepared(spark, sf) -> m.Prepared:
    return m.prepare(training_table(t.behavior(spark, sf), keep=["event_id"]), "event_id")


def _compare(spark, sf, *names):
    data = prepared(spark, sf)
    try:
        return m.compare(data, names)
    finally:
        data.release()


for _key, _name in (("m1_logistic_regression", "LR"), ("m2_gradient_boosted_trees", "GBT"),
                    ("m3_decision_tree", "DT"), ("m4_random_forest", "RF"),
                    ("m5_linear_svm", "LSVC"), ("m6_naive_bayes", "NB")):
    query(_key)(lambda spark, sf, name=_name: _compare(spark, sf, name))


@query("v8_leaderboard")
def leaderboard(spark, sf):
    return _compare(spark, sf, *m.MODELS)


# Test rows of the purchase models: a fifth of the training table by hash.
_TEST_PART = f"""{STEPS}, e AS (SELECT event_id, bought FROM c WHERE {_bits('event_id', 7)} >= {hash_edge(0.8)})"""


def _checked(data, names):
    """Test rows and positives of each model, whether every score is a chance, and whether two ways to the area agree."""
    found = []
    for name in names:
        model = m.estimator(name, data.max_bins)
        predictions = model.fit(data.train).transform(data.test).persist()
        table = m.scored(predictions)
        row = table.agg(F.count(F.lit(1)), F.sum("label").cast("long"), F.every(F.col("score").between(0, 1))).first()
        area = e.area_under_roc(table).first()["area_roc"]
        agrees = area is None or abs(area - m.evaluator(model).evaluate(predictions)) < 1e-9
        found.append((name, row[0], row[1], bool(row[2]) if name != "LSVC" else None, agrees))
        predictions.unpersist()
    return data.test.sparkSession.createDataFrame(
        found, "model string, n long, positive long, all_between_0_and_1 boolean, areas_agree boolean")


@query("m1_m6_rows_scored", t.with_views(f"""{_TEST_PART}
SELECT model, count(*) AS n, sum(bought)::BIGINT AS positive,
       CASE WHEN model = 'LSVC' THEN NULL ELSE true END AS all_between_0_and_1, true AS areas_agree
FROM e, (VALUES ('NB'), ('LR'), ('LSVC'), ('DT'), ('GBT'), ('RF')) AS names(model) GROUP BY model""", "behavior"))
def rows_scored(spark, sf):
    data = prepared(spark, sf)
    try:
        return _checked(data, list(m.MODELS))
    finally:
        data.release()


@query("m2_m4_rows_scored_on_rates", t.with_views(f"""{_TEST_PART}
SELECT model, count(*) AS n, sum(bought)::BIGINT AS positive, true AS all_between_0_and_1, true AS areas_agree
FROM e, (VALUES ('GBT'), ('RF')) AS names(model) GROUP BY model""", "behavior"))
def rows_scored_on_rates(spark, sf):
    data = m.prepare_rates(training_table(t.behavior(spark, sf), keep=["event_id"]), "event_id")
    try:
        return _checked(data, ["GBT", "RF"])
    finally:
        data.release()


@query("m9_grid_points", t.with_views(f"""{_TEST_PART}
SELECT 'maxIter=' || i || ', regParam=' || r AS settings, count(event_id) > 0 AS area_is_a_chance
FROM e, (VALUES (1), (5), (10)) AS a(i), (VALUES ('0.1'), ('0.01')) AS b(r) GROUP BY i, r""", "behavior"))
def grid_points(spark, sf):
    return _search(spark, sf, "LR", m.LR_GRID).select("settings", F.col("area_roc").between(0, 1).alias("area_is_a_chance"))


@query("a16_results_as_table", t.with_views("""
SELECT event_type AS model, round(count(*) / (SELECT count(*) FROM behavior), 9) AS accuracy,
       round(count(DISTINCT user_id) / (SELECT count(DISTINCT user_id) FROM behavior), 9) AS area_roc
FROM behavior GROUP BY event_type""", "behavior"))
def results_as_table(spark, sf):
    """A few figures worked out one by one, as rows of a table with declared types."""
    events = t.behavior(spark, sf)
    n, users = events.agg(F.count(F.lit(1)), F.count_distinct("user_id")).first()
    kinds = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users")).collect()
    return m.leaderboard(spark, [(round(r["n"] / n, 9), round(r["users"] / users, 9), r["event_type"]) for r in kinds])


def _metrics(predictions):
    """Accuracy, precision, recall and weighted F-beta in one row."""
    table = m.scored(predictions)
    one = lambda df, c: df.select(c).scalar().alias(c)
    rates = e.precision_recall(table)
    return e.accuracy(table).select("accuracy", one(rates, "precision"), one(rates, "recall"),
                                    one(e.weighted_fbeta(table), "fbeta"))


@query("m7_balanced_boosted_trees")
def balanced_boosted_trees(spark, sf):
    # Each is read several times, and built once.
    table = materialise(training_table_complete_rows(t.behavior(spark, sf)))
    smaller = table.groupBy("is_purchased").count().agg(F.min("count")).first()[0]
    balanced = materialise(sample_per_class(table, "is_purchased", smaller, "event_id"))
    texts = ["brand", "event_weekday", "category_code_level1", "category_code_level2"]
    coded = f.index_values(balanced, f.value_codes([balanced], texts), texts, suffix="_code")
    columns = ["brand_code", "price", "event_weekday_code", "category_code_level1_code",
               "category_code_level2_code", "activity_count"]
    vectors = m.sized_for_fits(VectorAssembler(inputCols=columns, outputCol="features").transform(
        f.with_label(coded)).select("event_id", "label", "features"), "event_id")
    train, test = random_split(vectors, [0.7, 0.3], "event_id", 0)
    try:
        row = _metrics(m.boosted_trees_fast().fit(train).transform(test)).first()
    finally:
        vectors.unpersist()
    return spark.createDataFrame([row], "accuracy double, precision double, recall double, fbeta double")


def _transaction_vectors(spark, sf):
    joined = joined_features(t.transactions(spark, sf), t.identity_info(spark, sf))
    parts = with_part(joined, {"train": 0.8, "test": 0.2}, "transaction_id", 7)
    train, test = (parts.where(F.col("part") == p).drop("part") for p in ("train", "test"))
    table, names = transaction_table(train, test)
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(
        f.with_label(table, "is_fraud"))
    return m.sized_for_fits(vectors.select("transaction_id", "fold", "label", "features"), "transaction_id"), names


# The table of the transaction queries: every transaction once, four fifths of them in the training part.
_TRAINED = f"""
, k AS (SELECT transaction_id, transaction_dt, is_fraud FROM transactions WHERE {_bits('transaction_id', 7)} < {hash_edge(0.8)}),
k5 AS (SELECT *, ntile(5) OVER (ORDER BY transaction_dt, transaction_id) - 1 AS fold FROM k)"""


def _tuned_on_four_folds(spark, sf):
    """Held-out rows of the last fold, scored by the tuned model of the other four."""
    vectors, _ = _transaction_vectors(spark, sf)
    edges = b.bin_edges(vectors)
    growing = b.Boosting(edges, m.TUNED_BOOSTING, [4])
    boosters, scored = growing.fit(b.chunked(vectors, edges, "label", "transaction_id", "fold"), [list(range(len(edges)))])
    held = materialise(growing.held_out(scored, boosters).withColumn("prediction", (F.col("score") > 0.5).cast("double")))
    for part in (scored, vectors):
        part.unpersist()
    return held


@query("m8_tuned_boosted_trees")
def tuned_boosted_trees(spark, sf):
    held = _tuned_on_four_folds(spark, sf)
    accuracy, area = e.accuracy(held).first()[0], e.area_under_roc(held).first()[0]
    return m.leaderboard(spark, [(accuracy, float(area), "GBT tuned")])


@query("m8_rows_scored", t.with_views(f"""{_TRAINED}
SELECT count(*) AS n, sum(is_fraud)::BIGINT AS positive, true AS all_between_0_and_1
FROM k5 WHERE fold = 4""", "transactions"))
def tuned_rows_scored(spark, sf):
    return _tuned_on_four_folds(spark, sf).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").cast("long").alias("positive"),
        F.every(F.col("score").between(0, 1)).alias("all_between_0_and_1"))


def _eliminated(spark, sf):
    vectors, names = _transaction_vectors(spark, sf)
    found = b.eliminate_features(vectors, m.TUNED_BOOSTING, "transaction_id", "fold", names, step=m.ELIMINATION_STEP)
    vectors.unpersist()
    return found


@query("m12_feature_elimination")
def feature_elimination(spark, sf):
    return _eliminated(spark, sf)[1]


@query("m12_scores_by_feature_count")
def scores_by_feature_count(spark, sf):
    return _eliminated(spark, sf)[0]


def _search(spark, sf, name, choices):
    data = prepared(spark, sf)
    try:
        found = m.cross_validate(m.estimator(name, data.max_bins), choices, data.train, parallelism=8)
        return m.grid_results(spark, found)
    finally:
        data.release()


@query("m9_grid_logistic_regression")
def grid_logistic_regression(spark, sf):
    return _search(spark, sf, "LR", m.LR_GRID)


@query("m10_grid_boosted_trees")
def grid_boosted_trees(spark, sf):
    return _search(spark, sf, "GBT", m.GBT_GRID)


@query("m11_grid_random_forest")
def grid_random_forest(spark, sf):
    return _search(spark, sf, "RF", m.RF_GRID)


@query("v6_feature_importance")
def feature_importance(spark, sf):
    data = prepared(spark, sf)
    try:
        model = m.estimator("GBT", data.max_bins).fit(data.train)
        return m.feature_importance(model, data.train)
    finally:
        data.release()


@query("m13_save_and_reload", t.with_views(
    f"{STEPS} SELECT count(*) AS n, count(*) AS same FROM c", "behavior"))
def save_and_reload(spark, sf):
    data, path = prepared(spark, sf), work_folder(spark, "model")
    try:
        model = PipelineModel([*data.features.stages, m.estimator("LR").fit(data.train)])
        m.save_model(model, path)
        again = PipelineModel.load(path)
        rows = f.with_label(training_table(t.behavior(spark, sf), keep=["event_id"]))
        one, two = (x.transform(rows).select("event_id", "prediction") for x in (model, again))
        return one.join(two.withColumnRenamed("prediction", "reloaded"), "event_id").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("prediction") == F.col("reloaded")).alias("same"))
    finally:
        data.release()
