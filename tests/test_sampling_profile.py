"""Sampling, splitting, profiles, histograms, codes."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cartflow.operators import features as f
from cartflow.operators import profile as p
from cartflow.operators import sampling as s
from cartflow.operators.explore import histogram, share_of_total
from cartflow.session import work_folder


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(5000).select("id", F.when(F.col("id") % 5 == 0, 1).otherwise(0).alias("label")).persist()


@pytest.mark.parametrize("n", [1, 37, 1000])
def test_exactly_n_per_class(rows, n):
    sample = s.sample_per_class(rows, "label", n, "id")
    counts = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    assert counts == {0: n, 1: n}
    assert sample.select("id").distinct().count() == 2 * n


def test_sample_does_not_depend_on_partitions(rows):
    a = s.sample_per_class(rows, "label", 50, "id")
    b = s.sample_per_class(rows.repartition(13), "label", 50, "id")
    assert a.exceptAll(b).isEmpty()


def test_sample_larger_than_class(rows):
    with pytest.raises(ValueError, match="has 1000 rows"):
        s.sample_per_class(rows, "label", 1001, "id")


def test_split_is_disjoint_and_complete(rows):
    train, test = s.random_split(rows, [0.8, 0.2], "id", 7)
    assert train.join(test, "id", "left_semi").isEmpty()
    assert train.count() + test.count() == 5000
    assert abs(train.count() - 4000) < 150


def test_oversample(rows):
    out = s.oversample_minority(rows, "label").groupBy("label").count().collect()
    assert {r.label: r["count"] for r in out} == {0: 4000, 1: 4000}


@pytest.mark.parametrize("n, k", [(10, 3), (11, 3), (12, 3), (2, 5)])
def test_contiguous_folds(spark, n, k):
    folds = s.contiguous_folds(spark.range(n), k, ["id"], slices=3).orderBy("id").collect()
    sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
    assert [r.fold for r in folds] == [i + 1 for i, size in enumerate(sizes) for _ in range(size)]


@pytest.fixture(scope="module")
def wide(spark):
    return spark.range(1000).select(
        "id", F.lit(7).alias("same"), F.lit(None).cast("string").alias("empty"),
        F.when(F.col("id") < 50, F.col("id").cast("string")).alias("sparse"),
        F.when(F.col("id") % 20 == 0, "rare").otherwise("main").alias("leading"),
        F.when(F.col("id") % 8 == 0, "rare").otherwise("main").alias("mixed"),
        (F.col("id") * 1.5).alias("x")).persist()


def test_useless_columns(wide):
    assert p.useless_columns([wide]) == ["empty", "leading", "same", "sparse"]
    assert p.useless_columns([wide], protect=["same"]) == ["empty", "leading", "sparse"]
    exact = {r["column_name"] for r in p.column_profile(wide).where("drop").collect()}
    assert exact == {"empty", "leading", "same", "sparse"}


@pytest.mark.parametrize("limit", [0.9, 0.5, 0.04])
def test_any_limit_gives_exact_shares(spark, wide, limit):
    many = wide.withColumn("spread", F.when(F.col("id") % 10 == 0, -1).otherwise(F.col("id") % 700))
    rows = {r["column_name"]: (r["top_ratio"], r["is_dominated"]) for r in p.dominant_values(many, limit=limit).collect()}
    exact = {r["column_name"]: r["top_ratio"] for r in p.column_profile(many).collect()}
    assert rows == {c: (pytest.approx(share), share > limit) for c, share in exact.items()}
    useless = p.useless_columns([many], limit=limit)
    assert set(useless) >= {c for c, share in exact.items() if share > limit}


def test_dominant_share_is_exact(wide):
    rows = {r["column_name"]: r["top_ratio"] for r in p.dominant_values(wide).collect()}
    assert rows["leading"] == 0.95 and rows["sparse"] == 0.95 and rows["mixed"] == 0.875


def test_narrowing(spark):
    df = spark.createDataFrame([(1, 127, 40000, 1.5, None), (-5, 0, 1, 1e300, None)],
                               "a long, b long, c int, d double, e int")
    narrowed, report = p.narrow_types(df)
    assert dict(narrowed.dtypes) == {"a": "tinyint", "b": "smallint", "c": "int", "d": "double", "e": "int"}
    assert report.count() == 5


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x), "k") for x in range(11)], "x double, t string")
    bins = {r["bin"]: r["n"] for r in histogram(df, ["x"]).collect()}
    assert bins == {**{i: 1 for i in range(9)}, 9: 2}
    assert histogram(df.limit(0), ["x", "t"]).count() == 0
    flat = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert [(r["bin"], r["n"]) for r in histogram(flat, ["x"]).collect()] == [(5, 4)]


def test_shares_add_up(rows):
    assert abs(share_of_total(rows, "label").agg(F.sum("percent")).first()[0] - 100) < 1e-9


@pytest.mark.parametrize("max_rows", [100, 0])
def test_codes(spark, max_rows):
    df = spark.createDataFrame([("b", "x"), ("b", "y"), ("a", None), ("c", "y"), ("c", "x")], "p string, q string")
    codes = f.value_codes([df], ["p", "q"], by="frequency")
    rows = {(r["column_name"], r["value"]): r["code"] for r in codes.collect()}
    assert rows == {("p", "b"): 0, ("p", "c"): 1, ("p", "a"): 2, ("q", "x"): 0, ("q", "y"): 1}
    coded = f.index_values(df, codes, ["p", "q"], max_rows=max_rows).where("p = 'a'").first()
    assert (coded.p_index, coded.q_index) == (2, None)
    texts = f.value_codes([df, spark.createDataFrame([("z", "a")], "p string, q string")], ["q"], null_text="nan")
    assert [(r.value, r.code) for r in texts.orderBy("code").collect()] == [("a", 0), ("nan", 1), ("x", 2), ("y", 3)]


def test_wide_column_gets_a_table_index(spark):
    """A million values, saved and reloaded; null and unseen values; both join forms."""
    rows = spark.range(1_000_000).select(F.concat(F.lit("v"), F.col("id")).alias("wide"), (F.col("id") % 3).cast("string").alias("narrow"))
    rows = rows.unionByName(rows.limit(1)).coalesce(8)
    assert f.wide_columns(rows, ["wide", "narrow"]) == ["wide"]
    model = f.feature_stages(["wide", "narrow"], [], [], wide=["wide"]).getStages()[1]
    model = model.fit(rows)
    path = work_folder(spark, "model")
    PipelineModel([model]).save(path)
    again = PipelineModel.load(path).stages[0]
    asked = spark.createDataFrame([("v0",), ("v1",), ("v10",), ("nowhere",), (None,)], "wide string")
    for one in (model.transform(asked), again.transform(asked), again._transform(asked, max_rows=10)):
        assert {r["wide"]: r["wide_index"] for r in one.collect()} == {"v0": 0, "v1": 1, "v10": 2, "nowhere": 1e6, None: 1e6}
    assert again.transform(rows).agg(F.count_distinct("wide_index")).first()[0] == 1_000_000


def test_hash_spreads_and_repeats(spark):
    from cartflow.functions.numeric import HASH_PRIME, hash_number

    keys = spark.range(20000).select(hash_number("id", 1).alias("a"), hash_number("id", 2).alias("b"),
                                     hash_number(F.col("id") * 10 ** 12 - 7, 1).alias("c"))
    row = keys.agg(*[F.count_distinct(c).alias(c) for c in "abc"], F.min("a").alias("lo"), F.max("a").alias("hi"),
                   F.corr("a", "b").alias("corr"), F.avg("c").alias("mean")).first()
    assert row.a == row.b == 20000 and row.c > 19990
    assert 0 <= row.lo < row.hi < HASH_PRIME
    assert abs(row["corr"]) < 0.03 and abs(row["mean"] / HASH_PRIME - 0.5) < 0.02
