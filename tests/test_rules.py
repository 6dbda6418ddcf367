"""Null and value rules, on small literal tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartflow.functions.numeric import natural_log, thousandths
from cartflow.functions.text import (DEVICE_MAKERS, email_provider, email_suffix, first_match,
                                     last_piece, piece)
from cartflow.functions.time import day_from_text, weekday_monday_first_text, weekday_sunday_first
from cartflow.operators.columns import dash_to_underscore, rare_to_others
from cartflow.operators.dedup import TARGET_KEY, keep_first
from cartflow.operators.labels import active_users_only, label_by_join, label_by_max
from cartflow.plans.training import FIRST, training_table, training_table_by_join
from cartflow.schemas import EVENTS_WITH_ID


def one(df):
    return df.first()[0]


def values(df):
    return [r[0] for r in df.collect()]


def event(i, kind, product=1, user=1, session="s", price=10.0, code="a.b.c", brand="x", minute=None):
    return (i, dt.datetime(2019, 10, 1, 0, minute if minute is not None else i), kind, product,
            2053013555631882655, code, brand, price, user, session)


def events(spark, *rows):
    return spark.createDataFrame(list(rows), EVENTS_WITH_ID)


def test_split_on_a_literal_dot_and_missing_pieces(spark):
    df = spark.createDataFrame([("a.b.c",), ("a.b",), ("a",), (None,)], "c string")
    rows = df.select(*[piece("c", ".", i) for i in range(3)]).collect()
    assert [tuple(r) for r in rows] == [("a", "b", "c"), ("a", "b", None), ("a", None, None), (None,) * 3]
    assert values(df.select(last_piece("c", "."))) == ["c", "b", "a", None]


def test_weekday_conventions(spark):
    df = spark.createDataFrame([(dt.datetime(2019, 10, 1),)], "t timestamp_ntz")
    assert tuple(df.select(weekday_sunday_first("t"), weekday_monday_first_text("t"),
                           day_from_text(F.col("t"))).first()) == (3, "1", dt.date(2019, 10, 1))


def test_amounts(spark):
    df = spark.createDataFrame([(0.0,), (29.99,), (68.5,)], "x double")
    assert values(df.select(natural_log("x")))[0] is None
    assert values(df.select(thousandths(F.col("x")))) == [0, 989, 500]


def test_email_columns(spark):
    df = spark.createDataFrame([("gmail.com",), ("scranton.edu",), ("nowhere.org",), ("gmail",), (None,)], "c string")
    assert values(df.select(email_provider(F.col("c")))) == ["google", "other", None, "google", None]
    assert values(df.select(email_suffix(F.col("c")))) == ["com", "us", "org", "us", None]


@pytest.mark.parametrize("text, maker", [
    ("SM-J700M Build/MMB29K", "Samsung"), ("SAMSUNG SM-G892A", "Samsung"), ("Moto G (4)", "Motorola"),
    ("moto x", "Motorola"), ("LG-D320", "LG"), ("rv:57.0", "RV"), ("ALE-L23", "Huawei"),
    ("KNT-L29", "Huawei"), ("Blade A6", "ZTE"), ("XT1635-02", "Sony"), ("Windows", "Windows"), (None, None)])
def test_device_maker(spark, text, maker):
    df = spark.createDataFrame([(text,)], "c string")
    assert one(df.select(first_match(F.col("c"), DEVICE_MAKERS))) == maker


def test_rare_values_become_others_and_nulls_stay(spark):
    rows = [("a",)] * 5 + [("b",)] * 2 + [(None,)] * 1
    got = values(rare_to_others(spark.createDataFrame(rows, "c string"), "c", below=3))
    assert sorted(got, key=str) == sorted(["a"] * 5 + ["Others"] * 2 + [None], key=str)


def test_rename_by_rule(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`id-01` int, `id_02` int, other int")
    assert dash_to_underscore(df).columns == ["id_01", "id_02", "other"]


def test_keep_first_is_by_time_then_id_and_idempotent(spark):
    df = events(spark, event(3, "cart", minute=5), event(2, "cart", minute=5), event(1, "cart", minute=9))
    once = keep_first(df, TARGET_KEY, FIRST)
    assert [r.event_id for r in once.collect()] == [2]
    assert keep_first(once, TARGET_KEY, FIRST).collect() == once.collect()


def test_label_forms(spark):
    df = events(spark, event(1, "cart"), event(2, "purchase"), event(3, "purchase", price=11.0),
                event(4, "cart", product=2))
    by_join = label_by_join(df).select("event_id", "is_purchased").collect()
    assert sorted(map(tuple, by_join)) == [(1, 1), (1, 1), (4, 0)]
    by_max = label_by_max(df).where("event_type = 'cart'").select("event_id", "is_purchased").collect()
    assert sorted(map(tuple, by_max)) == [(1, 1), (4, 0)]


def test_label_ignores_time_order(spark):
    df = events(spark, event(1, "purchase"), event(2, "cart"))
    assert [r.is_purchased for r in training_table(df).collect()] == [1]


def test_active_users(spark):
    df = events(spark, event(1, "view", user=1), event(2, "cart", user=1), event(3, "view", user=2))
    assert sorted(values(active_users_only(df).select("event_id"))) == [1, 2]


def test_training_row(spark):
    df = events(spark, event(1, "view"), event(2, "cart", code=None, brand=None),
                event(3, "cart", code=None, brand=None), event(4, "view", user=9), event(5, "cart", product=2))
    rows = {r.event_id: r for r in training_table(df, keep=["event_id"]).collect()}
    assert set(rows) == {2, 5}
    row = rows[2]
    assert (row.category_id_id1, row.category_id_id2, row.category_id_id3) == ("205301", "355563", "1882655")
    assert row.category_code_level1_f == row.brand_f == "205301"
    # User 9 never carted, so that view in the same session is not activity.
    assert row.activity_count == 4
    assert rows[5].category_code_level3_f == rows[5].category_code_level2_f == "b"


def test_training_by_join_needs_brand_and_code(spark):
    df = events(spark, event(1, "cart"), event(2, "cart", product=2, brand=None), event(3, "view"))
    rows = training_table_by_join(df).collect()
    assert [(r.event_id, r.activity_count, r.category_code_level4) for r in rows] == [(1, 2, "c")]
