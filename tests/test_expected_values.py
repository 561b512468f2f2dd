"""Small frames with exact expected values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemart.functions import dates, numeric, text
from tidemart.operators import cleaning, features, profile
from tidemart.operators.tabular import select_features


def test_bad_date_is_null(spark):
    df = spark.createDataFrame([("2023-01-01",), ("invalid",)], "date string")
    rows = [r["date"] for r in cleaning.convert_to_datetime(df, "date").collect()]
    assert rows == [dt.datetime(2023, 1, 1), None]


def test_missing_drop_and_mean(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "col1 double")
    assert cleaning.handle_missing(df, "drop").count() == 2
    assert sorted(r["col1"] for r in cleaning.handle_missing(df, "fill_mean").collect()) == [1.0, 2.0, 3.0]
    assert cleaning.handle_missing(df, "something else").count() == 3


def test_duplicates(spark):
    df = spark.createDataFrame([(1, 3), (1, 3), (2, 4)], "col1 int, col2 int")
    assert cleaning.drop_duplicates(df).count() == 2
    assert profile.duplicate_rows(df).first()["duplicates"] == 1


def test_transaction_parts(spark):
    df = spark.createDataFrame([("2023-01-01 10:00:00",), ("2023-01-02 11:00:00",)], "TransactionStartTime string")
    rows = features.add_transaction_parts(df).orderBy("TransactionStartTime").collect()
    assert rows[0]["transaction_hour"] == 10 and rows[1]["transaction_day"] == 2
    assert (rows[0]["transaction_month"], rows[0]["transaction_year"]) == (1, 2023)


def test_customer_aggregates(spark):
    df = spark.createDataFrame([("C1", 100), ("C1", 200), ("C2", 50)], "CustomerId string, Amount int")
    rows = {(r["CustomerId"], r["Amount"]): r for r in features.CustomerAggregates().fit(df).transform(df).collect()}
    one = rows[("C1", 100)]
    assert (one["total_amount"], one["txn_count"], one["avg_amount"]) == (300, 2, 150)
    two = rows[("C2", 50)]
    assert (two["total_amount"], two["txn_count"]) == (50, 1)


def test_text_functions(spark):
    df = spark.createDataFrame([("a  b\t\n c  ",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(text.collapse_whitespace(F.col("t"))).collect()] == ["a b c", "", ""]
    row = spark.range(1).select(
        text.slugify(F.lit("  Rating / by Bank! ")).alias("slug"), text.slugify(F.lit("!!")).alias("none"), text.safe_file_name(F.lit("café a/b.c-d")).alias("safe"),
        text.shorten(F.lit("x" * 41)).alias("long"), text.shorten(F.lit("a\nb")).alias("short"), text.file_stem(F.lit("/a/b.c/12.34.JPG")).alias("stem"),
        text.last_path_part(F.lit("https://t.me/chan")).alias("last"),
    ).first()
    assert row["slug"] == "rating_by_bank" and row["none"] == "figure" and row["safe"] == "café_a_b.c-d"
    assert row["long"] == "x" * 37 + "..." and row["short"] == "a b" and row["stem"] == "12.34" and row["last"] == "chan"


def test_headline_features(spark):
    row = spark.range(1).select(*[c.alias(n) for n, c in text.headline_features(F.lit("BUY NOW!  OK?")).items()]).first()
    assert row.asDict() == {"headline_length": 13, "word_count": 3, "has_exclamation": 1, "has_question": 1, "is_uppercase": 1}
    digits = spark.range(1).select(text.headline_features(F.lit("123"))["is_uppercase"]).first()[0]
    assert digits == 0


def test_labels_and_numbers(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0,)], "s double")
    labels = [tuple(r) for r in df.select(text.sentiment_label(F.col("s")), text.sentiment_label(F.col("s"), strict=True)).collect()]
    assert labels == [("positive", "neutral"), ("negative", "neutral"), ("neutral", "neutral")]
    n = spark.createDataFrame([("-1",), ("x",), ("NaN",), ("0",)], "v string").select(numeric.log1p_number(F.col("v"))).collect()
    assert [r[0] for r in n] == [None, None, None, 0.0]


def test_calendar(spark):
    row = spark.range(1).select(*[c.alias(n) for n, c in dates.calendar_parts(F.lit("2024-01-07").cast("date"), pad_names=True).items()]).first()
    assert row["day_of_week"] == 0 and row["is_weekend"] and row["day_name"] == "Sunday   " and row["week_of_year"] == 1 and row["month_name"] == "January  "


def test_review_cleaning_edges(spark):
    rows = [
        ("1", " good   app ", 5, "2024-01-02", None, None, None, "B", "Bank"),
        ("2", "   ", 4, "2024-01-01", "u", 1, "r", "A", "Bank"),
        ("3", None, 4, "2024-01-01", "u", 1, "r", "A", "Bank"),
        ("4", "bad", 0, "2024-01-01", "u", 1, "r", "A", "Bank"),
        ("5", "bad", 6, "2024-01-01", "u", 1, "r", "A", "Bank"),
        ("6", "fine", 3, "not a date", "u", 1, "r", "A", "Bank"),
        ("7", "null rating", None, "2024-01-01", "u", 1, "r", "A", "Bank"),
    ]
    df = spark.createDataFrame(rows, "review_id string, review_text string, rating int, review_date string, user_name string, thumbs_up int, reply_content string, bank_code string, bank_name string")
    clean = cleaning.clean_reviews(df).collect()
    assert [r["review_id"] for r in clean] == ["6", "1"]
    assert clean[1]["review_text"] == "good app" and clean[1]["user_name"] == "Anonymous" and clean[1]["thumbs_up"] == 0 and clean[1]["text_length"] == 8
    stats = cleaning.review_statistics(df, cleaning.ReviewColumns()).first()
    assert stats.asDict() == {"original_count": 7, "rows_removed_missing": 2, "empty_reviews_removed": 1, "invalid_ratings_removed": 2, "final_count": 2, "bad_dates": 1}
    kept = cleaning.keep_valid_ratings(df, cleaning.ReviewColumns(), keep_null=True)
    assert kept.count() == 5
    empty = df.filter("false")
    report = cleaning.quality_report(cleaning.clean_reviews(empty), cleaning.review_statistics(empty, cleaning.ReviewColumns()))["summary"].first()
    assert report["retention_rate"] is None and report["tier"] is None


def test_profiles_of_edges(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, None)], "k int, n int, s string")
    assert {r["column"] for r in profile.constant_columns(df).collect()} == {"k", "n"}
    missing = {r["column"]: r for r in profile.missingness(df).collect()}
    assert missing["n"]["missing_pct"] == 100.0 and missing["s"]["non_null"] == 1
    assert profile.coverage(df, "absent").first()["coverage"] == 0.0
    assert profile.coverage(df.filter("false"), "k").first()["coverage"] == 0.0
    assert profile.class_balance(df, ["absent"]) is None
    lists = spark.createDataFrame([("g", ["x", "y", "x"]), ("g", None), (None, ["x"])], "g string, v array<string>")
    assert {tuple(r) for r in profile.counts_by_group(lists, "g", "v").collect()} == {("g", "x", 2), ("g", "y", 1)}
    assert profile.counts_by_group(lists, "g", "absent").columns == ["g", "absent", "count"]
    assert [tuple(r) for r in profile.dtypes(df, 2).collect()] == [("k", "int"), ("n", "int")]
    assert select_features(df, ["k", "z"], ["s", "y"]) == (["k"], ["s"])


def test_outliers_of_null_and_constant(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (1.0,), (50.0,), (None,)], "v double")
    flags = {r["v"]: r["is_outlier"] for r in cleaning.flag_outliers(df, "v").collect()}
    assert flags[1.0] is False and flags[None] is False and flags[50.0] is True


def test_unknown_strategy_of_running(spark):
    from tidemart.operators.order import running

    with pytest.raises(ValueError):
        running(spark.range(3), [], ["id"], {"x": ("median", F.col("id"))})
