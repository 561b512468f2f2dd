"""Readers, writers, the incremental load and whole jobs."""

import json
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemart.operators.quality import Check, CheckedWriter, future_messages, run_checks
from tidemart.plans import jobs, marts, reports, staging
from tidemart.sources import readers, writers
from tidemart.sources.writers import TableFolder
from tidemart.streaming.landing import load_new_files


def land(folder, day, channel, messages):
    os.makedirs(f"{folder}/{day}", exist_ok=True)
    with open(f"{folder}/{day}/{channel}.json", "w") as f:
        json.dump(messages, f, indent=2)


def message(i, text, channel="https://t.me/pharm", date="2024-01-05T10:00:00", **more):
    return {"message_id": i, "channel_name": channel, "message_date": date, "message_text": text, "views": 10 * i, "forwards": 1, "has_media": False, "image_path": None, **more}


@pytest.fixture
def landing(folder):
    path = f"{folder}/landing"
    land(path, "2024-01-05", "pharm", [message(1, "first"), message(2, "two paracetamol tablets"), message(1, "again")])
    land(path, "2024-01-06", "cosm", [message(3, "", "cosm"), message(4, "cream Cream 5", "cosm", image_path="x/4.jpg"), {"message_id": 2, "channel_name": "cosm"}])
    with open(f"{path}/2024-01-06/notes.txt", "w") as f:
        f.write("not json")
    return path


def test_landing_load_first_wins_and_is_idempotent(spark, folder, landing):
    raw = readers.read_landing(spark, landing)
    assert raw.count() == 6
    assert readers.read_landing(spark, landing, "2024-01-05").count() == 3
    target = TableFolder(spark, f"{folder}/raw", jobs.RAW_SCHEMA)
    for _ in range(2):
        jobs.load_landing(spark, landing, target)
        rows = {r["message_id"]: r for r in target.read().collect()}
        assert target.read().count() == 4
    assert rows[1]["message_text"] == "first" and rows[1]["channel_name"] == "pharm" and rows[1]["view_count"] == 10
    assert rows[2]["message_text"] == "two paracetamol tablets"
    two = TableFolder(spark, f"{folder}/raw2", jobs.RAW_SCHEMA)
    jobs.load_landing(spark, landing, two, ("channel_name", "message_id"))
    assert two.read().count() == 5


def test_null_primary_key_is_rejected(spark, folder):
    target = TableFolder(spark, f"{folder}/t", "k long, v string")
    with pytest.raises(PySparkException):
        writers.insert_if_absent(target, spark.createDataFrame([(None, "x")], "k long, v string"), ["k"])


def test_stream_takes_only_new_files(spark, folder, landing):
    target = TableFolder(spark, f"{folder}/raw", jobs.RAW_SCHEMA)
    load_new_files(spark, landing, target, f"{folder}/check")
    assert target.read().count() == 4
    land(landing, "2024-01-07", "pharm", [message(1, "changed"), message(9, "nine")])
    load_new_files(spark, landing, target, f"{folder}/check")
    rows = {r["message_id"]: r["message_text"] for r in target.read().collect()}
    assert len(rows) == 5 and rows[1] == "first" and rows[9] == "nine"


def test_upsert(spark, folder):
    schema = "orig_review_id string, review_text string, rating int"
    target = TableFolder(spark, f"{folder}/reviews", schema)
    rows = lambda *r: spark.createDataFrame([(*x, i) for i, x in enumerate(r)], schema + ", seq int")
    assert writers.upsert(target, rows(("a", "one", 1), ("b", "two", 2), (None, "n1", 3), ("a", "three", 4)), "orig_review_id", ["seq"]) == 4
    before = target.read()
    writers.upsert(target, rows(("b", "four", 5), (None, "n1", 3)), "orig_review_id", ["seq"])
    assert sorted((r["orig_review_id"] or "", r["review_text"]) for r in target.read().collect()) == [("", "n1"), ("", "n1"), ("a", "three"), ("b", "four")]
    assert before.count() == 3


def test_review_store(spark, folder):
    banks = TableFolder(spark, f"{folder}/banks", "bank_id long, bank_name string")
    names = spark.createDataFrame([("B",), ("A",), ("",), (None,), ("A",)], "bank_name string")
    assert [tuple(r) for r in writers.register_banks(banks, names).orderBy("bank_id").collect()] == [(1, "A"), (2, "B")]
    table = writers.register_banks(banks, spark.createDataFrame([("C",), ("A",)], "bank_name string"))
    assert {r["bank_name"]: r["bank_id"] for r in table.collect()} == {"A": 1, "B": 2, "C": 3}
    df = spark.createDataFrame([("x", "A", "bad date", 5), (None, "Z", "2024-02-03", None)], "review_id string, bank_name string, review_date string, rating int")
    got = {r["orig_review_id"]: r for r in writers.shape_reviews(df, table).collect()}
    assert got["x"]["bank_id"] == 1 and got["x"]["review_date"] is None and got[None]["bank_id"] is None and str(got[None]["review_date"]) == "2024-02-03"
    raw = spark.createDataFrame([("r1", None, "B1"), (None, 4, "B2")], "reviewId string, score int, bank_code string")
    shaped = {r["bank_code"]: r for r in readers.normalise_reviews(raw, spark.createDataFrame([("B1", "Bank One")], "bank_code string, bank_name string")).collect()}
    assert shaped["B1"]["rating"] == 0 and shaped["B1"]["bank_name"] == "Bank One" and shaped["B2"]["review_id"] == "" and shaped["B2"]["app_id"] == "N/A" and shaped["B2"]["bank_name"] is None


def test_files(spark, folder):
    df = spark.createDataFrame([(1, 'say "hi"\nthere', 2.5), (2, None, None)], "id int, t string, x double")
    writers.write_csv(df, f"{folder}/a/b/out")
    assert sorted(map(tuple, readers.read_csv(spark, f"{folder}/a/b/out", df.schema, multi_line=True).collect())) == sorted(map(tuple, df.collect()))
    assert readers.read_csv(spark, f"{folder}/absent") is None
    writers.write_metrics(spark, {"f1": 0.5, "n": {"a": 1}}, f"{folder}/m")
    assert json.loads(spark.read.text(f"{folder}/m").first()[0]) == {"f1": 0.5, "n": {"a": 1}}
    quoted = spark.createDataFrame([(1, "it's", None, True)], "id int, t string, x double, b boolean")
    assert writers.insert_statements(quoted, "tab").first()[0] == "INSERT INTO tab VALUES (1, 'it''s', NULL, 'true');"
    writers.export_statements({"tab": quoted}, f"{folder}/sql")
    assert spark.read.text(f"{folder}/sql/tab.sql").count() == 1
    landing = df.select(F.lit("2024-01-01").alias("scrape_date"), F.lit("c").alias("channel_name"), F.col("id").alias("message_id"))
    assert writers.write_landing(landing, f"{folder}/land", dry_run=True).count() == 2 and not os.path.exists(f"{folder}/land")
    writers.write_landing(landing, f"{folder}/land")
    assert os.path.exists(f"{folder}/land/scrape_date=2024-01-01/channel_name=c")
    writers.create_view(df, "some_view")
    assert readers.read_table(spark, "some_view").count() == 2 and readers.table_exists(spark, "some_view") and not readers.table_exists(spark, f"{folder}/none")
    merged = readers.union_all([df, df.select("id")])
    assert merged.count() == 4 and merged.filter("t is null").count() == 3
    prepared = readers.read_preferred(spark, f"{folder}/absent", f"{folder}/a/b/out", lambda d, side: d.withColumn("side", F.lit(side is None)), f"{folder}/none", df.schema)
    assert prepared.filter("side").count() == 2


def test_images(spark, folder):
    for name in ("chan/12.JPG", "chan/13.png", "chan/readme.txt", "other/x_1.jpeg"):
        os.makedirs(os.path.dirname(f"{folder}/img/{name}"), exist_ok=True)
        with open(f"{folder}/img/{name}", "w") as f:
            f.write("bytes")
    got = {(r["channel_name"], r["message_id"]) for r in readers.list_images(spark, f"{folder}/img").collect()}
    assert got == {("chan", "12"), ("chan", "13"), ("other", "x_1")}


def test_daily_batch(spark, folder, landing):
    found = spark.createDataFrame(
        [("pharm", "1", "person", 0.9), ("pharm", "1", "bottle", 0.8), ("cosm", "4", "container", 0.7), ("cosm", "img", "cat", 0.5)],
        readers.DETECTION_SCHEMA.replace(", image_category string", ""),
    )
    checks = {(r["check"], r["model"], r["column"]): r["failures"] for r in jobs.daily_batch(spark, landing, f"{folder}/wh", found).collect()}
    assert checks[("unique", "fct_messages", "message_id")] == 0 and checks[("not_null", "fct_image_detections", "message_id")] == 1
    assert sum(checks.values()) == 1
    facts = spark.read.parquet(f"{folder}/wh/fct_image_detections/v1")
    assert {r["image_category"] for r in facts.filter("message_id = 1").collect()} == {"promotional"}
    terms = reports.top_terms(spark.read.parquet(f"{folder}/wh/fct_messages/v1"), 3).collect()
    assert len(terms) == 3 and tuple(terms[0]) == ("cream", 2)
    again = jobs.daily_batch(spark, landing, f"{folder}/wh", None)
    assert again.filter("not passed").count() == 0 and spark.read.parquet(f"{folder}/wh/fct_messages/v2").count() == 3


def test_channel_with_two_types_fans_out_and_is_reported(spark):
    rows = [(1, "c", "x", "t", "2024-01-01", 1, 1, None), (2, "c", "y", "t", "2024-01-02", 1, 1, "")]
    raw = spark.createDataFrame(rows, "message_id long, channel_name string, channel_type string, message_text string, post_date string, view_count int, forward_count int, image_url string")
    stg = staging.staging_messages(raw)
    channels, dates, fct = marts.star(stg)
    assert fct.count() == 4 and [r["channel_key"] for r in channels.orderBy("channel_type").collect()] == [1, 2]
    result = run_checks({"f": fct}, [Check("unique", "f", "message_id")]).first()
    assert result["failures"] == 2 and not result["passed"]
    assert reports.channel_activity(channels, "absent").count() == 0
    assert future_messages(fct, dates, "2023-01-01").count() == 0 and future_messages(fct, dates, "2024-01-01").count() == 2
    assert reports.visual_content_by_image(marts.image_categories(spark.createDataFrame([("c", "1", "dog")], "channel_name string, message_id string, detected_class string"))).first()["other_count"] == 1
    with pytest.raises(PySparkException):
        staging.staging_messages(raw.withColumn("post_date", F.lit("no date"))).collect()


def test_review_file_and_chunk_index(spark, folder):
    rows = [(str(i), f"text {i}  is fine", 1 + i % 5, "2024-01-02", None, None, None, f"b{i % 2}", f"Bank {i % 2}", None, "s") for i in range(20)]
    writers.write_csv(spark.createDataFrame(rows, readers.REVIEW_SCHEMA), f"{folder}/in")
    report = jobs.clean_review_file(spark, f"{folder}/in", f"{folder}/out")
    assert report["summary"].first()["tier"] == "EXCELLENT" and report["ratings"].count() == 5
    assert readers.read_csv(spark, f"{folder}/out").count() == 20
    assert jobs.clean_review_file(spark, f"{folder}/none", f"{folder}/out") is False
    docs = spark.createDataFrame([(i, f"p{i % 3}" if i else None, "word " * 200) for i in range(60)], "id long, product string, txt string")
    out = jobs.index_chunks(docs, "id", "txt", "product", f"{folder}/col", lambda c: F.array(F.length(c).cast("float")), 30)
    assert {r["product"] for r in out.select("product").distinct().collect()} == {"p0", "p1", "p2"}
    assert out.select("complaint_id").distinct().count() == 30 and "embedding" in out.columns
    assert readers.read_embeddings(spark, f"{folder}/col", "chunk_id", "embedding", ["text"]).columns == ["chunk_id", "text", "embedding"]


def test_checks_while_writing_are_those_of_run_checks(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    child = spark.createDataFrame([(1, 1, 5), (2, 9, -1), (3, None, None), (4, 9, 2), (4, 2, -3), (None, 8, 1)], "id long, k long, views int").repartition(3)
    checks = [
        Check("unique", "parent", "k"), Check("not_null", "parent", "k"), Check("unique", "child", "id"), Check("not_null", "child", "id"), Check("not_null", "child", "k"),
        Check("relationship", "child", "k", "parent", "k"), Check("relationship", "child", "id", "parent", "k"), Check("condition", "child", "views", failing=F.col("views") < 0, name="negative"),
    ]
    want = {
        ("unique", "parent", "k", 1, False), ("not_null", "parent", "k", 1, False), ("unique", "child", "id", 1, False), ("not_null", "child", "id", 1, False), ("not_null", "child", "k", 1, False),
        ("relationship", "child", "k", 3, False), ("relationship", "child", "id", 3, False), ("negative", "child", "views", 2, False),
    }
    assert set(map(tuple, run_checks({"parent": parent, "child": child}, checks).collect())) == want
    writer = CheckedWriter(checks)
    assert writer.write("parent", parent).count() == 4 and writer.write("child", child).count() == 6
    assert set(map(tuple, writer.results().collect())) == want
    empty = CheckedWriter(checks)
    empty.write("parent", parent.limit(0))
    empty.write("child", child.limit(0))
    assert {(row["failures"], row["passed"]) for row in empty.results().collect()} == {(0, True)}


def test_reviews_are_not_shuffled_by_their_few_codes(spark):
    raw = spark.range(100).select(F.col("id").cast("string").alias("reviewId"), F.when(F.col("id") % 2 == 0, "en").otherwise("fr").alias("bank_code"))
    out = readers.normalise_reviews(raw, spark.createDataFrame([("en", "English")], "bank_code string, bank_name string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
    assert [r["bank_name"] for r in out.collect()].count("English") == 50
