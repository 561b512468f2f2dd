"""Cleaning, profiling, sampling and chart data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.base import query, table
from tidemart.functions import dates, numeric, text
from tidemart.operators import charts, cleaning, order, profile

SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"

REVIEWS_SQL = r"""
rev AS (
  SELECT 'r' || doc_id AS review_id,
    CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN chr(160) || '  ' || chr(9) ELSE ' ' || text || chr(160) END AS review_text,
    CASE WHEN doc_id % 13 = 0 THEN NULL ELSE CAST(doc_id % 7 AS INTEGER) END AS rating,
    CASE doc_id % 4 WHEN 0 THEN strftime(DATE '2023-01-01' + CAST(doc_id % 500 AS INTEGER), '%Y-%m-%d')
      WHEN 1 THEN strftime(DATE '2023-01-01' + CAST(doc_id % 500 AS INTEGER), '%d/%m/%Y')
      WHEN 2 THEN strftime(DATE '2023-01-01' + CAST(doc_id % 500 AS INTEGER), '%Y-%m-%d') || ' 10:11:12' ELSE 'soon' END AS review_date,
    CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'u' || doc_id % 50 END AS user_name,
    CASE WHEN doc_id % 3 = 0 THEN NULL ELSE CAST(doc_id % 9 AS INTEGER) END AS thumbs_up,
    source AS bank_code, lang AS bank_name, 'Google Play' AS source
  FROM documents),
kept AS (SELECT * FROM rev WHERE review_text IS NOT NULL AND rating IS NOT NULL AND bank_name IS NOT NULL),
clean AS (
  SELECT review_id, trim(regexp_replace(review_text, '""" + SPACES + r"""', ' ', 'g')) AS review_text, rating,
    CAST(coalesce(try_strptime(review_date, '%Y-%m-%d %H:%M:%S'), try_strptime(review_date, '%Y-%m-%d'), try_strptime(review_date, '%d/%m/%Y')) AS DATE) AS review_date,
    bank_code, bank_name, coalesce(user_name, 'Anonymous') AS user_name, coalesce(thumbs_up, 0) AS thumbs_up, source
  FROM kept),
final AS (SELECT *, length(review_text) AS text_length FROM clean WHERE review_text <> '' AND rating BETWEEN 1 AND 5)"""


def reviews(spark, sf) -> DataFrame:
    d = F.col("doc_id")
    day = F.date_add(F.lit("2023-01-01").cast("date"), (d % 500).cast("int"))
    nbsp = F.lit(" ")
    return table(spark, sf, "documents").select(
        F.concat(F.lit("r"), d).alias("review_id"),
        F.when(d % 17 == 0, None).when(d % 19 == 0, F.lit("   \t")).otherwise(F.concat(F.lit(" "), "text", nbsp)).alias("review_text"),
        F.when(d % 13 != 0, (d % 7).cast("int")).alias("rating"),
        F.when(d % 4 == 0, F.date_format(day, "yyyy-MM-dd")).when(d % 4 == 1, F.date_format(day, "dd/MM/yyyy"))
        .when(d % 4 == 2, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 10:11:12"))).otherwise("soon").alias("review_date"),
        F.when(d % 5 != 0, F.concat(F.lit("u"), d % 50)).alias("user_name"),
        F.when(d % 3 != 0, (d % 9).cast("int")).alias("thumbs_up"),
        F.col("source").alias("bank_code"), F.col("lang").alias("bank_name"), F.lit("Google Play").alias("source"),
    )


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("bigint") for c in names})


@query("FLT8 FLT9 FLT10 FLT13 SCL1 SCL12 TOP1 PIPE2", f"""WITH {REVIEWS_SQL}
SELECT review_id, review_text, CAST(rating AS BIGINT) AS rating, review_date, CAST(year(review_date) AS BIGINT) AS review_year,
  CAST(month(review_date) AS BIGINT) AS review_month, bank_code, bank_name, user_name, CAST(thumbs_up AS BIGINT) AS thumbs_up,
  CAST(text_length AS BIGINT) AS text_length, source FROM final""")
def clean_reviews(spark, sf):
    return longs(cleaning.clean_reviews(reviews(spark, sf)), "rating", "review_year", "review_month", "thumbs_up", "text_length")


@query("FLT8 FLT10 SCL12 PIPE2", f"""WITH {REVIEWS_SQL}
SELECT (SELECT count(*) FROM rev) AS original_count, (SELECT count(*) FROM rev) - (SELECT count(*) FROM kept) AS rows_removed_missing,
  (SELECT count(*) FROM clean WHERE review_text = '') AS empty_reviews_removed,
  (SELECT count(*) FROM clean WHERE review_text <> '' AND rating NOT BETWEEN 1 AND 5) AS invalid_ratings_removed,
  (SELECT count(*) FROM final) AS final_count, (SELECT count(*) FROM rev WHERE review_date = 'soon') AS bad_dates""")
def review_statistics(spark, sf):
    return cleaning.review_statistics(reviews(spark, sf), cleaning.ReviewColumns())


@query("AGG22", f"""WITH {REVIEWS_SQL}, r AS (SELECT 100.0 * (SELECT count(*) FROM final) / (SELECT count(*) FROM rev) AS ret)
SELECT round(ret, 6) AS retention_rate, round(100 - ret, 6) AS error_rate,
  CASE WHEN 100 - ret < 5 THEN 'EXCELLENT' WHEN 100 - ret < 10 THEN 'GOOD' ELSE 'NEEDS ATTENTION' END AS tier,
  (SELECT min(review_date) FROM final) AS first_date, (SELECT max(review_date) FROM final) AS last_date,
  (SELECT round(avg(text_length), 6) FROM final) AS mean_length, (SELECT CAST(min(text_length) AS BIGINT) FROM final) AS min_length,
  (SELECT CAST(max(text_length) AS BIGINT) FROM final) AS max_length, (SELECT median(text_length) FROM final) AS median_length FROM r""")
def review_report(spark, sf):
    rev = reviews(spark, sf)
    out = cleaning.quality_report(cleaning.clean_reviews(rev), cleaning.review_statistics(rev, cleaning.ReviewColumns()))["summary"]
    out = out.withColumns({c: F.round(c, 6) for c in ("retention_rate", "error_rate", "mean_length")})
    return longs(out, "min_length", "max_length").select(
        "retention_rate", "error_rate", "tier", "first_date", "last_date", "mean_length", "min_length", "max_length", "median_length"
    )


@query("AGG22", f"""WITH {REVIEWS_SQL}
SELECT 'group' AS part, bank_name AS item, count(*) AS "count", CAST(NULL AS DOUBLE) AS pct FROM final GROUP BY bank_name
UNION ALL SELECT 'rating', CAST(rating AS VARCHAR), count(*), round(100.0 * count(*) / (SELECT count(*) FROM final), 6) FROM final GROUP BY rating""")
def review_distribution(spark, sf):
    rev = reviews(spark, sf)
    report = cleaning.quality_report(cleaning.clean_reviews(rev), cleaning.review_statistics(rev, cleaning.ReviewColumns()))
    groups = report["groups"].select(F.lit("group").alias("part"), F.col("bank_name").alias("item"), "count", F.lit(None).cast("double").alias("pct"))
    ratings = report["ratings"].select(F.lit("rating").alias("part"), F.col("rating").cast("string").alias("item"), "count", F.round("pct", 6).alias("pct"))
    return groups.unionByName(ratings)


@query("SCL11", f"""WITH {REVIEWS_SQL}
SELECT review_id, strftime(coalesce(try_strptime(review_date, '%Y-%m-%d %H:%M:%S'), try_strptime(review_date, '%Y-%m-%d'),
  try_strptime(review_date, '%d/%m/%Y')), '%Y-%m-%dT%H:%M:%S') AS parsed FROM rev""")
def lenient_dates(spark, sf):
    out = cleaning.convert_to_datetime(reviews(spark, sf), "review_date")
    return out.select("review_id", dates.iso_timestamp(F.col("review_date")).alias("parsed"))


@query("FLT11", """SELECT o_orderkey, o_custkey, o_totalprice, gap FROM (SELECT *, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS gap FROM orders) WHERE gap IS NOT NULL""")
def missing_dropped(spark, sf):
    return cleaning.handle_missing(_gaps(spark, sf), "drop", ["gap"]).select("o_orderkey", "o_custkey", "o_totalprice", "gap")


def _gaps(spark, sf):
    return table(spark, sf, "orders").withColumn("gap", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")))


@query("FLT11", """WITH g AS (SELECT *, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS gap FROM orders)
SELECT o_orderkey, round(coalesce(gap, (SELECT avg(gap) FROM g)), 4) AS filled FROM g""")
def missing_mean_filled(spark, sf):
    return cleaning.handle_missing(_gaps(spark, sf), "fill_mean", ["gap"]).select("o_orderkey", F.round("gap", 4).alias("filled"))


@query("FLT11 WIN9", """WITH g AS (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice END AS gap FROM orders)
SELECT o_orderkey, o_orderstatus,
  last_value(gap IGNORE NULLS) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS forward,
  first_value(gap IGNORE NULLS) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate, o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS backward
FROM g""")
def missing_filled_along_order(spark, sf):
    g = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderdate", F.when(F.col("o_orderkey") % 5 == 0, F.col("o_totalprice")).alias("gap")
    )
    keys, by = ["o_orderstatus"], ["o_orderdate", "o_orderkey"]
    forward = cleaning.handle_missing(g, "ffill", keys=keys, order=by).select("o_orderkey", "o_orderstatus", F.col("gap").alias("forward"))
    backward = cleaning.handle_missing(g, "bfill", keys=keys, order=by).select("o_orderkey", F.col("gap").alias("backward"))
    return forward.join(backward, "o_orderkey")


@query("FLT12", """SELECT lang, source, min(doc_id) AS doc_id FROM documents GROUP BY lang, source""")
def first_per_subset(spark, sf):
    d = table(spark, sf, "documents").select("lang", "source", "doc_id")
    return cleaning.drop_duplicates(d, ["lang", "source"], ["doc_id"])


@query("FLT12 SET3", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_rows(spark, sf):
    return cleaning.drop_duplicates(table(spark, sf, "orders").select("o_custkey", "o_orderstatus"))


@query("FLT15", """WITH b AS (SELECT quantile_cont(l_extendedprice * l_quantity, 0.25) AS q1, quantile_cont(l_extendedprice * l_quantity, 0.75) AS q3 FROM lineitem)
SELECT coalesce(x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1), FALSE) AS is_outlier, count(*) AS n, round(sum(x), 0) AS total
FROM (SELECT l_extendedprice * l_quantity AS x FROM lineitem), b GROUP BY 1""")
def iqr_outliers(spark, sf):
    x = table(spark, sf, "lineitem").select((F.col("l_extendedprice") * F.col("l_quantity")).alias("x"))
    return cleaning.flag_outliers(x, "x").groupBy("is_outlier").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("x"), 0).alias("total"))


@query("AGG12", """SELECT lang AS "group", w AS item, count(*) AS "count" FROM (SELECT lang, unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY 1, 2""")
def list_item_counts(spark, sf):
    d = table(spark, sf, "documents").select(F.col("lang").alias("group"), F.split("text", " ").alias("item"))
    return profile.counts_by_group(d, "group", "item")


@query("AGG12", """SELECT o_orderpriority, nullif(o_orderstatus, 'P') AS status, count(*) AS "count" FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2""")
def value_counts_by_group(spark, sf):
    o = table(spark, sf, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    return profile.counts_by_group(o, "o_orderpriority", "status")


@query("AGG13", """SELECT round(count(CASE WHEN o_orderkey % 5 <> 0 THEN 1 END)::DOUBLE / count(*), 6) AS coverage FROM orders""")
def column_coverage(spark, sf):
    return profile.coverage(_gaps(spark, sf), "gap").withColumn("coverage", F.round("coverage", 6))


@query("AGG14", f"""WITH {REVIEWS_SQL}, c AS (SELECT count(*) AS n FROM rev)
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{k}' AS dtype, round((n - (SELECT count({c}) FROM rev)) * 100.0 / n, 2) AS missing_pct, (SELECT count({c}) FROM rev) AS non_null FROM c"
    for c, k in (("review_id", "string"), ("review_text", "string"), ("rating", "int"), ("review_date", "string"), ("user_name", "string"),
                 ("thumbs_up", "int"), ("bank_code", "string"), ("bank_name", "string"), ("source", "string"))))
def missing_values(spark, sf):
    return profile.missingness(reviews(spark, sf))


@query("AGG15", """SELECT nullif(p_type, 'PROMO') AS kind, count(*) AS "count", round(count(*)::DOUBLE / (SELECT count(*) FROM part), 6) AS share
FROM part GROUP BY 1 ORDER BY 2 DESC, 1 NULLS LAST LIMIT 4""")
def top_values(spark, sf):
    p = table(spark, sf, "part").select(F.nullif("p_type", F.lit("PROMO")).alias("kind"))
    return profile.top_frequencies(p, "kind", 4).withColumn("share", F.round("share", 6))


@query("AGG16", """SELECT 'fixed' AS "column" UNION ALL SELECT 'nothing'""")
def constant_columns(spark, sf):
    o = table(spark, sf, "orders").withColumns({"fixed": F.lit(7), "nothing": F.lit(None).cast("int"), "holes": F.when(F.col("o_orderkey") > 5, 1)})
    return profile.constant_columns(o)


@query("AGG17", """SELECT 'o_custkey' AS "column", count(DISTINCT o_custkey) AS "unique", round(count(DISTINCT o_custkey)::DOUBLE / count(*), 6) AS unique_pct FROM orders
UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus), round(count(DISTINCT o_orderstatus)::DOUBLE / count(*), 6) FROM orders
UNION ALL SELECT 'gap', count(DISTINCT gap) + 1, round((count(DISTINCT gap) + 1)::DOUBLE / count(*), 6) FROM (SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS gap FROM orders)""")
def cardinality(spark, sf):
    out = profile.cardinality(_gaps(spark, sf), ["o_custkey", "o_orderstatus", "gap", "absent"])
    return out.withColumn("unique_pct", F.round("unique_pct", 6))


@query("AGG18 FLT17", """SELECT toxic, count(*) AS "count", round(count(*)::DOUBLE / (SELECT count(*) FROM labels), 6) AS share FROM labels GROUP BY 1""")
def class_balance(spark, sf):
    return profile.class_balance(table(spark, sf, "labels"), ["absent", "toxic", "quality"]).withColumn("share", F.round("share", 6))


@query("AGG18", """SELECT quality, count(*) AS "count", round(round(count(*)::DOUBLE / (SELECT count(*) FROM labels), 9) * 100, 3) AS pct FROM labels GROUP BY 1""")
def class_percentages(spark, sf):
    return profile.class_distribution(table(spark, sf, "labels"), "quality")


@query("AGG19", """SELECT CAST(sum(c - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS c FROM documents GROUP BY text, lang)""")
def duplicate_rows(spark, sf):
    return profile.duplicate_rows(table(spark, sf, "documents").select("text", "lang"))


NAN_SQL = "WITH v AS (SELECT l_returnflag, CASE WHEN l_linenumber <> 3 THEN l_quantity END AS x FROM lineitem)"


def quantities_with_nan(spark, sf):
    """Quantities with NaN where the line number is 3: missing values as pandas writes them."""
    x = F.when(F.col("l_linenumber") != 3, F.col("l_quantity").cast("double")).otherwise(F.lit(float("nan")))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_tax", x.alias("x"))


@query("AGG20", f"""{NAN_SQL} SELECT l_returnflag, 'x' AS "column", count(x) AS "count", round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS std, min(x)::DOUBLE AS "min",
max(x)::DOUBLE AS "max", round(quantile_cont(x, 0.5), 4) AS p50 FROM v GROUP BY l_returnflag""")
def description_with_nan(spark, sf):
    out = profile.describe_by_class(quantities_with_nan(spark, sf), "l_returnflag", ["x"], (0.5,))
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std", "p50")})


@query("AGG13", f"{NAN_SQL} SELECT count(x) / count(*)::DOUBLE AS coverage FROM v")
def coverage_with_nan(spark, sf):
    return profile.coverage(quantities_with_nan(spark, sf), "x")


@query("FLT11", f"{NAN_SQL} SELECT round(sum(coalesce(x, (SELECT avg(x) FROM v))), 2) AS total, count(*) AS n FROM v")
def mean_filled_nan(spark, sf):
    filled = cleaning.handle_missing(quantities_with_nan(spark, sf), "fill_mean", ["x"])
    return filled.agg(F.round(F.sum("x"), 2).alias("total"), F.count("x").alias("n"))


@query("AGG20", " UNION ALL ".join(
    f"""SELECT l_returnflag, '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS "min",
max({c})::DOUBLE AS "max", round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.9), 4) AS p90, round(quantile_cont({c}, 0.99), 4) AS p99
FROM lineitem GROUP BY l_returnflag""" for c in ("l_quantity", "l_extendedprice", "l_discount")))
def describe_by_class(spark, sf):
    out = profile.describe_by_class(table(spark, sf, "lineitem"), "l_returnflag", ["l_quantity", "l_extendedprice", "l_discount"], (0.9, 0.99))
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std", "p50", "p90", "p99")})


@query("VIZ1", """WITH v AS (SELECT l_extendedprice AS v FROM lineitem), e AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
c AS (SELECT least(floor((v - lo) / ((hi - lo) / 20)), 19) AS bin, count(*) AS n FROM v, e GROUP BY 1)
SELECT b AS bin, round(lo + (hi - lo) / 20 * b, 4) AS lower, round(lo + (hi - lo) / 20 * (b + 1), 4) AS upper, coalesce(n, 0) AS "count"
FROM range(20) r(b) CROSS JOIN e LEFT JOIN c ON c.bin = b""")
def price_histogram(spark, sf):
    return charts.histogram(table(spark, sf, "lineitem"), "l_extendedprice").withColumns({c: F.round(c, 4) for c in ("lower", "upper")})


@query("VIZ2", "SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean FROM orders GROUP BY 1")
def mean_price_by_priority(spark, sf):
    return charts.mean_by(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice").withColumn("mean", F.round("mean", 4))


@query("VIZ3", """SELECT event_type, count(*) AS "count", round(count(*)::DOUBLE / (SELECT count(*) FROM events), 6) AS share FROM events GROUP BY 1""")
def event_shares(spark, sf):
    return charts.shares(table(spark, sf, "events"), "event_type").withColumn("share", F.round("share", 6))


@query("VIZ4", """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
j AS (SELECT e.event_type, value, q1, median, q3, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM events e JOIN q USING (event_type))
SELECT event_type, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
  min(value) FILTER (inside) AS whisker_low, max(value) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers FROM j GROUP BY 1""")
def event_boxes(spark, sf):
    return charts.box_statistics(table(spark, sf, "events"), "value", "event_type").withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3")})


@query("VIZ5", """WITH s AS (SELECT l_returnflag AS cls, count(*) AS n, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi,
  stddev_samp(l_extendedprice) * pow(count(*), -0.2) AS bw FROM lineitem GROUP BY 1),
b AS (SELECT l_returnflag AS cls, least(floor((l_extendedprice - lo) / ((hi - lo) / 2048)), 2047) AS bin, count(*) AS c
  FROM lineitem JOIN s ON cls = l_returnflag GROUP BY 1, 2),
k AS (SELECT b.cls, p, lo - 3 * bw + (hi - lo + 6 * bw) * p / 199 AS x, lo, hi, bw, n, c, lo + (bin + 0.5) * ((hi - lo) / 2048) AS m FROM b JOIN s USING (cls) CROSS JOIN range(200) r(p))
SELECT cls AS l_returnflag, p AS point, round(max(x), 4) AS x, round(sum(c * exp(-(x - m) * (x - m) / (2 * bw * bw)) / sqrt(2 * pi()) / (n * bw)), 12) AS density FROM k GROUP BY 1, 2""")
def price_density(spark, sf):
    out = charts.density_by_class(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")
    return longs(out.withColumns({"x": F.round("x", 4), "density": F.round("density", 12)}), "point")


# Scores for the classification charts: the value of an event against whether it is a purchase.

SCORED_SQL = "scored AS (SELECT CAST(event_type = 'purchase' AS INTEGER) AS label, round(value / 5) AS score, CAST(value > 60 AS INTEGER) AS prediction FROM events)"


def scored(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        (F.col("event_type") == "purchase").cast("int").alias("label"),
        F.round(F.col("value") / 5).alias("score"),
        (F.col("value") > 60).cast("int").alias("prediction"),
    )


@query("VIZ6", f"""WITH {SCORED_SQL}, h AS (SELECT score, count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS n FROM scored GROUP BY 1)
SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL
SELECT score, round(sum(n) OVER (ORDER BY score DESC)::DOUBLE / (SELECT sum(n) FROM h), 9), round(sum(p) OVER (ORDER BY score DESC)::DOUBLE / (SELECT sum(p) FROM h), 9) FROM h""")
def roc_curve(spark, sf):
    return charts.roc_points(scored(spark, sf), "label", "score").withColumns({c: F.round(c, 9) for c in ("fpr", "tpr")})


@query("VIZ6 ML7", f"""WITH {SCORED_SQL}, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM scored)
SELECT round((sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
  / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 9) AS roc_auc FROM r""")
def roc_area(spark, sf):
    return charts.roc_auc(scored(spark, sf), "label", "score").withColumn("roc_auc", F.round("roc_auc", 9))


@query("VIZ7", f"""WITH {SCORED_SQL}, c AS (SELECT DISTINCT CAST(label AS VARCHAR) AS v FROM scored UNION SELECT DISTINCT CAST(prediction AS VARCHAR) FROM scored)
SELECT a.v AS label, b.v AS prediction, (SELECT count(*) FROM scored WHERE CAST(label AS VARCHAR) = a.v AND CAST(prediction AS VARCHAR) = b.v) AS "count" FROM c a CROSS JOIN c b""")
def confusion(spark, sf):
    return charts.confusion_matrix(scored(spark, sf), "label", "prediction")


# Sorting, top-n and sampling.

@query("TOP1", """SELECT * FROM (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus, o_totalprice DESC NULLS LAST, o_orderkey)""")
def sorted_orders(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return o.orderBy(*cleaning.output_order(o, ["o_orderstatus", ("o_totalprice", False), ("absent", True), "o_orderkey"]))


@query("TOP2", """SELECT event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 100""")
def latest_per_channel(spark, sf):
    e = table(spark, sf, "events").select("event_type", "event_id", "value", "ts")
    return order.head_per_group(e, ["event_type"], ["-ts", "-event_id"], 100).drop("ts")


@query("TOP2", """SELECT event_type, event_id, r FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 1200""")
def latest_many_per_channel(spark, sf):
    e = table(spark, sf, "events").select("event_type", "event_id", "ts")
    return order.head_per_group(e, ["event_type"], ["-ts", "-event_id"], 1200, "r").drop("ts")


@query("TOP3", """SELECT lang, doc_id, left(text, 200) AS shown FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS r FROM documents) WHERE r <= 3""")
def sample_texts(spark, sf):
    head = order.head_per_group(table(spark, sf, "documents"), ["lang"], ["doc_id"], 3)
    return head.select("lang", "doc_id", F.left("text", F.lit(200)).alias("shown"))


@query("TOP4", "SELECT * FROM (SELECT * FROM orders ORDER BY md5(o_orderkey::VARCHAR || ':42'), o_orderkey LIMIT 8000)")
def sampled_orders(spark, sf):
    return order.sample_if_larger(table(spark, sf, "orders"), "o_orderkey", 8000)


@query("TOP5", """SELECT n_type AS p_type, CAST(round_even(least(500.0 / (SELECT count(*) FROM part), 1) * n, 0) AS BIGINT) AS n FROM (SELECT p_type AS n_type, count(*) AS n FROM part GROUP BY 1)""")
def stratified_sample_sizes(spark, sf):
    return order.sample_share_per_group(table(spark, sf, "part"), "p_type", "p_partkey", 500).groupBy("p_type").agg(F.count(F.lit(1)).alias("n"))


@query("TOP5", """WITH r AS (SELECT p_type, p_partkey, row_number() OVER (PARTITION BY p_type ORDER BY md5(p_partkey::VARCHAR || ':42'), p_partkey) AS r,
  count(*) OVER (PARTITION BY p_type) AS n FROM part)
SELECT p_type, p_partkey FROM r WHERE r <= round_even(least(500.0 / (SELECT count(*) FROM part), 1) * n, 0)""")
def stratified_sample_rows(spark, sf):
    return order.sample_share_per_group(table(spark, sf, "part"), "p_type", "p_partkey", 500).select("p_type", "p_partkey")


# Scalars.

@query("SCL2 SCL3 SCL8", """SELECT page_id, url, regexp_replace(url, '[^\\p{L}\\p{N}\\-_.]', '_', 'g') AS safe,
  coalesce(nullif(lower(trim(regexp_replace(url, '[^a-zA-Z0-9]+', '_', 'g'), '_')), ''), 'figure') AS slug,
  list_extract(string_split(url, '/'), -1) AS last_part, regexp_replace(list_extract(string_split(url, '/'), -1), '^(.+)\\.[^.]*$', '\\1') AS stem FROM pages""")
def url_names(spark, sf):
    u = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", "url", text.safe_file_name(u).alias("safe"), text.slugify(u).alias("slug"), text.last_path_part(u).alias("last_part"), text.file_stem(u).alias("stem")
    )


@query("SCL4", """SELECT page_id, regexp_replace(html, 'http[^\\s]+|www[^\\s]+', ' ', 'g') AS no_urls,
  regexp_replace(url || ' ' || html, '[^\\p{L}\\p{M}\\p{N}_\\s\\x{85}\\p{Z}''-]', ' ', 'g') AS words FROM pages""")
def stripped_pages(spark, sf):
    p = table(spark, sf, "pages")
    return p.select(
        "page_id", text.strip_urls(F.col("html")).alias("no_urls"),
        text.strip_symbols(F.concat("url", F.lit(" "), "html")).alias("words"),
    )


@query("SCL6", f"""SELECT doc_id, length(text) AS headline_length, len(list_filter(regexp_split_to_array(text, '{SPACES}'), lambda x: x <> '')) AS word_count,
  CAST(contains(text, '!') AS BIGINT) AS has_exclamation, CAST(contains(text, '?') AS BIGINT) AS has_question,
  CAST(upper(text) = text AND lower(text) <> text AS BIGINT) AS is_uppercase FROM documents""")
def headline_features(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", *[c.cast("bigint").alias(n) for n, c in text.headline_features(F.col("text")).items()])


@query("SCL7", """SELECT doc_id, CASE WHEN length(t) > 40 THEN left(t, 37) || '...' ELSE t END AS shown FROM (SELECT doc_id, replace(text, chr(10), ' ') AS t FROM documents)""")
def shortened_texts(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.shorten(F.col("text")).alias("shown"))


@query("SCL13 SCL14", """SELECT o_orderkey, hour(t) AS transaction_hour, day(t) AS transaction_day, month(t) AS transaction_month, year(t) AS transaction_year,
  epoch(t)::BIGINT - epoch(o_orderdate)::BIGINT AS time_since_signup, hour(t) AS hour_of_day, dayofweek(t) AS day_of_week
FROM (SELECT *, o_orderdate + to_hours(CAST(o_orderkey % 5000 AS INTEGER)) AS t FROM orders)""")
def transaction_parts(spark, sf):
    o = table(spark, sf, "orders")
    o = o.withColumn("t", F.col("o_orderdate") + F.make_dt_interval(hours=F.col("o_orderkey") % 5000))
    parts = {**dates.transaction_parts(F.col("t")), **dates.purchase_parts(F.col("o_orderdate"), F.col("t"))}
    return o.select("o_orderkey", *[c.cast("bigint").alias(n) for n, c in parts.items()])


@query("SCL15 SCL18", """SELECT o_orderkey, CASE WHEN v > -1 THEN round(ln(1 + v), 6) END AS log_value, CASE WHEN d > 0 THEN round(v / d, 6) END AS ratio
FROM (SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 7 = 0 THEN 'n/a' WHEN o_orderkey % 7 = 1 THEN '-1' ELSE CAST(o_totalprice AS VARCHAR) END AS DOUBLE) AS v, o_custkey % 4 AS d FROM orders)""")
def logs_and_ratios(spark, sf):
    k = F.col("o_orderkey")
    raw = F.when(k % 7 == 0, "n/a").when(k % 7 == 1, "-1").otherwise(F.col("o_totalprice").cast("string"))
    o = cleaning.add_log1p(table(spark, sf, "orders").withColumn("raw", raw), "raw", "log_value")
    ratio = numeric.safe_ratio(numeric.number(F.col("raw")), F.col("o_custkey") % 4)
    return o.select("o_orderkey", F.round("log_value", 6).alias("log_value"), F.round(ratio, 6).alias("ratio"))


@query("SCL16 SCL17", """SELECT event_id, CASE WHEN s >= 0.05 THEN 'positive' WHEN s <= -0.05 THEN 'negative' ELSE 'neutral' END AS lexicon_label,
  CASE WHEN s > 0.05 THEN 'positive' WHEN s < -0.05 THEN 'negative' ELSE 'neutral' END AS polarity_label,
  CASE event_type WHEN 'click' THEN s WHEN 'error' THEN -s ELSE 0.0 END AS signed
FROM (SELECT *, (event_id % 21 - 10) / 100.0::DOUBLE AS s FROM events)""")
def sentiment_labels(spark, sf):
    s = (F.col("event_id") % 21 - 10) / 100.0
    named = F.when(F.col("event_type") == "click", "POSITIVE").when(F.col("event_type") == "error", "Neg").otherwise("other")
    return table(spark, sf, "events").select(
        "event_id", text.sentiment_label(s).alias("lexicon_label"), text.sentiment_label(s, strict=True).alias("polarity_label"),
        text.signed_score(named, s).alias("signed"),
    )


# Literal models and unions.

@query("SET1 FLT7 SNK7", "SELECT id, id = 1 AS chosen FROM (SELECT o_custkey AS id FROM orders UNION ALL SELECT CAST(NULL AS BIGINT)) s")
def example_models(spark, sf):
    ids = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    blank = spark.range(1).select(F.lit(None).cast("bigint").alias("id"))
    return ids.unionByName(blank).withColumn("chosen", F.col("id") == 1)


@query("SET2", """SELECT 'customer' AS kind, c_custkey AS id, c_mktsegment AS extra FROM customer UNION ALL SELECT 'supplier', s_suppkey, NULL FROM supplier""")
def union_of_batches(spark, sf):
    from tidemart.sources.readers import union_all

    c = table(spark, sf, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("extra"))
    return union_all([c, table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"))])
