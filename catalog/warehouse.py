"""Star schema, reports and quality checks over messages made from `documents` and detections from `lineitem`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.base import query, table
from tidemart.functions.dates import iso_timestamp
from tidemart.operators import quality
from tidemart.plans import marts, reports, staging

MESSAGES_SQL = """
raw_msg AS (
  SELECT doc_id AS message_id, source AS channel_name,
    CASE CAST(substr(source, 4) AS BIGINT) % 3 WHEN 0 THEN 'news' WHEN 1 THEN 'shop' ELSE 'forum' END AS channel_type,
    CASE WHEN doc_id % 11 = 5 THEN NULL WHEN doc_id % 11 = 7 THEN '' ELSE text END AS message_text,
    TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(doc_id % 60 AS INTEGER)) + to_hours(CAST(doc_id % 24 AS INTEGER)) AS post_date,
    CAST(n_chars AS INTEGER) - 300 AS view_count, CAST(doc_id % 7 AS INTEGER) AS forward_count,
    CASE doc_id % 3 WHEN 0 THEN 'img/' || doc_id || '.jpg' WHEN 1 THEN '' END AS image_url
  FROM documents),
stg AS (
  SELECT *, length(message_text) AS message_length, (image_url IS NOT NULL AND image_url <> '') AS has_image
  FROM raw_msg WHERE message_text IS NOT NULL AND message_text <> '')"""

STAR_SQL = MESSAGES_SQL + """,
channel_stats AS (
  SELECT channel_name, channel_type, min(post_date) AS first_post_date, max(post_date) AS last_post_date,
    count(*) AS total_posts, avg(view_count) AS avg_views
  FROM stg GROUP BY channel_name, channel_type),
dim_channels AS (
  SELECT row_number() OVER (ORDER BY channel_name NULLS LAST, channel_type NULLS LAST) AS channel_key, * FROM channel_stats),
dim_dates AS (
  SELECT row_number() OVER (ORDER BY full_date NULLS LAST) AS date_key, full_date
  FROM (SELECT DISTINCT CAST(post_date AS DATE) AS full_date FROM stg)),
fct AS (
  SELECT m.message_id, c.channel_key, d.date_key, m.message_text, m.message_length, m.view_count, m.forward_count, m.has_image
  FROM stg m LEFT JOIN dim_channels c ON m.channel_name = c.channel_name
  LEFT JOIN dim_dates d ON CAST(m.post_date AS DATE) = d.full_date)"""

DETECTIONS_SQL = """
det AS (
  SELECT 'ch_' || lower(l_linestatus) || (l_orderkey % 5) AS channel_name,
    CASE WHEN l_orderkey % 13 = 0 THEN 'img_' || l_orderkey ELSE CAST(l_orderkey AS VARCHAR) END AS message_id,
    CASE l_linenumber WHEN 1 THEN 'person' WHEN 2 THEN 'bottle' WHEN 3 THEN 'container' WHEN 4 THEN 'car' WHEN 5 THEN 'dog' ELSE 'chair' END AS detected_class,
    l_discount AS confidence_score
  FROM lineitem),
cat AS (
  SELECT channel_name, message_id,
    CASE WHEN bool_or(detected_class = 'person') AND bool_or(detected_class IN ('bottle', 'container')) THEN 'promotional'
      WHEN bool_or(detected_class IN ('bottle', 'container')) THEN 'product_display'
      WHEN bool_or(detected_class = 'person') THEN 'lifestyle' ELSE 'other' END AS image_category
  FROM det GROUP BY channel_name, message_id),
classified AS (SELECT det.*, cat.image_category FROM det JOIN cat USING (channel_name, message_id))"""


def raw_messages(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    kind = F.substring("source", 4, 9).cast("bigint") % 3
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return d.select(
        F.col("doc_id").alias("message_id"),
        F.col("source").alias("channel_name"),
        F.when(kind == 0, "news").when(kind == 1, "shop").otherwise("forum").alias("channel_type"),
        F.when(F.col("doc_id") % 11 == 5, None).when(F.col("doc_id") % 11 == 7, "").otherwise(F.col("text")).alias("message_text"),
        (start + F.make_dt_interval(days=F.col("doc_id") % 60, hours=F.col("doc_id") % 24)).alias("message_date"),
        (F.col("n_chars").cast("int") - 300).alias("views"),
        (F.col("doc_id") % 7).cast("int").alias("forwards"),
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("img/"), "doc_id", F.lit(".jpg"))).when(F.col("doc_id") % 3 == 1, "").alias("image_path"),
    )


def stg(spark: SparkSession, sf: str) -> DataFrame:
    return staging.staging_messages(staging.normalise_messages(raw_messages(spark, sf)))


def detections(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("l_linenumber")
    classes = F.when(n == 1, "person").when(n == 2, "bottle").when(n == 3, "container").when(n == 4, "car").when(n == 5, "dog")
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("ch_"), F.lower("l_linestatus"), (F.col("l_orderkey") % 5).cast("string")).alias("channel_name"),
        F.when(F.col("l_orderkey") % 13 == 0, F.concat(F.lit("img_"), "l_orderkey")).otherwise(F.col("l_orderkey").cast("string")).alias("message_id"),
        classes.otherwise("chair").alias("detected_class"),
        F.col("l_discount").alias("confidence_score"),
    )


@query("SRC2 FLT1 FLT2 FLT3 SCL9 SCL19", f"""WITH {MESSAGES_SQL}
SELECT message_id, channel_name, channel_type, message_text, strftime(post_date, '%Y-%m-%dT%H:%M:%S') AS post_date,
  CAST(view_count AS BIGINT) AS view_count, CAST(forward_count AS BIGINT) AS forward_count, image_url,
  CAST(message_length AS BIGINT) AS message_length, has_image FROM stg""")
def staging_rows(spark, sf):
    return stg(spark, sf).select(
        "message_id", "channel_name", "channel_type", "message_text",
        iso_timestamp(F.col("post_date")).alias("post_date"),
        *[F.col(c).cast("bigint").alias(c) for c in ("view_count", "forward_count")],
        "image_url", F.col("message_length").cast("bigint").alias("message_length"), "has_image",
    )


@query("AGG1 WIN1", f"""WITH {STAR_SQL}
SELECT channel_key, channel_name, channel_type, strftime(first_post_date, '%Y-%m-%dT%H:%M:%S') AS first_post_date,
  strftime(last_post_date, '%Y-%m-%dT%H:%M:%S') AS last_post_date, total_posts, round(avg_views, 6) AS avg_views FROM dim_channels""")
def channel_dimension(spark, sf):
    return marts.dim_channels(stg(spark, sf)).select(
        "channel_key", "channel_name", "channel_type",
        iso_timestamp(F.col("first_post_date")).alias("first_post_date"),
        iso_timestamp(F.col("last_post_date")).alias("last_post_date"),
        "total_posts", F.round("avg_views", 6).alias("avg_views"),
    )


@query("AGG2 SCL10 SET3 WIN1", f"""WITH {STAR_SQL}
SELECT date_key, full_date, CAST(extract(dow FROM full_date) AS BIGINT) AS day_of_week, strftime(full_date, '%A') AS day_name,
  CAST(extract(week FROM full_date) AS BIGINT) AS week_of_year, CAST(extract(month FROM full_date) AS BIGINT) AS "month",
  strftime(full_date, '%B') AS month_name, CAST(extract(quarter FROM full_date) AS BIGINT) AS quarter,
  CAST(extract(year FROM full_date) AS BIGINT) AS "year", extract(dow FROM full_date) IN (0, 6) AS is_weekend FROM dim_dates""")
def date_dimension(spark, sf):
    d = marts.dim_dates(stg(spark, sf))
    longs = ("day_of_week", "week_of_year", "month", "quarter", "year")
    return d.withColumns({c: F.col(c).cast("bigint") for c in longs})


@query("JOIN1 JOIN2 SNK7", f"""WITH {STAR_SQL}
SELECT message_id, channel_key, date_key, message_text, CAST(message_length AS BIGINT) AS message_length,
  CAST(view_count AS BIGINT) AS view_count, CAST(forward_count AS BIGINT) AS forward_count, has_image FROM fct""")
def message_facts(spark, sf):
    _, _, fct = marts.star(stg(spark, sf))
    return fct.withColumns({c: F.col(c).cast("bigint") for c in ("message_length", "view_count", "forward_count")})


@query("AGG3 FLT4 SCL5", f"""WITH {STAR_SQL}
SELECT word AS product, count(*) AS "count" FROM (SELECT unnest(string_split(lower(message_text), ' ')) AS word FROM fct)
WHERE regexp_matches(word, '^[a-zA-Z]+') GROUP BY word ORDER BY count(*) DESC, word LIMIT 10""")
def top_products(spark, sf):
    _, _, fct = marts.star(stg(spark, sf))
    return reports.top_terms(fct, 10)


@query("FLT6", f"""WITH {STAR_SQL}
SELECT channel_name, total_posts, round(avg_views, 6) AS avg_views, strftime(first_post_date, '%Y-%m-%dT%H:%M:%S') AS first_post_date,
  strftime(last_post_date, '%Y-%m-%dT%H:%M:%S') AS last_post_date FROM dim_channels WHERE channel_name = 'src7'""")
def channel_activity(spark, sf):
    out = reports.channel_activity(marts.dim_channels(stg(spark, sf)), "src7")
    return out.withColumns({
        "avg_views": F.round("avg_views", 6),
        "first_post_date": iso_timestamp(F.col("first_post_date")),
        "last_post_date": iso_timestamp(F.col("last_post_date")),
    })


@query("FLT5", f"""WITH {STAR_SQL}
SELECT f.message_id, c.channel_name, f.message_text, d.full_date AS post_date, CAST(f.view_count AS BIGINT) AS view_count,
  CAST(f.forward_count AS BIGINT) AS forward_count, f.has_image
FROM fct f LEFT JOIN dim_channels c USING (channel_key) LEFT JOIN dim_dates d USING (date_key)
WHERE f.message_text ILIKE '%tion%' ORDER BY f.message_id, f.channel_key LIMIT 20""")
def message_search(spark, sf):
    channels, dates, fct = marts.star(stg(spark, sf))
    out = reports.search_messages(fct, channels, dates, "tion", 20)
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("view_count", "forward_count")})


@query("FLT16", f"""WITH {DETECTIONS_SQL} SELECT channel_name, message_id, image_category FROM cat""")
def image_categories(spark, sf):
    return marts.image_categories(detections(spark, sf))


@query("AGG4", f"""WITH {DETECTIONS_SQL}
SELECT channel_name, CAST(sum(CASE WHEN image_category = 'promotional' THEN 1 ELSE 0 END) AS BIGINT) AS promotional_count,
  CAST(sum(CASE WHEN image_category = 'product_display' THEN 1 ELSE 0 END) AS BIGINT) AS product_display_count,
  CAST(sum(CASE WHEN image_category = 'lifestyle' THEN 1 ELSE 0 END) AS BIGINT) AS lifestyle_count,
  CAST(sum(CASE WHEN image_category = 'other' THEN 1 ELSE 0 END) AS BIGINT) AS other_count
FROM classified GROUP BY channel_name""")
def visual_content(spark, sf):
    return reports.visual_content(marts.classify_detections(detections(spark, sf)))


@query("JOIN3 SNK6", f"""WITH {STAR_SQL}, {DETECTIONS_SQL}
SELECT m.message_id, m.channel_key, m.date_key, d.detected_class, d.confidence_score, d.image_category
FROM classified d LEFT JOIN fct m ON TRY_CAST(d.message_id AS BIGINT) = m.message_id""")
def image_detection_facts(spark, sf):
    _, _, fct = marts.star(stg(spark, sf))
    return marts.fct_image_detections(marts.classify_detections(detections(spark, sf)), fct)


@query("AGG27", f"""WITH {MESSAGES_SQL}
SELECT 'day' AS grain, channel_name, CAST(date_trunc('day', post_date) AS DATE) AS period, count(*) AS posts FROM stg GROUP BY 2, 3
UNION ALL SELECT 'week', channel_name, CAST(date_trunc('week', post_date) AS DATE), count(*) FROM stg GROUP BY 2, 3""")
def posting_volume(spark, sf):
    s = stg(spark, sf)
    day, week = [reports.posting_volume(s, g).select(F.lit(g).alias("grain"), "channel_name", "period", "posts") for g in ("day", "week")]
    return day.unionByName(week)


@query("AGG28", f"""WITH {MESSAGES_SQL}
SELECT channel_name, count(*) AS posts, round(avg(CASE WHEN has_image THEN 1.0 ELSE 0.0 END), 6) AS image_share FROM stg GROUP BY 1""")
def visual_share(spark, sf):
    return reports.visual_share(stg(spark, sf)).withColumn("image_share", F.round("image_share", 6))


@query("AGG28", f"""WITH {STAR_SQL}, {DETECTIONS_SQL},
pairs AS (SELECT DISTINCT m.message_id, d.image_category FROM classified d JOIN fct m ON TRY_CAST(d.message_id AS BIGINT) = m.message_id)
SELECT image_category, count(*) AS messages, round(avg(view_count), 6) AS avg_views FROM pairs JOIN fct USING (message_id) GROUP BY 1""")
def views_by_category(spark, sf):
    _, _, fct = marts.star(stg(spark, sf))
    facts = marts.fct_image_detections(marts.classify_detections(detections(spark, sf)), fct)
    return reports.views_by_category(facts, fct).withColumn("avg_views", F.round("avg_views", 6))


CHECKS = f"""WITH {STAR_SQL}, {DETECTIONS_SQL},
img AS (SELECT m.message_id, m.channel_key, m.date_key FROM classified d LEFT JOIN fct m ON TRY_CAST(d.message_id AS BIGINT) = m.message_id),
res AS ("""


def _checks_sql() -> str:
    names = {"stg_messages": "stg", "dim_channels": "dim_channels", "dim_dates": "dim_dates", "fct_messages": "fct", "fct_image_detections": "img"}
    unique = [("stg_messages", "message_id"), ("dim_channels", "channel_key"), ("dim_dates", "date_key"), ("fct_messages", "message_id")]
    not_null = [
        ("stg_messages", "message_id"), ("stg_messages", "channel_name"), ("stg_messages", "message_text"), ("stg_messages", "post_date"),
        ("dim_channels", "channel_key"), ("dim_channels", "channel_name"), ("dim_dates", "date_key"), ("dim_dates", "full_date"),
        ("fct_messages", "message_id"), ("fct_messages", "channel_key"), ("fct_messages", "date_key"), ("fct_messages", "message_text"),
        ("fct_image_detections", "message_id"),
    ]
    parts = [
        f"SELECT 'unique' AS \"check\", '{m}' AS model, '{c}' AS \"column\", count(*) AS failures FROM "
        f"(SELECT {c} FROM {names[m]} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)" for m, c in unique
    ]
    parts += [f"SELECT 'not_null', '{m}', '{c}', count(*) FROM {names[m]} WHERE {c} IS NULL" for m, c in not_null]
    for model in ("fct_messages", "fct_image_detections"):
        for c, parent in (("channel_key", "dim_channels"), ("date_key", "dim_dates")):
            parts.append(
                f"SELECT 'relationship', '{model}', '{c}', count(*) FROM {names[model]} x WHERE {c} IS NOT NULL "
                f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{c} = x.{c})"
            )
    parts.append("SELECT 'non_negative_views', 'fct_messages', 'view_count', count(*) FROM fct WHERE view_count < 0")
    return CHECKS + " UNION ALL ".join(parts) + ") SELECT *, failures = 0 AS passed FROM res"


@query("DQ1 DQ2 DQ3 DQ5 DQ6 JOIN6", _checks_sql())
def quality_checks(spark, sf):
    """Every model is written once, checked while it is written, and read by the next ones."""
    writer = quality.CheckedWriter(quality.star_checks())
    s = writer.write("stg_messages", stg(spark, sf))
    channels, dates = writer.write("dim_channels", marts.dim_channels(s)), writer.write("dim_dates", marts.dim_dates(s))
    facts = writer.write("fct_messages", marts.fct_messages(s, channels, dates))
    writer.write("fct_image_detections", marts.fct_image_detections(marts.classify_detections(detections(spark, sf)), facts))
    return writer.results()


@query("DQ4 JOIN12", f"""WITH {STAR_SQL}
SELECT message_id, channel_key, date_key FROM fct
WHERE date_key > (SELECT max(date_key) FROM dim_dates WHERE full_date <= DATE '2024-02-20')""")
def future_messages(spark, sf):
    _, dates, fct = marts.star(stg(spark, sf))
    return quality.future_messages(fct, dates, "2024-02-20").select("message_id", "channel_key", "date_key")


@query("DQ5", f"""WITH {STAR_SQL} SELECT message_id, CAST(view_count AS BIGINT) AS view_count FROM fct WHERE view_count < 0""")
def negative_views(spark, sf):
    _, _, fct = marts.star(stg(spark, sf))
    return quality.negative_views(fct).select("message_id", F.col("view_count").cast("bigint").alias("view_count"))


@query("DQ1 DQ3 JOIN6", """SELECT 'order_line' AS what, CAST(l_orderkey AS VARCHAR) AS "key", count(*) AS n FROM lineitem GROUP BY 2 HAVING count(*) > 5
UNION ALL SELECT 'orphan', CAST(l_partkey AS VARCHAR), count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) GROUP BY 2""")
def key_violations(spark, sf):
    lines = table(spark, sf, "lineitem")
    dup = quality.duplicate_keys(lines, "l_orderkey").filter("n > 5")
    orphan = quality.orphan_keys(lines, "l_partkey", table(spark, sf, "part").filter("p_size > 5"), "p_partkey")
    return dup.select(F.lit("order_line").alias("what"), F.col("l_orderkey").cast("string").alias("key"), "n").unionByName(
        orphan.select(F.lit("orphan").alias("what"), F.col("key").cast("string").alias("key"), "n")
    )


# Parents and children: documents with their labels; most documents have none.


def parents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "source", F.concat(F.lit("doc "), "doc_id").alias("doc_name"))


def children(spark, sf):
    verdict = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
    return table(spark, sf, "labels").withColumns({"label_id": F.col("doc_id"), "verdict": verdict, "score": F.col("quality") - F.col("toxic") / 4})


CHILDREN_SQL = """ch AS (SELECT *, doc_id AS label_id, quality - toxic / 4.0 AS score, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' END AS verdict FROM labels)"""


@query("AGG5 JOIN4", """SELECT 'doc ' || d.doc_id AS doc_name, count(l.doc_id) AS "count" FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""")
def child_counts(spark, sf):
    return reports.child_count(parents(spark, sf), children(spark, sf), "doc_id", "doc_name", "label_id")


@query("AGG6 AGG7", f"""WITH {CHILDREN_SQL}
SELECT 'doc ' || d.doc_id AS doc_name, round(avg(score), 6) AS average FROM documents d LEFT JOIN ch ON d.doc_id = ch.doc_id GROUP BY 1""")
def child_averages(spark, sf):
    out = reports.child_average(parents(spark, sf), children(spark, sf), "doc_id", "doc_name", "score")
    return out.withColumn("average", F.round("average", 6))


@query("AGG8", f"""WITH {CHILDREN_SQL}
SELECT d.source, coalesce(verdict, 'unknown') AS label, count(label_id) AS "count" FROM documents d LEFT JOIN ch ON d.doc_id = ch.doc_id GROUP BY 1, 2""")
def label_counts_by_parent(spark, sf):
    return reports.child_label_counts(parents(spark, sf), children(spark, sf), "doc_id", "source", "verdict", "label_id")


@query("AGG8", f"""WITH {CHILDREN_SQL},
c AS (SELECT d.source, coalesce(verdict, 'unknown') AS label, count(label_id) AS n FROM documents d LEFT JOIN ch ON d.doc_id = ch.doc_id GROUP BY 1, 2)
SELECT source, string_agg(label || '=' || n, ',' ORDER BY label) AS counts FROM c GROUP BY 1""")
def label_maps_by_parent(spark, sf):
    maps = reports.label_count_maps(label_counts_by_parent(spark, sf), "source")
    pairs = F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return maps.select("source", F.array_join(pairs, ",").alias("counts"))


@query("AGG9", """WITH l AS (SELECT nullif(o_orderpriority, '5-LOW') AS label FROM orders)
SELECT coalesce(label, 'unknown') AS label, count(*) AS "count" FROM l GROUP BY 1
UNION ALL SELECT 'nulls', count(*) FROM l WHERE label IS NULL""")
def label_totals(spark, sf):
    return reports.label_totals(table(spark, sf, "orders").withColumn("label", F.nullif("o_orderpriority", F.lit("5-LOW"))), "label")


@query("AGG23", """SELECT n_nationkey, n_name, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS "count" FROM nation""")
def suppliers_per_nation(spark, sf):
    suppliers = table(spark, sf, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    return reports.source_counts(table(spark, sf, "nation"), suppliers, "n_nationkey", "n_name")
