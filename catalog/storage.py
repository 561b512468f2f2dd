"""Sources and sinks: what is written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import query, table
from tidemart.session import materialize, new_shared_path
from tidemart.sources import readers, writers
from tidemart.sources.buckets import BucketTable

RICHEST_SQL = "(SELECT c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) = 1)"


def customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")


def stored_customers(spark, sf):
    """All customers in a bucketed table."""
    rows = customers(spark, sf)
    target = BucketTable(spark, new_shared_path(spark, "customers"), rows.schema, ("c_custkey",))
    target.upsert(rows, ["c_name"])
    return target


def raised(spark, sf):
    """A batch: the richest customer of each nation with a new balance, and one new customer per nation."""
    first = customers(spark, sf).groupBy("c_nationkey").agg(F.max_by("c_custkey", F.struct("c_acctbal", -F.col("c_custkey"))).alias("c_custkey"))
    rich = first.select("c_custkey").join(customers(spark, sf), "c_custkey").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    new = first.select((-F.col("c_nationkey") - 1).alias("c_custkey"), F.lit("new").alias("c_name"), "c_nationkey", F.lit(0.0).cast(rich.schema["c_acctbal"].dataType).alias("c_acctbal"))
    return rich.unionByName(new)


@query("SNK5", f"""SELECT c_custkey, c_name, c_nationkey, round(c_acctbal + CASE WHEN c_custkey IN {RICHEST_SQL} THEN 1 ELSE 0 END, 2) AS c_acctbal FROM customer
UNION ALL SELECT DISTINCT -c_nationkey - 1, 'new', c_nationkey, 0.0 FROM customer""")
def upserted_customers(spark, sf):
    target = stored_customers(spark, sf)
    target.upsert(raised(spark, sf), ["c_name"])
    return target.read().withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("SNK5 SNK4", "SELECT count(*) + count(DISTINCT c_nationkey) AS n, TRUE AS others_unchanged, TRUE AS some_written, TRUE AS repeat_changes_nothing FROM customer")
def merges_write_few_buckets(spark, sf):
    """Files of buckets that a batch does not fall into are the same ones, and the same batch again writes none."""
    target = stored_customers(spark, sf)
    before = materialize(target.files(), "files")
    written = target.upsert(raised(spark, sf), ["c_name"])
    after = materialize(target.files(), "files")
    again = target.upsert(raised(spark, sf), ["c_name"]) + target.insert_if_absent(raised(spark, sf), ["c_name"])
    last = materialize(target.files(), "files")
    facts = before.join(after.withColumn("kept", F.lit(1)), before.columns, "left").groupBy("bucket").agg(F.count_if(F.col("kept").isNull()).alias("gone"))
    changed = facts.agg(F.count_if(F.col("gone") > 0).alias("changed"), F.count_if(F.col("gone") == 0).alias("same"))
    new = last.exceptAll(after).agg(F.count(F.lit(1)).alias("new"))
    return target.read().agg(F.count(F.lit(1)).alias("n")).crossJoin(changed).crossJoin(new).select(
        "n", (F.col("changed") <= F.lit(written)).alias("others_unchanged"),
        (F.lit(written) > 0).alias("some_written"), ((F.col("new") == 0) & (F.lit(again) == 0)).alias("repeat_changes_nothing"),
    )


@query("SNK4 JOIN7", """WITH a AS (SELECT o_custkey, min(o_orderkey) FILTER (o_orderstatus = 'F') AS early, min(o_orderkey) AS any_order FROM orders GROUP BY 1)
SELECT o_custkey, coalesce(early, any_order) AS o_orderkey FROM a""")
def first_orders_stay(spark, sf):
    """The first finished order of each customer is stored first; of all orders only those of customers without one come in, however often they are sent."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    target = BucketTable(spark, new_shared_path(spark, "orders"), orders.schema, ("o_custkey",))
    target.insert_if_absent(orders.filter("o_orderstatus = 'F'"), ["o_orderkey"])
    target.insert_if_absent(orders, ["o_orderkey"])
    target.insert_if_absent(orders, ["-o_orderkey"])
    return target.read().select("o_custkey", "o_orderkey")


@query("SNK4", """SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1""")
def first_orders_in_versions(spark, sf):
    """Insert-if-absent into a table folder with versions."""
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    target = writers.TableFolder(spark, new_shared_path(spark, "orders"), orders.schema)
    for _ in range(2):
        writers.insert_if_absent(target, orders, ("o_custkey",), ["o_orderkey"])
    return target.read()


MESSAGES_SQL = "SELECT doc_id AS message_id, source AS channel_name, text AS message_text, n_chars::BIGINT AS views FROM documents"


@query("SNK3", MESSAGES_SQL)
def landed_documents(spark, sf):
    """Documents as messages, landed as JSON by date and channel, and read again with all files below the folder."""
    d = table(spark, sf, "documents")
    rows = d.select(F.lit("2024-01-01").alias("scrape_date"), F.col("source").alias("channel_name"), F.col("doc_id").alias("message_id"), F.col("source").alias("channel"), F.col("text").alias("message_text"), F.col("n_chars").alias("views"))
    folder = new_shared_path(spark, "landing")
    writers.write_landing(rows, folder)
    # the channel is also a folder of the path, which the reader leaves alone
    back = spark.read.schema("message_id bigint, channel string, message_text string, views bigint").option("recursiveFileLookup", True).json(folder)
    return back.select("message_id", F.col("channel").alias("channel_name"), "message_text", "views")


@query("SRC3 SNK1", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_round_trip(spark, sf):
    """Whole documents through a CSV with a header: quotes are doubled, line breaks stay in their cells."""
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = new_shared_path(spark, "csv")
    writers.write_csv(d, path)
    return readers.read_csv(spark, path, d.schema, multi_line=True)


@query("SRC6 SNK6", "SELECT l_returnflag, 2 * count(*) AS n, round(2 * sum(l_quantity), 2) AS quantity FROM lineitem GROUP BY 1")
def appended_twice(spark, sf):
    """Appends have no key: the same rows twice are there twice; read through the table reader."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    target = writers.TableFolder(spark, new_shared_path(spark, "lines"), lines.schema)
    target.append(lines)
    target.append(lines)
    back = readers.read_table(spark, f"{target.path}/v{target.version()}")
    return back.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("SNK7 FLT7", "SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'FRANCE' OR n_regionkey = 3 GROUP BY 1")
def model_over_views(spark, sf):
    """Models as a view and a table; a third filters the second by equality."""
    writers.create_view(table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")), "tidemart_customers")
    counted = spark.sql("SELECT n_name, n_regionkey, count(*) AS customers FROM tidemart_customers GROUP BY ALL")
    name = "tidemart_nation_customers"
    writers.create_table(counted, name)
    kept = spark.table(name).filter("n_name = 'FRANCE' OR n_regionkey = 3").select("n_name", "customers")
    return materialize(kept, "model")


@query("SNK8", """SELECT 'INSERT INTO supplier VALUES (' || s_suppkey || ', ''' || replace(s_name, '''', '''''') || ''', ' || s_nationkey || ');' AS statement FROM supplier""")
def supplier_statements(spark, sf):
    """The exported file's lines, read again."""
    folder = new_shared_path(spark, "statements")
    writers.export_statements({"supplier": table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")}, folder)
    return spark.read.text(f"{folder}/supplier.sql").withColumnRenamed("value", "statement")


@query("SNK9", "SELECT row_number() OVER (ORDER BY source) AS bank_id, source AS bank_name FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL AND source <> '')")
def registered_sources(spark, sf):
    """Each name has an id once, whether it comes with the first batch or again."""
    names = table(spark, sf, "documents").select(F.col("source").alias("bank_name"))
    target = writers.TableFolder(spark, new_shared_path(spark, "names"), "bank_id long, bank_name string")
    writers.register_banks(target, names)
    return writers.register_banks(target, names)


@query("SNK2", "SELECT count(*) AS documents, sum(n_chars)::BIGINT AS characters FROM documents")
def metrics_file(spark, sf):
    path = new_shared_path(spark, "metrics")
    facts = table(spark, sf, "documents").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("characters")).first()
    writers.write_metrics(spark, facts.asDict(), path)
    return spark.read.schema("documents bigint, characters bigint").json(path)


@query("SNK10 SRC4", "SELECT label::VARCHAR AS product, count(*) AS n, round(sum(embedding[1]::DOUBLE), 4) AS first FROM embeddings GROUP BY 1")
def stored_collection(spark, sf):
    """Vectors through the typed reader into a collection by product, and back."""
    e = readers.read_embeddings(spark, f"{sf}/embeddings.parquet", "vec_id", "embedding", ["label"])
    chunks = e.select(F.col("vec_id").cast("string").alias("chunk_id"), "embedding", F.col("label").cast("string").alias("product"), F.lit("").alias("text"))
    path = new_shared_path(spark, "collection")
    writers.write_collection(chunks, path)
    back = spark.read.schema(chunks.schema).parquet(path)
    return back.groupBy("product").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("embedding")[0].cast("double")), 4).alias("first"))


@query("SRC7", """SELECT doc_id::VARCHAR AS review_id, coalesce(text, '') AS review_text, 0 AS rating, 'Anonymous' AS user_name, 0 AS thumbs_up, lang AS bank_code, CASE lang WHEN 'en' THEN 'English' END AS bank_name,
'N/A' AS app_id, 'Google Play' AS source FROM documents""")
def document_reviews(spark, sf):
    """Documents as store records that lack most fields."""
    raw = table(spark, sf, "documents").select(F.col("doc_id").alias("reviewId"), F.col("text").alias("content"), F.col("lang").alias("bank_code"))
    names = spark.createDataFrame([("en", "English")], "bank_code string, bank_name string")
    return readers.normalise_reviews(raw, names).drop("review_date", "reply_content")


@query("SRC8", "SELECT doc_id, n_chars FROM documents")
def preferred_file(spark, sf):
    """The processed file where there is one, else the raw file prepared; here first the one, then the other, which agree."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    raw, processed = new_shared_path(spark, "raw"), new_shared_path(spark, "processed")
    writers.write_csv(d.withColumn("n_chars", F.col("n_chars") - 1), raw)
    prepare = lambda df, side: df.withColumn("n_chars", F.col("n_chars") + 1)
    made = readers.read_preferred(spark, processed, raw, prepare, multi_line=False)
    writers.write_csv(made, processed)
    return readers.read_preferred(spark, processed, raw, prepare, multi_line=False).select(F.col("doc_id").cast("bigint"), F.col("n_chars").cast("bigint"))
