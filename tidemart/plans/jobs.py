"""Whole jobs: each runs its stages in dependency order and writes tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.ml import explain, models, prep
from tidemart.ml.evaluate import compare_models, select_best_model
from tidemart.ml.tracking import Tracker, as_results, cross_validate
from tidemart.operators import chunks, cleaning, features, quality
from tidemart.operators.order import sample_if_larger, sample_share_per_group
from tidemart.plans import marts, staging
from tidemart.session import materialize
from tidemart.sources import readers, writers
from tidemart.sources.writers import TableFolder

RAW_SCHEMA = ", ".join(f"{name} {kind}" for name, (kind, _) in staging.MESSAGE_FIELDS.items())

# The parameters searched per kind of model.
GRIDS = {
    "log_reg": {"C": [0.1, 1.0, 3.0]},
    "decision_tree": {"maxDepth": [5, 10, models.UNLIMITED_DEPTH], "minInstancesPerNode": [1, 2]},
    "random_forest": {"numTrees": [100, 200], "maxDepth": [models.UNLIMITED_DEPTH, 10]},
    "gradient_boosting": {"maxIter": [100, 200], "stepSize": [0.05, 0.1]},
    "boosted_trees": {"maxIter": [200, 400], "stepSize": [0.05, 0.1]},
}


def load_landing(spark: SparkSession, folder: str, target: TableFolder, key: Sequence[str] = ("message_id",), scrape_date: str | None = None) -> None:
    """Landing files into the raw table; the first record of a key in file order wins, stored rows stay."""
    rows = readers.read_landing(spark, folder, scrape_date, with_origin=True)
    origin = ["origin_file", "origin_place"]
    writers.insert_if_absent(target, staging.normalise_messages(rows, origin), key, origin)


def daily_batch(spark: SparkSession, landing: str, warehouse: str, detections: DataFrame | None = None, key: Sequence[str] = ("message_id",)) -> DataFrame:
    """Load, stage, classify detections, build the marts, check them; returns the check results.

    `detections` is the detector's output (channel_name, message_id, detected_class, confidence_score).
    """
    raw = TableFolder(spark, f"{warehouse}/raw_messages", RAW_SCHEMA)
    load_landing(spark, landing, raw, key)

    def write(name: str, df: DataFrame) -> DataFrame:
        """Every later stage reads the written table, so nothing is computed twice."""
        folder = TableFolder(spark, f"{warehouse}/{name}", df.schema)
        folder.replace(df)
        return folder.read()

    models = quality.CheckedWriter(quality.star_checks(detections is not None), write)
    stg = models.write("stg_messages", staging.staging_messages(raw.read()))
    channels, dates = models.write("dim_channels", marts.dim_channels(stg)), models.write("dim_dates", marts.dim_dates(stg))
    facts = models.write("fct_messages", marts.fct_messages(stg, channels, dates))
    if detections is not None:
        stored = TableFolder(spark, f"{warehouse}/image_detections", readers.DETECTION_SCHEMA)
        stored.append(marts.classify_detections(detections))
        models.write("fct_image_detections", marts.fct_image_detections(stored.read(), facts))
    return models.results()


def clean_review_file(spark: SparkSession, source: str, target: str, cols: cleaning.ReviewColumns = cleaning.ReviewColumns()) -> dict[str, DataFrame] | bool:
    """CSV to cleaned CSV; returns the report frames, or False when the file is missing."""
    raw = readers.read_csv(spark, source, readers.REVIEW_SCHEMA, multi_line=True)  # review texts have line breaks
    if raw is None:
        return False
    clean = cleaning.clean_reviews(raw, cols)
    writers.write_csv(clean, target)
    return cleaning.quality_report(materialize(clean, "clean"), cleaning.review_statistics(raw, cols), cols)


def build_features(spark: SparkSession, source: str, target: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Transactions CSV to model-ready features CSV: time parts, customer aggregates, fill, scale, one-hot."""
    raw = readers.read_csv(spark, source, readers.TRANSACTION_SCHEMA)
    if raw is None:
        raise FileNotFoundError(f"no transactions at {source}")
    rows = features.CustomerAggregates().fit(raw).transform(features.add_transaction_parts(raw))
    made = ["total_amount", "avg_amount", "txn_count", "transaction_hour", "transaction_day", "transaction_month", "transaction_year"]
    encoded = prep.build_preprocessor([*numeric, *made], categorical).fit(rows).transform(rows)
    values = explain.vector_to_array("features")
    wide = encoded.select(*[values[i].alias(n) for i, n in enumerate(explain.feature_names(encoded))])
    writers.write_csv(wide, target)
    return wide


def prepare_fraud_rows(df: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """Purchase time parts, country of the address and key frequencies, each where its columns exist."""
    out = df
    if {"signup_time", "purchase_time"} <= set(df.columns):
        out = features.add_purchase_parts(out)
    if countries is not None and "ip_address" in df.columns:
        out = features.add_country(out, countries)
    if {"user_id", "device_id", "ip_address"} <= set(df.columns):
        out = features.add_frequencies(out)
    return out


def model_rows(
    spark: SparkSession, df: DataFrame, key: str, label: str, experiment: str, root: str, resampling: str = "undersample",
    drop: Iterable[str] = ("signup_time", "purchase_time"), names: Iterable[str] | None = None, use_cv: bool = False, tuned: bool = True,
    quick_rows: int | None = None, hashed: Iterable[str] = (),
) -> dict[str, DataFrame]:
    """Split, resample the training part, fit or cross-validate every model, compare, choose, register.

    resampling is "undersample", "smote" (numeric features only) or "none". Returns the comparison
    and the choice; runs, models and the registry are below `root`. `quick_rows` bounds the rows that models are
    fitted on (a sample by key hash); every test row is evaluated. `hashed` names the categories with too
    many levels for one-hot columns.
    """
    rows = df.withColumn(label, F.col(label).cast("int"))
    rows = materialize(rows, "modelling")
    train, test = prep.split_train_test(rows, key, label, [c for c in drop if c in rows.columns], stratify=True)
    if quick_rows:
        train = sample_if_larger(train, key, quick_rows)
    numeric = [f.name for f in train.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in (label, key)]
    categorical = [f.name for f in train.schema.fields if isinstance(f.dataType, T.StringType) and f.name != key]
    if resampling == "smote":
        made = prep.smote(train, key, label, numeric).drop("synthetic").withColumn(key, F.monotonically_increasing_id())
        train, categorical = materialize(made, "train"), []
    else:
        train = materialize(prep.undersample(train, key, label) if resampling == "undersample" else train, "train")
    test = materialize(test, "test")
    few, many = prep.split_by_levels(train, categorical, hashed)
    candidates = models.classification_models(prep.build_preprocessor(numeric, few, many), label, rows=max(1, train.count()))
    tracker, results = Tracker(spark, root), []
    for name, model in candidates.items():
        if names is not None and name not in names:
            continue
        tagged = name if resampling == "none" else f"{name}__{'rus' if resampling == 'undersample' else resampling}"
        if use_cv:
            folds = cross_validate(model, train, label, key)
            tracker.log_folds(experiment, tagged, folds, resampling)
            results.append(as_results(tagged, folds, True))
        else:
            grid = next((g for part, g in GRIDS.items() if part in name), None) if tuned else None
            _, metrics = tracker.run(experiment, tagged, model, train, test, label, key, grid)
            results.append(as_results(tagged, metrics, False))
    compared = materialize(compare_models(readers.union_all(results)), "comparison")
    writers.write_csv(compared, f"{root}/comparison")
    if not use_cv:
        tracker.register_best(experiment)
    return {"comparison": compared, "choice": select_best_model(compared)}


def index_chunks(df: DataFrame, id_col: str, text_col: str, product_col: str, path: str, embed=None, sample_size: int | None = None) -> DataFrame:
    """Chunk every row, embed by the caller's column function, write the collection. With `sample_size` only a
    stratified sample of about that many rows is indexed."""
    sampled = df if sample_size is None else sample_share_per_group(df, product_col, id_col, sample_size)
    pieces = chunks.create_chunks(sampled, id_col, text_col, product_col)
    if embed is not None:
        pieces = pieces.withColumn("embedding", embed(F.col("text")))
    writers.write_collection(pieces, path, "overwrite")
    return df.sparkSession.read.parquet(path)


def label_risk_file(spark: SparkSession, source: str, target: str, customer: str = "CustomerId", time: str = "TransactionStartTime", amount: str = "Amount") -> dict[str, DataFrame] | None:
    """Transactions CSV to the same rows with is_high_risk; returns cluster means and label counts."""
    raw = readers.read_csv(spark, source)
    if raw is None:
        return None
    clusters = materialize(explain.rfm_clusters(raw, customer, time, amount), "clusters")
    labelled = explain.label_customers(raw, clusters, customer)
    writers.write_csv(labelled, target)
    return {"means": explain.cluster_means(clusters), "labels": labelled.groupBy("is_high_risk").agg(F.count(F.lit(1)).alias("count"))}


def score_file(spark: SparkSession, model: PipelineModel, source: str, target: str, version: str) -> DataFrame | None:
    raw = readers.read_csv(spark, source, readers.TRANSACTION_SCHEMA)
    if raw is None:
        return None
    scored = explain.score_transactions(model, raw, version)
    writers.write_csv(scored, target)
    return scored
