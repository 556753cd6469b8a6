"""The named queries, each over whole tables."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.functions.display import risk_message
from riskflow.functions.hashing import in_fraction
from riskflow.functions.records import (
    export_name,
    json_path,
    parse_record,
    record_json,
    utf8_bytes,
    utf8_text,
)
from riskflow.operators import balance, encode, ids, learned, metrics, review, score, upsert
from riskflow.operators import validate, verdict
from riskflow.plans import views
from riskflow.plans.online import ONLINE
from riskflow.plans.jobs import FIT_PARTITIONS, partitions_for, score_batch, spread, train_job
from riskflow.schema import (
    INTAKE_COLUMNS,
    SERVING_SPEC,
    TARGET,
    TRAINING,
    TRAIN_FRACTION,
    without_steps,
)
from riskflow.sources import readers, writers
from riskflow.streaming import flows
from riskflow.workspace import run_dir

SEED = 42
# The derived numbers are not multiples of 0.1, so the step rules do not apply.
RULES = without_steps()
LOOKUP_IDS = (0, 42, 1234, 9_999_999_999)

EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value", "props")
_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


# ------------------------------------------------------ sources and sinks --
def scan_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{run_dir(spark, 'records')}/table"
    writers.save_records(views.records(spark, sf_dir), path)
    return readers.scan_records(spark, path)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{run_dir(spark, 'csv')}/table"
    columns = TRAINING.fieldNames()
    writers.save_training_csv(views.intake(spark, sf_dir).select(*columns), path)
    back = readers.read_training_csv(spark, path)
    return back.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("bmi").isNull()).alias("n_null_bmi"),
        F.count_if(F.col("gender").isNull()).alias("n_null_gender"),
        F.sum(F.col("id")).alias("sum_id"),
        F.sum(F.col("age").cast("bigint")).alias("sum_age"),
        F.sum(F.col(TARGET).cast("bigint")).alias("sum_stroke"),
        F.min("avg_glucose_level").alias("min_glucose"),
        F.max("bmi").alias("max_bmi"),
    )


def csv_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per outcome, of a CSV with words in the place of some numbers."""
    path = f"{run_dir(spark, 'csv')}/table"
    rows = views.intake(spark, sf_dir).select(*[F.col(name).cast("string") for name in TRAINING.fieldNames()])
    number = F.col("id").cast("bigint")
    bad = rows.withColumns(
        {
            "age": F.when(number % 89 == 0, "old").otherwise(F.col("age")),
            "bmi": F.when(number % 83 == 0, "high").otherwise(F.col("bmi")),
        }
    )
    writers.save_training_csv(bad, path)
    return validate.count_reasons(readers.judge_training_csv(spark, path))


def export_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{run_dir(spark, 'export')}/lines"
    writers.export_json_gz(views.records(spark, sf_dir), path, buckets=64)
    parsed = spark.read.text(path).select(parse_record(F.col("value")).alias("r"))
    return parsed.select("r.*")


def audit_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed, observation = review.audit(
        views.intake(spark, sf_dir).select("id", (F.col(TARGET) == 1).alias("positive")),
        "intake_audit",
        positive="positive",
    )
    observed.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(
        [observation.get], "n bigint, min_id bigint, max_id bigint, n_positive bigint"
    )


# ---------------------------------------------- projections and predicates --
def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.drop_incomplete(views.intake(spark, sf_dir))


def labelled_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.labelled_set(views.intake(spark, sf_dir)).select("id", "label")


def class_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.intake(spark, sf_dir).where(balance.is_positive(TARGET))


def lookup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.lookup(views.records(spark, sf_dir), LOOKUP_IDS)


def lookup_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = views.table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    return review.lookup_many(views.records(spark, sf_dir), wanted)


def _submitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.intake_raw(spark, sf_dir)


def validate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.count_reasons(validate.tag_records(_submitted(spark, sf_dir), RULES))


def validated_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted, _ = validate.validate_records(_submitted(spark, sf_dir), RULES)
    return accepted


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = validate.validate_records(_submitted(spark, sf_dir), RULES)
    return rejected.select("id", "age", "bmi", "reason")


def decode_for_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = review.decode_for_review(views.intake(spark, sf_dir))
    return decoded.select("id", "hypertension", "heart_disease", "work_type")


def message_per_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.rule_scores(spark, sf_dir).select(
        "id", risk_message("a_positive").alias("message")
    )


# -------------------------------------------------- aggregates, ids, splits --
def assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = views.intake_unassigned(spark, sf_dir)
    taken = records.where(F.col("id") >= 0)
    numbered = ids.assign_ids(records, taken, order="seq", output="new_id")
    return numbered.select("seq", "id", "new_id")


def next_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.next_id(views.intake_unassigned(spark, sf_dir))


def top_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.top_record(views.intake(spark, sf_dir))


def review_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.review_summary(views.records(spark, sf_dir), SEED)


def review_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.review_page(views.records(spark, sf_dir), SEED)


def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance.class_balance(views.intake(spark, sf_dir), TARGET)


def class_balance_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance.class_balance(views.table(spark, sf_dir, "labels"), "toxic")


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = balance.with_class_weights(views.intake(spark, sf_dir), TARGET)
    return weighted.select("id", "weights")


def class_weights_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    weighted = balance.with_class_weights(views.table(spark, sf_dir, "labels"), "toxic")
    return weighted.select("doc_id", "weights")


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.when(in_fraction("id", TRAIN_FRACTION, SEED), "train").otherwise("test")
    return (
        views.intake(spark, sf_dir)
        .groupBy(side.alias("side"))
        .agg(F.count("*").alias("n"), F.sum(F.col(TARGET)).alias("n_positive"))
    )


def train_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.intake(spark, sf_dir).where(in_fraction("id", TRAIN_FRACTION, SEED)).select("id")


# ------------------------------------------------------------------ upserts --
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = views.table(spark, sf_dir, "events").select(*EVENT_COLUMNS, "ts")
    return upsert.latest_by_key(events, "user_id", ["ts", "event_id"]).select(*EVENT_COLUMNS)


def upsert_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete records are stored; positive and incomplete ones come in, a year older."""
    records = views.intake(spark, sf_dir)
    incoming = records.where(balance.is_positive(TARGET) | F.col("bmi").isNull()).withColumns(
        {"age": F.col("age") + 1, "version": F.col("id")}
    )
    stored = validate.drop_incomplete(records)
    return upsert.upsert_by_key(stored, incoming, ["version"]).select("id", "age", "bmi", TARGET)


# ----------------------------------------------------------------- features --
def _complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.drop_incomplete(views.records(spark, sf_dir))


def encode_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode_wide(_complete(spark, sf_dir), ["id"], SERVING_SPEC)


def encode_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.feature_ranges(_complete(spark, sf_dir), SERVING_SPEC)


def encode_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.vector_widths(encode.encode(_complete(spark, sf_dir), SERVING_SPEC))


def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.intake(spark, sf_dir).select("id", "bmi")
    filled = learned.impute_mean(rows, ["bmi"]).transform(rows)
    return filled.select("id", F.round("bmi", 6).alias("bmi"))


def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.when(F.col("bmi").isNotNull(), F.col("hypertension")).alias("hypertension")
    rows = views.intake(spark, sf_dir).select("id", known)
    return learned.impute_mode(rows, ["hypertension"]).transform(rows)


def index_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["gender", "work_type", "smoking_status"]
    rows = views.intake(spark, sf_dir).select("id", *names)
    indexed = learned.index_categories(rows, names).transform(rows)
    return indexed.select("id", *[f"{name}_idx" for name in names])


def index_categories_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return learned.index_categories(rows, ["l_orderkey"]).transform(rows)


def learned_encoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _complete(spark, sf_dir)
    values = vector_to_array("features")
    return (
        learned.learned_encoder(rows)
        .transform(rows)
        .select(
            "id",
            F.size(values).alias("width"),
            F.size(F.filter(values, lambda value: value != 0)).alias("nonzeros"),
        )
    )


def learned_encoder_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records, also those with gaps: bmi as it is, one text and one integer category nulled here and there."""
    gaps = {
        "smoking_status": F.when(F.col("id") % 11 != 0, F.col("smoking_status")),
        "hypertension": F.when(F.col("id") % 13 != 0, F.col("hypertension")),
    }
    rows = views.records(spark, sf_dir).withColumns(gaps)
    values = F.transform(vector_to_array("features"), lambda value: F.round(value, 6))
    return learned.learned_encoder(rows).transform(rows).select("id", values.alias("features"))


def learned_encoder_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All that is not zero in the vectors of all records, gaps as above, one row per slot."""
    values = F.posexplode("features").alias("slot", "value")
    return learned_encoder_filled(spark, sf_dir).select("id", values).where("value <> 0")


def _items_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items to be encoded by order and return flag; every fifth order, seventh part and fourth line leaves one out."""
    return views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_orderkey")).alias("order"),
        F.when(F.col("l_partkey") % 7 != 0, F.col("l_returnflag")).alias("mode"),
        F.when(F.col("l_linenumber") != 4, F.col("l_quantity").cast("double")).alias("quantity"),
    )


def learned_encoder_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One slot for each order: fitted, saved, loaded again, and applied to all line items."""
    rows = _items_with_gaps(spark, sf_dir)
    folder = run_dir(spark, "encoder")
    learned.wide_encoder(rows, ["quantity"], ["order", "mode"]).save(spark, folder)
    vector = F.unwrap_udt("features")
    return (
        learned.WideEncoder.load(spark, folder)
        .transform(rows)
        .select(
            "l_orderkey",
            "l_linenumber",
            vector["size"].alias("width"),
            F.array_join(vector["indices"].cast("array<string>"), ",").alias("slots"),
            F.round(F.aggregate(vector["values"], F.lit(0.0), lambda a, b: a + b), 6).alias("total"),
        )
    )


# --------------------------------------------------- evaluation, arbitration --
def _rule_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.intake(spark, sf_dir).select(
        F.col(TARGET).alias("label"), (F.col("age") > 70).alias("prediction")
    )


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion(_rule_prediction(spark, sf_dir))


def hard_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = metrics.hard_areas(metrics.confusion(_rule_prediction(spark, sf_dir)))
    return areas.select(F.round("auroc", 6).alias("auroc"), F.round("auprc", 6).alias("auprc"))


def arbitrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score.arbitrate(views.rule_scores(spark, sf_dir), ["a", "b"]).select("id", "positive")


def arbitrate_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = views.rule_scores(spark, sf_dir)
    first = both.select("id", "a_positive", "a_confidence")
    second = both.select("id", "b_positive", "b_confidence")
    return score.arbitrate_joined(first, second, ["a", "b"], "id").select("id", "positive")


# --------------------------------------------------------------------- JSON --
def export_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record to JSON bytes and back; ``fields`` shows the order they were written in."""
    text = utf8_text(utf8_bytes(record_json()))
    lines = views.records(spark, sf_dir).select(text.alias("json"))
    fields = F.array_join(F.json_object_keys("json"), ",").alias("fields")
    return lines.select(parse_record(F.col("json")).alias("r"), fields).select("r.*", "fields")


def record_json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.records(spark, sf_dir).select(record_json().alias("json"))
    return lines.select(
        json_path(F.col("json"), "$.id").cast("bigint").alias("id"),
        json_path(F.col("json"), "$.work_type").alias("work_type"),
    )


def events_json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        "event_id", json_path(F.col("props"), "$.k").cast("bigint").alias("k")
    )


def export_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        "event_id", export_name(F.col("event_id"), F.col("ts")).alias("name")
    )


# ---------------------------------------------------------------- streaming --
def _table_stream(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    # A file stream takes a folder or a glob; this glob fits a table of either kind.
    return readers.read_intake_stream(spark, f"{sf_dir}/{name}.parque[t]", schema)


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream-upsert")
    events = _table_stream(spark, sf_dir, "events", _EVENTS)
    flows.start_change_log(events, f"{root}/log", f"{root}/checkpoint").awaitTermination()
    log = spark.read.schema(_EVENTS).parquet(f"{root}/log")
    flows.compact(log, f"{root}/snapshot", ["ts", "event_id"], key="user_id")
    return spark.read.parquet(f"{root}/snapshot").select(*EVENT_COLUMNS)


def stream_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream-export")
    events = _table_stream(spark, sf_dir, "events", _EVENTS)
    flows.start_export(
        events, f"{root}/lines", f"{root}/checkpoint", EVENT_COLUMNS
    ).awaitTermination()
    parsed = F.from_json("value", _EVENTS).alias("r")
    return spark.read.text(f"{root}/lines").select(parsed).select(
        *[f"r.{name}" for name in EVENT_COLUMNS]
    )


def _landed(spark: SparkSession, records: DataFrame, root: str) -> DataFrame:
    """The records written to a folder, then read from it as a stream."""
    records.write.parquet(f"{root}/landing")
    return readers.read_intake_stream(
        spark, f"{root}/landing", records.schema, max_bytes=64 * 2**30
    )


def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream-fanout")
    records = flows.accepted_stream(_landed(spark, views.records(spark, sf_dir), root), RULES)
    running = flows.start_fanout(
        records,
        {
            "stored": lambda stream: stream,
            "encoded": lambda stream: encode.encode(stream).select("id", encode.FEATURES),
        },
        root,
    )
    for query in running.values():
        query.awaitTermination()
    stored = readers.scan_records(spark, f"{root}/stored")
    encoded = spark.read.parquet(f"{root}/encoded")
    return stored.agg(
        F.count("*").alias("n_stored"), F.sum("id").alias("sum_id_stored")
    ).select(
        "n_stored",
        "sum_id_stored",
        encoded.agg(F.count("*")).scalar().alias("n_encoded"),
        encoded.agg(F.sum("id")).scalar().alias("sum_id_encoded"),
    )


# ------------------------------------------------------------- fitted models --
ENSEMBLE = ("forest", "gbt")
_trained: dict[tuple[str, str, tuple[str, ...]], dict[str, str]] = {}


def _model_paths(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...]) -> dict[str, str]:
    """Where this application saved the models it trained on ``sf_dir``."""
    key = (spark.sparkContext.applicationId, sf_dir, kinds)
    if key not in _trained:
        records = views.intake(spark, sf_dir)
        out = run_dir(spark, "models")
        trained = train_job(spark, records, out, kinds=kinds)
        _trained[key] = {kind: fitted.path for kind, fitted in trained.items()}
    return _trained[key]


def fitted_models(
    spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = ENSEMBLE
) -> dict[str, Model]:
    together = ENSEMBLE if set(kinds) <= set(ENSEMBLE) else kinds
    paths = _model_paths(spark, sf_dir, together)
    return {kind: readers.load_model(kind, paths[kind]) for kind in kinds}


def score_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = spread(_complete(spark, sf_dir), FIT_PARTITIONS)
    return verdict.verdicts(complete, fitted_models(spark, sf_dir))


def score_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = fitted_models(spark, sf_dir, ("svc",))["svc"]
    return score.score_class(encode.encode(_complete(spark, sf_dir)), "svc", model).select(
        "id", "svc_positive"
    )


def model_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{run_dir(spark, 'model-copy')}/forest"
    writers.save_model(fitted_models(spark, sf_dir, ("forest",))["forest"], path)
    loaded = {"forest": readers.load_model("forest", path)}
    complete = spread(_complete(spark, sf_dir), FIT_PARTITIONS)
    return score.score(encode.encode(complete), loaded).select(
        "id", "forest_positive", "forest_confidence"
    )


def model_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard areas of the verdict over the complete records that no model was trained on."""
    held_out = ~in_fraction("id", TRAIN_FRACTION, SEED)
    labelled = encode.labelled_set(validate.drop_incomplete(views.intake(spark, sf_dir).where(held_out)))
    encoded = encode.encode(spread(labelled, FIT_PARTITIONS))
    judged = score.arbitrate(
        score.score(encoded, fitted_models(spark, sf_dir)), ["forest", "gbt"], "prediction"
    )
    return metrics.hard_areas(metrics.confusion(judged))


def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    models = fitted_models(spark, sf_dir)
    root = run_dir(spark, "stream-score")
    records = flows.accepted_stream(_landed(spark, views.records(spark, sf_dir), root), RULES)
    landed = readers.scan_records(spark, f"{root}/landing").count()
    flows.start_scoring(
        records,
        models,
        f"{root}/verdicts",
        f"{root}/checkpoint",
        partitions=partitions_for(landed, FIT_PARTITIONS),
    ).awaitTermination()
    return spark.read.parquet(f"{root}/verdicts").select("id", "positive")


def intake_to_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    submitted = _submitted(spark, sf_dir).withColumn("seq", F.col("id"))
    result = score_batch(
        spark,
        submitted,
        store=_complete(spark, sf_dir),
        models=fitted_models(spark, sf_dir),
        out=run_dir(spark, "intake"),
        order="seq",
        rules=RULES,
        partitions=FIT_PARTITIONS,
    )
    return result.verdicts.select("id", "positive", "message")


QUERIES = {
    "scan_intake": scan_intake,
    "csv_round_trip": csv_round_trip,
    "csv_rejected": csv_rejected,
    "export_round_trip": export_round_trip,
    "audit_metrics": audit_metrics,
    "drop_incomplete": drop_incomplete,
    "labelled_set": labelled_set,
    "class_filter": class_filter,
    "lookup_by_id": lookup_by_id,
    "lookup_many": lookup_many,
    "validate_reasons": validate_reasons,
    "validated_ok": validated_ok,
    "rejected_rows": rejected_rows,
    "decode_for_review": decode_for_review,
    "risk_message": message_per_record,
    "assign_ids": assign_ids,
    "next_id": next_id,
    "top_record": top_record,
    "review_summary": review_summary,
    "review_page": review_page,
    "class_balance": class_balance,
    "class_balance_labels": class_balance_labels,
    "class_weights": class_weights,
    "class_weights_labels": class_weights_labels,
    "split_counts": split_counts,
    "train_split": train_split,
    "upsert_latest": upsert_latest,
    "upsert_records": upsert_records,
    "encode_features": encode_features,
    "encode_stats": encode_stats,
    "encode_width": encode_width,
    "impute_mean": impute_mean,
    "impute_mode": impute_mode,
    "index_categories": index_categories,
    "index_categories_wide": index_categories_wide,
    "learned_encoder": learned_encoder,
    "learned_encoder_filled": learned_encoder_filled,
    "learned_encoder_slots": learned_encoder_slots,
    "learned_encoder_wide": learned_encoder_wide,
    "confusion": confusion,
    "hard_auc": hard_auc,
    "arbitrate": arbitrate,
    "arbitrate_joined": arbitrate_joined,
    "export_json": export_json,
    "json_path": record_json_path,
    "events_json_path": events_json_path,
    "export_name": export_names,
    "stream_upsert": stream_upsert,
    "stream_export": stream_export,
    "stream_fanout": stream_fanout,
    "score_ensemble": score_ensemble,
    "score_svc": score_svc,
    "model_round_trip": model_round_trip,
    "model_evaluation": model_evaluation,
    "stream_score": stream_score,
    "intake_to_verdict": intake_to_verdict,
    **ONLINE,
}
