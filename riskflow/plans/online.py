"""The named queries on the online flow: streams, the record store, models with a known answer."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.records import record_json
from riskflow.operators import balance, encode, score, validate
from riskflow.operators.ids import next_id
from riskflow.operators.store import RecordStore
from riskflow.plans import views
from riskflow.plans.jobs import IntakeResult, score_batch, spread, train_job
from riskflow.schema import INTAKE, INTAKE_COLUMNS, TARGET, without_steps
from riskflow.sources import readers, writers
from riskflow.streaming import audit, flows, intake
from riskflow.workspace import run_dir, write_once

RULES = without_steps()
LOOKUP_IDS = (0, 42, 1234, 9_999_999_999)
EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value", "props")
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
#: Parts in which a table arrives.
ARRIVALS = 4


def _arrivals(df: DataFrame, key: str) -> list[DataFrame]:
    """All rows, cut at ``ARRIVALS - 1`` values of the key, in order."""
    low, high = df.agg(F.min(key), F.max(key)).first()
    width = (high - low) // ARRIVALS + 1 if low is not None else 1
    part = F.floor((F.col(key) - F.lit(low or 0)) / width)
    return [df.where(part == i) for i in range(ARRIVALS)]


# ---------------------------------------------------------------- store --
def _versioned(df: DataFrame, version) -> DataFrame:
    return df.withColumn("version", version.cast("bigint"))


def store_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The complete records are stored; positive and incomplete ones are put, a year older, twice."""
    records = views.intake(spark, sf_dir)
    stored = _versioned(validate.drop_incomplete(records), F.lit(-1))
    coming = records.where(balance.is_positive(TARGET) | F.col("bmi").isNull())
    coming = _versioned(coming.withColumn("age", F.col("age") + 1), F.col("id"))
    store = RecordStore.create(spark, f"{run_dir(spark, 'store')}/records", stored.schema, ["version"])
    store.put(stored)
    store.put(coming)
    store.put(coming)
    return store.read().select("id", "age", "bmi", TARGET)


def lookup_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _versioned(views.records(spark, sf_dir), F.col("id"))
    store = RecordStore.create(spark, f"{run_dir(spark, 'store')}/records", records.schema, ["version"])
    store.put(records)
    return store.lookup(LOOKUP_IDS).select(*INTAKE_COLUMNS)


# --------------------------------------------------------------- streams --
def stream_assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records without id arrive in four parts; the others are in use already."""
    records = views.intake_unassigned(spark, sf_dir)
    root = run_dir(spark, "stream-ids")
    kept = records.where("id >= 0").select("seq", "id", F.col("id").alias("new_id"))
    first = next_id(kept).first()["next_id"]
    for part in _arrivals(records.where("id < 0"), "seq"):
        part.write.mode("append").parquet(f"{root}/landing")
        landed = readers.read_intake_stream(spark, f"{root}/landing", records.schema)
        intake.start_numbering(landed, root, f"{root}/checkpoint", first, ["seq"]).awaitTermination()
    numbered = spark.read.parquet(f"{root}/log")
    return kept.unionByName(numbered.select("seq", F.lit(-1).cast("bigint").alias("id"), F.col("id").alias("new_id")))


def _submitted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON as a form sends it; some lines break off."""
    whole = record_json()
    line = F.when(F.col("id") % 101 == 0, F.substring(whole, 1, 30)).otherwise(whole)
    return views.intake_raw(spark, sf_dir).select(line.alias("value"))


def stream_intake_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "stream-text")
    _submitted_lines(spark, sf_dir).write.text(f"{root}/landing")
    lines = intake.read_lines_stream(spark, f"{root}/landing")
    intake.start_intake(lines, f"{root}/judged", f"{root}/checkpoint", RULES).awaitTermination()
    judged = spark.read.schema(intake.judged_schema()).parquet(f"{root}/judged")
    return validate.count_reasons(judged)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(*EVENTS.names)


def _event_store(spark: SparkSession, root: str) -> RecordStore:
    return RecordStore.create(spark, f"{root}/store", EVENTS, ["ts", "event_id"], key="user_id")


def stream_compact_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the events, compaction, the other half, compaction."""
    root = run_dir(spark, "stream-compact")
    store = _event_store(spark, root)
    for half in (0, 1):
        part = _events(spark, sf_dir).where(F.pmod("event_id", F.lit(2)) == half)
        part.write.mode("append").parquet(f"{root}/landing")
        landed = readers.read_intake_stream(spark, f"{root}/landing", EVENTS)
        flows.start_change_log(landed, f"{root}/log", f"{root}/log-checkpoint").awaitTermination()
        log = readers.read_intake_stream(spark, f"{root}/log", EVENTS)
        flows.start_compaction(log, store, f"{root}/store-checkpoint").awaitTermination()
    return RecordStore.open(spark, store.path).read().select(*EVENT_COLUMNS)


def stream_state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest events arrive first, so that later batches must not replace them."""
    root = run_dir(spark, "stream-state")
    store = _event_store(spark, root)
    for part in reversed(_arrivals(_events(spark, sf_dir), "event_id")):
        part.write.mode("append").parquet(f"{root}/landing")
        landed = readers.read_intake_stream(spark, f"{root}/landing", EVENTS)
        flows.start_latest(landed, store, f"{root}/checkpoint").awaitTermination()
    return RecordStore.open(spark, store.path).read().select(*EVENT_COLUMNS)


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the micro-batches when one file at a time is let in."""
    root = run_dir(spark, "stream-batches")
    records = write_once(views.records(spark, sf_dir), "records")
    for part in _arrivals(records, "id"):
        # A file is written by one task; all that this task does is to copy rows that many have written.
        write_once(part, "arrival").coalesce(1).write.mode("append").parquet(f"{root}/landing")
    landed = readers.read_intake_stream(spark, f"{root}/landing", INTAKE, max_files=1)
    query = flows.start_append(landed, f"{root}/out", f"{root}/checkpoint")
    query.awaitTermination()
    sizes = [(p["batchId"], p["numInputRows"]) for p in query.recentProgress if p["numInputRows"]]
    return spark.createDataFrame(sizes, "batch bigint, n bigint")


def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of a scored stream, added up over its batches."""
    root = run_dir(spark, "stream-audit")
    scored = views.intake(spark, sf_dir).select("id", (F.col(TARGET) == 1).alias("positive"))
    for part in _arrivals(scored, "id"):
        part.write.mode("append").parquet(f"{root}/landing")
    landed = readers.read_intake_stream(spark, f"{root}/landing", scored.schema, max_files=2)
    listener = audit.listen(spark)
    try:
        watched = audit.observed(landed, "scored", positive="positive")
        query = flows.start_append(watched, f"{root}/out", f"{root}/checkpoint")
        query.awaitTermination()
        listener.wait_for(query)
    finally:
        spark.streams.removeListener(listener)
    schema = "n bigint, min_id bigint, max_id bigint, n_positive bigint"
    return spark.createDataFrame([listener.totals("scored")], schema)


def stream_arbitrate_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both scorers run as streams of their own, and what they say of a record is joined."""
    root = run_dir(spark, "stream-join")
    both = views.rule_scores(spark, sf_dir)
    # Scored at moments that follow the ids, ten records a second, the second scorer a little later.
    moment = F.timestamp_seconds(F.floor(F.col("id") / 10) + 1_700_000_000)
    sides = []
    for name, delay in (("a", 0), ("b", 3)):
        columns = [f"{name}_positive", f"{name}_confidence"]
        at = (moment + F.expr(f"INTERVAL {delay} SECONDS")).alias(f"{name}_at")
        side = both.select("id", *columns, at)
        side.write.parquet(f"{root}/{name}")
        sides.append(readers.read_intake_stream(spark, f"{root}/{name}", side.schema))
    joined = flows.arbitrate_streams(*sides, ["a", "b"], ["a_at", "b_at"])
    flows.start_append(joined, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("id", "positive")


# ------------------------------------------- models with a known answer --
#: Partitions of a fit, and of scoring, at least.
PARTITIONS = 8
KINDS = ("forest", "gbt", "svc")
_learned: dict[tuple[str, str], dict[str, str]] = {}


def learned_models(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] = KINDS[:2]) -> dict[str, Model]:
    """Models of a target that is one of the fields, so that a right model makes no mistake."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _learned:
        records = views.intake(spark, sf_dir).withColumn(TARGET, F.col("heart_disease"))
        trained = train_job(spark, records, run_dir(spark, "learned"), kinds=KINDS, partitions=PARTITIONS)
        _learned[key] = {kind: fitted.path for kind, fitted in trained.items()}
    return {kind: readers.load_model(kind, _learned[key][kind]) for kind in kinds}


def _encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = validate.drop_incomplete(views.records(spark, sf_dir))
    return encode.encode(spread(complete, PARTITIONS))


def _scored(rows: DataFrame, kind: str, model: Model) -> DataFrame:
    """Class, and whether its confidence is that of the likelier of two."""
    confidence = F.col(f"{kind}_confidence")
    scored = score.score(rows, {kind: model})
    return scored.select("id", F.col(f"{kind}_positive").alias("positive"), confidence.between(0.5, 1).alias("sure"))


def score_learned_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(_encoded(spark, sf_dir), "forest", learned_models(spark, sf_dir)["forest"])


def score_learned_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(_encoded(spark, sf_dir), "gbt", learned_models(spark, sf_dir)["gbt"])


def score_learned_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = learned_models(spark, sf_dir, KINDS)["svc"]
    scored = score.score_class(_encoded(spark, sf_dir), "svc", model)
    return scored.select("id", F.col("svc_positive").alias("positive"))


def model_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save what was loaded, load that, and score."""
    copies = {}
    for kind, model in learned_models(spark, sf_dir).items():
        path = f"{run_dir(spark, 'model-copy')}/{kind}"
        writers.save_model(model, path)
        copies[kind] = readers.load_model(kind, path)
    judged = score.arbitrate(score.score(_encoded(spark, sf_dir), copies), list(copies))
    return judged.select("id", "positive")


def stream_score_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submitted lines, judged, numbered and scored, each by a stream of its own."""
    root = run_dir(spark, "stream-learned")
    _submitted_lines(spark, sf_dir).write.text(f"{root}/landing")
    lines = intake.read_lines_stream(spark, f"{root}/landing")
    intake.start_intake(lines, f"{root}/judged", f"{root}/judged-checkpoint", RULES).awaitTermination()
    judged = spark.readStream.schema(intake.judged_schema()).parquet(f"{root}/judged")
    intake.start_numbering(intake.accepted_from(judged), root, f"{root}/log-checkpoint").awaitTermination()
    flows.start_scoring(
        intake.read_log_stream(spark, root),
        learned_models(spark, sf_dir),
        f"{root}/verdicts",
        f"{root}/verdicts-checkpoint",
    ).awaitTermination()
    return spark.read.parquet(f"{root}/verdicts").select("id", "positive", "message")


def _taken_in(spark: SparkSession, sf_dir: str) -> IntakeResult:
    """A store that holds all complete records a year younger, and the submissions put into it."""
    root = run_dir(spark, "intake")
    younger = validate.drop_incomplete(views.records(spark, sf_dir)).withColumn("age", F.col("age") - 1)
    younger = younger.withColumn("seq", F.lit(-1).cast("bigint"))
    store = RecordStore.create(spark, f"{root}/store", younger.schema, ["seq"])
    store.put(younger)
    submitted = views.intake_raw(spark, sf_dir).withColumn("seq", F.col("id"))
    models = learned_models(spark, sf_dir)
    return score_batch(spark, submitted, store, models, root + "/batch", "seq", RULES, PARTITIONS)


def intake_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _taken_in(spark, sf_dir).verdicts.select("id", "positive", "message")


def intake_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _taken_in(spark, sf_dir).stored


def intake_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _taken_in(spark, sf_dir).rejected.select("id", "age", "reason")


ONLINE = {
    "store_upsert_bucketed": store_upsert_bucketed,
    "lookup_bucketed": lookup_bucketed,
    "stream_assign_ids": stream_assign_ids,
    "stream_intake_text": stream_intake_text,
    "stream_compact_twice": stream_compact_twice,
    "stream_state_latest": stream_state_latest,
    "stream_batches": stream_batches,
    "stream_audit": stream_audit,
    "stream_arbitrate_joined": stream_arbitrate_joined,
    "score_learned_forest": score_learned_forest,
    "score_learned_gbt": score_learned_gbt,
    "score_learned_svc": score_learned_svc,
    "model_reload": model_reload,
    "stream_score_learned": stream_score_learned,
    "intake_verdicts": intake_verdicts,
    "intake_stored": intake_stored,
    "intake_rejected": intake_rejected,
}
