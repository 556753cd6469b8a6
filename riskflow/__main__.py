"""Jobs for ``spark-submit``: train, score, serve, review, export."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import secrets

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskflow.functions.sqltext import quoted
from riskflow.operators.review import lookup, review_page
from riskflow.operators.store import RecordStore
from riskflow.operators.validate import REASON
from riskflow.operators.verdict import verdicts
from riskflow.plans.jobs import score_batch, train_job
from riskflow.schema import INTAKE
from riskflow.sources import files
from riskflow.sources.readers import load_model, read_training_csv, scan_records
from riskflow.sources.writers import export_folder, export_json_gz
from riskflow.streaming import audit, flows, intake
from riskflow.workspace import write_once


def _models(folder: str) -> dict:
    return {kind: load_model(kind, f"{folder}/{kind}") for kind in ("forest", "gbt")}


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    trained = train_job(spark, read_training_csv(spark, args.csv), args.out, args.kinds)
    print(json.dumps({kind: result.hard for kind, result in trained.items()}))


def _store(spark: SparkSession, path: str) -> RecordStore:
    """The store in a folder, or a new one."""
    if RecordStore.versions(spark, path):
        return RecordStore.open(spark, path)
    schema = T.StructType([*INTAKE.fields, T.StructField(intake.ARRIVAL, T.LongType())])
    return RecordStore.create(spark, path, schema, [intake.ARRIVAL])


def _records(spark: SparkSession, path: str) -> DataFrame:
    """The records of a store, or of a plain folder."""
    if RecordStore.versions(spark, path):
        return RecordStore.open(spark, path).read().select(*INTAKE.names)
    return scan_records(spark, path)


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    """One batch of submissions; the next state of the store is under ``out``."""
    store = scan_records(spark, args.store) if args.store else spark.createDataFrame([], INTAKE)
    schema = T.StructType([*INTAKE.fields, T.StructField(args.order, T.LongType())])
    lines = spark.read.text(args.submitted).select(F.col("value").alias(intake.LINE))
    judged = write_once(intake.judge_lines(lines, schema=schema), "lines")
    malformed = judged.where(F.col(REASON) == intake.MALFORMED)
    malformed.select(intake.LINE).write.text(f"{args.out}/malformed")
    # Text as submitted; a field that is absent reads as null.
    submitted = judged.where(f"{REASON} IS DISTINCT FROM '{intake.MALFORMED}'")
    submitted = submitted.select(*INTAKE.names, F.col(quoted(args.order)).try_cast("bigint").alias(args.order))
    result = score_batch(
        spark, submitted, store, _models(args.models), args.out, args.order, partitions=args.partitions
    )
    print(json.dumps({**result.paths, "malformed": f"{args.out}/malformed", "counters": result.counters}))


def serve(spark: SparkSession, args: argparse.Namespace) -> None:
    """Judge, number, store and score submitted lines of JSON as they land, until stopped.

    Each line is parsed and judged once, into ``judged``; the accepted records get their
    ids in ``log``, from which ``store`` and ``verdicts`` follow, each at its own pace.
    """
    out, models, listener = args.out, _models(args.models), audit.listen(spark)
    store = _store(spark, args.store or f"{out}/store")
    lines = intake.read_lines_stream(spark, args.landing, max_files=args.max_files)
    judged_schema, how = intake.judged_schema(), {"available_now": args.once}

    def judge() -> StreamingQuery:
        return intake.start_intake(lines, f"{out}/judged", f"{out}/judged-checkpoint", **how)

    def number() -> StreamingQuery:
        judged = spark.readStream.schema(judged_schema).parquet(f"{out}/judged")
        records = audit.observed(intake.accepted_from(judged), "accepted")
        return intake.start_numbering(records, out, f"{out}/log-checkpoint", store.next_id(), **how)

    def put() -> StreamingQuery:
        return flows.start_compaction(intake.read_log_stream(spark, out), store, f"{out}/store-checkpoint", **how)

    def decide() -> StreamingQuery:
        scored = verdicts(intake.read_log_stream(spark, out), models)
        watched = audit.observed(scored, "scored", positive="positive")
        return flows.start_append(watched, f"{out}/verdicts", f"{out}/verdicts-checkpoint", **how)

    files.make_folder(spark, f"{out}/judged")
    files.make_folder(spark, f"{out}/log")
    if not args.once:
        for start in (judge, number, put, decide):
            start()
        spark.streams.awaitAnyTermination()
    for start in (judge, number, put, decide):
        query = start()
        query.awaitTermination()
        listener.wait_for(query)
    spark.streams.removeListener(listener)
    print(json.dumps({name: listener.totals(name) for name in ("accepted", "scored")}))


def review(spark: SparkSession, args: argparse.Namespace) -> None:
    """A stored record drawn anew on each call, unless a seed is given."""
    seed = secrets.randbelow(1 << 31) if args.seed is None else args.seed
    print(f"seed {seed}")
    review_page(_records(spark, args.store), seed).show(vertical=True, truncate=False)


def export(spark: SparkSession, args: argparse.Namespace) -> None:
    if RecordStore.versions(spark, args.store):
        found = RecordStore.open(spark, args.store).lookup([args.id]).select(*INTAKE.names)
    else:
        found = lookup(scan_records(spark, args.store), [args.id])
    path = export_folder(args.out, args.id, dt.datetime.now())
    counters = export_json_gz(found, path)
    print(path)
    print(json.dumps(counters))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="riskflow", description=__doc__)
    commands = parser.add_subparsers(required=True)

    def command(action, *options):
        sub = commands.add_parser(action.__name__, help=action.__doc__)
        for name, settings in options:
            sub.add_argument(f"--{name}", **settings)
        sub.set_defaults(action=action)

    needed = {"required": True}
    command(
        train,
        ("csv", needed),
        ("out", needed),
        ("kinds", {"nargs": "+", "default": ["forest", "gbt"]}),
    )
    command(
        score,
        ("submitted", needed),
        ("store", {}),
        ("models", needed),
        ("out", needed),
        ("order", {"default": "seq"}),
        ("partitions", {"type": int}),
    )
    command(
        serve,
        ("landing", needed),
        ("models", needed),
        ("out", needed),
        ("store", {}),
        ("max-files", {"type": int}),
        ("once", {"action": "store_true"}),
    )
    command(review, ("store", needed), ("seed", {"type": int}))
    command(export, ("store", needed), ("id", {"type": int, "required": True}), ("out", needed))
    args = parser.parse_args(argv)
    args.action(SparkSession.builder.appName("riskflow").getOrCreate(), args)


if __name__ == "__main__":
    main()
