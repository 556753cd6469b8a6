"""Submitted text as a stream, and ids for what was accepted.

``start_intake`` judges each submitted line once and keeps all of them, in one folder
per outcome.  ``start_numbering`` gives the accepted records an arrival number and, if
they have none, an id, and puts each batch into a folder of its own; that is the log
which scoring, storing and export read.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskflow.operators.ids import is_unassigned, number_in_order
from riskflow.operators.validate import REASON, accepted_records, first_broken_rule, rejected_records
from riskflow.schema import FORM_RULES, ID, INTAKE, Rule
from riskflow.sources import files
from riskflow.streaming.flows import start_append
from riskflow.workspace import write_once

ACCEPTED, ARRIVAL, BATCH, LINE, FILE = "accepted", "arrival", "batch", "line", "file"
MALFORMED = "line:malformed"
_CORRUPT = "__corrupt"


def read_lines_stream(
    spark: SparkSession, path: str, max_files: int | None = None, max_bytes: int | None = None
) -> DataFrame:
    """Text lines as they land, with the file each came from."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.text(path).select(F.col("value").alias(LINE), F.col("_metadata.file_path").alias(FILE))


def judge_lines(
    lines: DataFrame, rules: tuple[Rule, ...] = FORM_RULES, schema: T.StructType = INTAKE
) -> DataFrame:
    """Each line with the fields submitted in it as text, ``reason`` and ``accepted``.

    A line that is no JSON object is kept whole, with reason ``line:malformed``; fields
    outside the schema stay in the line.  Batch or stream.
    """
    fields = T.StructType([*(T.StructField(name, T.StringType()) for name in schema.names), T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = lines.withColumn("__r", F.from_json(LINE, fields, options))
    parsed = parsed.select(*lines.columns, *(F.col("__r")[name].alias(name) for name in fields.names))
    # Neither an array nor a bare value is a record, though both are JSON.
    no_object = F.col(_CORRUPT).isNotNull() | ~F.coalesce(F.col(LINE).rlike(r"^\s*\{"), F.lit(False))
    reason = F.when(no_object, F.lit(MALFORMED)).otherwise(first_broken_rule(rules, schema))
    judged = parsed.withColumn(REASON, reason).drop(_CORRUPT)
    return judged.withColumn(ACCEPTED, F.col(REASON).isNull())


def judged_schema(schema: T.StructType = INTAKE) -> T.StructType:
    text = [LINE, FILE, *schema.names, REASON]
    return T.StructType([*(T.StructField(n, T.StringType()) for n in text), T.StructField(ACCEPTED, T.BooleanType())])


def start_intake(
    lines: DataFrame, path: str, checkpoint: str, rules: tuple[Rule, ...] = FORM_RULES, **how
) -> StreamingQuery:
    """Judge lines once; ``path`` gets a folder for the accepted and one for the rejected ones."""
    return start_append(judge_lines(lines, rules), path, checkpoint, partition_by=[ACCEPTED], **how)


def accepted_from(judged: DataFrame, schema: T.StructType = INTAKE) -> DataFrame:
    """Typed records of what ``start_intake`` accepted, batch or stream; a missing id is -1."""
    return accepted_records(judged.where(ACCEPTED).drop(ACCEPTED, LINE), schema)


def rejected_from(judged: DataFrame) -> DataFrame:
    """Whole lines that were not accepted, with the reason."""
    return rejected_records(judged.where(~F.col(ACCEPTED))).select(LINE, FILE, REASON)


@dataclass(frozen=True)
class Numbered:
    """What a batch got: ``n_fresh`` ids from ``first_id``, ``n`` arrival numbers from ``first_arrival``."""

    batch: int
    first_id: int
    n_fresh: int
    first_arrival: int
    n: int
    #: First id that no record of this or an earlier batch has.
    next_id: int


class Ledger:
    """One small file per batch, written before the batch's records become visible."""

    def __init__(self, spark: SparkSession, path: str, first_free: int):
        self.spark, self.path, self.first_free = spark, path, first_free
        files.make_folder(spark, path)

    def batches(self) -> list[int]:
        names = files.names(self.spark, self.path)
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def entry(self, batch: int) -> Numbered:
        return Numbered(**json.loads(files.read_text(self.spark, f"{self.path}/{batch}.json")))

    def before(self, batch: int) -> Numbered:
        earlier = [b for b in self.batches() if b < batch]
        return self.entry(earlier[-1]) if earlier else Numbered(-1, 0, 0, 0, 0, self.first_free)

    def add(self, entry: Numbered) -> None:
        files.write_new(self.spark, f"{self.path}/{entry.batch}.json", json.dumps(asdict(entry)))


def number_batch(batch: DataFrame, number: int, root: str, ledger: Ledger, order: list[str], key: str = ID) -> None:
    """Write one batch, numbered, to ``<root>/log/batch=<number>``.

    The ledger says from where a batch counts.  A batch that comes again after a failure
    finds its entry, or its finished folder, there, and gets the same numbers: the order
    is that of ``order`` and then of all columns, so only equal rows could change places.
    """
    spark = batch.sparkSession
    target = f"{root}/log/{BATCH}={number}"
    if files.exists(spark, target):
        return
    rows = write_once(batch, "numbering")
    fresh = is_unassigned(key)
    if number in ledger.batches():
        entry = ledger.entry(number)
    else:
        before = ledger.before(number)
        sums = rows.agg(F.count("*"), F.count_if(fresh), F.max(F.when(~fresh, F.col(key)))).first()
        taken = before.next_id if sums[2] is None else max(before.next_id, sums[2] + 1)
        entry = Numbered(
            number, taken, sums[1], before.first_arrival + before.n, sums[0], taken + sums[1]
        )
        ledger.add(entry)
    # Records without an id first: they take the ids, then all take the arrival numbers.
    in_order = [(~fresh).cast("int"), *order, *(c for c in rows.columns if c not in order)]
    numbered = number_in_order(rows, in_order, "__number")
    given = F.when(fresh, F.lit(entry.first_id) + F.col("__number")).otherwise(F.col(key)).cast("bigint")
    numbered = numbered.withColumn(ARRIVAL, (F.lit(entry.first_arrival) + F.col("__number")).cast("bigint"))
    numbered = numbered.withColumn(key, given).drop("__number")
    hidden = f"{root}/_unfinished/{BATCH}={number}"
    numbered.write.mode("overwrite").parquet(hidden)
    files.move(spark, hidden, target)


def start_numbering(
    records: DataFrame,
    root: str,
    checkpoint: str,
    first_free: int = 0,
    order: list[str] | None = None,
    key: str = ID,
    available_now: bool = True,
    name: str | None = None,
) -> StreamingQuery:
    """Number accepted records as they come: ids from ``first_free`` on, dense over all batches.

    ``<root>/log`` holds the records with ``arrival``, ``<root>/ledger`` what each batch
    got.  An explicit id is kept, and later automatic ids start after it.
    """
    spark = records.sparkSession
    ledger = Ledger(spark, f"{root}/ledger", first_free)
    files.make_folder(spark, f"{root}/log")
    order = order if order is not None else [FILE] if FILE in records.columns else []

    def number(batch: DataFrame, batch_id: int) -> None:
        number_batch(batch, batch_id, root, ledger, order, key)

    writer = records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(number)
    if name is not None:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def log_schema(schema: T.StructType = INTAKE) -> T.StructType:
    """Of the log that ``start_numbering`` writes from judged lines."""
    more = [(FILE, T.StringType()), (ARRIVAL, T.LongType()), (BATCH, T.LongType())]
    return T.StructType([*schema.fields, *(T.StructField(name, kind) for name, kind in more)])


def read_log_stream(spark: SparkSession, root: str, schema: T.StructType = INTAKE) -> DataFrame:
    """The numbered records as they come."""
    return spark.readStream.schema(log_schema(schema)).parquet(f"{root}/log")
