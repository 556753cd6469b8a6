"""Whole jobs: train the models, take in a batch of submissions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.hashing import in_fraction
from riskflow.operators.balance import with_class_weights
from riskflow.operators.encode import training_set
from riskflow.operators.ids import assign_ids, is_unassigned
from riskflow.operators.metrics import evaluate_hard, evaluate_raw
from riskflow.operators.review import audit
from riskflow.operators.store import RecordStore
from riskflow.operators.train import train_forest, train_gbt, train_svc
from riskflow.operators.upsert import upsert_by_key
from riskflow.operators.validate import (
    REASON,
    accepted_records,
    rejected_records,
    tag_records,
)
from riskflow.operators.verdict import verdicts
from riskflow.schema import ATTRIBUTES, FORM_RULES, ID, INTAKE_COLUMNS, TRAIN_FRACTION, Rule
from riskflow.sources.readers import load_model, scan_records
from riskflow.sources.writers import save_model
from riskflow.workspace import ensure_checkpoint_dir, run_dir

TRAINING_TABLE = T.StructType(
    [
        T.StructField(ID, T.LongType()),
        T.StructField("features", VectorUDT()),
        T.StructField("label", T.DoubleType()),
        T.StructField("side", T.StringType()),
    ]
)
#: Partitions of a training side at least, unless the job names another number.  Bagging follows
#: the layout, so it must depend neither on the cores nor on how the files were packed.
FIT_PARTITIONS = 32
#: Rows of a partition at most, on average.  A fit of 200 trees holds 1 kB for each.
PARTITION_ROWS = 200_000
TRAINERS = {"forest": train_forest, "gbt": train_gbt, "svc": train_svc}


@dataclass
class TrainedModel:
    model: Model
    path: str
    hard: dict[str, float]
    raw: dict[str, float] | None = None


def partitions_for(rows: int, least: int) -> int:
    """``least``, or as many as keep a partition at ``PARTITION_ROWS``; it follows from the rows alone."""
    return max(least, -(-rows // PARTITION_ROWS))


def spread(df: DataFrame, least: int) -> DataFrame:
    """The rows dealt out evenly to ``least`` tasks, or more where they are many; counts them first."""
    return df.repartition(partitions_for(df.count(), least))


def write_training_table(
    spark: SparkSession, records: DataFrame, fraction: float = TRAIN_FRACTION, seed: int = 42
) -> str:
    """Encode the complete records into a table with one folder per side; returns its path.

    The source is read once, here; every fit and evaluation reads its own
    folder and nothing else.  The table outlives lost executors, needs no
    executor memory, and cuts the lineage.
    """
    path = f"{run_dir(spark, 'training')}/set"
    # A record without an id is drawn by its attributes.
    drawn = F.coalesce(F.col(ID).cast("string"), F.md5(F.to_json(F.struct(*ATTRIBUTES))))
    placed = records.withColumn("_drawn", drawn)
    side = F.when(in_fraction("_drawn", fraction, seed), "train").otherwise("test")
    training_set(placed, extra=("_drawn",)).withColumn("side", side).drop("_drawn").write.partitionBy(
        "side"
    ).parquet(path)
    return path


def training_side(
    spark: SparkSession, path: str, side: str, partitions: int = FIT_PARTITIONS
) -> DataFrame:
    """The ``train`` or ``test`` folder, weighted by the class balance of both.

    The balance is a subquery over the label column of the table.  Rows are laid
    out by id, so that a fit is the same on any cluster; in ``partitions`` parts, more
    for a side of more than ``PARTITION_ROWS`` rows a part.  On a side of more than
    ``PARTITION_ROWS`` rows, those without an id are laid out by what they hold: by id
    they would all be in one part.
    """
    table = spark.read.schema(TRAINING_TABLE).parquet(path)
    on_side = F.col("side") == side
    rows = table.where(on_side).count()
    content = F.xxhash64(vector_to_array("features"), "label")
    place = F.col(ID) if rows <= PARTITION_ROWS else F.when(is_unassigned(), content).otherwise(F.col(ID))
    return (
        with_class_weights(table)
        .where(on_side)
        .repartition(partitions_for(rows, partitions), place)
        .sortWithinPartitions(ID, content)
    )


def train_job(
    spark: SparkSession,
    records: DataFrame,
    out: str,
    kinds: Sequence[str] = ("forest", "gbt"),
    options: Mapping[str, dict] | None = None,
    seed: int = 42,
    raw_areas: bool = False,
    partitions: int = FIT_PARTITIONS,
) -> dict[str, TrainedModel]:
    """Fit on 70 % of the records, evaluate on the rest, then save each model under ``out``.

    Evaluated is the model as read back from a first copy: what serving will
    load, without the training summary, which would pull the session into
    every scoring task.  ``raw_areas`` adds the areas over the continuous
    score; they sort the whole test side.
    """
    ensure_checkpoint_dir(spark)
    fresh = run_dir(spark, "fitted")
    table = write_training_table(spark, records, seed=seed)
    test = training_side(spark, table, "test")
    trained = {}
    for kind in kinds:
        train = training_side(spark, table, "train", partitions)
        save_model(TRAINERS[kind](train, **(options or {}).get(kind, {})), f"{fresh}/{kind}")
        model = load_model(kind, f"{fresh}/{kind}")
        tested = model.transform(test)
        hard, raw = evaluate_hard(tested), evaluate_raw(tested) if raw_areas else None
        path = f"{out}/{kind}"
        save_model(model, path)
        trained[kind] = TrainedModel(model, path, hard, raw)
    return trained


@dataclass
class IntakeResult:
    verdicts: DataFrame
    stored: DataFrame
    rejected: DataFrame
    paths: dict[str, str] = field(default_factory=dict)
    #: Records scored, their range of ids, and how many are positive.
    counters: dict[str, int] = field(default_factory=dict)


def score_batch(
    spark: SparkSession,
    submitted: DataFrame,
    store: DataFrame | RecordStore,
    models: Mapping[str, Model],
    out: str,
    order: str,
    rules: tuple[Rule, ...] = FORM_RULES,
    partitions: int | None = None,
) -> IntakeResult:
    """Validate, number, store and score one batch of submissions.

    ``order`` is the unique arrival number.  The submissions are parsed and
    judged once, into a table with a folder per outcome.  The numbered records
    are written too, so that storing and scoring see the same ids.  A
    :class:`RecordStore`, which must have ``order`` as its order, gets the batch
    put into the buckets it touches, and knows its highest id.  The next state of
    a store given as a frame goes to a new folder under ``out``; the store that
    was read stays as it is.  ``partitions`` says in how many tasks records are
    scored at least, see :func:`spread`; by default they are scored as they are written.
    """
    paths = {name: f"{out}/{name}" for name in ("submitted", "numbered", "store", "verdicts")}
    tagged = tag_records(submitted, rules)
    schema = T.StructType([*tagged.schema.fields, T.StructField("accepted", T.BooleanType())])
    judged = tagged.withColumn("accepted", F.col(REASON).isNull())
    judged.write.partitionBy("accepted").parquet(paths["submitted"])
    judged = spark.read.schema(schema).parquet(paths["submitted"])

    accepted = accepted_records(judged.where("accepted").drop("accepted"))
    accepted = accepted.select(*INTAKE_COLUMNS, order)
    bucketed = isinstance(store, RecordStore)
    highest = spark.range(store.next_id() - 1, store.next_id()).toDF(ID) if bucketed else store.select(ID)
    assign_ids(accepted, highest.unionByName(accepted.select(ID)), order).write.parquet(paths["numbered"])

    numbered = spark.read.parquet(paths["numbered"])
    if bucketed:
        store.put(numbered)
        paths["store"] = store.path
    else:
        upsert_by_key(store.select(*INTAKE_COLUMNS), numbered, [order]).write.parquet(paths["store"])
    scored = verdicts(numbered if partitions is None else spread(numbered, partitions), models)
    scored, counters = audit(scored, "scored", positive="positive")
    scored.write.parquet(paths["verdicts"])
    return IntakeResult(
        verdicts=spark.read.parquet(paths["verdicts"]),
        stored=store.read().select(*INTAKE_COLUMNS) if bucketed else scan_records(spark, paths["store"]),
        rejected=rejected_records(judged.where("NOT accepted").drop("accepted")),
        paths=paths,
        counters=counters.get,
    )
