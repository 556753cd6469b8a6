"""Times every named query with a ``noop`` sink and prints one JSON line.

Environment: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (cores), ``BENCH_RUNS``
(timed runs per query, median reported), ``BENCH_FITS=0`` to leave out the
full-size fits, ``BENCH_ONLY`` (comma-separated query names).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskflow.plans import views  # noqa: E402
from riskflow.plans.jobs import (  # noqa: E402
    TRAINERS,
    training_side,
    write_training_table,
)
from riskflow.plans.queries import QUERIES  # noqa: E402
from riskflow.session import local_session  # noqa: E402
from riskflow.workspace import ensure_checkpoint_dir  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
FITS = os.environ.get("BENCH_FITS", "1") != "0"
ONLY = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    spark = local_session(CPUS, "riskflow-bench")
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in ONLY or QUERIES:
        query = QUERIES[name]
        counter = Observation()
        drain(query(spark, SF_DIR).observe(counter, F.count("*").alias("n")))
        rows[name] = counter.get["n"]
        seconds[name] = round(
            statistics.median(timed(lambda: drain(query(spark, SF_DIR))) for _ in range(RUNS)), 4
        )
    fits: dict[str, float] = {}
    if FITS and not ONLY:
        ensure_checkpoint_dir(spark)
        table = write_training_table(spark, views.intake(spark, SF_DIR))
        for kind, trainer in TRAINERS.items():
            train = training_side(spark, table, "train")
            fits["rows"] = train.count()
            fits[kind] = round(timed(lambda: trainer(train)), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows": rows,
                "fit_seconds": fits,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cores": int(CPUS),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
