"""Run a load whose feed-reading tasks fail on their first attempt (local[4,3] retries them).

Prints one JSON line: the LoadResult of the flaky run and of a clean run, and whether the
landed tables are equal.  Used by tests/test_retries.py in a separate JVM.
"""

from __future__ import annotations

import json
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from ledgerloom.plans import jobs  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402
from ledgerloom.sources import derived  # noqa: E402
from ledgerloom.sources.feed_csv import FEED_ORDER  # noqa: E402


def _flaky(_):
    # Test-only fault injection: every task's first attempt dies mid-partition.
    ctx = TaskContext.get()
    if ctx is not None and ctx.attemptNumber() == 0:
        raise RuntimeError("injected executor loss")
    return True


# Nondeterministic, so the optimizer keeps it where it is written (after the shuffle).
flaky = F.udf(_flaky, T.BooleanType()).asNondeterministic()


def main() -> None:
    spark = build_session(master="local[4,3]", shuffle_partitions=4,
                          extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ledgerloom-retry-"),
                                 "spark.sql.files.maxPartitionBytes": "65536"})
    sf = "/root/testdata/sf0.01"
    records = derived.lineitem_feed(spark, sf).withColumnRenamed("feed_order", FEED_ORDER)
    clean_store, flaky_store = jobs.create_schema(spark), jobs.create_schema(spark)
    clean = jobs.load_trades(clean_store, records, incremental=False)
    spark.sparkContext.setJobGroup("flaky", "load with injected task failures")
    # Spread the rows over 8 tasks first (the feed order is a data column here, so a
    # shuffle does not change which copy is last); each of those tasks dies once.
    flaky_records = records.repartition(8, "trade_id").where(flaky(F.col("trade_id")))
    bad = jobs.load_trades(flaky_store, flaky_records, incremental=False)
    tracker = spark.sparkContext.statusTracker()
    failed = 0
    for job_id in tracker.getJobIdsForGroup("flaky"):
        for stage_id in tracker.getJobInfo(job_id).stageIds:
            info = tracker.getStageInfo(stage_id)
            failed += info.numFailedTasks if info else 0
            if info and "--debug" in sys.argv:
                print("stage", stage_id, info.name[:40], info.numTasks, info.numCompletedTasks, info.numFailedTasks, file=sys.stderr)
    spark.sparkContext.setJobGroup(None, None)
    cols = ["trade_id", "instrument_id", "side", "quantity", "price", "executed_at"]
    a, b = clean_store.trades().select(*cols), flaky_store.trades().select(*cols)
    same = a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    fields = ("rows_read", "rows_upserted", "rows_skipped_by_watermark", "duplicates_collapsed")
    print(json.dumps({"clean": [getattr(clean, f) for f in fields], "flaky": [getattr(bad, f) for f in fields],
                      "same_table": same, "partitions": records.rdd.getNumPartitions(),
                      "failed_tasks": failed}))
    spark.stop()


if __name__ == "__main__":
    main()
