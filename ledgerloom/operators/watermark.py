"""The high-water mark of an ingestion stream (a batch mark, not an event-time watermark).

The mark has two jobs: it filters an incremental load (``ingest.above_watermark``)
and it is a floor that never moves back.  Advancing it is
``greatest(stored, max(executed_at of the rows upserted))``; ``rows_loaded``
accumulates (re-upserts count again).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DEFAULT_STREAM, WATERMARK_SCHEMA


def empty_marks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], WATERMARK_SCHEMA)


def marks_frame(spark: SparkSession, marks: dict[str, dict]) -> DataFrame:
    """The etl_watermark table from the committed manifest (one row per stream: tiny)."""
    rows = [
        (stream, m.get("watermark_at"), int(m.get("rows_loaded", 0)), m.get("updated_at"))
        for stream, m in sorted(marks.items())
    ]
    return spark.createDataFrame(rows, WATERMARK_SCHEMA)


def read_mark(marks: DataFrame, stream: str = DEFAULT_STREAM) -> dt.datetime | None:
    """The stored mark of ``stream``, None if it never loaded."""
    row = marks.where(F.col("stream") == stream).select(F.unix_micros("watermark_at")).first()
    if row is None or row[0] is None:
        return None
    # Through epoch micros: a collected timestamp would come back naive, in the local zone.
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=row[0])


def advance(marks: DataFrame, upserted: DataFrame, stream: str = DEFAULT_STREAM) -> DataFrame:
    """New etl_watermark table after upserting ``upserted`` (lazy).

    The batch's max and count come from one aggregate over the batch, read as a
    single struct-valued scalar subquery (Spark evaluates an identical subquery
    once).  The stream's row is written even for an empty batch; other streams
    are kept.
    """
    batch = upserted.agg(
        F.struct(F.max("executed_at").alias("max_at"), F.count(F.lit(1)).alias("rows")).alias("b")
    ).scalar()
    stored = marks.where(F.col("stream") == stream).agg(
        F.struct(F.max("watermark_at").alias("mark"), F.sum("rows_loaded").alias("rows")).alias("s")
    ).scalar()
    new = marks.sparkSession.range(1).select(
        F.lit(stream).alias("stream"),
        F.greatest(stored.getField("mark"), batch.getField("max_at")).alias("watermark_at"),
        (F.coalesce(stored.getField("rows"), F.lit(0)) + batch.getField("rows")).cast("long").alias("rows_loaded"),
        F.current_timestamp().alias("updated_at"),
    )
    return marks.where(F.col("stream") != stream).unionByName(new)
