"""Incremental landing of a feed directory with Structured Streaming.

New CSV files dropped into ``input_dir`` are picked up by a file stream; each
micro-batch runs the same load job as a batch run (``jobs.load_trades``), so the
high-water filter, the collapse and the atomic commit are identical.  The number of
the micro-batch is committed with its rows, under the stream's checkpoint location: a
micro-batch that is replayed after a failure has been committed or not, and if so
nothing is done again, so ``rows_loaded`` counts it once.  This is a batch high-water
mark, not an event-time watermark: nothing is dropped for lateness except by the stored mark.

Streaming file sources need a declared schema and map columns by position, so
the stream reads fields by position, headers included, and each micro-batch maps
them by the header of their own file (a file is never split over micro-batches).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import jobs
from ..schema import DEFAULT_STREAM
from ..sources.feed_csv import FEED_ORDER, by_header, csv_options
from ..sources.store import TableStore


def feed_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = csv_options(spark.readStream)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(input_dir).select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"))


def start_incremental_load(
    spark: SparkSession,
    input_dir: str,
    store: TableStore,
    checkpoint_location: str,
    *,
    stream: str = DEFAULT_STREAM,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it drains what is there and stops."""

    def land(batch: DataFrame, epoch_id: int) -> None:
        # The row position is taken per micro-batch scan, before any shuffle.
        order = F.struct("file", F.col("_block").alias("block"), F.monotonically_increasing_id().alias("row"))
        records = by_header(batch.select("*", order.alias(FEED_ORDER))).drop("file", "_block")
        jobs.load_trades(store, records, stream=stream, source_file=f"stream-epoch-{epoch_id}",
                         replay=(checkpoint_location, epoch_id))

    writer = feed_stream(spark, input_dir, max_files_per_trigger).writeStream.foreachBatch(land) \
        .option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
