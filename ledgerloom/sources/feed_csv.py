"""The trade feed as CSV files: columns matched by the header of each file, written in the fixed order."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import FEED_COLUMNS

FEED_ORDER = "feed_order"
SURPLUS = "surplus"
_FIELDS = [f"f{i}" for i in range(len(FEED_COLUMNS))]
#: Fields by position; one more than the feed has shows lines that are too long.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in [*_FIELDS, SURPLUS]])
#: Files whose first line is read at the same time.
HEADER_THREADS = 32


class FeedHeaderError(ValueError):
    """A file has no header, or one that misses a feed column or has one the feed does not know."""

    def __init__(self, files: list[str]):
        super().__init__(f"no header with the columns {', '.join(FEED_COLUMNS)} in {sorted(files)[:5]}")


def csv_options(reader):
    """Quotes are escaped by doubling; every field is text; no field spans lines, so files stay splittable."""
    return reader.schema(RAW_SCHEMA).option("header", False).option("escape", '"').option("mode", "PERMISSIVE")


def _first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file that isn't empty, through Hadoop's file systems and codecs; None if there is none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        plain = stream if codec is None else codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        line = reader.readLine()
        while line is not None and not line.strip():
            line = reader.readLine()
        return line
    finally:
        stream.close()


def read_headers(spark: SparkSession, files: list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each order of columns, by their first lines alone; files without a line are left out."""
    read = inheritable_thread_target(spark)(lambda file: _first_line(spark, file))
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        lines = dict(zip(files, pool.map(read, files)))
    orders: dict[tuple[str, ...], list[str]] = {}
    bare = []
    for file, line in lines.items():
        if line is None:
            continue
        names = tuple(next(csv.reader([line])))
        if sorted(names) == sorted(FEED_COLUMNS):
            orders.setdefault(names, []).append(file)
        else:
            bare.append(file)
    if bare:
        raise FeedHeaderError(bare)
    return orders


def _rows(raw: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Rows by position -> the feed columns, given the order of the columns; headers drop out, the rest of the columns stays.

    A line with more fields than the feed has raises when it is read.
    """
    header = reduce(Column.__and__, (F.coalesce(F.col(f), F.lit("")) == F.lit(name) for f, name in zip(_FIELDS, names)))
    too_long = F.raise_error(F.concat(F.lit("a line has more than the six fields of the feed: "), F.concat_ws(",", *_FIELDS)))
    value = {name: F.coalesce(F.col(f), F.lit("")) for f, name in zip(_FIELDS, names)}
    value["trade_id"] = F.when(F.col(SURPLUS).isNotNull(), too_long).otherwise(value["trade_id"])
    rest = [c for c in raw.columns if c not in RAW_SCHEMA.names]
    return raw.where(~header).select(*(value[c].alias(c) for c in FEED_COLUMNS), *rest)


def by_header(raw: DataFrame) -> DataFrame:
    """Rows by position (``RAW_SCHEMA`` and ``file``) of a micro-batch -> the feed columns, by the header of their own file.

    The names of the files are the only thing read beforehand, and their first lines.  A file
    without a proper header raises ``FeedHeaderError``.
    """
    files = [r[0] for r in raw.select("file").distinct().collect()]
    orders = read_headers(raw.sparkSession, files)
    if len(orders) == 1:
        return _rows(raw, next(iter(orders)))
    parts = [_rows(raw.where(F.col("file").isin(own)), names) for names, own in orders.items()]
    return reduce(DataFrame.unionByName, parts) if parts else _rows(raw, tuple(FEED_COLUMNS))


def read_feed_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Feed rows (six strings, '' for an empty field) plus ``feed_order``.

    Every file may have its own order of columns: the first line of each file is read
    ahead, then files of one order are one scan, so the feed is read once.  A file without
    a proper header raises ``FeedHeaderError``.  ``feed_order`` captures the
    position in the input (file, split, row) at scan time, before any shuffle,
    so "last occurrence" means last in file order even across splits.
    """
    order = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("row"))
    orders = read_headers(spark, list(spark.read.text(path).inputFiles())) or {tuple(FEED_COLUMNS): path}
    parts = [_rows(csv_options(spark.read).csv(own).select("*", order.alias(FEED_ORDER)), names) for names, own in orders.items()]
    return reduce(DataFrame.unionByName, parts)


def write_feed_csv(feed: DataFrame, path: str, mode: str = "errorifexists", columns: list[str] | None = None) -> str:
    """Write the six feed columns, header first, values untrimmed, '' as an empty field."""
    (
        feed.select(*(columns or FEED_COLUMNS))
        .write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
