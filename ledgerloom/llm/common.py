"""Small helpers shared by the operators: shared-folder tables, row digests, free column names."""

from __future__ import annotations

import io
import zipfile
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh table under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage: what comes later survives lost executors without
    recomputing what came before, and nothing is evaluated twice.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first variant of it that is no column of ``df`` (case ignored)."""
    taken = {c.lower() for c in df.columns}
    out, i = name, 0
    while out.lower() in taken:
        i += 1
        out = f"{name}_{i}"
    return out


def remainder(column, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts: sizes partitions, never changes a result."""
    return int(docs.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array)
                                       else columns[f.name].cast(f.type) for f in schema], schema=schema)


def tree_sum(parts: DataFrame, column: str, fan_in: int = 32) -> np.ndarray | None:
    """Sum float64 vectors held as binaries of one length, in rounds of ``fan_in`` partitions.

    Each task sums what it holds, so neither the driver nor any task sees more
    than ``fan_in`` vectors times the (fixed) length of a vector at once.
    """
    def add(rows):
        total = None
        for row in rows:
            v = np.frombuffer(row, np.float64) if isinstance(row, (bytes, bytearray)) else row
            total = v.copy() if total is None else total + v
        return [] if total is None else [total.tobytes()]

    rdd = parts.select(column).rdd.map(lambda r: bytes(r[0])).mapPartitions(add)
    while rdd.getNumPartitions() > fan_in:
        rdd = rdd.coalesce(max(1, rdd.getNumPartitions() // fan_in), shuffle=True).mapPartitions(add)
    sums = [np.frombuffer(x, np.float64) for x in rdd.collect()]
    return reduce(np.add, sums) if sums else None


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per session.

    What ``spark-submit --py-files`` does; needed when the session was started
    by a script whose workers do not have the repository on their path.  The
    archive lies in the shared folder.
    """
    # Texts are long: batches of the default 10 000 rows would hold tens of MB in Python and in the JVM.
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    context = spark.sparkContext
    if getattr(context, "_ledgerloom_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    path = context._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark, 'package')}/ledgerloom_package.zip")
    out = path.getFileSystem(context._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(held.getvalue()))
    finally:
        out.close()
    context.addPyFile(path.toString())
    context._ledgerloom_shipped = True
