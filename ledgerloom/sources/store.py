"""Parquet tables with an atomic commit record, on any Hadoop file system.

There is no table format jar (Delta/Iceberg/Hudi) in the image, so the commit
protocol is the smallest one that gives "rows and mark flip together":

* every write goes to a fresh directory that no reader references yet;
* a commit is one small JSON manifest ``_manifests/v0000000042.json`` created by
  an atomic rename that fails if the version exists (a concurrent writer loses
  and must retry on top of the new version);
* readers open the newest manifest and read only the files it lists.

A crash before the rename leaves unreferenced files and no visible change.
Rename is atomic on HDFS and local disks; on a plain object store use a table
format instead (swap ``TableStore`` for ``DataFrame.mergeInto`` on a catalog).

A commit that lost the race is put on top of the newest version when the two
changed different parts of the manifest (``publish``).

Tables:
  trade       leaf directories by month of the UTC trade date (rows without a time under
              ``none``) and bucket of trade_id, written with Spark's ``bucketBy``; always merged:
              a load that re-sends known trades rewrites the leaves that hold their old
              versions, so a read is a plain scan.  ``bucketed_trades`` reads leaves as a
              bucketed table of the session catalog: a join on trade_id does not shuffle them
              (once buckets grow beyond ``BUCKET_ROWS`` it does: ``keyed_trades``).
  daily_pnl   leaf directories by month and bucket of instrument_id; a run rewrites only the
              leaves it touches.  The files also hold each day's sums for later opening books.
  touched     per load, the instrument-days whose trades changed and how many rows landed there.
  totals      realised sums and row counts per instrument and month of daily_pnl.
  instrument  one directory per version.
  marks       the etl_watermark rows live in the manifest itself (one per stream).

The numbers of buckets are chosen when the store is created and kept in its manifest: more
buckets make smaller leaves, less to rewrite, and more tasks for a bucketed join.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import utc_date
from ..operators.book import DAY_SUMS
from ..operators.watermark import marks_frame
from ..schema import DAILY_PNL_SCHEMA, DEFAULT_STREAM, INSTRUMENT_SCHEMA, TRADE_SCHEMA
from ..session import scratch_dir

NO_MONTH = "none"
#: daily_pnl as stored: with the day's exact sums.
STORED_DAILY = T.StructType([*DAILY_PNL_SCHEMA.fields,
                             *(T.StructField(c, T.DecimalType(*size)) for c, size in zip(DAY_SUMS, ((28, 4), (37, 10), (28, 4))))])
TOUCHED_SCHEMA = "instrument_id int, trade_date date, landed long"
TOTALS_SCHEMA = T.StructType([T.StructField("instrument_id", T.IntegerType()), T.StructField("pnl_month", T.StringType()),
                              T.StructField("pnl_bucket", T.IntegerType()), T.StructField("n", T.LongType()),
                              T.StructField("realised_pnl", T.DecimalType(28, 6))])
TRADE_BUCKETS, DAILY_BUCKETS = 2, 2
#: A bucketed join reads a bucket in one task.  Trades that may fill buckets beyond this are shuffled instead, in as many parts as Spark is told.
BUCKET_ROWS = 500_000


def observed(observation: Observation) -> dict:
    """The metrics of a finished write; none if Spark took the observed step out because its input turned out empty."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


Leaves = dict[str, list[str]]  # month -> leaf directories


class CommitConflict(RuntimeError):
    """Another writer committed the version this writer wanted."""


def _iso(ts: dt.datetime | None) -> str | None:
    if ts is None:
        return None
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=dt.timezone.utc)
    return ts.astimezone(dt.timezone.utc).isoformat()


def _from_iso(s: str | None) -> dt.datetime | None:
    return None if s is None else dt.datetime.fromisoformat(s)


class TableStore:
    """The four tables of the engine under one root directory."""

    def __init__(self, spark: SparkSession, root: str | None = None,
                 trade_buckets: int = TRADE_BUCKETS, daily_buckets: int = DAILY_BUCKETS):
        """``trade_buckets`` and ``daily_buckets`` count for a new store; an existing one keeps its own."""
        self.spark = spark
        self._buckets, self._fixed = {"trade": trade_buckets, "daily_pnl": daily_buckets}, False
        self.root = (root or scratch_dir(spark, "store")).rstrip("/")
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._Path(self.root).getFileSystem(conf)

    # ------------------------------------------------------------ manifest

    def _manifest_dir(self) -> str:
        return f"{self.root}/_manifests"

    def version(self) -> int:
        d = self._Path(self._manifest_dir())
        if not self._fs.exists(d):
            return 0
        names = [s.getPath().getName() for s in self._fs.listStatus(d)]
        nums = [int(n[1:11]) for n in names if n.startswith("v") and n.endswith(".json")]
        return max(nums, default=0)

    def manifest(self, version: int | None = None) -> dict:
        v = self.version() if version is None else version
        if v == 0:
            return {"version": 0, "trade_months": {}, "daily_pnl": {}, "instrument": None, "marks": {}, "buckets": self._buckets}
        stream = self._fs.open(self._Path(f"{self._manifest_dir()}/v{v:010d}.json"))
        try:
            reader = self.spark.sparkContext._jvm.java.io.BufferedReader(
                self.spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8")
            )
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
        finally:
            stream.close()
        return json.loads("\n".join(lines))

    def commit(self, base_version: int, manifest: dict) -> int:
        """Publish ``manifest`` as version base_version + 1, atomically; raise on conflict."""
        new = base_version + 1
        manifest = {**manifest, "version": new, "committed_at": _iso(dt.datetime.now(dt.timezone.utc))}
        final = self._Path(f"{self._manifest_dir()}/v{new:010d}.json")
        tmp = self._Path(f"{self._manifest_dir()}/.tmp-{uuid.uuid4().hex}")
        self._fs.mkdirs(self._Path(self._manifest_dir()))
        out = self._fs.create(tmp, False)
        try:
            out.write(bytearray(json.dumps(manifest, indent=1, sort_keys=True).encode("utf-8")))
        finally:
            out.close()
        if self._fs.exists(final) or not self._fs.rename(tmp, final):
            self._fs.delete(tmp, False)
            raise CommitConflict(f"version {new} already committed under {self.root}")
        return new

    def publish(self, read: dict, changes: dict) -> int:
        """Commit ``changes`` made on top of the manifest ``read``.

        If other versions were committed meanwhile and left the changed parts
        alone, the changes go on top of the newest one; else ``CommitConflict``.
        """
        newest = read
        while True:
            try:
                return self.commit(newest["version"], {**newest, **changes})
            except CommitConflict:
                newest = self.manifest()
                if any(newest.get(part) != read.get(part) for part in changes):
                    raise

    # ------------------------------------------------------------ reads

    def instruments(self, manifest: dict | None = None) -> DataFrame:
        m = manifest or self.manifest()
        if not m.get("instrument"):
            return self.spark.createDataFrame([], INSTRUMENT_SCHEMA)
        return self.spark.read.schema(INSTRUMENT_SCHEMA).parquet(m["instrument"])

    def trades(self, manifest: dict | None = None, since: dt.date | None = None) -> DataFrame:
        """The current trade table; with ``since`` only the months that hold trades from that date on."""
        m = manifest or self.manifest()
        first = None if since is None else f"{since:%Y-%m}"
        months = [k for k in m["trade_months"] if first is None or (k != NO_MONTH and k >= first)]
        return self.read_trades([p for k in sorted(months) for p in m["trade_months"][k]])

    def read_trades(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], TRADE_SCHEMA)
        return self.spark.read.schema(TRADE_SCHEMA).parquet(*paths)

    @contextlib.contextmanager
    def bucketed_trades(self, paths: list[str]) -> Iterator[DataFrame]:
        """The trades of some leaves as a bucketed table: scans and joins on trade_id need no exchange.

        The table is a temporary entry of the session catalog over files that stay where they are.
        """
        name = f"ledgerloom_trade_{uuid.uuid4().hex}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TRADE_SCHEMA.fields)
        # The folder of the entry itself stays empty: every leaf is a partition with a place of its own.
        self.spark.sql(f"CREATE TABLE {name} ({columns}, leaf STRING) USING parquet PARTITIONED BY (leaf) CLUSTERED BY (trade_id) "
                       f"INTO {self.buckets('trade')} BUCKETS LOCATION '{self._new_dir('scan')}'")
        try:
            places = " ".join(f"PARTITION (leaf='{k}') LOCATION '{p}'" for k, p in enumerate(paths))
            if places:
                self.spark.sql(f"ALTER TABLE {name} ADD {places}")
            yield self.spark.table(name).drop("leaf")
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def daily_pnl(self, manifest: dict | None = None, months: Iterable[str] | None = None,
                  schema: T.StructType = DAILY_PNL_SCHEMA, buckets: Iterable[int] | None = None) -> DataFrame:
        """daily_pnl; ``months`` ('YYYY-MM') and ``buckets`` read only those leaves, ``STORED_DAILY`` the day sums too."""
        m = manifest or self.manifest()
        return self.read_daily(self.daily_leaves(m, months, buckets), schema)

    def daily_leaves(self, m: dict, months: Iterable[str] | None = None, buckets: Iterable[int] | None = None) -> list[str]:
        months, wanted = (None if x is None else set(x) for x in (months, buckets))
        return [p for k, leaves in sorted(m["daily_pnl"].items()) if months is None or k in months
                for p in leaves if wanted is None or leaf_of(p)[1] in wanted]

    def read_daily(self, paths: list[str], schema: T.StructType = DAILY_PNL_SCHEMA) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def touched(self, manifest: dict, since_load: int = 0) -> DataFrame:
        """(instrument_id, trade_date, landed): what loads from number ``since_load`` on changed; repeated days are not summed."""
        return self.read_touched([t["path"] for t in manifest.get("touched", []) if t["load"] >= since_load])

    def read_touched(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], TOUCHED_SCHEMA)
        return self.spark.read.schema(TOUCHED_SCHEMA).parquet(*paths)

    def buckets(self, table: str) -> int:
        if not self._fixed:
            self._buckets, self._fixed = self.manifest().get("buckets", self._buckets), self.version() > 0
        return self._buckets[table]

    def daily_bucket(self, instrument: Column) -> Column:
        return F.pmod(F.hash(instrument), F.lit(self.buckets("daily_pnl"))).cast("int")

    def marks(self, manifest: dict | None = None) -> DataFrame:
        m = manifest or self.manifest()
        marks = {
            s: {"watermark_at": _from_iso(v["watermark_at"]), "rows_loaded": v["rows_loaded"],
                "updated_at": _from_iso(v.get("updated_at"))}
            for s, v in m["marks"].items()
        }
        return marks_frame(self.spark, marks)

    def read_mark(self, stream: str = DEFAULT_STREAM, manifest: dict | None = None) -> dt.datetime | None:
        """I4: the committed high-water mark of ``stream``; None if it never loaded."""
        m = manifest or self.manifest()
        return _from_iso((m["marks"].get(stream) or {}).get("watermark_at"))

    # ------------------------------------------------------------ writes (not visible until commit)

    def _new_dir(self, table: str) -> str:
        return f"{self.root}/{table}/{uuid.uuid4().hex}"

    def fills_buckets(self, m: dict, landed: int = 0) -> bool:
        """Whether the trades of ``m`` and ``landed`` more may make buckets of more than ``BUCKET_ROWS``.

        By the rows that loads reported: re-sent trades count again, so this errs towards a shuffle.
        """
        return sum(mark["rows_loaded"] for mark in m["marks"].values()) + landed > BUCKET_ROWS * self.buckets("trade")

    @contextlib.contextmanager
    def keyed_trades(self, paths: list[str], shuffled: bool) -> Iterator[DataFrame]:
        """The trades of some leaves for a join on trade_id: as a bucketed table, or plainly if the join is to shuffle them."""
        if shuffled:
            yield self.read_trades(paths)
        else:
            with self.bucketed_trades(paths) as rows:
                yield rows

    def write_trades(self, rows: DataFrame, spread: bool = True) -> Leaves:
        """Write trades by month and bucket; month -> leaf directories.

        ``spread`` first deals the rows to the leaves: a small leaf is one file, and Spark's
        rebalancing cuts what is larger than its advisory size, so that no task takes more.  Rows
        that come from ``bucketed_trades`` are dealt already.  Rows of a file are sorted by
        instrument and time: Parquet row-group statistics on both let a read skip row groups.
        """
        n = self.buckets("trade")
        path, name = self._new_dir("trade"), f"ledgerloom_write_{uuid.uuid4().hex}"
        month = F.coalesce(F.date_format(utc_date("executed_at"), "yyyy-MM"), F.lit(NO_MONTH))
        out = rows.select(*TRADE_SCHEMA.fieldNames(), month.alias("trade_month"), trade_bucket(n).alias("trade_bucket"))
        if spread:
            out = out.hint("rebalance", F.col("trade_month"), F.col("trade_bucket"))
        # bucketBy needs a table; its entry in the session catalog is dropped again, the files stay.
        (out.write.format("parquet").partitionBy("trade_month", "trade_bucket").bucketBy(n, "trade_id")
         .sortBy("instrument_id", "executed_at").option("path", path).saveAsTable(name))
        self.spark.sql(f"DROP TABLE {name}")
        return self._leaves(path)

    def _leaves(self, path: str) -> Leaves:
        """The directories two levels below ``path`` (month, bucket), by month."""
        found: Leaves = {}
        root = self._Path(path)
        if self._fs.exists(root):
            for month in self._fs.listStatus(root):
                name = month.getPath().getName()
                if month.isDirectory() and "=" in name:
                    inner = [st.getPath().getName() for st in self._fs.listStatus(month.getPath())]
                    found[name.split("=", 1)[1]] = sorted(f"{path}/{name}/{x}" for x in inner if "=" in x)
        return found

    def write_instruments(self, instruments: DataFrame) -> str:
        path = self._new_dir("instrument")
        instruments.select(*INSTRUMENT_SCHEMA.fieldNames()).write.mode("errorifexists").parquet(path)
        return path

    def write_daily_months(self, rows: DataFrame, observation=None, metrics=()) -> Leaves:
        """Write ``rows`` by month and bucket of the instrument under one new directory; month -> leaf directories.

        ``observation``/``metrics`` are attached after the last exchange, i.e. in
        the stage that writes, where Spark applies each task's result once even
        when tasks or earlier stages are re-run.  Columns not in the daily_pnl
        schema (markers for the metrics) are dropped before the write.  A leaf is
        dealt to one task by a hash: nothing is sampled, so nothing runs twice.
        """
        path = self._new_dir("daily_pnl")
        out = rows.withColumns({"pnl_month": F.date_format("pnl_date", "yyyy-MM"),
                                "pnl_bucket": self.daily_bucket(F.col("instrument_id"))}).repartition("pnl_month", "pnl_bucket")
        if observation is not None:
            out = out.observe(observation, *metrics)
        (
            out.select(*STORED_DAILY.fieldNames(), "pnl_month", "pnl_bucket")
            .sortWithinPartitions("pnl_month", "pnl_bucket", "instrument_id", "pnl_date")
            .write.mode("errorifexists")
            .partitionBy("pnl_month", "pnl_bucket")
            .parquet(path)
        )
        return self._leaves(path)

    def write_totals(self, leaves: Leaves) -> dict[str, str]:
        """Write the sums of daily_pnl leaves per instrument and month; leaf -> directory, for the manifest."""
        paths = [p for same in leaves.values() for p in same]
        if not paths:
            return {}
        path, month = self._new_dir("totals"), F.date_format("pnl_date", "yyyy-MM").alias("pnl_month")
        (self.read_daily(paths).groupBy("instrument_id", month)
         .agg(F.count(F.lit(1)).alias("n"), F.sum("realised_pnl").alias("realised_pnl"))
         .withColumn("pnl_bucket", self.daily_bucket(F.col("instrument_id")))
         .select(*TOTALS_SCHEMA.fieldNames()).write.mode("errorifexists").parquet(path))
        return {leaf_name(p): path for p in paths}

    def totals(self, manifest: dict | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """(instrument_id, pnl_month, pnl_bucket, n, realised_pnl): rows and realised sum of each instrument's months."""
        m, wanted = manifest or self.manifest(), None if buckets is None else set(buckets)
        current: dict[str, list[str]] = {}
        for name, path in m.get("totals", {}).items():
            if wanted is None or int(name.rsplit("/", 1)[1]) in wanted:
                current.setdefault(path, []).append(name)
        # Of a directory only the leaves that no later run has written again count.
        name = F.concat_ws("/", "pnl_month", "pnl_bucket")
        parts = [self.spark.read.schema(TOTALS_SCHEMA).parquet(path).where(name.isin(names)) for path, names in sorted(current.items())]
        return reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], TOTALS_SCHEMA)

    def write_touched(self, rows: DataFrame) -> dict:
        """Write the instrument-days a load changed; the entry for the manifest (``most``: the fullest day's rows)."""
        path, obs = self._new_dir("touched"), Observation("touched")
        rows.observe(obs, F.max("landed").alias("most")).write.mode("errorifexists").parquet(path)
        return {"path": path, "most": int(observed(obs).get("most") or 0)}

    def compact_trades(self) -> int:
        """Fold what several loads added to one leaf, and their counts of touched days, into one (same rows); the new version."""
        m, changes = self.manifest(), {}
        several = [p for paths in m["trade_months"].values() for same in by_leaf(paths).values() if len(same) > 1 for p in same]
        if several:
            shuffled = self.fills_buckets(m)
            with self.keyed_trades(several, shuffled) as rows:
                folded = self.write_trades(rows, spread=shuffled)
            changes["trade_months"] = replaced(m["trade_months"], several, folded)
        settled = [t for t in m.get("touched", []) if t["load"] < (m.get("book") or {}).get("loads", 0)]
        if len(settled) > 1:
            rows = self.read_touched([t["path"] for t in settled]).groupBy("instrument_id", "trade_date").agg(F.sum("landed").alias("landed"))
            changes["touched"] = [{**self.write_touched(rows), "load": settled[-1]["load"]},
                                  *(t for t in m["touched"] if t not in settled)]
        return self.publish(m, changes) if changes else m["version"]


def trade_bucket(n: int) -> Column:
    """The bucket Spark's ``bucketBy(n, "trade_id")`` puts a row in."""
    return F.pmod(F.hash("trade_id"), F.lit(n)).cast("int")


def leaf_of(path: str) -> tuple[str, int]:
    """Month and bucket of a leaf directory."""
    month, bucket = path.rstrip("/").rsplit("/", 2)[1:]
    return month.split("=", 1)[1], int(bucket.split("=", 1)[1])


def leaf_name(path: str) -> str:
    return "{}/{}".format(*leaf_of(path))


def by_leaf(paths: Iterable[str]) -> dict[tuple[str, int], list[str]]:
    out: dict[tuple[str, int], list[str]] = {}
    for p in paths:
        out.setdefault(leaf_of(p), []).append(p)
    return out


def replaced(leaves: Leaves, old: Iterable[str], new: Leaves) -> Leaves:
    """``leaves`` without the directories ``old`` and with ``new``; months left empty go."""
    gone = set(old)
    out = {month: [p for p in paths if p not in gone] for month, paths in leaves.items()}
    for month, paths in new.items():
        out[month] = [*out.get(month, []), *paths]
    return {month: paths for month, paths in out.items() if paths}
