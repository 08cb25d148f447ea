"""Landing a feed: merge by key, parsing, the high-water mark, files and headers, commits."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from ledgerloom.operators.dedup import collapse_duplicates
from ledgerloom.operators.ingest import coerce_feed
from ledgerloom.operators.instruments import classify
from ledgerloom.operators.watermark import read_mark
from ledgerloom.plans import jobs, serve
from ledgerloom.sources.feed_csv import FeedHeaderError, read_feed_csv, write_feed_csv
from ledgerloom.sources import store as store_module
from ledgerloom.sources.store import CommitConflict, by_leaf, leaf_of
from ledgerloom.streaming.incremental import start_incremental_load
from tests.conftest import Tape

HEADER = "trade_id,instrument_id,side,quantity,price,executed_at\n"


def table(store):
    return {r.trade_id: r for r in store.trades().collect()}


def test_a_second_feed_merges_into_the_first(store):
    """Of five fills two come again (one cancelled to 1 unit, one moved to another month), one is new."""
    Tape(*()).buy("f1", 30, "4.25", "2023-05-02 09:30").sell("f2", 10, "4.50", "2023-05-03 09:30").buy(
        "f3", 7, "99", "2023-06-01 15:00", on=2).land(store)
    landed = table(store)
    out = Tape().buy("f2", 1, "4.75", "2023-05-03 09:30").buy("f3", 7, "98", "2023-07-20 15:00", on=2).buy(
        "f4", 2, "1", "2023-05-02 10:00").land(store)
    now = table(store)
    assert (out.rows_read, out.rows_upserted, out.duplicates_collapsed) == (3, 3, 0)
    assert {k: (r.side, r.quantity, r.price) for k, r in now.items()} == {
        "f1": ("BUY", Decimal("30.0000"), Decimal("4.250000")), "f2": ("BUY", Decimal("1.0000"), Decimal("4.750000")),
        "f3": ("BUY", Decimal("7.0000"), Decimal("98.000000")), "f4": ("BUY", Decimal("2.0000"), Decimal("1.000000"))}
    assert now["f2"].ingested_at == landed["f2"].ingested_at and now["f3"].ingested_at == landed["f3"].ingested_at
    assert now["f4"].ingested_at > landed["f1"].ingested_at
    assert store.manifest()["marks"]["trades_csv"]["rows_loaded"] == 6
    assert sorted(store.manifest()["trade_months"]) == ["2023-05", "2023-07"]


def test_landing_a_tape_again_changes_nothing(store):
    tape = Tape().buy("a", 5, "2", "2023-01-10 10:00").sell("b", 5, "3", "").buy("c", 1, "9", "2023-02-10 10:00")
    tape.land(store)
    first = store.trades().drop("ingested_at")
    tape.land(store)
    assert first.exceptAll(store.trades().drop("ingested_at")).count() == 0 and store.trades().count() == 3


def test_an_empty_feed_lands_nothing(store):
    """Before anything is stored, and after: no rows, no mark, and a book without days."""
    assert Tape().land(store).rows_read == 0 and store.trades().count() == 0 and store.read_mark() is None
    assert jobs.compute_daily_pnl(store).rows_written == 0 and store.daily_pnl().count() == 0
    Tape().buy("a", 1, "1", "2023-08-01 12:00").land(store)
    out = Tape().land(store)
    assert (out.rows_read, out.rows_upserted) == (0, 0) and out.watermark_after == out.watermark_before
    assert jobs.refresh_daily_pnl(store).rows_written == 1 and jobs.refresh_daily_pnl(store).rows_written == 0


def test_copies_in_one_tape_collapse_to_the_last(store):
    tape = Tape()
    for price in ("7", "8", "9"):
        tape.buy("x", 1, price, "2023-01-10 10:00").buy(f"only-{price}", 1, price, "2023-01-10 10:00")
    out = tape.land(store)
    assert (out.rows_read, out.rows_upserted, out.duplicates_collapsed) == (6, 4, 2)
    assert table(store)["x"].price == Decimal("9.000000")
    assert out.summary() == "4 of 6 feed rows landed (0 not after the mark, 2 repeated)"


def test_text_that_does_not_parse_lands_as_null(store):
    Tape().raw("g", "one", "", "12 pieces", "$4", "last week").raw("h", "", "Hold", "", "", "").land(store)
    rows = table(store)
    assert all(rows["g"][c] is None for c in ("instrument_id", "side", "quantity", "price", "executed_at"))
    assert rows["h"].side == "Hold" and rows["h"].quantity is None


def test_the_mark_is_the_latest_time_seen_and_only_rises(store):
    late, early = "2023-08-01 12:00", "2023-02-01 12:00"
    out = Tape().buy("a", 1, "1", early).buy("b", 1, "1", late).buy("c", 1, "1", "").land(store)
    top = dt.datetime(2023, 8, 1, 12, tzinfo=dt.timezone.utc)
    assert (out.watermark_before, out.watermark_after) == (None, top)
    assert read_mark(store.marks()) == store.read_mark() == top and store.read_mark("another") is None
    out = Tape().buy("d", 1, "1", "2023-03-01 12:00").land(store)
    assert out.rows_skipped_by_watermark == 0 and out.watermark_after == top and "d" in table(store)


def test_an_incremental_load_takes_only_what_is_after_the_mark(store):
    Tape().buy("a", 1, "1", "2023-08-01 12:00").land(store)
    out = Tape().buy("b", 1, "1", "2023-08-01 12:00").buy("c", 1, "1", "2023-07-31 12:00").buy(
        "d", 1, "1", "2023-08-01 12:01").buy("e", 1, "1", "").land(store, incremental=True)
    assert (out.rows_skipped_by_watermark, out.rows_upserted) == (2, 2)
    assert set(table(store)) == {"a", "d", "e"}


def test_the_mark_filters_before_copies_collapse(store):
    """Of the two copies the later line is not after the mark, so the earlier line is the one that lands."""
    Tape().buy("a", 1, "1", "2023-08-01 12:00").land(store)
    out = Tape().buy("z", 1, "5", "2023-09-01 12:00").buy("z", 1, "6", "2023-07-01 12:00").land(store, incremental=True)
    assert (out.rows_skipped_by_watermark, out.duplicates_collapsed) == (1, 0)
    assert table(store)["z"].price == Decimal("5.000000")


def test_a_resent_trade_without_a_time_replaces_the_good_one(store):
    Tape().buy("a", 3, "1", "2023-08-01 12:00").land(store)
    Tape().raw("a", 1, "BUY", 3, "", "").land(store, incremental=True)
    row = table(store)["a"]
    assert row.executed_at is None and row.price is None and store.trades().count() == 1
    assert sorted(store.manifest()["trade_months"]) == ["none"]


def test_three_overlapping_loads_and_compaction(store):
    for k, (low, high) in enumerate(((0, 20), (10, 30), (25, 35))):
        tape = Tape()
        for i in range(low, high):
            tape.buy(f"t{i}", 1, str(1000 * k + i), f"2023-{1 + i % 3:02d}-15 10:00")
        tape.land(store)
    price = {k: int(r.price) for k, r in table(store).items()}
    assert price == {f"t{i}": (2000 if i >= 25 else 1000 if i >= 10 else 0) + i for i in range(35)}
    Tape().buy("new", 1, "1", "2023-01-20 10:00").land(store)
    before = store.trades()

    def several():
        return [leaf for p in store.manifest()["trade_months"].values() for leaf, same in by_leaf(p).items() if len(same) > 1]

    assert several()
    store.compact_trades()
    assert not several()
    assert before.exceptAll(store.trades()).count() == 0 and store.trades().count() == 36


def test_reading_after_two_loads_shuffles_no_trades(spark, store):
    """The table is merged when it is written: a read is a scan, with broadcasts off as well."""
    Tape().buy("a", 1, "1", "2023-08-01 12:00").buy("b", 1, "1", "2023-08-01 12:00").land(store)
    Tape().buy("a", 2, "1", "2023-08-01 12:00").land(store)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = store.trades()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan


def paths_of(store):
    return {p for paths in store.manifest()["trade_months"].values() for p in paths}


def test_one_resent_trade_rewrites_its_leaf_only(store):
    tape = Tape()
    for i in range(200):
        tape.buy(f"t{i}", 1, "1", f"2023-{1 + i % 4:02d}-15 10:00")
    tape.land(store)
    before = paths_of(store)
    Tape().buy("t6", 1, "2", "2023-03-15 10:00").land(store)  # stored in March, comes again in March
    gone, new = before - paths_of(store), paths_of(store) - before
    assert len(gone) == 1 and {leaf_of(p) for p in gone} == {leaf_of(p) for p in new} and len(new) == 1
    assert next(iter(gone)).count("trade_month=2023-03") == 1
    assert store.trades().count() == 200 and table(store)["t6"].price == Decimal("2.000000")


def test_the_key_lookup_shuffles_the_batch_only_and_is_cut_by_a_bloom_filter(spark, store):
    """The stored side is bucketed by trade_id; without a broadcast, Spark's runtime filter of the batch reaches its scan."""
    tape, again = Tape(), Tape()
    for i in range(300):
        tape.buy(f"t{i:03d}", 1, "1", f"2023-{1 + i % 4:02d}-15 10:00")
    tape.land(store)
    stored_paths = sorted(paths_of(store))
    for i in range(0, 300, 50):
        again.buy(f"t{i:03d}", 1, "2", "2023-07-01 10:00")
    landed = sorted(p for paths in store.write_trades(coerce_feed(again.frame(spark)).withColumn(
        "ingested_at", jobs.F.current_timestamp())).values() for p in paths)
    # The size from which on a scan is worth a filter is 10 GB by default.
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        with store.bucketed_trades(stored_paths) as stored:
            found = jobs.replaced_trades(stored, store.read_trades(landed), "t000", "t250")
            plan, with_filter = (getattr(found._jdf.queryExecution(), k)().toString() for k in ("executedPlan", "optimizedPlan"))
            assert sorted(r.trade_id for r in found.collect()) == [f"t{i:03d}" for i in range(0, 300, 50)]
            text = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "might_contain" in with_filter and "Bucketed: true" in text
    assert plan.count("Exchange hashpartitioning(trade_id") == 1  # of the batch; the stored side keeps its buckets


def test_a_leaf_is_written_by_as_many_tasks_as_its_size_asks_for(spark, store):
    """The write is not held to one task a bucket: what is larger than Spark's advisory size is cut."""
    k = jobs.F.col("id")
    rows = spark.range(0, 40_000, 1, 8).select(
        jobs.F.sha2(k.cast("string"), 256).alias("trade_id"), (k % 3 + 1).cast("int").alias("instrument_id"), jobs.F.lit("BUY").alias("side"),
        k.cast("decimal(18,4)").alias("quantity"), k.cast("decimal(18,6)").alias("price"),
        jobs.F.lit("2023-04-01T09:00:00Z").cast("timestamp").alias("executed_at"), jobs.F.lit("x").alias("source_file"),
        jobs.F.current_timestamp().alias("ingested_at"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        leaves = store.write_trades(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert [len(p) for p in leaves.values()] == [store.buckets("trade")]
    landed = store.read_trades([p for paths in leaves.values() for p in paths])
    assert len(landed.inputFiles()) >= 2 * store.buckets("trade")
    assert landed.count() == 40_000 and landed.select("trade_id").distinct().count() == 40_000


def test_trades_that_fill_their_buckets_are_joined_by_a_shuffle(store, monkeypatch):
    """Beyond ``BUCKET_ROWS`` no task reads a bucket whole; the merged table and the compacted one are as before."""
    first, again = Tape(), Tape()
    for i in range(40):
        first.buy(f"t{i:02d}", 1, "1", f"2023-{1 + i % 2:02d}-15 10:00")
    for i in range(20, 60):
        again.buy(f"t{i:02d}", 1, "2", f"2023-{1 + i % 3:02d}-15 10:00")
    first.land(store)
    seen = {k: r.ingested_at for k, r in table(store).items()}
    monkeypatch.setattr(store_module, "BUCKET_ROWS", 20)
    monkeypatch.setattr(store, "bucketed_trades", lambda paths: (_ for _ in ()).throw(AssertionError("a bucket in one task")))
    assert not store.fills_buckets(store.manifest()) and store.fills_buckets(store.manifest(), 1)
    again.land(store)
    Tape().buy("new", 1, "3", "2023-01-20 10:00").land(store)
    store.compact_trades()
    got = table(store)
    assert {k: int(r.price) for k, r in got.items()} == {"new": 3, **{f"t{i:02d}": 1 if i < 20 else 2 for i in range(60)}}
    assert store.trades().count() == 61 and all(got[k].ingested_at == at for k, at in seen.items())


def test_a_stored_book_is_built_from_leaves_that_many_tasks_wrote(spark, store):
    """A first load and its book: no bucket of the loaded trades was one task's, and the book counts each trade once."""
    k = jobs.F.col("id")
    text = {"trade_id": jobs.F.sha2(k.cast("string"), 256), "instrument_id": k % 3 + 1, "side": jobs.F.lit("BUY"), "quantity": jobs.F.lit(1),
            "price": k % 7 + 1, "executed_at": jobs.F.concat(jobs.F.lit("2023-04-0"), (k % 2 + 1).cast("string"), jobs.F.lit("T09:00:00Z"))}
    feed = spark.range(0, 40_000, 1, 8).select(*(c.cast("string").alias(n) for n, c in text.items()), k.alias("feed_order"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        jobs.load_trades(store, feed, incremental=False, order_col="feed_order")
        jobs.compute_daily_pnl(store)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(store.trades().inputFiles()) >= 2 * store.buckets("trade")
    days = {(r.pnl_date.day, r.instrument_id): (r.trade_count, r.closing_position) for r in store.daily_pnl().collect()}
    ids = [(i % 2 + 1, i % 3 + 1) for i in range(40_000)]
    assert {day: n for day, (n, _) in days.items()} == {day: ids.count(day) for day in set(ids)}
    assert sorted(r.symbol for r in jobs.running_pnl(store, limit=3).collect()) == ["AAPL", "EURUSD", "MSFT"]


def test_a_refresh_after_a_shuffled_merge_is_the_book_of_a_full_run(store, monkeypatch):
    """Trades of one instrument sent again dearer, one moved to another: no bucket is read by one task, the book is that of a full run."""
    monkeypatch.setattr(store_module, "BUCKET_ROWS", 5)
    monkeypatch.setattr(store, "bucketed_trades", lambda paths: (_ for _ in ()).throw(AssertionError("a bucket in one task")))
    first, again = Tape(), Tape()
    for i in range(30):
        first.buy(f"t{i:02d}", 2, "1", f"2023-{1 + i % 3:02d}-1{i % 4} 10:00", on=1 + i % 3)
    for i in range(0, 15, 3):
        again.buy(f"t{i:02d}", 2, "2", f"2023-{1 + i % 3:02d}-1{i % 4} 10:00", on=1 if i else 2)
    first.land(store)
    jobs.compute_daily_pnl(store)
    again.land(store)
    assert jobs.refresh_daily_pnl(store).rows_written > 0
    refreshed = sorted(tuple(r) for r in store.daily_pnl().drop("computed_at").collect())
    jobs.compute_daily_pnl(store)
    assert refreshed == sorted(tuple(r) for r in store.daily_pnl().drop("computed_at").collect())
    assert {k: int(r.price) for k, r in table(store).items()} == {f"t{i:02d}": 2 if i < 15 and i % 3 == 0 else 1 for i in range(30)}


def land_in_many_tasks(spark, store, n=40_000):
    """Load ``n`` fills of two months so that no bucket of them is written by one task, and compute the book."""
    k = jobs.F.col("id")
    text = {"trade_id": jobs.F.sha2(k.cast("string"), 256), "instrument_id": k % 3 + 1, "side": jobs.F.when(k % 5 < 3, "BUY").otherwise("SELL"),
            "quantity": k % 4 + 1, "price": k % 7 + 1,
            "executed_at": jobs.F.concat(jobs.F.lit("2023-0"), (k % 2 + 1).cast("string"), jobs.F.lit("-0"), (k % 4 + 1).cast("string"))}
    feed = spark.range(0, n, 1, 8).select(*(c.cast("string").alias(x) for x, c in text.items()), k.alias("feed_order"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    try:
        jobs.load_trades(store, feed, incremental=False, order_col="feed_order")
        jobs.compute_daily_pnl(store)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    months = store.manifest()["trade_months"]
    assert sorted(months) == ["2023-01", "2023-02"]
    for paths in months.values():
        assert len(store.read_trades(paths).inputFiles()) >= 2 * store.buckets("trade")


def test_the_newest_rows_of_a_book_whose_trades_many_tasks_wrote(spark, store):
    land_in_many_tasks(spark, store)
    whole = [tuple(r) for r in serve.running_pnl(store.daily_pnl(), store.instruments()).collect()]
    assert len(whole) == 12 and [tuple(r) for r in jobs.running_pnl(store, limit=4).collect()] == whole[:4]


def test_a_carried_run_over_trades_that_many_tasks_wrote_is_the_full_run(spark, store):
    land_in_many_tasks(spark, store)
    full = sorted(tuple(r) for r in store.daily_pnl().drop("computed_at").collect())
    assert jobs.compute_daily_pnl(store, since=dt.date(2023, 2, 1), carry_in=True).rows_written == 6
    assert len(full) == 12 and sorted(tuple(r) for r in store.daily_pnl().drop("computed_at").collect()) == full


# ---------------------------------------------------------------- commits


def test_nothing_shows_before_the_commit(store, monkeypatch):
    version = store.version()
    monkeypatch.setattr(store, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):
        Tape().buy("a", 1, "1", "2023-08-01 12:00").land(store)
    monkeypatch.undo()
    assert store.version() == version and store.trades().count() == 0 and not store.manifest()["marks"]


def test_changes_of_the_same_part_conflict(store):
    seen = store.manifest()
    store.publish(seen, {"marks": {"a": {"watermark_at": None, "rows_loaded": 1, "updated_at": None}}})
    with pytest.raises(CommitConflict):
        store.publish(seen, {"marks": {"b": {"watermark_at": None, "rows_loaded": 2, "updated_at": None}}})
    with pytest.raises(CommitConflict):
        store.commit(seen["version"], seen)


def test_a_pnl_run_and_a_load_meanwhile_both_count(store, monkeypatch):
    Tape().buy("a", 1, "10", "2023-08-01 12:00").land(store)
    write, done = store.write_daily_months, []

    def write_and_load(*args, **kw):
        if not done:
            done.append(Tape().buy("b", 1, "20", "2023-08-02 12:00").land(store))
        return write(*args, **kw)

    monkeypatch.setattr(store, "write_daily_months", write_and_load)
    assert jobs.compute_daily_pnl(store).rows_written == 1
    assert store.trades().count() == 2 and store.daily_pnl().count() == 1
    assert jobs.sums_valid_before(store.manifest()) == dt.date(2023, 8, 2)


def test_loads_of_two_streams_at_once_both_land(store, monkeypatch):
    """The second to commit is merged again on top of the first, here over a trade that both hold."""
    Tape().buy("a", 1, "10", "2023-08-01 12:00").land(store)
    merge, done = jobs._merge, []

    def merge_and_load(*args):
        out = merge(*args)
        if not done:
            done.append(True)
            done.append(Tape().buy("b", 1, "20", "2023-08-02 12:00").buy("a", 1, "11", "2023-08-01 12:00").land(store, stream="other"))
        return out

    monkeypatch.setattr(jobs, "_merge", merge_and_load)
    out = Tape().buy("b", 2, "30", "2023-09-02 12:00").buy("c", 1, "1", "2023-08-03 12:00").land(store)
    assert out.rows_upserted == 2
    assert {k: int(r.price) for k, r in table(store).items()} == {"a": 11, "b": 30, "c": 1} and store.trades().count() == 3
    m = store.manifest()
    assert (m["marks"]["other"]["rows_loaded"], m["marks"]["trades_csv"]["rows_loaded"], m["loads"]) == (2, 3, 3)
    # A load of the same stream meanwhile still conflicts: its mark is not the one that was read.
    done.clear()

    def merge_and_load_same(*args):
        out = merge(*args)
        if not done:
            done.append(True)
            Tape().buy("d", 1, "1", "2023-10-01 12:00").land(store)
        return out

    monkeypatch.setattr(jobs, "_merge", merge_and_load_same)
    with pytest.raises(CommitConflict):
        Tape().buy("e", 1, "1", "2023-10-02 12:00").land(store)


def test_a_load_of_a_committed_number_does_nothing(store):
    tape = Tape().buy("a", 1, "10", "2023-08-01 12:00")
    tape.land(store, replay=("inbox", 4))
    version, mark = store.version(), store.manifest()["marks"]
    for number in (4, 3):
        assert tape.land(store, replay=("inbox", number)).rows_read == 0
    assert store.version() == version and store.manifest()["marks"] == mark
    assert tape.land(store, replay=("other inbox", 4)).rows_upserted == 1
    assert Tape().buy("b", 1, "1", "2023-08-02 12:00").land(store, replay=("inbox", 5)).rows_upserted == 1


def test_dimension_keys_are_checked(spark, store):
    def given(*rows):
        return classify(spark.createDataFrame(list(rows), "instrument_id int, symbol string"))

    with pytest.raises(jobs.DimensionKeyError, match="instrument_id"):
        jobs.upsert_instruments(store, given((7, "KO"), (7, "PEP")))
    with pytest.raises(jobs.DimensionKeyError, match="symbol"):
        jobs.upsert_instruments(store, given((8, "AAPL")))
    assert store.instruments().count() == 3
    assert jobs.upsert_instruments(store, given((1, "KO"), (9, "AAPL"))) == 2


# ---------------------------------------------------------------- files


def test_file_order_decides_across_files_and_splits(spark, tmp_path):
    (tmp_path / "part-a.csv").write_text(HEADER + "".join(f"K{i % 50},1,BUY,1,{i},2024-01-01\n" for i in range(3000)))
    (tmp_path / "part-b.csv").write_text(HEADER + "K7,1,BUY,1,99999,2024-01-01\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many splits of part-a
    try:
        rows = read_feed_csv(spark, str(tmp_path))
        assert rows.rdd.getNumPartitions() > 2
        last = {r.trade_id: r.price for r in collapse_duplicates(rows).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert last == {f"K{k}": "99999" if k == 7 else str(2950 + k) for k in range(50)}


def test_every_file_has_its_own_column_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "T1,1,BUY,5,20,2024-01-01\n")
    (tmp_path / "b.csv").write_text('price,executed_at,side,trade_id,quantity,instrument_id\n"1,5",,SELL,T2,7,3\n')
    rows = {r.trade_id: tuple(r)[:6] for r in read_feed_csv(spark, str(tmp_path)).collect()}
    assert rows == {"T1": ("T1", "1", "BUY", "5", "20", "2024-01-01"), "T2": ("T2", "3", "SELL", "7", "1,5", "")}


@pytest.mark.parametrize("head", ["trade_id,side", "trade_id,instrument_id,side,quantity,price,when", "T0,1,BUY,1,1,2024-01-01"])
def test_a_wrong_header_raises_in_batch_and_stream(spark, tmp_path, store, head):
    (tmp_path / "a.csv").write_text(HEADER + "T1,1,BUY,5,20,2024-01-01\n")
    (tmp_path / "b.csv").write_text(head + "\nT2,1,BUY,5,20,2024-01-01\n")
    with pytest.raises(FeedHeaderError):
        read_feed_csv(spark, str(tmp_path))
    query = start_incremental_load(spark, str(tmp_path), store, str(tmp_path / "ckpt"))
    with pytest.raises(PySparkException):
        query.awaitTermination()
    assert store.trades().count() == 0


def test_the_stream_reads_files_of_different_headers(spark, tmp_path, store):
    (tmp_path / "a.csv").write_text(HEADER + "T1,1,BUY,5,20,2024-01-01\n")
    (tmp_path / "b.csv").write_text("side,price,trade_id,instrument_id,executed_at,quantity\nSELL,21,T2,2,2024-01-02,6\n")
    start_incremental_load(spark, str(tmp_path), store, str(tmp_path / "ckpt")).awaitTermination()
    assert {k: (r.instrument_id, r.side, int(r.quantity), int(r.price)) for k, r in table(store).items()} == {
        "T1": (1, "BUY", 5, 20), "T2": (2, "SELL", 6, 21)}


def test_the_feed_is_scanned_once_for_each_order_of_columns(spark, tmp_path):
    """First lines are read by themselves, also of compressed and empty files; files of one order are one scan."""
    import gzip

    (tmp_path / "a.csv").write_text(HEADER + "T1,1,BUY,5,20,2024-01-01\n")
    (tmp_path / "b.csv").write_text("")
    with gzip.open(tmp_path / "c.csv.gz", "wt") as out:
        out.write("\n" + HEADER + "T3,1,BUY,5,20,2024-01-01\n")
    rows = read_feed_csv(spark, str(tmp_path))
    assert rows._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted(r.trade_id for r in rows.collect()) == ["T1", "T3"]
    (tmp_path / "d.csv").write_text('"side",price,"trade_id",instrument_id,executed_at,quantity\nSELL,21,T4,2,2024-01-02,6\n')
    rows = read_feed_csv(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Join" not in plan
    assert {r.trade_id: r.price for r in rows.collect()} == {"T1": "20", "T3": "20", "T4": "21"}


def test_blank_and_short_lines_are_read_and_long_ones_raise(spark, tmp_path):
    good, long_ = tmp_path / "good.csv", tmp_path / "long.csv"
    good.write_text(HEADER + "T1,1,BUY,5,10,2024-01-01T10:00:00Z\n\nT2,1,SELL\n")
    rows = {r.trade_id: r for r in read_feed_csv(spark, str(good)).collect()}
    assert set(rows) == {"T1", "T2"} and (rows["T2"].quantity, rows["T2"].executed_at) == ("", "")
    assert coerce_feed(read_feed_csv(spark, str(good)).drop("feed_order")).where("quantity is null").count() == 1
    long_.write_text(HEADER + "T3,1,BUY,5,10,2024-01-02T10:00:00Z,surplus\n")
    with pytest.raises(PySparkException, match="more than the six fields"):
        read_feed_csv(spark, str(long_)).collect()


def test_a_written_feed_reads_back(spark, tmp_path):
    tape = Tape().raw("T1", 1, " BUY ", 1, "", "x").raw('T"2', 2, "", "1", "2", "2024-01-01").raw("a,b", "", "S", "", "", "")
    path = write_feed_csv(tape.frame(spark), str(tmp_path / "out.csv"))
    assert sorted(tuple(r)[:6] for r in read_feed_csv(spark, path).collect()) == sorted(tape.rows)


def test_one_file_or_two_land_alike(spark, store_factory, tmp_path):
    lines = [f"K{i % 37},{1 + i % 3},BUY,{1 + i % 5},{10 + i},2024-01-{1 + i % 28:02d}T10:00:00Z\n" for i in range(400)]
    one, two = tmp_path / "one", tmp_path / "two"
    one.mkdir()
    two.mkdir()
    (one / "feed.csv").write_text(HEADER + "".join(lines))
    (two / "feed-1.csv").write_text(HEADER + "".join(lines[:250]))
    (two / "feed-2.csv").write_text(HEADER + "".join(lines[250:]))
    a, b = store_factory(), store_factory()
    ra = jobs.load_trades(a, read_feed_csv(spark, str(one)), incremental=False)
    rb = jobs.load_trades(b, read_feed_csv(spark, str(two)), incremental=False)
    assert ra == rb and (ra.rows_read, ra.rows_upserted, ra.duplicates_collapsed) == (400, 37, 363)
    ta, tb = a.trades().drop("ingested_at"), b.trades().drop("ingested_at")
    assert ta.exceptAll(tb).count() == 0 and ta.where("trade_id = 'K0'").first().price == Decimal("380.000000")
