"""The incremental file stream lands new files through the same load job."""

from __future__ import annotations

from ledgerloom.session import scratch_dir
from ledgerloom.streaming.incremental import start_incremental_load

HEADER = "trade_id,instrument_id,side,quantity,price,executed_at\n"


def test_available_now_stream_lands_new_files_once(spark, store, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    ckpt = scratch_dir(spark, "stream-ckpt")
    (inbox / "a.csv").write_text(HEADER + "T1,1,BUY,10,5,2024-01-01T10:00:00+00:00\nT2,1,SELL,5,6,2024-01-02T10:00:00+00:00\n")
    q = start_incremental_load(spark, str(inbox), store, ckpt)
    q.awaitTermination(120)
    assert store.trades().count() == 2
    (inbox / "b.csv").write_text(HEADER + "T2,1,SELL,5,7,2024-01-03T10:00:00+00:00\nT3,1,BUY,1,1,2024-01-01T00:00:00+00:00\n")
    q = start_incremental_load(spark, str(inbox), store, ckpt)
    q.awaitTermination(120)
    rows = {r.trade_id: r for r in store.trades().collect()}
    assert set(rows) == {"T1", "T2"}  # T3 is at or below the mark (Jan 2): skipped
    assert str(rows["T2"].price) == "7.000000"
    assert store.manifest()["marks"]["trades_csv"]["watermark_at"] == "2024-01-03T10:00:00+00:00"


def test_each_micro_batch_is_its_own_load(spark, store, tmp_path):
    """maxFilesPerTrigger=1: two micro-batches, two commits; the second sees the first's mark."""
    import os
    import time

    inbox = tmp_path / "inbox2"
    inbox.mkdir()
    (inbox / "a.csv").write_text(HEADER + "A1,1,BUY,1,5,2024-01-05T00:00:00Z\n")
    time.sleep(1.1)
    (inbox / "b.csv").write_text(HEADER + "B1,1,BUY,1,5,2024-01-01T00:00:00Z\nB2,1,BUY,1,5,2024-01-10T00:00:00Z\n")
    os.utime(inbox / "a.csv", (time.time() - 60, time.time() - 60))  # a is older: processed first
    before = store.version()
    q = start_incremental_load(spark, str(inbox), store, scratch_dir(spark, "stream-ckpt"),
                               max_files_per_trigger=1)
    q.awaitTermination(120)
    assert store.version() == before + 2
    assert sorted(r.trade_id for r in store.trades().collect()) == ["A1", "B2"]  # B1 <= the mark of batch 1
    assert store.manifest()["marks"]["trades_csv"]["rows_loaded"] == 2


def test_a_replayed_micro_batch_counts_once(spark, store, tmp_path):
    """The stream's record of the commit is lost after the load: the micro-batch runs again and changes nothing."""
    from pathlib import Path

    inbox = tmp_path / "inbox3"
    inbox.mkdir()
    (inbox / "a.csv").write_text(HEADER + "T1,1,BUY,10,5,2024-01-01T10:00:00Z\nT2,1,SELL,5,6,2024-01-02T10:00:00Z\n")
    ckpt = str(tmp_path / "ckpt")
    start_incremental_load(spark, str(inbox), store, ckpt).awaitTermination(120)
    mark, version = store.manifest()["marks"], store.version()
    for done in (Path(ckpt) / "commits").iterdir():
        done.unlink()
    start_incremental_load(spark, str(inbox), store, ckpt).awaitTermination(120)
    assert store.version() == version and store.manifest()["marks"] == mark and store.trades().count() == 2
    (inbox / "b.csv").write_text(HEADER + "T3,1,BUY,1,1,2024-01-03T00:00:00Z\n")
    start_incremental_load(spark, str(inbox), store, ckpt).awaitTermination(120)
    assert store.trades().count() == 3 and store.manifest()["marks"]["trades_csv"]["rows_loaded"] == 3
