"""The command line drives the same jobs, in the session its launcher configured."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from ledgerloom.__main__ import main
from ledgerloom.plans import jobs
from ledgerloom.session import scratch_dir
from tests.conftest import Tape


def test_a_demo_a_late_load_and_a_run_from_a_date(spark, tmp_path, capsys):
    root = scratch_dir(spark, "cli")
    assert main(["demo", "--root", root, "--sf-dir", "/root/testdata/sf0.001"]) == 0
    out = capsys.readouterr().out
    assert "1000 of 1000 feed rows landed" in out and "trade_rows = 1000" in out
    (tmp_path / "late.csv").write_text("executed_at,trade_id,instrument_id,side,quantity,price\n"
                                       "2030-01-01T00:00:00Z,L1,1,BUY,1,1\n2000-01-01T00:00:00Z,L2,1,BUY,1,1\n")
    assert main(["load", "--root", root, "--file", str(tmp_path / "late.csv")]) == 0
    assert "1 of 2 feed rows landed (1 not after the mark, 0 repeated)" in capsys.readouterr().out
    assert main(["pnl", "--root", root, "--since", "2030-01-01", "--carry-in", "--hot-rows", "1"]) == 0
    assert "daily_pnl: 1 instrument-days, 2030-01-01 onwards" in capsys.readouterr().out
    assert main(["stats", "--root", root]) == 0
    assert "trade_rows = 1001" in capsys.readouterr().out


def test_reset_leaves_earlier_versions_readable(store):
    Tape().buy("a", 1, "1", "2023-08-01 12:00").land(store)
    jobs.compute_daily_pnl(store)
    before = store.manifest()
    assert main(["reset", "--root", store.root, "--yes"]) == 0
    assert store.trades().count() == store.daily_pnl().count() == store.instruments().count() == 0
    assert store.read_mark() is None and store.trades(before).count() == 1


def test_master_and_partitions_of_the_launcher_are_kept(tmp_path):
    code = ("from ledgerloom.__main__ import main\nfrom pyspark.sql import SparkSession\n"
            f"main(['init', '--root', '{tmp_path}/store'])\n"
            "s = SparkSession.getActiveSession()\nprint(s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))")
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--master local[3] --conf spark.sql.shuffle.partitions=5 "
                                               "--conf spark.ui.enabled=false pyspark-shell"}
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], env=env,
                          capture_output=True, text=True, timeout=300)
    assert done.stdout.splitlines()[-1] == "local[3] 5", done.stderr[-800:]
