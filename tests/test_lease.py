"""One daily run at a time: in a process, across processes, and when a run dies or is too slow."""

from __future__ import annotations

import datetime as dt
import os
import subprocess
import sys
import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from folioflow.plans.jobs import DailyRun
from folioflow.plans.lease import LeaseLost, RunLease
from folioflow.sinks.registry import GuideRegistry, InvoiceRegistry
from tests.samples import Landing, invoice

NOW = dt.datetime(2026, 4, 8, 9, 0)
HOUR = dt.timedelta(hours=1)


def test_take_renew_release(spark, tmp_path):
    first, second = (RunLease(spark, str(tmp_path / "lease"), HOUR) for _ in range(2))
    assert (first.take(), second.take(), first.renew(), second.take()) == (1, None, 2, None)
    first.release()
    first.release()
    assert second.take() == 3
    with pytest.raises(LeaseLost):
        first.renew()
    # Only the newest number is kept.
    assert [p.name for p in (tmp_path / "lease").iterdir() if not p.name.startswith(".")] == ["000000000003"]


def test_expired_lease_is_taken_over_by_one(spark, tmp_path):
    slow = RunLease(spark, str(tmp_path / "lease"), HOUR)
    assert slow.take() == 1
    late = [RunLease(spark, str(tmp_path / "lease"), HOUR, lambda: time.time() + 7200) for _ in range(6)]
    with ThreadPoolExecutor(6) as pool:
        taken = list(pool.map(RunLease.take, late))
    assert sorted(taken, key=str) == [2, None, None, None, None, None]
    with pytest.raises(LeaseLost):
        slow.renew()
    slow.release()
    assert RunLease(spark, str(tmp_path / "lease"), HOUR).take() is None


def test_other_process_is_kept_out(spark, tmp_path):
    lease = RunLease(spark, str(tmp_path / "lease"), HOUR)
    assert lease.take() == 1
    code = (
        "import sys; from folioflow.session import local_session; from folioflow.plans.lease import RunLease\n"
        "spark = local_session('1'); print('took', RunLease(spark, sys.argv[1]).take()); spark.stop()"
    )

    def other():
        done = subprocess.run(
            [sys.executable, "-c", code, str(tmp_path / "lease")], capture_output=True, text=True, timeout=120,
            env={**os.environ, "PYTHONPATH": os.getcwd()},
        )
        return done.stdout.strip().splitlines()[-1]

    assert other() == "took None"
    lease.release()
    assert other() == "took 2"


def test_run_that_was_taken_over_commits_nothing(spark, tmp_path, monkeypatch):
    landing = Landing(tmp_path)
    landing.put("xml", "a.xml", invoice())
    guides, invoices = GuideRegistry(spark, str(tmp_path / "g")), InvoiceRegistry(spark, str(tmp_path / "i"))
    lease, other = (RunLease(spark, str(tmp_path / "lease"), HOUR) for _ in range(2))
    run = DailyRun(spark, landing.folders, guides, invoices, lease=lease)

    def overtaken(*_, **__):
        later = RunLease(spark, str(tmp_path / "lease"), HOUR, lambda: time.time() + 7200)
        assert later.take() == 2
        return real(*_, **__)

    real = invoices.append
    with monkeypatch.context() as patch:
        patch.setattr(invoices, "append", overtaken)
        (row,) = run.run(NOW, pipelines=("invoice",)).collect()
    assert "taken over" in row["error"] and invoices.headers().count() == 0
    assert run.run(NOW, pipelines=("invoice",)) is None
    other.number = 2
    other.release()
    (row,) = run.run(NOW, pipelines=("invoice",)).collect()
    assert (row["error"], row["processed"], invoices.headers().count()) == (None, 1, 1)
    assert invoices.guard is None and lease.number is None
