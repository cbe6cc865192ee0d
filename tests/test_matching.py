"""PDFs and records that meet in a stream's state, on real files and on tables with times of their own."""

from __future__ import annotations

import datetime as dt
import time

import pytest

from folioflow.sinks.registry import GuideRegistry
from folioflow.streaming import ingest, matching, remainders, stateful
from tests.samples import Landing, record

NOW = dt.datetime(2026, 4, 8, 9, 0)


@pytest.fixture
def pairs(spark, tmp_path):
    """A landing folder, its registry, and a function that drains the stream once."""
    landing, registry = Landing(tmp_path), GuideRegistry(spark, str(tmp_path / "guides"))

    def run(within="1 day"):
        ingest.guides_from_pairs(
            registry, landing.folders, str(tmp_path / "state"), lambda: NOW, within=within, outcomes=str(tmp_path / "log")
        ).awaitTermination()
        return sorted(row["greName"] for row in registry.read().collect())

    return landing, run


def test_whichever_comes_first(pairs):
    landing, run = pairs
    landing.put("pdf", "20990011224-09-T001-00000001.pdf", "early")
    landing.put("txt", "20990011224-t001-0000002.TXT", record(serie="T001", number="0000002"))
    landing.guide("0000003")
    landing.put("pdf", "20990011224-09-T001-00000004.pdf", "")
    landing.put("pdf", "short-name.pdf", "x")
    assert run() == ["GR-0T001-0000003"]
    landing.put("txt", "20990011224-T001-0000001.txt", record(serie="T001", number="0000001"))
    landing.put("pdf", "20990011224-09-T001-00000002.PDF", "late")
    assert run() == ["GR-0T001-0000001", "GR-0T001-0000002", "GR-0T001-0000003"]
    assert run() == ["GR-0T001-0000001", "GR-0T001-0000002", "GR-0T001-0000003"]


def test_a_pdf_alone_is_judged_when_its_time_is_over(spark, pairs, tmp_path):
    landing, run = pairs
    landing.put("pdf", "20990011224-09-T001-00000001.pdf", "alone")
    landing.put("pdf", "short-name.pdf", "x")
    assert run("1 second") == []
    time.sleep(2)
    landing.guide("0000002")
    assert run("1 second") == ["GR-0T001-0000002"]
    log = spark.read.parquet(str(tmp_path / "log"))
    said = {row["path"].rsplit("/", 1)[1]: (row["success"], row["error"]) for row in log.collect()}
    assert said == {
        "20990011224-09-T001-00000001.pdf": (True, "record_missing"), "short-name.pdf": (False, "bad_file_name"),
        "20990011224-09-T001-00000002.pdf": (True, None),
    }


def test_time_on_both_sides_and_repeated_records(spark, tmp_path):
    hour = dt.timedelta(hours=1)
    schema = "path string, arrived_at timestamp"
    name = "20990011224-T001-000000{}.txt"
    pdfs = [(f"/p/20990011224-09-T001-0000000{n}.pdf", NOW) for n in range(1, 6)] + [("/p/odd.pdf", NOW), (None, NOW)]
    texts = [
        (1, NOW - hour), (1, NOW + hour), (2, NOW - 2 * hour), (3, NOW + 2 * hour), (4, NOW + 3 * hour), (9, NOW),
        (5, NOW - dt.timedelta(days=3)),
    ]
    for folder, rows in (("pdf", pdfs), ("txt", [("/t/" + name.format(f"{n}"), at) for n, at in texts])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / folder))

    def stream(folder):
        return spark.readStream.schema(schema).parquet(str(tmp_path / folder))

    records = stream("txt").selectExpr("path", "arrived_at", "struct(path, arrived_at) as record")
    with stateful.rocksdb_state(spark):
        met = matching.matched_records(stream("pdf"), records, "2 hours", "7 days").select("path", "record.arrived_at")
        query = met.writeStream.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
        query.format("parquet").start(str(tmp_path / "out")).awaitTermination()
        found = [(r["path"][-5:-4], r["arrived_at"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
        waiting = {row["path"] for row in remainders.open_pdfs(spark, str(tmp_path / "state")).collect()}
    assert sorted(found) == [("1", NOW - hour), ("1", NOW + hour), ("2", NOW - 2 * hour), ("3", NOW + 2 * hour)]
    assert waiting == {pdfs[3][0], pdfs[4][0], "/p/odd.pdf", None}
