"""Listings that tasks make, against those of Spark's own file source."""

from __future__ import annotations

import os

import pytest

from folioflow.sources.landing import TXT_FILES, XML_FILES, _listed_by_driver, _timed, list_files, stream_listing


def test_same_files_as_the_file_source(spark, tmp_path):
    (tmp_path / "sub.txt").mkdir()
    for i, name in enumerate(("a.txt", "B.TXT", ".h.txt", "_x.txt", "_a=b.txt", "a b%20ñ.txt", "c.pdf", "x.txt._COPYING_", "x..txt")):
        (tmp_path / name).write_text("x" * (i + 1))
        os.utime(tmp_path / name, (1_700_000_000.123 + i,) * 2)
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "gone.txt").symlink_to(tmp_path / "nowhere")
    listed = list_files(spark, str(tmp_path), TXT_FILES)
    assert "binaryFile" not in listed._jdf.queryExecution().toString()
    (tmp_path / "gone.txt").unlink()
    assert sorted(listed.collect()) == sorted(_timed(_listed_by_driver(spark, str(tmp_path), TXT_FILES)).collect())
    assert listed.count() == 5


def test_no_such_folder(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        list_files(spark, str(tmp_path / "none"), TXT_FILES)


def test_stream_takes_each_file_once_oldest_first(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()
    taken = []

    def run():
        stream = stream_listing(spark, str(landing), XML_FILES, str(tmp_path / "arrivals"), 3)
        writer = stream.writeStream.foreachBatch(lambda rows, _: taken.append([r.path.rsplit("/", 1)[1] for r in rows.collect()]))
        writer.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()

    def put(i):
        (landing / f"{i:02d}.xml").write_text("x")
        os.utime(landing / f"{i:02d}.xml", (1_700_000_000 - i,) * 2)

    for i in range(8):
        put(i)
    run()
    assert sum(taken, []) == [f"{i:02d}.xml" for i in reversed(range(8))] and max(map(len, taken)) <= 3
    taken.clear()
    run()
    assert sum(taken, []) == []
    put(9)
    run()
    assert sum(taken, []) == ["09.xml"]
