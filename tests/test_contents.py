"""Exact reads and copies of single files."""

from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from folioflow.sinks.copies import copy_files, write_files
from folioflow.sources import contents, landing
from folioflow.sources.contents import read_files, read_texts
from folioflow.sources.landing import TXT_FILES, list_files, read_content, read_documents
from folioflow.sources.stores import Stores, as_text, reachable


@pytest.fixture
def folder(tmp_path):
    for k in range(40):
        (tmp_path / f"file {k:02d}ñ%.txt").write_text(f"text {k}" * (1 + k % 3))
    return tmp_path


def test_only_wanted_files_are_opened(spark, folder):
    listed = list_files(spark, str(folder), TXT_FILES)
    wanted = listed.where(F.col("path").rlike("0[0-7]ñ")).withColumn("tag", F.col("length") * 2)
    paths = [r["path"] for r in wanted.collect()]
    assert len(paths) == 8
    frozen = spark.createDataFrame([tuple(r) for r in wanted.collect()], wanted.schema)
    plan = read_content(spark, str(folder), TXT_FILES, listed)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "content" not in plan.split("ReadSchema")[-1]
    # Whatever is not wanted is gone before anything is read; opening it would fail.
    for file in folder.iterdir():
        if not any(p.endswith(file.name) for p in paths):
            file.unlink()
    found = {r["path"]: (r["value"], r["error"], r["tag"]) for r in read_texts(frozen, "tag").collect()}
    assert found == {p: (t := f"text {k}" * (1 + k % 3), None, 2 * len(t)) for k, p in enumerate(sorted(paths))}


def test_files_that_are_gone_are_rows_with_an_error(spark, folder, monkeypatch):
    monkeypatch.setattr(contents, "BATCH_FILES", 3)
    listed = list_files(spark, str(folder), TXT_FILES).collect()
    frozen = spark.createDataFrame([tuple(r) for r in listed], list_files(spark, str(folder), TXT_FILES).schema)
    (folder / "file 01ñ%.txt").unlink()
    rows = {r["path"].rsplit("/", 1)[1]: r for r in read_files(frozen).collect()}
    assert len(rows) == 40
    assert rows["file 01ñ%.txt"]["content"] is None and "FileNotFound" in rows["file 01ñ%.txt"]["error"]
    assert bytes(rows["file 02ñ%.txt"]["content"]) == b"text 2" * 3 and rows["file 02ñ%.txt"]["error"] is None
    assert read_content(spark, str(folder), TXT_FILES, frozen).count() == 39
    assert read_documents(spark, str(folder), TXT_FILES, frozen).where("value is null").count() == 1


def test_nothing_wanted_and_folders_only_spark_reaches(spark, folder):
    listed = list_files(spark, str(folder), TXT_FILES)
    assert read_files(listed.limit(0)).count() == 0
    assert reachable(str(folder)) and reachable(f"file://{folder}") and not reachable("viewfs://store/in")
    scanned = landing._scanned(spark, str(folder), TXT_FILES, listed.where("length > 7"))
    exact = read_content(spark, str(folder), TXT_FILES, listed.where("length > 7"))
    assert sorted(map(str, scanned.collect())) == sorted(map(str, exact.collect()))


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "utf-16", "utf-16-be", "utf-32", "utf-32-be"])
def test_byte_order_marks(encoding):
    mark = {"utf-16-be": b"\xfe\xff", "utf-32-be": b"\x00\x00\xfe\xff"}.get(encoding, b"")
    assert as_text(mark + "A;Serie;1;ñ€\U0001f4c4\n".encode(encoding)) == "A;Serie;1;ñ€\U0001f4c4\n"
    assert as_text(b"\xff\xfea") == "�" and as_text(b"a\xf1") == "a�" and as_text(b"") == ""


def test_copies_are_whole_and_failures_are_rows(spark, folder, tmp_path):
    listed = list_files(spark, str(folder), TXT_FILES)
    wanted = listed.withColumn("target", F.concat(F.lit(f"{tmp_path}/out/"), F.col("length"), F.lit("/"), F.element_at(F.split("path", "/"), -1)))
    broken = spark.createDataFrame([(f"{folder}/none.txt", f"{tmp_path}/out/none.txt", 5)], "path string, target string, length long")
    (tmp_path / "taken").write_text("a file where a folder is needed")
    blocked = listed.limit(1).withColumn("target", F.lit(f"{tmp_path}/taken/x.txt"))
    rows = wanted.select("path", "target", "length").unionByName(broken).unionByName(blocked.select("path", "target", "length"))
    for _ in range(2):  # a second copy replaces the first
        outcomes = {r["target"]: r for r in copy_files(rows).collect()}
        failed = {t for t, r in outcomes.items() if r["error"]}
        assert failed == {f"{tmp_path}/out/none.txt", f"{tmp_path}/taken/x.txt"}
        for target, r in outcomes.items():
            if target not in failed:
                with open(target, "rb") as copy, open(r["path"].removeprefix("file:"), "rb") as source:
                    data = copy.read()
                    assert data == source.read() and r["bytes"] == len(data) and r["sha256"] == hashlib.sha256(data).hexdigest()
    left = [f.name for f in (tmp_path / "out").rglob("*") if f.is_file()]
    assert sorted(left) == sorted(f"file {k:02d}ñ%.txt" for k in range(40))


def test_a_write_that_breaks_off_leaves_the_old_file(tmp_path):
    target = tmp_path / "a.txt"
    target.write_text("old")

    def broken(out):
        out.write(b"half")
        raise OSError("disk is full")

    with pytest.raises(OSError):
        Stores().put(str(target), broken, "1")
    assert target.read_text() == "old" and [f.name for f in tmp_path.iterdir()] == ["a.txt"]


def test_unfinished_files_lie_in_a_folder_of_their_attempt(spark, tmp_path):
    seen = []

    def write(out):
        out.write(b"x")
        seen.extend((f.name, f.is_dir()) for f in tmp_path.iterdir())

    # As long as a name may be: there is no room for an attempt beside it.
    name = "a" * 251 + ".txt"
    stores = Stores()
    stores.put(f"file:{tmp_path}/{name}", write, "7")
    stores.close()
    assert seen == [(".7", True)] and [f.name for f in tmp_path.iterdir()] == [name]
    assert stores.about(f"file:{tmp_path}/{name}")[0] == 1 and stores.about(str(tmp_path)) is None
    rows = spark.createDataFrame([(f"{tmp_path}/{name}", "yy")], "target string, content string")
    assert [r["error"] for r in write_files(rows).collect()] == [None]
    assert (tmp_path / name).read_text() == "yy" and len(list(tmp_path.iterdir())) == 1


def test_rows_are_made_once_to_be_dealt_out(spark, folder):
    listed = list_files(spark, str(folder), TXT_FILES)
    made = listed.withColumn("length", F.col("length") + F.floor(F.rand()).cast("long"))
    plan = contents.dealt_out(made)._jdf.queryExecution().toString()
    assert "rand" not in plan


def test_files_from_rows_keep_their_write_time(spark, tmp_path):
    rows = spark.createDataFrame(
        [(f"{tmp_path}/x/a.txt", "ñ", 1_000_000_000), (f"file:{tmp_path}/x/b.txt", None, None)], "target string, content string, modified long"
    )
    assert {r["bytes"] for r in write_files(rows).collect()} == {0, 2}
    assert os.stat(tmp_path / "x/a.txt").st_mtime == 1_000_000_000 and (tmp_path / "x/b.txt").read_bytes() == b""
