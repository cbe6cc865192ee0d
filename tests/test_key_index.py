"""The index of registered keys: answers as a plain set gives them, plans that leave the registry where it lies."""

from __future__ import annotations

import datetime as dt

import pytest

from folioflow.sinks import key_index
from folioflow.sinks.registry import InvoiceRegistry

NOW = dt.datetime(2026, 4, 8)


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "name string")


@pytest.fixture
def registry(spark, tmp_path):
    registry = InvoiceRegistry(spark, str(tmp_path / "invoices"))
    for batch in range(3):
        registry.write_names(f"b{batch}", names(spark, [f"/Key{k}.XML" for k in range(batch * 300, batch * 300 + 400)] + [None, " "]))
        registry.commit(f"b{batch}", NOW)
    return registry


def found(registry, spark, values):
    return sorted(r["registered_key"] for r in registry.known(names(spark, values)).collect())


def test_known_keys_of_small_and_large_batches(spark, registry, monkeypatch):
    asked = [f"/key{k}.xml" for k in range(-5, 1400, 7)] + [None, "", "  ", "/key8.xml", "/key8.xml"]
    wanted = sorted({f"/key{k}.xml" for k in range(-5, 1400, 7) if 0 <= k < 1000} | {"/key8.xml"})
    assert found(registry, spark, asked) == wanted
    assert found(registry, spark, []) == [] and found(registry, spark, [None]) == []
    monkeypatch.setattr(key_index, "MOST_SENT", 3)
    assert set(wanted) <= set(found(registry, spark, asked)) and len(found(registry, spark, asked)) == 1000


def test_a_full_sketch_gives_the_same_answers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(key_index, "WORDS", 1)
    monkeypatch.setattr(key_index, "PREFIXES", 2)
    registry = InvoiceRegistry(spark, str(tmp_path / "r"))
    registry.write_names("b", names(spark, [f"k{k}" for k in range(500)]))
    assert found(registry, spark, ["k1"]) == []  # not committed yet
    registry.commit("b", NOW)
    assert registry._maybe(names(spark, ["x1", "x2"]).selectExpr("name as key", "0 as prefix"), [0]).count() == 2
    assert found(registry, spark, ["k1", "k499", "k500", "x"]) == ["k1", "k499"]


def test_most_unknown_keys_are_told_by_the_sketch(spark, registry):
    asked = names(spark, [f"new{k}" for k in range(2000)]).selectExpr("name as key")
    asked = asked.withColumn("prefix", key_index.prefix_of(asked["key"]))
    assert registry._maybe(asked, list(range(key_index.PREFIXES))).count() < 20


def test_a_small_batch_leaves_the_registry_where_it_lies(spark, registry):
    plan = registry.known(names(spark, ["/key1.xml", "/key2000.xml"]))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scan = next(k for k, line in enumerate(lines) if "FileScan" in line and "struct<key:string,prefix:int>" in line)
    assert "EqualTo(prefix" in lines[scan] or "In(prefix" in lines[scan]
    # From the scan of the keys up to the result of the semi join there is no exchange of them.
    semi = max(k for k, line in enumerate(lines[:scan]) if "LeftSemi" in line and "prefix" in line)
    assert "BroadcastHashJoin" in lines[semi]
    assert not any("Exchange" in line and "Broadcast" not in line for line in lines[semi:scan])
