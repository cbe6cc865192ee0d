"""Every stage of the pipeline on what the one before kept, against SQL or plain Python."""

from __future__ import annotations

from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from folioflow.llm.queries import ORACLE
from tests.llm.test_packing import check_places, ids_of
from tests.llm.test_secrets import plain_base
from tests.llm.test_simhash import plain_components, plain_fingerprint

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, tmp_path):
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        out[name] = docs.collect()
        if name != "packing":
            assert docs.columns == COLUMNS

    sql = duckdb.connect()
    sql.execute(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    kept = {r[0] for r in sql.execute(f"select doc_id from ({ORACLE['op2_line_frequency']}) where kept").fetchall()}
    assert {r["doc_id"] for r in out["quality"]} == kept

    fps = {r["doc_id"]: plain_fingerprint(r["text"]) for r in out["quality"]}
    assert {r["doc_id"] for r in out["near_dedup"]} == set(plain_components(fps).values())

    before = {r["doc_id"]: r["text"] for r in out["near_dedup"]}
    after = {r["doc_id"]: r["text"] for r in out["secrets"]}
    assert set(before) == set(after)
    for doc_id, text in before.items():
        assert not plain_base(after[doc_id])
        assert plain_base(text) or after[doc_id] == text

    sql.execute(f"create or replace view documents as select * from '{tmp_path}/secrets/*.parquet'")
    wanted = sql.execute(f"select doc_id, size, taken from ({ORACLE['op4_pareto_mixture']})").fetchall()
    copies = Counter(r["doc_id"] for r in out["mixture"])
    assert all(copies[d] == (taken // size if size else copies[d]) for d, size, taken in wanted)

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert Counter((r["doc_id"], r["piece"]) for r in out["packing"]) == Counter(
        (r["doc_id"], k) for r in out["mixture"] for k in range(-(-len(ids_of(plain, r["text"])) // 4096))
    )
    check_places([r for r in out["packing"]])
    assert np.mean([r["length"] for r in out["packing"]]) > 1


def test_an_empty_corpus_goes_through(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.count() == 0
