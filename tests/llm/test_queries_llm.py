"""The SQL twins of the training-data queries, and the contract's columns of the others."""

from __future__ import annotations

import zlib
from pathlib import Path

import pytest

from biblioflow.llm.queries import ORACLES, QUERIES
from tests.twins import compare

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the supplied tables are not here")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_its_twins_rows(spark, name):
    compare(spark, QUERIES[name], ORACLES[name], FOLDER)


def test_shards_of_documents(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op2_hilbert"](spark, FOLDER).collect()
    assert len(got) == len(docs)
    for r in got:
        data = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 1, zlib.crc32(data), "rows")


def test_classifiers_on_held_out_rows(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op10_langid"](spark, FOLDER).collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(lang[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    toxic = QUERIES["op1_toxicity"](spark, FOLDER).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in toxic)
