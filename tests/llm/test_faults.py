"""Files of one name, repeated rows, many languages, nested maps and variants, many dimensions."""

from __future__ import annotations

import shutil
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from biblioflow.llm import backoff_lm, common, dac, decontam, hilbert, langid, packing, repetition, resampling, simhash, token_ids, toxicity
from tests.llm.test_edges import folder  # noqa: F401

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def test_two_tokenizers_of_one_file_name(spark, tmp_path):
    docs = spark.createDataFrame([(1, "One sentence, and another <|ENDOFTEXT|> ."), (2, None)], "doc_id long, text string")
    for k, path in enumerate((WORD, BYTE, WORD)):
        own = tmp_path / str(k) / "tokenizer.json"
        own.parent.mkdir()
        shutil.copy(path, own)
        want = {i: len(token_ids.Encoder(path).encode([t])[0]) // 4 + 1 for i, t in docs.collect()}
        got = packing.pack(docs, str(own)).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
        assert {r["doc_id"]: r["n"] for r in got} == want
    assert spark.range(10, numPartitions=4).selectExpr("sum(id)").first()[0] == 45


def test_a_language_of_repeated_rows_is_learned(spark):
    rows = spark.range(40_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("der die das und nicht ein").alias("text"), F.lit("big").alias("lang"))
    few = spark.createDataFrame([(10 + k, f"the cat number {k} sat on that mat", "small") for k in range(100)], rows.schema)
    net = langid.train(rows.unionByName(few), F.lit(True))
    assert net.languages == ["big", "small"]
    got = {r["lang"]: r["lang_pred"] for r in langid.predicted(rows.limit(3).unionByName(few.limit(3)), net).select("lang", "lang_pred").collect()}
    assert got == {"big": "big", "small": "small"}
    assert langid.train(few.withColumn("lang", F.col("doc_id").cast("string")), F.lit(True), most=7, windows=1).languages == sorted(str(10 + k) for k in range(100))[:7]


@pytest.mark.parametrize("n", [4, 100, 300])
def test_memory_does_not_grow_with_the_languages(n):
    net = langid.start([f"l{k}" for k in range(n)])
    texts = [b"some text of words " * 480 for _ in range(30)]
    tracemalloc.start()
    p = langid.probabilities(net, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert p.shape == (30, n) and np.allclose(p.sum(axis=1), 1, atol=1e-4) and peak < 200e6


def nested(spark):
    """Rows that differ by what lies inside a metadata column only."""
    say = lambda k: " ".join(f"t{k}w{j}" for j in range(30))
    d = spark.createDataFrame([(k, say(k // 2), "en", "a", k % 3) for k in range(12)], "doc_id long, text string, lang string, source string, n_chars long")
    return d.selectExpr("*", "array(map('k', array(map(doc_id, 'v'), null)), null) AS deep", "parse_json(concat('{\"a\": ', doc_id, '}')) AS said", "named_struct('m', map('x', named_struct('y', map(1, text)))) AS s", "map() AS none")


def test_row_keys_of_nested_maps_variants_and_nulls(spark):
    d = nested(spark)
    assert d.select(common.row_key(d).alias("k")).distinct().count() == 12
    pairs = spark.createDataFrame([((None, "x"), [None, "x"]), (("x", None), [None, "x"]), ((None, "x"), ["x", None]), ((None, "x"), [None, "x"])], "s struct<a: string, b: string>, l array<string>")
    keys = [tuple(r["k"]) for r in pairs.select(common.row_key(pairs).alias("k")).collect()]
    assert Counter(Counter(keys).values()) == {1: 2, 2: 1}
    same = spark.sql("SELECT map('a', map(1, 2, 3, 4), 'b', map()) AS m UNION ALL SELECT map('b', map(), 'a', map(3, 4, 1, 2))")
    assert same.select(common.row_key(same).alias("k")).distinct().count() == 1


def test_operators_and_stages_with_nested_columns(spark, folder):  # noqa: F811
    d = nested(spark)
    labels = spark.createDataFrame([(k, k % 2) for k in range(8)], "doc_id long, toxic int")
    model = toxicity.train(d, labels, F.lit(True))
    assert toxicity.scored(d, model).count() == 12 and langid.predicted(d, langid.train(d, F.lit(True))).count() == 12
    assert hilbert.write(d.drop("said", "none"), ["source", "n_chars"], shards=2).count() == 12
    assert repetition.judged(d).count() == simhash.near_duplicates(d).count() == 12
    assert dac.read(dac.write(d, WORD, 2)).count() == backoff_lm.scored(d, F.lit(True)).count() == 12
    target = spark.createDataFrame([(1, "t0w1 t0w2")], "item_id long, text string")
    assert decontam.report(d, target).count() == resampling.resampled(d, target).count() == 12
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, d, folder)
        assert got.columns == d.columns, name
        if name == "simhash_near_dedup":
            assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == [0, 2, 4, 6, 8, 10]
    assert corpus_pipeline.STAGES[-1][1](spark, d, folder).select("doc_id").distinct().count() == 12


def test_many_dimensions(spark):
    d = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), *[(F.col("id") * p % 97).alias(f"d{p}") for p in (2, 3, 5, 7, 11, 13, 17)])
    got = hilbert.write(d, [c for c in d.columns if c[0] == "d" and c != "doc_id"], shards=4).collect()
    assert sorted(r["rank"] for r in got) == list(range(500)) and Counter(r["shard"] for r in got) == dict.fromkeys(range(4), 125)


def test_copies_alike_in_every_column_leave_one(spark):
    say = lambda k: " ".join(f"t{k}w{j}" for j in range(30))
    rows = [(1, say(1))] * 3 + [(2, say(1)), (3, say(2)), (4, say(3)), (4, say(3)), (5, say(3) + " more")]
    got = simhash.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 3, 4]
