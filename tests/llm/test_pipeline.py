"""The pipeline against a plain version of its stages over a small fixture."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from biblioflow.llm import langid, token_ids
from biblioflow.llm.queries import language_network, toxicity_model
from tests.llm.test_llm import plain_report, shingle_sets


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents in two invented languages; some toxic, copied, without letters, empty or holding a benchmark passage."""
    rng = random.Random(11)
    words = {"xx": ["aei", "lano", "mielo", "onna", "ul", "leim"], "yy": ["zxk", "qjar", "rstz", "kaxz", "tq", "jzzr"]}
    say = lambda lang, n: [rng.choice(words[lang]) + rng.choice(words[lang]) for _ in range(n)]
    passage = say("xx", 20)
    rows, labels = [], []
    for i in range(160):
        lang = ("xx", "yy")[i % 2]
        w = say(lang, rng.randrange(15, 60))
        if i % 5 == 0:
            w[3:3] = ["vile", "scummy"]
        labels.append((i, 1, int(i % 5 == 0)))
        if i % 17 == 3:
            w += passage
        rows.append((i, " ".join(w), lang, f"s{i % 3}", len(w)))
    rows += [(200, rows[1][1], "yy", "s", 1), (201, rows[1][1].upper(), "yy", "s", 1), (202, None, None, None, None), (203, "", "xx", "s", 0), (204, "12 34 ...", "xx", "s", 3), (205, rows[2][1], "xx", "s", 1)]
    near = max((r[1].split() for r in rows[:160] if r[0] % 2 == 0 and r[0] % 5 and r[0] % 17 != 3), key=len)  # copies at similarities of 0.8 or more, and one below
    rows += [(206, " ".join([*near[:-1], "aeiul"]), "xx", "s", 1), (207, " ".join(["lanoei", *near[1:-1], "aeiul"]), "xx", "s", 1), (208, " ".join(w if k % 9 else "onnaei" for k, w in enumerate(near)), "xx", "s", 1)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_match_a_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    model = toxicity_model(docs, labels)
    left = {r["doc_id"]: r["text"] for r in docs.collect() if model.score(r["text"]) < 0.7}
    toxic = {i for i in range(0, 160, 5)}
    assert not toxic & set(left) and set(left) | toxic == {r["doc_id"] for r in docs.collect()}
    net = language_network(docs.where(F.col("doc_id").isin(*left)))
    texts = {i: t for i, t in left.items() if t and any(c.isalpha() for c in t)}
    p = langid.probabilities(net, [t.encode() for t in texts.values()]).max(axis=1)
    least = langid.least_score(net, corpus_pipeline.LANGUAGE_MARGIN)
    assert least == 0.5 + 0.5 * corpus_pipeline.LANGUAGE_MARGIN
    left = {i: t for (i, t), q in zip(texts.items(), p, strict=True) if q >= least}
    assert 201 in left and not {202, 203, 204} & set(left)
    sets, label = {i: shingle_sets(t) for i, t in left.items()}, {i: i for i in left}
    near = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    for _ in near:
        for a, b in near:
            label[a] = label[b] = min(label[a], label[b])
    left = {i: t for i, t in left.items() if label[i] == i}
    assert not {200, 201, 205, 206, 207} & set(left) and 208 in left
    left = {i: left[i] for i, r in plain_report(left, items).items() if not r[3]}
    assert not {i for i in range(160) if i % 17 == 3} & set(left) and len(left) > 100
    encoder = token_ids.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: encoder.encode([t])[0] + bytes(4) for i, t in left.items()}
    got: dict = {}
    for r in sorted(corpus_pipeline.run(spark, folder).collect(), key=lambda r: r["start"]):
        got[r["doc_id"]] = got.get(r["doc_id"], b"") + bytes(r["ids"])
    assert got == want


def test_stages_return_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language_id", "simhash_near_dedup", "benchmark_decontamination", "packing"]


def test_stages_accept_an_empty_table(spark, folder):
    none = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0
