"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, shared ids, clashing columns, empty tables."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from biblioflow.llm import chat, common, dac, decontam, hilbert, langid, packing, repetition, simhash, token_ids, toxicity, url_filter
from biblioflow.llm.queries import URL_RULES
from tests.llm.test_llm import plain_components, plain_fingerprint, plain_report, shingle_sets

#: Names that the operators use inside or give out.
CLASHING = ("_key", "_bad", "_keep", "_g", "_t", "_number", "_p", "_id", "_text", "_label", "key", "node", "fp", "row", "at", "term", "words", "lang_pred", "score", "shard", "slot", "rank", "label", "predicted", "length", "start")
DDL = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
LONG = " ".join(f"word{i % 997}x{i}" for i in range(20_000))
PASSAGE = " ".join(f"passage{j}" for j in range(20))
WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def odd_rows() -> list[tuple]:
    say = lambda i, n=40: " ".join(f"t{i}w{j}" for j in range(n))
    given = [(1, None), (2, ""), (3, " \n "), (4, "one two"), (5, LONG), (6, "Ünï <turn> \\ 東京"), (6, "Ünï <turn> \\ 東京"), (None, say(0)), (None, say(1)), (None, say(0)), (7, say(2)), (7, say(3)), (7, say(1)), (8, say(2)), (8, PASSAGE), (None, f"{say(4)} {PASSAGE}"), (8, say(5)), (9, "12 34 ..."), (10, "<|endoftext|> a")]
    rows = [(i, t, ["en", "de", None][k % 3], ["a", None][k % 2], k if k % 4 else None) for k, (i, t) in enumerate(given)]
    rows = [(*r, *(f"{c}{k}" if k % 5 else None for c in CLASHING)) for k, r in enumerate(rows)]
    rows[6] = rows[5]  # alike in every column
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(), DDL)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def own(rows) -> Counter:
    return Counter(tuple(r) for r in rows)


def test_row_keys_tell_rows_apart_by_every_column(docs):
    keys = Counter(tuple(r["k"]) for r in docs.select(common.row_key(docs).alias("k")).collect())
    assert sorted(keys.values()) == [1] * (len(odd_rows()) - 2) + [2]
    assert common.spare(docs, "_KEY") == "_KEY_"


def test_toxicity_scores_every_row_and_replaces_its_own_column(spark, docs, none):
    labels = spark.createDataFrame([(4, 1), (7, 0), (8, 1), (5, 0), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    got = toxicity.scored(docs, model)
    want = own((*r[:2], model.score(r[1])) for r in odd_rows())
    assert own(got.select("doc_id", "text", "score").collect()) == want and set(got.columns) == set(docs.columns)
    kept = own(toxicity.reject_toxic(docs, model).collect())
    assert kept == own(r for r in odd_rows() if model.score(r[1]) < 0.7)
    assert toxicity.scored(none, model).count() == 0 and toxicity.train(none, labels, F.lit(True)).score("x") < 0.01


def test_layout_holds_every_row_once_with_its_columns(docs, none):
    kept = [c for c in docs.columns if c not in ("shard", "slot", "rank")]
    got = hilbert.write(docs, ["source", "lang", "n_chars", "doc_id"], shards=4)
    assert own(got.select(*kept).collect()) == own(docs.select(*kept).collect())
    assert sorted(r["rank"] for r in got.collect()) == list(range(docs.count()))
    assert hilbert.write(none, ["lang", "source"]).count() == 0


def test_urls_with_clashing_columns(spark):
    url = "http://a.example.net/de/" + "x7" * 20_000
    rows = [(1, None, "h", "s"), (2, "", None, "s"), (3, "http://a.com/en/1", "h", "s"), (3, "http://a.com/en/1", "h", "s"), (None, "http://b.net/de/7", "h", None), (4, url, "h", "s")]
    d = spark.createDataFrame(rows, "page_id long, url string, host string, path string").withColumns({c: F.lit("x") for c in ("row", "gram", "text", "score", "rule", "verdict", "allow", "ratio", "context")})
    got = url_filter.judged(d, URL_RULES).collect()
    assert sorted((str(r["page_id"]), r["host"], r["verdict"]) for r in got) == sorted([("1", "", "allow"), ("2", "", "allow"), ("3", "a.com", "block"), ("3", "a.com", "block"), ("None", "b.net", "allow"), ("4", "a.example.net", "allow")])
    assert url_filter.judged(d.where("false"), URL_RULES).count() == 0


def test_repetition_judges_every_row(docs, none):
    got = repetition.judged(docs)
    assert own(got.select("doc_id", "n_words").collect()) == own((r[0], len((r[1] or "").encode().split())) for r in odd_rows())
    assert repetition.judged(none).count() == 0


def test_chat_with_clashing_columns_and_a_long_text(spark):
    rows = [(1, 0, "user", LONG), (1, 1, "assistant", LONG[::-1]), (1, 2, "assistant", "</turn><" + LONG), (None, 0, None, None), (2, 0, "assistant", ""), (2, 0, "assistant", "")]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("x") for c in ("source", "own", "line", "row", "rows", "formatted", "loss_spans", "turns", "identical")})
    got = {r["conv_id"]: r for r in chat.formatted(d).withColumn("loss", chat.under_mask(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert all(r["identical"] for r in got.values())
    assert {k: r["loss"] for k, r in got.items()} == {1: [LONG[::-1], "</turn><" + LONG], None: [], 2: ["", ""]}
    assert chat.formatted(d.where("false")).count() == 0


def test_a_wrong_mask_shows(spark):
    d = spark.createDataFrame([(1, 0, "user", "question"), (1, 1, "assistant", "an <answer>")], "conv_id long, turn long, role string, text string")
    got = chat.formatted(d)
    moved = F.transform("loss_spans", lambda s: F.struct((s["start"] - 1).alias("start"), s["length"].alias("length")))
    row = got.select(chat.under_mask(F.col("formatted"), F.col("loss_spans")).alias("right"), chat.under_mask(F.col("formatted"), moved).alias("wrong")).first()
    assert row["right"] == ["an <answer>"] and row["wrong"] != row["right"]


def test_packing_and_token_files_keep_every_row(docs, none):
    for path, end, pieces in ((BYTE, 0, packing.pack(docs, BYTE).collect()), (WORD, 2, dac.read(dac.write(docs, WORD, 2, segment=50)).collect())):
        encoder = token_ids.Encoder(path)
        sizes = [len(encoder.encode([r[1]])[0]) // 4 + 1 for r in odd_rows()]
        assert sum(r["length"] if end == 0 else r["n_tokens"] for r in pieces) == sum(sizes)
        if end:
            assert own((r["doc_id"], r["n_tokens"]) for r in pieces) == own((r[0], n) for r, n in zip(odd_rows(), sizes, strict=True))
    assert packing.pack(none, BYTE).count() == 0 and dac.read(dac.write(none, WORD, 2)).count() == 0


def test_decontamination_judges_rows_by_themselves(spark, docs, none):
    items = {1: PASSAGE, 2: "one two", 3: None}
    b = spark.createDataFrame(list(items.items()), "item_id long, text string").withColumn("terms", F.lit("x"))
    plain = plain_report({k: r[1] for k, r in enumerate(odd_rows())}, {k: v for k, v in items.items() if v})
    got = decontam.report(docs, b).collect()
    assert own((r["doc_id"], r["n_words"], r["n_hit"], r["contaminated"]) for r in got) == own((odd_rows()[k][0], n, h, c) for k, (n, h, _, c) in plain.items())
    assert own(decontam.decontaminate(docs, b).collect()) == own(r for k, r in enumerate(odd_rows()) if not plain[k][3])
    assert decontam.decontaminate(none, b).count() == 0 and decontam.decontaminate(docs, b.where("false")).count() == docs.count()


def plain_deduplicated(rows: list[tuple]) -> Counter:
    """Of each component of texts with five-word similarity 0.8 or more the row of the smallest id; rows alike once."""
    rows = list(dict.fromkeys(rows))
    sets = [shingle_sets(r[1] or "") if (r[1] or "").split() else set() for r in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a == b or (a and b and len(a & b) / len(a | b) >= 0.8):
                    label[i] = label[j] = min(label[i], label[j])
    out = []
    for k in set(label):
        out.append(min((rows[i] for i in range(len(rows)) if label[i] == k), key=lambda r: (r[0] is None, r[0] or 0)))
    return own(out)


def test_near_duplicates_of_odd_rows(docs, none):
    got = simhash.near_duplicates(docs).collect()
    prints = [plain_fingerprint(r[1]) for r in odd_rows()]
    label = plain_components(prints, 4)
    least = {k: min((odd_rows()[i][0] for i in range(len(label)) if label[i] == k and odd_rows()[i][0] is not None), default=None) for k in set(label)}
    assert own((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got) == own((r[0], p, least[k]) for r, p, k in zip(odd_rows(), prints, label, strict=True))
    left = simhash.deduplicate(docs)
    ids = lambda c: Counter((r[0], r[1]) for r in c.elements())  # noqa: E731  null ids tie: the row's hash decides
    assert left.columns == docs.columns and ids(own(left.collect())) == ids(plain_deduplicated(odd_rows()))
    assert simhash.deduplicate(none).count() == 0


def test_language_replaces_its_own_columns_only(docs, none):
    net = langid.train(docs, F.lit(True))
    got = langid.predicted(docs, net)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    assert own(got.select(*kept).collect()) == own(docs.select(*kept).collect()) and set(got.columns) == set(docs.columns)
    assert all((r["lang_pred"] == "und") == (not any(map(str.isalpha, r["text"] or ""))) for r in got.collect())
    assert langid.predicted(none, net).count() == 0


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame([(4, 1, 1), (7, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_on_odd_rows(spark, docs, none, folder):
    stages = dict(corpus_pipeline.STAGES)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, folder)
        assert got.columns == docs.columns and not own(got.collect()) - own(odd_rows()), name
        assert stage(spark, none, folder).count() == 0
    assert stages["language_id"](spark, docs, folder).where(F.col("text").isNull() | ~F.col("text").rlike(r"\p{L}")).count() == 0
    ids = lambda rows: Counter((r[0], r[1]) for r in rows)
    assert ids(stages["simhash_near_dedup"](spark, docs, folder).collect()) == ids(plain_deduplicated(odd_rows()).elements())
    bad = plain_report({k: r[1] for k, r in enumerate(odd_rows())}, {1: PASSAGE})
    assert own(stages["benchmark_decontamination"](spark, docs, folder).collect()) == own(r for k, r in enumerate(odd_rows()) if not bad[k][3])
    encoder = token_ids.Encoder(BYTE)
    assert sum(r["length"] for r in stages["packing"](spark, docs, folder).collect()) == sum(len(encoder.encode([r[1]])[0]) // 4 + 1 for r in odd_rows())
    assert stages["packing"](spark, none, folder).count() == 0
