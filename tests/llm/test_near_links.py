"""Links of near copies: chance agreement of 128 bits makes none, and few rows are joined to find components."""

import numpy as np
from pyspark.sql import functions as F

from biblioflow.llm import simhash


def test_texts_near_in_128_bits_by_chance_are_no_links(spark):
    chance = np.random.default_rng(7)
    words = chance.integers(0, 1 << 64, (60, 4), dtype="u8")
    words[1::2, :2] = words[::2, :2] ^ np.uint64(0xFFF)  # 24 differing bits, and about 64 in the other two words
    words[1:20:2, 2:] = words[0:20:2, 2:] ^ np.uint64(1)  # but two in those
    rows = [(k, *(int(x) for x in w.view("<i8")), [5]) for k, w in enumerate(words)]
    got = simhash.near_links(spark.createDataFrame(rows, "node long, fp long, more long, third long, fourth long, blocks array<int>"))
    assert {tuple(r) for r in got.collect()} == {(k, k + 1) for k in range(0, 20, 2)}
    assert simhash.wide_forest(words, simhash.NEAR_BITS, 256) == [(k, k + 1) for k in range(0, 60, 2)]


def test_sketches_hold_what_the_check_reads(spark):
    text = " ".join(f"w{k}" for k in range(50))
    row = simhash.sketches(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id", "text", 5).first()
    wide = simhash.wide_majority(np.unique(simhash.shingles(text.encode(), 5)))
    assert [row[c] for c in simhash.HELD] == wide[:4].view("<i8").tolist()


def test_links_between_what_is_one_already_are_not_read_again(spark, monkeypatch):
    """A dense group and a long chain: after the first round few links are left, whatever the numbering."""
    made, table = [], simhash.table
    monkeypatch.setattr(simhash, "table", lambda df, name, *a: made.append((name, out := table(df, name, *a), out.count())) or out)
    dense = [(a, b) for a in range(100) for b in range(a + 1, 100)]
    chain = [(k, k + 1) for k in range(1000, 3000)]
    label = simhash.components(spark.createDataFrame([*dense, *chain, (-5, 9000), (7000, 7000)], "a long, b long"))
    by = label.groupBy("label").agg(F.count("*").alias("n"), F.min("node").alias("low")).collect()
    assert sorted((r["low"], r["n"]) for r in by) == [(-5, 2), (0, 100), (1000, 2001), (7000, 1)]
    links = [n for name, _, n in made if name == "links"]
    assert sum(links[1:]) <= 2 * len(chain) < len(dense) and links[-1] == 0 and len(links) <= 12
