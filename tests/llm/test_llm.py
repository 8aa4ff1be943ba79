"""The training-data operators against brute force, round trips, and the defined edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from biblioflow.llm import chat, dac, decontam, hilbert, langid, packing, repetition, simhash, token_ids, toxicity, url_filter
from biblioflow.llm.queries import URL_RULES, op5_chat
from biblioflow.sources import stages

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int"
BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
LONG = " ".join(f"word{i % 997}x{i}" for i in range(20_000))


def odd_rows(n: int = 0) -> list[tuple]:
    """Nulls in any column, empty and long texts, ties, repeated rows; extra columns of clashing names."""
    rows = [(1, None, "en", "a", 1, 0.5, 9), (2, "", None, None, None, None, None), (3, "  \n ", "en", "a", 4, 0.1, 1), (4, "one two", "en", "b", 7, 0.1, 1), (5, LONG, "en", "a", len(LONG), 0.1, 1), (6, "Ünï <turn> \\ 東京", "de", "a", 5, 0.1, 1), (6, "Ünï <turn> \\ 東京", "de", "a", 5, 0.1, 1), (None, "no id here", "en", "a", 3, 0.1, 1)]
    return rows + [(100 + i, f"text number {i} with some words in it and {i * i} more of them", "en", "s", i, 0.0, 0) for i in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(odd_rows(40), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# SimHash


def plain_fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_matches_the_definition_and_spark(spark):
    for text in ("", "A b", "The QUICK brown Fox jumps over the lazy dog " * 3, "ÀÉ x\x1cy z\u00a0w v u"):
        assert simhash.fingerprint(text.encode()) % 2**64 == plain_fingerprint(text)
    assert spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def plain_components(fps: list[int], bits: int) -> list[int]:
    label = list(range(len(fps)))
    for _ in fps:
        for i, a in enumerate(fps):
            for j, b in enumerate(fps):
                if (a ^ b).bit_count() <= bits:
                    label[i] = label[j] = min(label[i], label[j])
    return label


def test_components_match_brute_force(spark):
    rng = random.Random(3)
    fps = []
    for _ in range(6):
        at = rng.getrandbits(64)
        for _ in range(12):
            fps.append(at)
            for b in rng.sample(range(64), rng.choice([1, 2, 4, 5])):
                at ^= 1 << b
    signed = [(f - 2**64 if f >> 63 else f,) for f in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long").distinct(), 4)
    assert edges.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 4).count() == 0
    label = {r["node"]: r["label"] for r in simhash.components(edges).collect()}
    want = plain_components(fps, 4)
    by = defaultdict(set)
    for (s,), w in zip(signed, want, strict=True):
        by[w].add(label.get(s, s))
    assert all(len(x) == 1 for x in by.values()) and len({next(iter(x)) for x in by.values()}) == len(by)


def test_dense_bucket_gives_a_forest_not_all_pairs():
    fps = np.unique(np.random.default_rng(1).integers(0, 64, 3000, dtype=np.uint64) | np.uint64(1 << 40))
    assert len(simhash.forest(fps, 6)) == len(fps) - 1


@pytest.mark.parametrize("blocks", [6, 7, 8])
def test_every_close_pair_shares_a_key(blocks):
    masks = simhash.block_masks(blocks, 4)
    rng = random.Random(blocks)
    for _ in range(300):
        diff = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(diff & (m % 2**64) == 0 for m in masks)
    assert simhash.block_count(100, 4) == 6 and simhash.block_count(10**10, 4) > 6


def test_near_duplicates_edge_cases(spark, docs, none):
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert len(got) == docs.count() and simhash.near_duplicates(none).count() == 0
    by = {i: (fp, c) for i, fp, c in got}
    assert by[1][0] == by[2][0] == by[3][0] == 0 and by[1][1] == by[2][1] == by[3][1] == 1 and by[6][1] == 6
    kept = [r["doc_id"] for r in simhash.deduplicate(docs).collect()]
    assert kept.count(1) == 1 and 2 not in kept and kept.count(6) == 1 and {4, 5} <= set(kept)
    assert simhash.deduplicate(docs).columns == docs.columns


def shingle_sets(text: str) -> set:
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def test_sketches_never_rule_a_link_out():
    rng = random.Random(4)
    for n in (3, 40, 190, 200, 400, 3000):
        base = [rng.getrandbits(64) for _ in range(n)]
        sets = [base]
        for _ in range(30):
            own = [h for h in base if rng.random() > rng.choice([0, 0.05, 0.1, 0.2])]
            sets.append(own + [rng.getrandbits(64) for _ in range(rng.randrange(max(1, n // 6)))])
        sets = [np.unique(np.array(x, "u8")) for x in sets]
        zero = np.zeros(len(sets), "u8")
        bucket = simhash.Bucket(zero, np.arange(len(sets)), np.array([len(x) for x in sets]), [simhash.odd_sketch(x) for x in sets], 0.8)
        linked, near = set(), set()
        for u in range(len(sets)):
            near |= {(u, int(v)) for v in bucket.near(u, np.arange(len(sets)))}
            linked |= {(u, v) for v in range(len(sets)) if len(np.intersect1d(sets[u], sets[v])) / max(1, len(np.union1d(sets[u], sets[v]))) >= 0.8}
        assert linked <= near and len(near) < 1.6 * len(linked) + 10


def test_near_copies_meet_in_blocks_of_wide_fingerprints(spark):
    """Links of near copies: within the bits allowed, with a block untouched, and spanning all such pairs; at similarity 0.8 nearly all have both."""
    chance = np.random.default_rng(5)
    some = lambda n: chance.integers(0, 1 << 64, n, dtype="u8")
    sets = [some(n) for n in (1, 2, 40, 300)]
    for h in sets:
        assert simhash.wide_majority(h)[0].astype("<i8") == simhash.majority(h)
    for n in (10, 50, 260):
        for _ in range(40):
            common, more = some(8 * n // 10), some(n - 8 * n // 10)
            sets += [np.r_[common, more[::2]], np.r_[common, more[1::2]]]
    prints = [simhash.wide_majority(h) for h in sets]
    keys = [simhash.wide_blocks(w) for w in prints]
    assert all(len(k) == 64 and (k >> 12 == np.arange(64)).all() for k in keys)
    flips = np.packbits(np.arange(768) % 12 * 64 + np.arange(768) // 12 < 63, bitorder="little").view("<u8")  # one bit of each block but the last
    assert np.bitwise_count(flips).sum() == 63 and (simhash.wide_blocks(prints[3] ^ flips) == keys[3]).tolist() == [False] * 63 + [True]
    apart = lambda u, v: int(np.bitwise_count(prints[u][:2] ^ prints[v][:2]).sum())
    near = {(u, v) for u in range(len(sets)) for v in range(u + 1, len(sets)) if apart(u, v) <= simhash.NEAR_BITS and (keys[u] == keys[v]).any()}
    assert sum((u, u + 1) in near for u in range(4, len(sets), 2)) >= 119
    words = np.array([w[:2] for w in prints])
    found = simhash.wide_forest(words, simhash.NEAR_BITS)
    assert all(apart(u, v) <= simhash.NEAR_BITS for u, v in found)
    rows = [(u, *(int(x) for x in w[:2].view("<i8")), k.tolist()) for u, (w, k) in enumerate(zip(prints, keys, strict=True))]
    got = {tuple(r) for r in simhash.near_links(spark.createDataFrame(rows, "node long, fp long, more long, blocks array<int>")).collect()}
    assert got <= near and plain_labels(got, len(sets)) == plain_labels(near, len(sets))
    dense = np.array([w ^ np.uint64(1 << int(chance.integers(64))) for w in [words[3]] * 2000])
    assert len(simhash.wide_forest(dense, 4)) == 1999


def plain_labels(pairs: set, n: int) -> list[int]:
    label = list(range(n))
    for _ in range(n):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    return label


def test_deduplicate_finds_copies_from_similarity_08(spark):
    rng = random.Random(17)
    texts: dict[int, str] = {}
    for i in range(30):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 200))]
        texts[len(texts)] = " ".join(base)
        for _ in range(rng.randrange(4) if i else 30):
            w = list(base)
            for _ in range(rng.choice([1, 2, 3, 4])):
                w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
            texts[len(texts)] = " ".join(w)
    sets = {i: shingle_sets(t) for i, t in texts.items()}
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    near = [(a, b) for a in sets for b in sets if a < b and alike(a, b) >= 0.8]
    assert sum(alike(a, b) < 0.9 for a, b in near) > 20 and any(0.6 < alike(a, b) < 0.8 for a in sets for b in sets if a < b)
    label = {i: i for i in sets}
    for _ in sets:
        for a, b in near:
            label[a] = label[b] = min(label[a], label[b])
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.deduplicate(d).collect()) == sorted(set(label.values()))


# Decontamination


def plain_report(texts: dict, items: dict) -> dict:
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    out = {}
    for i, text in texts.items():
        w, hit, found = words(text), set(), set()
        for item, it in items.items():
            q = words(it)
            k = min(13, len(q))
            wins = {tuple(q[s : s + k]) for s in range(len(q) - k + 1)} if q else set()
            for s in range(len(w) - k + 1) if q else ():
                if tuple(w[s : s + k]) in wins:
                    hit |= set(range(s, s + k))
                    found.add(item)
        out[i] = (len(w), len(hit), sorted(map(str, found)), bool(hit) and 20 * len(hit) >= len(w))
    return out


def test_decontamination_matches_brute_force(spark):
    rng = random.Random(5)
    word = lambda: rng.choice(["the", "of", "and", "a", "Éa", "x1", "rare" + str(rng.randrange(40))])
    items = {i: " ".join(word() for _ in range(rng.choice([1, 2, 5, 12, 13, 14, 30]))) for i in range(12)} | {90: None, 91: "...", 92: "The the"}
    texts = {}
    for i in range(60):
        w = [word() for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            it = (items[rng.randrange(12)] or "").split()
            a = rng.randrange(max(1, len(it) - 12))
            w[rng.randrange(len(w) + 1) : 0] = it[a : a + rng.choice([12, 13, 20])]
        texts[i] = rng.choice([" ", ", ", "\n"]).join(w).title() if i else None
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    b = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in decontam.report(d, b).collect()}
    assert got == plain_report(texts, items)


def test_decontamination_edge_cases(spark, docs, none):
    b = spark.createDataFrame([(None, "no id here"), (1, None), (1, "one two")], "item_id long, text string")
    rows = decontam.report(docs, b).collect()
    assert len(rows) == docs.count() and {r["doc_id"]: r["items"] for r in rows}[None] == [""]
    assert decontam.report(none, b).count() == 0
    assert decontam.report(docs, b.where("false")).where("contaminated").count() == 0
    kept = decontam.decontaminate(docs, b)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r[0] for r in odd_rows(40)} - {None, 4}


def plain_proximity(texts: dict, items: dict, length: int, slack: int, share: float) -> set:
    """(doc, item, start, length) of spans that begin and end at a term of a window and hold enough of its terms."""
    out = set()
    for item, it in items.items():
        q = it.split()
        k = min(length, len(q))
        for win in {tuple(q[s : s + k]) for s in range(len(q) - k + 1)}:
            need = -(-len(set(win)) * share // 1)
            for i, text in texts.items():
                w = text.split()
                phrase = {s for s in range(len(w)) if tuple(w[s : s + k]) == win}
                for s in set(range(len(w))) - phrase:
                    held = [p for p in range(s, min(len(w), s + k + slack)) if w[p] in win]
                    if held and held[0] == s and len({w[p] for p in held}) >= need:
                        out.add((i, str(item), s, held[-1] - s + 1))
    return out


@pytest.mark.parametrize(("share", "slack"), [(1.0, 3), (0.75, 2), (0.6, 0)])
def test_proximity_matches_brute_force(spark, share, slack):
    rng = random.Random(12)
    word = lambda: rng.choice(["the", "of", "a", *(f"w{rng.randrange(30)}" for _ in range(3))])
    items = {i: " ".join(word() for _ in range(rng.choice([3, 5, 8]))) for i in range(8)} | {50: "rareone alpha beta gamma delta"}
    texts = {i: " ".join(word() for _ in range(rng.randrange(30))) for i in range(30)}
    texts |= {90: "x rartypo alpha beta gamma delta y", 91: "alpha x beta rareone gamma delta", 92: "rareone alpha beta gamma delta", 93: "alpha beta"}
    for i in range(8):
        w = items[i].split()
        w[rng.randrange(len(w))] = "typo"
        texts[60 + i] = f"q {' '.join(w)} q {items[i]}"
    corpus = decontam.tokens(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    b = spark.createDataFrame(list(items.items()), "item_id long, text string")
    ids = {r["row"]: r["doc_id"] for r in corpus.collect()}
    found = decontam.find(corpus, b, length=5, slack=slack, share=share).collect()
    near = {(ids[r["row"]], r["item_id"], r["start"], r["length"]) for r in found if r["kind"] == "proximity"}
    assert near == plain_proximity(texts, items, 5, slack, share) and near
    if share < 1:
        assert any(i == 90 for i, *_ in near)  # the rarest word is another one
    whole = decontam.postings(corpus)
    again = decontam.find(corpus, b, length=5, slack=slack, share=share, index=whole).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


# Token ids, packing, token files


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_piecewise_ids_equal_the_library(path):
    rng = random.Random(1)
    alphabet = [*"aAbZéß İσΣ\u00a0\u2003'’.,!?_-0 1²Ⅷ\n\t\u0301 \x1c\u3000😀<|>'s't'll中文\u0958\ufb1d", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "endoftext"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(4000)] + ["it's he'll we've. foo's, 'tis  x\n\n y \n z", LONG[:5000], "", None, f"a<|endoftext|> {LONG[:3000]} <|startoftext|><|endoftext|>b"]
    assert sum("<|endoftext|>" in (t or "") for t in texts) > 1000
    encoder, library = token_ids.Encoder(path), Tokenizer.from_file(path)
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert encoder.encode(texts) == want and encoder.encode(texts) == want


def plain_best_fit(lengths: list[int], capacity: int) -> Counter:
    left: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(left) if r >= n]
        if fits:
            left[min(fits)[1]] -= n
        else:
            left.append(capacity - n)
    return Counter(capacity - r for r in left)


@pytest.mark.parametrize("seed", range(5))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 100, 1024])
    lengths = [rng.randrange(1, capacity + 1) if rng.random() < 0.7 else rng.choice([1, capacity // 3, capacity // 2]) for _ in range(800)]
    counts = Counter(lengths)
    rules = packing.plan(dict(counts), capacity)
    used, places = Counter(), set()
    for n in counts:
        own = [r for r in rules.tolist() if r[0] == n]
        for k in range(counts[n]):
            rule = [r for r in own if r[1] <= k][-1]
            window, at = rule[2] + (k - rule[1]) // rule[3], rule[4] + (k - rule[1]) % rule[3] * n
            used[window] += n
            places |= {(window, at + j) for j in range(n)}
    assert len(places) == sum(lengths) and max(a for _, a in places) < capacity  # nothing overlaps or sticks out
    assert Counter(used.values()) == plain_best_fit(lengths, capacity)
    assert max(a for w, a in places) + 1 <= capacity and sorted(used) == list(range(len(used)))


def test_packing_round_trip(spark, docs, none):
    packed = packing.pack(docs.repartition(3), BYTE).collect()
    encoder = token_ids.Encoder(BYTE)
    want = Counter((r[0], encoder.encode([r[1]])[0] + bytes(4)) for r in odd_rows(40))
    whole = defaultdict(list)
    for r in packed:
        whole[r["doc_id"], r["doc_tokens"]].append((r["start"], bytes(r["ids"])))
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    copies = {k: n for k, n in want.items() if n == 1}
    for (i, ids), _ in copies.items():
        assert b"".join(x for _, x in sorted(whole[i, len(ids) // 4])) == ids
    assert sum(r["length"] for r in packed) == sum(len(ids) // 4 * n for (_, ids), n in want.items())
    cells = Counter((r["sequence_id"], r["offset"] + k) for r in packed for k in range(r["length"]))
    assert max(cells.values()) == 1 and max(a for _, a in cells) < 1024
    assert packing.pack(none, BYTE).count() == 0
    stored = packing.sequences(packing.pack(docs, BYTE))
    assert {r["stored"] for r in stored.collect()} <= {1024} | {2**k for k in range(11)}


@pytest.mark.parametrize("seed", range(4))
def test_codes_give_random_access(seed):
    rng = np.random.default_rng(seed)
    ids = np.where(rng.random(5000) < 0.5, rng.integers(0, 300, 5000), rng.integers(0, [300, 2**16, 2**32 - 1, 70_000][seed], 5000)).astype("<u4")
    reader = dac.Reader(dac.encode(ids))
    assert reader.slice(0, 5000).tolist() == ids.tolist()
    for i in rng.integers(0, 5000, 300).tolist():
        assert reader.token(i) == ids[i]
    for a, b in rng.integers(0, 5001, (50, 2)).tolist():
        assert reader.slice(min(a, b), max(a, b)).tolist() == ids[min(a, b) : max(a, b)].tolist()
    with pytest.raises(IndexError):
        reader.token(5000)
    with pytest.raises(ValueError, match="token file"):
        dac.Reader(b"something else")
    assert dac.Reader(dac.encode(ids[:0])).slice(0, 0).tolist() == []


def test_positions_are_looked_up_in_the_codes(spark, docs):
    files = dac.write(docs, WORD, 2, segment=100)
    whole = np.concatenate([dac.Reader(r["data"]).slice(0, r["n_tokens"]) for r in files.orderBy("bucket", "segment").collect()])
    asked = sorted({0, len(whole) - 1, *random.Random(1).sample(range(len(whole)), 200)})
    got = dac.tokens_at(files, spark.createDataFrame([(p,) for p in [*asked, *asked, -1, len(whole)]], "position long"), segment=64)
    assert sorted((r["position"], r["token"]) for r in got.collect()) == [(p, int(whole[p])) for p in asked]


def test_large_ids_keep_their_order_beside_a_null(spark):
    ids = [2**62 + k for k in range(40)] + [None, -(2**62)]
    d = spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")
    got = sorted(dac.read(dac.write(d, WORD, 2, segment=7)).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, *sorted(i for i in ids if i is not None)]


def test_token_files_round_trip(spark, docs, none):
    got = sorted((tuple(r) for r in dac.read(dac.write(docs, WORD, 2, segment=100)).collect()), key=lambda r: r[1])
    encoder, start, want = token_ids.Encoder(WORD), 0, []
    for i, text in sorted(((r[0], r[1]) for r in odd_rows(40)), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = encoder.encode([text])[0] + np.array([2], "<u4").tobytes()
        want.append((i, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert got == want and dac.read(dac.write(none, WORD, 2)).count() == 0


# Toxicity


def toxic_corpus(spark, n: int = 600):
    rng = random.Random(2)
    plain = [f"w{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [rng.choice(plain) for _ in range(30)] + (["awful", "nastyish"] if bad else [])
        if rng.random() < (0.8 if bad else 0.1):
            words += ["muslims"]
        rng.shuffle(words)
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_learns_and_leaves_mentions_alone(spark):
    d, y = toxic_corpus(spark)
    model = toxicity.train(d, y, F.col("doc_id") % 3 != 1)
    hits = [(r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in toxicity.scored(d, model).where("doc_id % 3 = 1").collect()]
    assert sum(hits) / len(hits) > 0.97
    shift = model.logit("muslims w1 w2") - model.logit("people w1 w2")
    assert abs(shift) < 0.5 and model.score("muslims w1 w2") < 0.5


def test_counterfactual_term_cuts_false_positives_on_neutral_mentions(spark):
    """Planted group mentions: most toxic rows name a group, so a free model takes the name for toxicity."""
    rng = random.Random(9)
    plain = [f"w{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(900):
        bad = i % 3 == 0
        words = [rng.choice(plain) for _ in range(25)]
        if rng.random() < (0.95 if bad else 0.02):
            words += ["jews", "immigrants"]
        if bad and rng.random() < 0.7:
            words += [rng.choice(["vermin", "filth", "scumlike"])]
        rng.shuffle(words)
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(bad)))
    neutral = [(10_000 + i, " ".join([*rng.sample(plain, 20), "jews", "immigrants"]) + ".") for i in range(60)]
    d, y = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    held, free = (toxicity.train(d, y, F.lit(True), swap=w) for w in (1.0, 0.0))
    wrong = lambda m: sum(m.score(t) >= 0.7 for _, t in neutral)
    assert held.pairs > 100 and wrong(free) > 30 and wrong(held) < wrong(free) / 3
    caught = lambda m: sum(m.score(t) >= 0.7 for (i, t) in rows if any(w in t for w in ("vermin", "filth", "scumlike"))) / sum(any(w in t for w in ("vermin", "filth", "scumlike")) for _, t in rows)
    assert caught(held) > 0.95


def test_every_mention_is_swapped():
    text = ". ".join(f"x{i} muslims and jews" for i in range(40))
    partners = toxicity.swap_partners(toxicity.IDENTITY)
    assert len(list(toxicity.counterfactuals(text, partners))) == 40 * (len(partners["muslims"]) + len(partners["jews"]))
    a, b = next(toxicity.counterfactuals("muslims here", {"muslims": ["people"]}))
    assert a == toxicity.forms("muslims") and b == toxicity.forms("people")


def test_counterfactual_term_lowers_the_change():
    rng = np.random.default_rng(1)
    y = (np.arange(400) % 2).astype(float)
    word = lambda k: np.array(sorted(k), "<i4").tobytes()
    rows = [word({1 + int(b), *([0] if rng.random() < (0.9 if b else 0.2) else []), 3 + int(rng.integers(5))}) for b in y]
    pairs = [(word({0, 3}), word({3}), 5)]
    free, _ = toxicity.fit_logistic(rows, y, [], 8)
    held, _ = toxicity.fit_logistic(rows, y, pairs, 8)
    assert abs(held[0]) < 0.2 * abs(free[0])


def test_toxicity_edge_cases(spark, docs, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, None), (None, 1), (7, 5)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    assert toxicity.scored(docs, model, out="tox").where("tox between 0 and 1").count() == docs.count()
    assert toxicity.scored(none, model).count() == 0
    assert toxicity.reject_toxic(docs, toxicity.train(docs, labels.where("false"), F.lit(True))).count() == docs.count()
    assert model.score(None) == model.score("")


# Language


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    net = langid.start(["a", "b", "c"], hidden=4, seed=1)
    for part in (net.forward, net.backward):
        part.gates, part.candidate, part.to_gates, part.to_candidate = (p.astype("f8") for p in part.parts())
    x, y = rng.integers(0, 256, (7, 5)), rng.integers(0, 3, 5)
    _, grads = langid.gradients(net, x.astype(np.intp), y)
    step = 1e-2
    for p, g in zip(net.parts(), grads, strict=True):
        for at in [np.unravel_index(k, p.shape) for k in np.argsort(-np.abs(g), axis=None)[:2]]:
            old = p[at]
            p[at] = old + step
            up = langid.gradients(net, x.astype(np.intp), y)[0]
            p[at] = old - step
            down = langid.gradients(net, x.astype(np.intp), y)[0]
            p[at] = old
            assert abs((up - down) / (2 * step) - g[at]) < 0.05 * abs(g[at]) + 2e-4


def test_language_is_learned_and_every_position_labelled(spark):
    rng = random.Random(4)
    kinds = {"xx": "aeiou lmn", "yy": "zxkqj rst"}
    rows = [(i, "".join(rng.choice(kinds[k]) for _ in range(rng.randrange(30, 200))), k) for i, k in enumerate(["xx", "yy"] * 60)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = langid.train(d, F.col("doc_id") % 4 != 2, sample=60)
    held = langid.predicted(d, net).where("doc_id % 4 = 2").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.95
    texts = [b"aeiou" * 700, b"", b"z" * 65, "".join(rng.choice(kinds["xx"] + kinds["yy"]) for _ in range(2000)).encode()]
    seen = np.zeros(4, int)
    for own, p, real in langid.label_positions(net, texts):
        assert np.allclose(p.sum(axis=2), 1, atol=1e-4)
        np.add.at(seen, own, real.sum(axis=0))
    assert seen.tolist() == [3500, 0, 65, 2000]
    for t, got in zip(texts, langid.probabilities(net, texts), strict=True):
        if t:  # against the whole text in one stretch, state carried from end to end
            x = np.frombuffer(t, np.uint8).astype(np.intp)[:, None]
            assert np.allclose(got, langid.softmax(langid.states(net, x) @ net.out + net.bias).mean(axis=(0, 1)), atol=2e-3)


def test_every_language_is_learned_whatever_its_id(spark):
    rows = [(f"id-{i}", chr(0x4E00 + 40 * (i % 70)) * 30 + " ab", f"l{i % 70}") for i in range(210)]
    net = langid.train(spark.createDataFrame(rows, "doc_id string, text string, lang string"), F.lit(True))
    assert net.languages == sorted(f"l{k}" for k in range(70))


def test_sample_is_bounded_by_language(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(langid, "fit", lambda x, y, names: seen.update(n=np.bincount(y), names=names))
    rows = [(i, f"text {i} " * 30, "big" if i % 10 else "small") for i in range(2000)] + [(5, "same", "big")] * 500
    langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), sample=20, windows=1)
    assert seen["names"] == ["big", "small"] and seen["n"].tolist() == [20, 20]


def test_language_edge_cases(spark, docs, none):
    net = langid.train(docs, F.lit(True))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predicted(docs, net).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[4][0] in ("en", "de")
    assert langid.predicted(none, net).count() == 0 and langid.train(none, F.lit(True)) is None
    assert {r["lang_pred"] for r in langid.predicted(docs, None).collect()} == {"und"}
    assert langid.reject_unknown(docs, net, margin=0.0).columns == docs.columns


# Repetition


def plain_repeats(words: list[bytes], least: int) -> tuple[int, int]:
    """(words covered by repeated runs of ``least`` words or more, longest repeat)."""
    n, covered, longest = len(words), set(), 0
    for i in range(n):
        for j in range(i + 1, n):
            k = 0
            while j + k < n and words[i + k] == words[j + k]:
                k += 1
            longest = max(longest, k)
            if k >= least:
                covered |= set(range(i, i + k)) | set(range(j, j + k))
    return len(covered), longest


def test_repetition_matches_brute_force():
    rng = random.Random(6)
    texts = ["", "a", "a a a a a a a a a a", "x\ny\n\nx\n x\nx"]
    for _ in range(25):
        part = [rng.choice("abcde") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 40))]
        texts.append(" ".join(part + [rng.choice("fgh") for _ in range(rng.randrange(10))] + part[: rng.randrange(20)]))
    for text, got in zip(texts, repetition.measure([t.encode() for t in texts], 6), strict=True):
        words = text.encode().split()
        assert (got[0], got[5], got[6]) == (len(words), *plain_repeats(words, 6))
        assert got[4] == plain_repeats(words, 8)[0]
        lines = [x for x in text.split("\n") if x.split()]
        assert got[3] == len(lines) - len(set(lines)) and got[5] == sum(b - a for a, b in got[7])


def test_repetition_edge_cases(spark, docs, none):
    got = {r["doc_id"]: r for r in repetition.judged(docs).collect()}
    assert got[1]["n_words"] == 0 and got[1]["base_failed"] and not got[1]["kept"] and got[5]["kept"]
    assert got[6]["word_chars"] == len("Ünï<turn>\\東京") and got[6]["n_symbols"] == 2
    assert repetition.judged(docs).count() == docs.count() and repetition.judged(none).count() == 0
    twice = " ".join(f"u{i}" for i in range(300))
    long = spark.createDataFrame([(1, f"{twice} {' '.join(f'v{i}' for i in range(9000))} {twice}")], "doc_id long, text string")
    row = repetition.judged(long).first()
    assert row["longest_repeat"] == 300 and not row["kept"] and not row["base_failed"]


# Hilbert curve


@pytest.mark.parametrize(("dims", "bits"), [(2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbours(dims, bits):
    cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
    order = np.argsort(hilbert.curve_index(cells, bits))
    assert sorted(hilbert.curve_index(cells, bits).tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_shards_hold_every_row_once(spark, law):
    rows = odd_rows(500)
    d = spark.createDataFrame(rows, DOCS)
    got = hilbert.write(d, ["source", "lang", "n_chars", "doc_id"], law=law, shards=4).collect()
    key = lambda r: (str(r["doc_id"]), str(r["text"]))
    assert sorted(map(key, got)) == sorted((str(r[0]), str(r[1])) for r in rows)
    for s in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    counts = Counter(r["shard"] for r in got)
    if law == "rows":
        assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 4
    assert sorted(r["rank"] for r in got) == list(range(len(rows)))


def test_ranks_follow_the_curve_and_files_prune(spark):
    rng = random.Random(3)
    rows = [(i, f"text {i}", rng.choice("abcdefgh"), rng.choice("pqrstuvw"), rng.randrange(10**6)) for i in range(20_000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    dims, bits = ["source", "lang", "n_chars"], 3
    got = hilbert.write(d, dims, shards=4, bits=bits)
    cell = got.withColumn("cell", hilbert.cell_of(d, dims, bits)).orderBy("rank").collect()
    cells = np.array([[r["cell"] >> bits * (2 - i) & (1 << bits) - 1 for i in range(3)] for r in cell])
    assert (np.diff(hilbert.curve_index(cells, bits)) >= 0).all()
    bounds = lambda key: [(min(r[d] for r in f), max(r[d] for r in f)) for f in key for d in ["n_chars"]]
    runs = [cell[k : k + 500] for k in range(0, len(cell), 500)]
    for dim in range(3):  # a run of 500 of 20,000 rows spans a part of every dimension
        spans = [cells[k : k + 500, dim].max() - cells[k : k + 500, dim].min() + 1 for k in range(0, len(cells), 500)]
        assert np.mean(spans) < 0.62 * (1 << bits)
    assert len(runs) == len(bounds(runs))
    files = got.groupBy(F.input_file_name().alias("f")).agg(F.min("rank").alias("a"), F.max("rank").alias("z"), F.count("*").alias("n")).orderBy("a").collect()
    assert all(f["z"] - f["a"] + 1 == f["n"] for f in files)


def test_few_values_and_equal_rows_are_dealt_evenly(spark, monkeypatch):
    d = spark.createDataFrame([(i, f"t{i}", ["en", "de", None][i % 3]) for i in range(9000)], "doc_id long, text string, lang string")
    got = hilbert.write(d, ["lang"], shards=4).groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m")).collect()
    assert [(r["n"], r["m"]) for r in got] == [(2250, 2249)] * 4
    same = spark.range(40_000).select(F.lit(5).cast("long").alias("doc_id"), F.lit("one text").alias("text"), F.lit("en").alias("lang"))
    laid = hilbert.layout(same, ["lang"], shards=4)
    parts = [r["count"] for r in laid.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(parts) == 40_000 and len(parts) > 2 and max(parts) < 2 * 40_000 / len(parts)
    assert laid.select("rank").distinct().count() == 40_000 and laid.columns[:3] == same.columns


def test_layout_of_an_empty_table(spark, none):
    assert hilbert.write(none, ["source", "n_chars"]).count() == 0


# URLs


def test_hosts_paths_and_rules(spark):
    urls = ["http://A.Example.COM/en/7?x", "https://x.com/en/", "http://sub.example.net/de/81", "http://b.net/de/#t", "ftp://c.org/es", "http://d.org/es/x", None, "nothing", "http://notexample.com/en/7", "x://y?q/en/"]
    d = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judged(d, URL_RULES).collect()}
    assert got[0] == ("a.example.com", "/en/7", "example.com/en/7", "allow")
    assert got[1] == ("x.com", "/en/", "com/en/", "block")
    assert got[2] == ("sub.example.net", "/de/81", "example.net/de/8", "block")
    assert got[3] == ("b.net", "/de/", "net/de/", "allow")
    assert got[4][:3] == ("c.org", "/es", None) and got[5][2:] == ("org/es/", "block")
    assert got[6][:3] == ("", "", None) and got[7][:3] == ("", "", None)
    assert got[8][2] == "com/en/" and got[9][:2] == ("y", "")


def test_models_tell_kinds_of_urls_apart(spark):
    rng = random.Random(8)
    make = lambda letters: "".join(rng.choice(letters) for _ in range(12))
    rows = [(i, f"http://{make('abcd')}.net/de/{make('abcd')}") for i in range(200)] + [(1000 + i, f"http://{make('wxyz')}.com/en/{make('wxyz')}") for i in range(200)]
    rows += [(5000 + i, f"http://{make('abcd')}.edu/{make('abcd')}") for i in range(20)] + [(6000 + i, f"http://{make('wxyz')}.edu/{make('wxyz')}") for i in range(20)] + [(7000, None), (7001, ""), (7002, "é"), (7002, "é")]
    got = url_filter.judged(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r["verdict"] for r in got}
    assert all(by[5000 + i] == "allow" and by[6000 + i] == "block" for i in range(20)) and by[7000] == by[7001] == "allow"
    assert url_filter.judged(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0


def plain_ratios(grams: dict[str, tuple[int, int]], order: int) -> dict[str, float]:
    """Witten-Bell from the longest context down, by definition."""

    def p(gram, side):
        n = lambda f: sum(v[side] for g, v in grams.items() if f(g))
        both = lambda f: sum(sum(v) for g, v in grams.items() if f(g))
        x = (n(lambda g: g[-1] == gram[-1]) + 1) / (n(lambda g: True) + url_filter.ALPHABET)
        for k in range(1, order + 1):
            own = lambda g, k=k: g[-k - 1 : -1] == gram[-k - 1 : -1]
            if n(own) and (k == 1 or both(own) >= url_filter.LEAST):
                kinds = len({g[-1] for g, v in grams.items() if own(g) and v[side]})
                x = (n(lambda g, k=k: g[-k - 1 :] == gram[-k - 1 :]) + kinds * x) / (n(own) + kinds)
        return np.log(x)

    return {g: p(g, 0) - p(g, 1) for g in grams}


def test_log_ratios_match_plain_witten_bell(spark):
    grams = {"^^a": (3, 1), "^ab": (2, 0), "abc": (1, 1), "^^b": (0, 4), "bca": (2, 2), "xbc": (1, 0), "yya": (0, 0)}
    got = {r["gram"]: r["ratio"] for r in url_filter.log_ratios(spark.createDataFrame([(g, *n) for g, n in grams.items()], "gram string, yes long, no long"), order=2).collect()}
    assert got == pytest.approx(plain_ratios(grams, 2))


def test_url_verdicts_match_brute_force(spark):
    """Labels, counts, scores, cut and verdicts of whole URLs, by definition."""
    rng = random.Random(21)
    make = lambda: "".join(rng.choice(["ab", "ca", "7", "-", "xy", "Z", "é"]) for _ in range(rng.randrange(1, 4)))
    urls = list(dict.fromkeys(f"{rng.choice(['http', 'https'])}://{make()}.{rng.choice(['example.com', 'example.net', 'b.org', 'c.edu'])}/{rng.choice(['en', 'de', 'es'])}/{rng.choice('78')}{make()}" for _ in range(120)))
    got = {r["url"]: r for r in url_filter.judged(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), URL_RULES).collect()}
    order, allow, grams = url_filter.ORDER, {}, defaultdict(lambda: [0, 0])

    def text(u):
        return "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" + url_filter.MARKS else "~" for c in re.sub("[A-Z]", lambda m: m[0].lower(), u.split("://", 1)[1]))

    def cuts(u):
        padded = url_filter.START * order + text(u)
        return [padded[i : i + order + 1] for i in range(len(text(u)))]

    for u in urls:
        host, path = re.match(r"([^/?#]*)([^?#]*)", u.split("://", 1)[1]).groups()
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        allow[u] = max(fits, key=lambda r: len(r.name)).allow if fits else None
        assert got[u]["rule"] == (max(fits, key=lambda r: len(r.name)).name if fits else None)
        for g in cuts(u):
            grams[g][0 if allow[u] else 1] += allow[u] is not None and zlib.crc32(u.encode()) % url_filter.FOLDS != 0
    ratio = plain_ratios({g: tuple(n) for g, n in grams.items()}, order)
    score = {u: sum(ratio[g] for g in cuts(u)) / len(cuts(u)) for u in urls}
    assert {u: r["score"] for u, r in got.items()} == pytest.approx(score)
    held = sorted({(int(score[u] // url_filter.STEP), allow[u]) for u in urls if allow[u] is not None and zlib.crc32(u.encode()) % url_filter.FOLDS == 0})
    free = [u for u in urls if allow[u] is None]
    assert len(held) > 5 and len(free) > 20 and {got[u]["verdict"] for u in free} == {"allow", "block"}
    least = min(score[u] for u in free if got[u]["verdict"] == "allow")
    assert max(score[u] for u in free if got[u]["verdict"] == "block") < least
    errors = lambda cut: sum((score[u] >= cut) != allow[u] for u in urls if allow[u] is not None and zlib.crc32(u.encode()) % url_filter.FOLDS == 0)
    assert errors(least) <= min(errors(c / 100) for c in range(-500, 500)) + 1  # the cut lies on a step
    assert all(r["verdict"] == ("allow" if allow[u] else "block") for u, r in got.items() if allow[u] is not None)


# Chat


def test_chat_round_trip(spark, tmp_path):
    traps = ["plain", "", None, "\\", "\\\\", "\\l", "\\n", "<", "</turn>", "<turn>", "a</turn>\n<turn>user\nb", "x\\", "\\### Assistant: </turn> ok", "é\n\n", "</tur", "n>", "\\<turn>"]
    rows = [(c, i, role, text) for c in range(3) for i, text in enumerate(traps) for role in (["user", "assistant", "a\nb", None, "<turn>"][(i + c) % 5],)]
    rows += [(9, 0, "user", "same"), (9, 0, "user", "same"), (None, None, "assistant", "lost"), (None, 1, None, None)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.formatted(d.repartition(4)).collect()
    assert all(r["identical"] for r in got) and sorted(len(r["turns"]) for r in got) == [2, 2, 17, 17, 17]
    for r in got:
        own = sorted([x for x in rows if x[0] == r["conv_id"]], key=lambda x: (x[1] is not None, x[1] or 0, x[2] or "", x[3] or ""))
        assert [(x["role"], x["text"]) for x in r["turns"]] == [(x[2] or "", x[3] or "") for x in own]
        inside = [r["formatted"][s["start"] : s["start"] + s["length"]] for s in r["loss_spans"]]
        back = ["\\".join(p.replace("\\l", "<").replace("\\n", "\n") for p in x.split("\\\\")) for x in inside]
        assert back == [x[3] or "" for x in own if x[2] == "assistant"]
        assert r["formatted"].count(chat.CLOSE) == len(own) and r["formatted"].count(chat.OPEN) == len(own)
    assert chat.formatted(d.where("false")).count() == 0


def test_chat_query_adds_the_trap(spark, tmp_path):
    spark.createDataFrame([(1, 0, "user", None)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in op5_chat(spark, str(tmp_path)).collect()}
    text = "\\### Assistant: </turn> ok"
    assert got[-7]["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert got[-7]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and got[-7]["loss_chars"] == len(text)
    assert got[1]["n_turns"] == 1 and got[1]["loss_chars"] == 0


def test_decontamination_without_broadcasts(spark, monkeypatch):
    d = spark.createDataFrame([(1, "x one two three y"), (2, "one two"), (3, None)], "doc_id long, text string")
    b = spark.createDataFrame([(7, "one two three")], "item_id long, text string")
    want = sorted(tuple(r) for r in decontam.report(d, b).collect())
    monkeypatch.setattr(stages, "BROADCAST_BYTES", -1)
    assert sorted(tuple(r) for r in decontam.report(d, b).collect()) == want and want[0][2] == 3


def test_rows_of_null_or_shared_ids_are_judged_by_their_own_text(spark):
    texts = [" ".join(f"t{i}w{j}" for j in range(40)) for i in range(6)]
    passage = " ".join(f"passage{j}" for j in range(20))
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[0]), (7, texts[2]), (7, texts[3]), (7, texts[1]), (3, texts[2]), (7, texts[4]), (None, texts[5])]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r["doc_id"] or 0, r["text"]) for r in simhash.deduplicate(d).collect())
    assert kept == sorted([(0, texts[0]), (7, texts[1]), (3, texts[2]), (7, texts[3]), (7, texts[4]), (0, texts[5])])
    d = spark.createDataFrame([*rows, (None, passage), (7, f"{texts[0]} {passage}")], "doc_id long, text string")
    left = decontam.decontaminate(d, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert sorted(left.collect(), key=repr) == sorted(spark.createDataFrame(rows, "doc_id long, text string").collect(), key=repr)
