"""Language-model scores by a weighted backoff automaton over smoothed n-grams of the whole corpus.

The model is Witten-Bell's, over tokens: the words of a text and one end. For a history h that was seen c(h) times before
T(h) different tokens,

    p(w | h) = (c(hw) + T(h) p(w | h')) / (c(h) + T(h)),    h' = h without its oldest token,

and below the shortest history lies the base distribution (c(w) + 1/2) / (N + (V + 1) / 2). Every seen history is a state.
A seen n-gram is an arc with the logarithm of its probability to the longest history that it ends with; where a state has no
arc for a token, its failure arc leads to h' and costs log T(h) / (c(h) + T(h)). An arc that is taken leads to a seen history,
as the token is followed by another, so the state before a token is always the longest seen history that the text has there: all tokens
are read at once, failure by failure, and what arcs and failures cost is added up for each text.

The automaton grows with the corpus, so nobody holds all of it:

1. ``blocks``: texts are dealt, in the order of their partition, into blocks of about BLOCK bytes, each one written row: the
   block's different words as 64-bit hashes and its texts as numbers of words.
2. ``counted``: each block sends its different n-grams, with their counts in rows to learn from, to the bucket of their
   history; a bucket adds up the counts of all blocks and answers each block for just the n-grams that it asked for.
   A frequent history (HOT of all tokens or more, so there are few) is dealt over many buckets by the next token.
3. ``scores``: a block meets its answers, makes them into the part of the automaton that its texts can reach, and reads them.

So a block or bucket meets in a task, never a word's n-grams nor the model. Histories and words are told apart by 64-bit
hashes, tokens after one history by 48 bits of theirs.

Defined cases: a null or empty text is the end alone; with nothing to learn from every token has probability 1;
``eligible`` null means not learned from; repeated rows are counted and scored each; doc_id may be of any type, null or shared;
other columns are left aside, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biblioflow.llm.common import small_batches, table

#: UTF-8 bytes of the texts in a block, each with ROW bytes more.
BLOCK, ROW = 6 << 20, 16
#: Bytes of text for each bucket.
BUCKET = 16 << 20
#: A history of this share of all tokens is surely dealt over SPREAD buckets; one of less than half of it is not.
HOT, SPREAD = 1 / 500, 64
BEGIN, END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
LOW = np.uint64((1 << 48) - 1)


def tokens_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def packed(a: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(a).tobytes(), 1)


def opened(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


def small(a: np.ndarray) -> bytes:
    """Counts as four bytes each, or eight where one is too large."""
    return packed(a.astype("<u4" if not len(a) or a.max() < 1 << 32 else "<u8"))


def counts_of(data: bytes, n: int) -> np.ndarray:
    raw = zstandard.decompress(data)
    return np.frombuffer(raw, "<u4" if len(raw) == 4 * n else "<u8").astype(np.int64)


def histories_of(words: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each level the history of every token, and the places of the tokens that have one of that level."""
    starts = np.cumsum(lengths) - lengths
    at = np.arange(len(tokens)) - np.repeat(starts, lengths)
    before = np.r_[BEGIN, words[tokens[:-1]]]
    before[starts] = BEGIN
    histories, places = [before], [np.arange(len(tokens))]
    for k in range(1, order - 1):  # of k + 1 tokens, from the k before the last one
        longer = np.r_[np.uint64(0), mixed(histories[-1][:-1], before[1:] + np.uint64(k))]
        histories.append(longer)
        places.append(np.flatnonzero(at >= k))
    return histories, places


def frequent(words: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, order: int, least: float) -> list[tuple[int, int]]:
    """(history, times) of the histories that occur ``least`` times or more; those of one token are counted as tokens but the last."""
    times = np.bincount(tokens, minlength=len(words)) - np.bincount(tokens[np.cumsum(lengths) - 1], minlength=len(words))
    found = [(np.r_[words, BEGIN], np.r_[times, len(lengths)])]
    if order > 2:
        found += [np.unique(h[p], return_counts=True) for h, p in list(zip(*histories_of(words, tokens, lengths, order), strict=True))[1:]]
    return [(int(h), int(n)) for of, times in found for h, n in zip(of[times >= least].astype(np.int64), times[times >= least], strict=True)]


class Grams:
    """A block's n-grams: for each history, in order of hash, the different tokens after it."""

    def __init__(self, words: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, order: int):
        """words: hashes, in order; tokens: places in ``words`` of all texts' tokens; lengths: tokens of each text."""
        histories, places = histories_of(words, tokens, lengths, order)
        self.width = len(words)
        all_ = np.concatenate([h[p] for h, p in zip(histories, places, strict=True)])
        self.histories, history = np.unique(all_, return_inverse=True)
        self.levels = np.zeros(len(self.histories), np.int64)
        #: For each level the history of each token, -1 where there is none.
        self.of, first = [], 0
        for k, p in enumerate(places):
            own = np.full(len(tokens), -1, np.int64)
            own[p] = history[first : first + len(p)]
            first += len(p)
            self.levels[own[p]] = k
            self.of.append(own)
        keys = history.astype(np.int64) * self.width + np.concatenate([tokens[p] for p in places])
        self.keys, self.inverse = np.unique(keys, return_inverse=True)
        self.history, self.word = np.divmod(self.keys, self.width)
        self.places = places

    def seen(self, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts, in the tokens marked, of each n-gram and of each history."""
        marks = np.concatenate([learned[p] for p in self.places]).astype(float)
        grams = np.bincount(self.inverse, marks, len(self.keys)).astype(np.int64)
        return grams, np.bincount(self.history, grams, len(self.histories)).astype(np.int64)

    def buckets(self, words: np.ndarray, hot: np.ndarray, n: int) -> np.ndarray:
        """The bucket of each n-gram: by its history, of a hot history also by the token after it."""
        own = mixed(self.histories, self.histories)
        chosen = own[self.history]
        split = np.isin(self.histories, hot)[self.history]
        chosen[split] = mixed(chosen[split], words[self.word[split]] % np.uint64(SPREAD))
        return (chosen % np.uint64(n)).astype(np.int64)


class Automaton:
    """States (the seen histories) with arcs (the n-grams that were learned), failure arcs and their logarithms, for a block."""

    def __init__(self, grams: Grams, counts: np.ndarray, seen: np.ndarray, kinds: np.ndarray, base: np.ndarray):
        """counts: of each n-gram; seen, kinds: c and T of each history; base: probability of each word."""
        levels = grams.levels
        shorter = np.full(len(grams.histories), -1, np.int64)  # the history without its oldest token
        for k, places in enumerate(grams.places[1:], 1):
            shorter[grams.of[k][places]] = grams.of[k - 1][places]
        p = np.zeros(len(grams.keys))
        order = np.argsort(levels[grams.history], kind="stable")
        for k in range(len(grams.of)):  # the longer from the shorter
            own = order[np.searchsorted(levels[grams.history][order], k) : np.searchsorted(levels[grams.history][order], k, side="right")]
            h, w = grams.history[own], grams.word[own]
            below = base[w]
            if k:
                at = np.searchsorted(grams.keys, shorter[h] * grams.width + w)
                below = p[at]
            total = seen[h] + kinds[h]
            p[own] = np.where(total > 0, (counts[own] + kinds[h] * below) / np.maximum(total, 1), below)
        self.grams, self.live, self.states = grams, counts > 0, seen > 0
        self.weight = np.log10(p)
        self.cost = np.log10(np.where(seen > 0, kinds, 1) / np.maximum(seen + kinds, 1))
        self.base = np.log10(base)

    def spent(self, tokens: np.ndarray) -> np.ndarray:
        """A row for each token: what its failures and then its arc, or the base, cost; zero where it needs none.

        Every token starts in the state of its longest history and fails down to the first one that has an arc for it.
        """
        grams, end = self.grams, len(self.grams.inverse)
        out = np.zeros((len(tokens), len(grams.places) + 1))
        waiting = np.ones(len(tokens), bool)
        for k in reversed(range(len(grams.places))):
            at = grams.places[k]
            arc = grams.inverse[end - len(at) : end]
            end -= len(at)
            state = grams.history[arc]
            here = waiting[at] & self.states[state]
            at, arc, state = at[here], arc[here], state[here]
            found = self.live[arc]
            out[at, k] = np.where(found, self.weight[arc], self.cost[state])
            waiting[at[found]] = False
        out[waiting, -1] = self.base[tokens[waiting]]
        return out


def coded(rows: list[tuple]) -> dict:
    """A block of (learned, tokens): hashes of its words, numbers of its tokens."""
    place = {w: k for k, w in enumerate({w for _, ts in rows for w in ts})}
    raw = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=11), place), np.uint64, len(place))
    words, inverse = np.unique(np.r_[raw, END], return_inverse=True)
    at = inverse.tolist()
    number = dict(zip(place, at, strict=False))
    end = at[-1]
    tokens = np.fromiter((x for _, ts in rows for x in (*map(number.__getitem__, ts), end)), np.uint32)
    return {"words": words, "tokens": tokens, "lengths": np.array([len(ts) + 1 for _, ts in rows], np.uint32), "learned": np.array([y for y, _ in rows], np.uint8)}


def read_block(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return opened(row["words"], "<u8"), opened(row["tokens"], "<u4").astype(np.int64), opened(row["lengths"], "<u4").astype(np.int64), opened(row["learned"], "u1") > 0


def blocks(docs: DataFrame, eligible: Column, doc_id: str, text: str, order: int, size: int) -> DataFrame:
    """(block, ids, words, tokens, lengths, learned, n_tokens, n_learned, hot): the texts, coded; n_learned: texts to learn from;
    hot: (history, times) of histories that are HOT / 2 of the block's tokens."""
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(eligible, F.lit(False)).alias("learned"), F.col(text).alias("text"))
    hot_type = pa.list_(pa.struct([("history", pa.int64()), ("times", pa.int64())]))

    def made(block: int, ids: list[pa.Array], held: list[tuple]) -> pa.RecordBatch:
        c = coded(held)
        often = frequent(c["words"], c["tokens"].astype(np.int64), c["lengths"].astype(np.int64), order, max(2, len(c["tokens"]) * HOT / 2))
        hot = [{"history": h, "times": n} for h, n in often]
        own = pa.concat_arrays(ids)
        return pa.RecordBatch.from_pydict({
            "block": pa.array([block], pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
            **{k: pa.array([packed(c[k])], pa.binary()) for k in ("words", "tokens", "lengths", "learned")},
            "n_tokens": pa.array([len(c["tokens"])], pa.int64()),
            "n_learned": pa.array([int(c["learned"].sum())], pa.int64()),
            "hot": pa.array([hot], hot_type),
        })

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, ids, held, full = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            first = 0
            for k, (y, t) in enumerate(zip(batch.column("learned").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                held.append((y, tokens_of(t)))
                full += len(t or "") + ROW
                if full >= size:
                    yield made((part << 32) + n, [*ids, batch.column("id").slice(first, k + 1 - first)], held)
                    n, ids, held, full, first = n + 1, [], [], 0, k + 1
            ids.append(batch.column("id").slice(first))
        if held:
            yield made((part << 32) + n, ids, held)

    kind = T.StructType().add("block", "long").add("ids", T.ArrayType(rows.schema["id"].dataType))
    for name in ("words", "tokens", "lengths", "learned"):
        kind = kind.add(name, "binary")
    kind = kind.add("n_tokens", "long").add("n_learned", "long").add("hot", T.DataType.fromDDL("array<struct<history: long, times: long>>"))
    return table(rows.mapInArrow(dealt, kind), "lm_blocks", "uncompressed")


def hot_histories(dealt: DataFrame, total: int) -> np.ndarray:
    """Histories of HOT of all tokens or more, and none of less than half of that: at most 2 / HOT for each length."""
    some = dealt.select(F.explode("hot").alias("x")).groupBy("x.history").agg(F.sum("x.times").alias("n")).where(F.col("n") >= F.lit(total * HOT / 2))
    return np.sort(np.array([r["history"] for r in some.collect()], np.int64).astype(np.uint64))


ANSWER = "bucket long, block long, totals binary, seen binary, kinds binary, tokens long, words long, hot array<struct<history: long, word: boolean, seen: long, kinds: long>>"


def counted(dealt: DataFrame, hot: np.ndarray, n: int, order: int) -> DataFrame:
    """Each bucket's answers to each block: totals of the n-grams it asked for, c and T of their histories, in the order asked;
    in one answer of a bucket also its tokens and words (the base's N and V) and its shares of hot histories."""

    def asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                words, tokens, lengths, learned = read_block(row)
                g = Grams(words, tokens, lengths, order)
                counts, _ = g.seen(np.repeat(learned, lengths))
                bucket = g.buckets(words, hot, n)
                by = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[by], np.arange(n + 1))
                out = []
                for b in np.flatnonzero(np.diff(edges)).tolist():
                    own = by[edges[b] : edges[b + 1]]
                    h, size = np.unique(g.history[own], return_counts=True)
                    nexts = (words[g.word[own]] & LOW).astype("<u8").view("<u2").reshape(-1, 4)[:, :3]
                    out.append((b, row["block"], g.histories[h].tobytes(), g.levels[h].astype("u1").tobytes(), size.astype("<u4").tobytes(), np.ascontiguousarray(nexts).tobytes(), small(counts[own])))
                yield pd.DataFrame(out, columns=["bucket", "block", "histories", "levels", "sizes", "nexts", "counts"])

    def answered(key: tuple, chunks: pd.DataFrame) -> pd.DataFrame:
        chunks = chunks.sort_values("block")
        sizes = [np.frombuffer(x, "<u4").astype(np.int64) for x in chunks["sizes"]]
        histories = np.concatenate([np.frombuffer(x, "<u8") for x in chunks["histories"]])
        levels = np.concatenate([np.frombuffer(x, "u1") for x in chunks["levels"]])
        nexts = np.zeros((sum(int(s.sum()) for s in sizes), 4), "<u2")
        nexts[:, :3] = np.concatenate([np.frombuffer(x, "<u2") for x in chunks["nexts"]]).reshape(-1, 3)
        counts = np.concatenate([counts_of(c, int(s.sum())) for c, s in zip(chunks["counts"], sizes, strict=True)])
        different, of = np.unique(histories, return_inverse=True)
        own = np.repeat(of, np.concatenate(sizes))
        after = nexts.view("<u8").ravel()
        order_ = np.lexsort((after, own))
        first = np.r_[True, (own[order_][1:] != own[order_][:-1]) | (after[order_][1:] != after[order_][:-1])]
        group = np.cumsum(first) - 1
        sums = np.bincount(group, counts[order_]).astype(np.int64)
        totals = np.empty(len(own), np.int64)
        totals[order_] = sums[group]
        owner = own[order_][first]
        seen = np.bincount(owner, sums, len(different)).astype(np.int64)
        kinds = np.bincount(owner[sums > 0], minlength=len(different))
        level = np.zeros(len(different), np.int64)
        level[of] = levels
        is_hot = np.isin(different, hot)
        plain = (level == 0) & ~is_hot & (different != BEGIN) & (seen > 0)
        shares = [{"history": int(different[k].astype(np.int64)), "word": bool(level[k] == 0 and different[k] != BEGIN), "seen": int(seen[k]), "kinds": int(kinds[k])} for k in np.flatnonzero(is_hot)]
        out, a, b = [], 0, 0
        for block, s in zip(chunks["block"], sizes, strict=True):
            mine, m = of[a : a + len(s)], int(s.sum())
            out.append((key[0], block, small(totals[b : b + m]), small(seen[mine]), small(kinds[mine]), 0, 0, []))
            a, b = a + len(s), b + m
        out[0] = (*out[0][:5], int(seen[plain].sum()), int(plain.sum()), shares)
        return pd.DataFrame(out, columns=[x.split()[0] for x in ANSWER.split(", ")[:7]] + ["hot"])

    sent = dealt.select("block", "words", "tokens", "lengths", "learned").mapInPandas(asked, "bucket long, block long, histories binary, levels binary, sizes binary, nexts binary, counts binary")
    return table(sent.groupBy("bucket").applyInPandas(answered, ANSWER), "lm_answers", "uncompressed")


def scored(docs: DataFrame, eligible: Column, doc_id: str = "doc_id", text: str = "text", order: int = 2, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row; ``eligible`` (over docs) says which are learned from."""
    if order < 2:
        raise ValueError("an automaton has histories of one token at least")
    small_batches(docs.sparkSession)
    dealt = blocks(docs, eligible, doc_id, text, order, block)
    id_type = dealt.schema["ids"].dataType.elementType
    sums = dealt.agg(F.sum("n_tokens").alias("n"), F.sum("n_learned").alias("ends"), F.sum(F.octet_length("tokens") + F.octet_length("words")).alias("bytes")).first()
    n, n_ends = max(1, -(-2 * (sums["bytes"] or 0) // bucket)), sums["ends"] or 0
    hot = hot_histories(dealt, sums["n"] or 0)
    answers = counted(dealt, hot, n, order)
    shares = answers.select(F.explode("hot").alias("x")).groupBy("x.history", "x.word").agg(F.sum("x.seen").alias("seen"), F.sum("x.kinds").alias("kinds")).collect()  # as many as ``hot``
    of_hot = {np.uint64(r["history"] % (1 << 64)): (r["seen"], r["kinds"]) for r in shares}
    rest = answers.agg(F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).first()
    total = (rest["tokens"] or 0) + n_ends + sum(r["seen"] for r in shares if r["word"])
    different = (rest["words"] or 0) + (n_ends > 0) + sum(r["seen"] > 0 for r in shares if r["word"])

    def read(key: tuple, own: pa.Table, given: pa.Table) -> pa.Table:
        row = {c: own.column(c)[0].as_py() for c in ("words", "tokens", "lengths", "learned")}
        words, tokens, lengths, _ = read_block(row)
        g = Grams(words, tokens, lengths, order)
        buckets = g.buckets(words, hot, n)
        by = np.argsort(buckets, kind="stable")
        edges = np.searchsorted(buckets[by], np.arange(n + 1))
        counts, seen, kinds = np.zeros(len(g.keys), np.int64), np.zeros(len(g.histories), np.int64), np.zeros(len(g.histories), np.int64)
        answered = 0
        for b, totals, s, k in zip(*(given.column(c).to_pylist() for c in ("bucket", "totals", "seen", "kinds")), strict=True):
            mine = by[edges[b] : edges[b + 1]]
            h = np.unique(g.history[mine])
            counts[mine], seen[h], kinds[h] = counts_of(totals, len(mine)), counts_of(s, len(h)), counts_of(k, len(h))
            answered += len(mine)
        if answered != len(by):
            raise ValueError(f"{answered} answers to {len(by)} n-grams")
        for h in np.flatnonzero(np.isin(g.histories, hot)).tolist():
            seen[h], kinds[h] = of_hot[g.histories[h]]
        c = np.zeros(len(words), np.int64)  # a word is seen as often as what follows it
        place = np.minimum(np.searchsorted(g.histories, words), len(g.histories) - 1)
        found = g.histories[place] == words
        c[found] = seen[place[found]]
        c[words == END] = n_ends
        base = (c + 0.5) / (total + 0.5 * (different + 1))
        automaton = Automaton(g, counts, seen, kinds, base)
        known, starts = c > 0, np.cumsum(lengths) - lengths
        each = lambda of: [math.fsum(of[a : a + m].ravel().tolist()) for a, m in zip(starts.tolist(), lengths.tolist(), strict=True)]
        return pa.table({
            "doc_id": own.column("ids").combine_chunks().flatten(),
            "n_tokens": pa.array(lengths, pa.int64()),
            "n_known": pa.array(np.add.reduceat(known[tokens].astype(np.int64), starts), pa.int64()),
            "train_tokens": pa.array([total] * len(lengths), pa.int64()),
            "base_score": pa.array(each(automaton.base[tokens]), pa.float64()),
            "score": pa.array(each(automaton.spent(tokens)), pa.float64()),
        })

    kind = T.StructType().add("doc_id", id_type).add("n_tokens", "long").add("n_known", "long").add("train_tokens", "long").add("base_score", "double").add("score", "double")
    own = dealt.select("block", "ids", "words", "tokens", "lengths", "learned").groupBy("block")
    return own.cogroup(answers.select("block", "bucket", "totals", "seen", "kinds").groupBy("block")).applyInArrow(read, kind)
