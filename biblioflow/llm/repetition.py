"""Quality rules by suffix-array repetition, over the words of each whole text.

The suffix array is built by prefix doubling for a batch of documents at once: suffixes are ranked by their first word
(and document), then by twice as many words, and only those still tied are sorted again. Neighbours in the array
share their longest common prefix, read off the ranks of the rounds. A place's longest repeat is the longer of its
two neighbours' prefixes, as every common-prefix interval around it is at most that long; repeats that the
place before extends by one word are not maximal. The maximal repeats of ``least`` words or more are united into
spans; ``covered`` of a document's words may lie in spans and no repeat may be longer than ``longest`` words.

Defined cases: a null or empty text has no words, fails the base rule (too few words) and is not kept; repeated rows are
judged each; very long texts are sorted whole (four bytes a word are kept for each doubling up to the longest repeat);
other columns, also of clashing names, are left aside; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biblioflow.llm.common import small_batches, utf8

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\v\f\r"
#: Window of the base rule's repeated words.
BASE_WINDOW = 8


@dataclass(frozen=True)
class Rules:
    least_words: int = 20
    base_repeat: int = 30  # percent of the words in repeated windows of BASE_WINDOW words
    least: int = 6  # words of a repeat that counts
    covered: float = 0.3
    longest: int = 200


def suffix_array(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array of ``words`` (codes in which documents share no value; ``ends``: end of each place's document).

    Also the ranks of each round: round k's are equal where the first 2 ** k words are.
    """
    n = len(words)
    array = np.argsort(words, kind="stable")
    key = words[array]
    rounds, ranks, active = [], np.empty(n, np.int64), np.arange(n)
    slots = np.arange(n)
    while True:
        new = np.r_[True, key[1:] != key[:-1]]
        start = slots[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        ranks = ranks.copy()
        ranks[array[slots]] = start
        rounds.append(ranks.astype(np.int32) if n < 1 << 31 else ranks)  # kept for the common prefixes
        tied = ~(new & np.r_[new[1:], True])
        slots = slots[tied]
        if not len(slots):
            return array, rounds
        active = array[slots]
        ahead = active + (1 << (len(rounds) - 1))
        second = np.where(ahead < ends[active], ranks[np.minimum(ahead, n - 1)], -1) + 1
        key = ranks[active] * (n + 1) + second
        order = np.argsort(key, kind="stable")
        array[slots], key = active[order], key[order]


def longest_repeats(array: np.ndarray, rounds: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """For every place, the words of the longest prefix of its suffix that occurs elsewhere in its document."""
    n = len(array)
    best = np.zeros(n, np.int64)
    tied = np.flatnonzero(rounds[0][array[1:]] == rounds[0][array[:-1]])
    a, b = array[tied].copy(), array[tied + 1].copy()
    common = np.zeros(len(tied), np.int64)
    for k in range(len(rounds) - 1, -1, -1):
        inside = (a < ends[array[tied]]) & (b < ends[array[tied + 1]])
        same = inside & (rounds[k][np.minimum(a, n - 1)] == rounds[k][np.minimum(b, n - 1)])
        step = same * (1 << k)
        common, a, b = common + step, a + step, b + step
    np.maximum.at(best, array[tied], common)
    np.maximum.at(best, array[tied + 1], common)
    return best


def united(repeats: np.ndarray, least: int, base: int = 0) -> list[tuple[int, int]]:
    """Union of the maximal repeats' spans in one document; ``repeats``: longest repeat at each place."""
    maximal = np.flatnonzero((repeats >= least) & (np.r_[0, repeats[:-1]] <= repeats))
    spans: list[tuple[int, int]] = []
    for start, end in zip((maximal + base).tolist(), (maximal + base + repeats[maximal]).tolist(), strict=True):
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], end))
        else:
            spans.append((start, end))
    return spans


def line_copies(text: bytes) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines))


def measure(texts: list[bytes], least: int) -> list[tuple]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered, longest, spans) of each text."""
    code: dict[bytes, int] = defaultdict(count().__next__)
    words = [t.split() for t in texts]  # bytes: ASCII white space only
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    bounds = np.r_[0, np.cumsum(sizes)]
    n = int(bounds[-1])
    repeats = np.zeros(0, np.int64)
    if n:
        codes = np.fromiter((c for w in words for c in map(code.__getitem__, w)), np.int64, n)
        own = np.repeat(np.arange(len(texts)), sizes)
        ends = np.repeat(bounds[1:], sizes)
        repeats = longest_repeats(*suffix_array(own * len(code) + codes, ends), ends)
    out = []
    for k, (text, w) in enumerate(zip(texts, words, strict=True)):
        mine = repeats[bounds[k] : bounds[k + 1]]
        spans = united(mine, least)
        windows = united(np.minimum(mine, BASE_WINDOW), BASE_WINDOW)
        inner = 0 if text.isascii() else int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) == 0x80))  # bytes that begin no character
        chars = sum(map(len, w)) - inner
        out.append((len(w), chars, sum(map(text.count, (bytes([s]) for s in SYMBOLS))), line_copies(text), sum(b - a for a, b in windows), sum(b - a for a, b in spans), int(mine.max(initial=0)), spans))
    return out


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """(doc_id, FIELDS, spans): counts of each text and its repeats' spans, in words."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in FIELDS), T.StructField("spans", SPANS)])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measure(list(utf8(batch.column("text").to_pylist())), rules.least)
            columns = list(zip(*found, strict=True)) or [()] * (len(FIELDS) + 1)
            spans = pa.array([[{"start": a, "end": b} for a, b in s] for s in columns[-1]], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.record_batch([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:-1]), spans], names=schema.names)

    return rows.mapInArrow(of, schema)


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """``measured`` with base_failed and kept."""
    failed = (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.base_repeat * F.col("n_words"))
    fine = (F.col("covered_words") <= rules.covered * F.col("n_words")) & (F.col("longest_repeat") <= rules.longest)
    return measured(docs, doc_id, text, rules).withColumn("base_failed", failed).withColumn("kept", ~failed & fine)
