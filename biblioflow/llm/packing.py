"""Packing by best-fit decreasing, planned on the histogram of piece lengths.

Best-fit decreasing looks only at lengths, and there are at most ``capacity`` of them, so its exact outcome for any
number of documents follows from the counts by length. ``plan`` runs it on those counts: a segment tree indexed by
remaining capacity finds the tightest open windows, and all windows of one state are filled together. Its rules (at
most a few times ``capacity``, whatever the corpus) say which ranks of a length go to which windows; every piece then
finds its place from its own length and rank. No piece is sorted or moved for it.

``pieces`` tokenizes once, cuts documents into full windows and a rest, and writes them as a table with the writing
task's number and the piece's ordinal among that task's pieces of equal length; ranks follow from counts by task. These
counts are broadcast while they are measured to be small; beyond that their join shuffles the pieces once.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each; an empty table gives no rows;
other columns are left aside. Sequences are padded to ``capacity``; one whose length is a power of two needs no
padding (``padded_length``).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biblioflow.llm import token_ids
from biblioflow.llm.common import sized, small_batches, table

CAPACITY = 1024


class CapacityTree:
    """Segment tree over remaining capacities 0..n: the smallest one, from a given capacity on, that has windows."""

    def __init__(self, n: int):
        self.leaves = 1 << n.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, capacity: int, has: bool) -> None:
        i = self.leaves + capacity
        self.any[i] = has
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def first(self, capacity: int) -> int | None:
        i = self.leaves + capacity
        while not self.any[i]:
            while i & 1:  # a right child: what follows lies beyond its parent
                i //= 2
            if i <= 1:
                return None
            i += 1
        while i < self.leaves:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.leaves


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rules (length, first rank, first window, pieces a window, offset in it) of best-fit decreasing, in key order."""
    tree, open_windows = CapacityTree(capacity), [[] for _ in range(capacity + 1)]
    rules, windows = [], 0

    def push(remaining: int, first: int, n: int) -> None:
        if n and remaining:
            open_windows[remaining].append((first, n))
            tree.set(remaining, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            remaining = tree.first(length)
            if remaining is None:
                n = -(-left // (capacity // length))
                push(capacity, windows, n)
                windows += n
                continue
            first, n = open_windows[remaining].pop()
            tree.set(remaining, bool(open_windows[remaining]))
            # the window just filled is again the tightest while it holds another piece of this length
            each = remaining // length
            full = min(n, left // each)
            if full:
                rules.append((length, rank, first, each, capacity - remaining))
                push(remaining - each * length, first, full)
                rank, left = rank + full * each, left - full * each
            if full < n and left:
                rules.append((length, rank, first + full, left, capacity - remaining))
                push(remaining - left * length, first + full, 1)
                full, left = full + 1, 0
            push(remaining, first + full, n - full)
    return np.array(sorted(rules), dtype=np.int64).reshape(-1, 5)


def padded_length(used: Column, capacity: int = CAPACITY) -> Column:
    """Length of a sequence in storage: its own if that is a power of two, else the capacity."""
    return F.when(used.bitwiseAND(used - 1) == 0, used).otherwise(F.lit(capacity))


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, ids, ids_crc32, doc_tokens, part, ordinal): every document cut, written once.

    ids: little-endian unsigned 32-bit integers.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("start", "length")), T.StructField("ids", T.BinaryType()), *(T.StructField(c, T.LongType()) for c in ("ids_crc32", "doc_tokens", "part", "ordinal"))])
    end = np.array([end_id], dtype="<u4").tobytes()
    shipped = token_ids.ship(docs.sparkSession, tokenizer)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = token_ids.encoder(shipped).encode, TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            take, out = [], []
            for k, ids in enumerate(encode(batch.column("text").to_pylist())):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    length = len(piece) // 4
                    take.append(k)
                    out.append((start, length, piece, zlib.crc32(piece), n, part, int(seen[length])))
                    seen[length] += 1
            columns = zip(*out, strict=True) if out else [[]] * 7
            yield pa.record_batch([batch.column("doc_id").take(pa.array(take, pa.int64())), *(pa.array(c, pa.binary() if i == 2 else pa.int64()) for i, c in enumerate(columns))], names=schema.names)

    return table(rows.mapInArrow(cut, schema), "pieces")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The pieces of all documents with sequence_id and offset."""
    cut = pieces(docs, tokenizer, end_id, capacity, doc_id, text)
    by_task = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = table(by_task.select("length", "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "bases")
    counts = {r["length"]: r["n"] for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    rules = plan(counts, capacity)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        n, r = length.to_numpy("i8"), rank.to_numpy("i8")
        rule = rules[np.searchsorted(rules[:, 0] * (1 << 48) + rules[:, 1], n * (1 << 48) + r, side="right") - 1]
        k = r - rule[:, 1]
        return pd.DataFrame({"sequence_id": rule[:, 2] + k // rule[:, 3], "offset": rule[:, 4] + k % rule[:, 3] * n})

    ranked = cut.join(sized(bases, 24).select("length", "part", "base"), ["length", "part"])
    placed = ranked.withColumn("at", place("length", F.col("base") + F.col("ordinal")))
    return placed.select("doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "at.sequence_id", "at.offset")


def sequences(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(sequence_id, ids, used, stored): each sequence's ids in order; at most ``capacity`` ids a group."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = packed.groupBy("sequence_id").agg(rows.alias("rows"), F.sum("length").alias("used"))
    ids = F.aggregate("rows", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return whole.select("sequence_id", ids.alias("ids"), "used", padded_length(F.col("used"), capacity).alias("stored"))
