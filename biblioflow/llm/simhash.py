"""SimHash near-duplicates: pigeonhole blocks, Hamming check, connected components.

Two fingerprints that differ in at most ``d`` of 64 bits leave at least ``b - d`` of ``b`` blocks untouched, so
they meet under at least one choice of ``b - d`` blocks. Distinct fingerprints are dealt under every such choice
and compared where they meet. Only what links them is kept: inside a bucket a search from member to member gives
a spanning forest of the links of at most ``d`` bits, so a bucket never yields all its pairs, however many near
copies it holds, and no link between different components is lost. Exact copies collapse into one fingerprint first.

Near copies in the sense of a Jaccard similarity (``near_copies``) go the same way with a wide fingerprint, of WIDE_BLOCKS
blocks: texts whose wide fingerprints leave a block untouched meet there, the Hamming check looks at the fingerprint's first
128 bits and then at 256 (of fewer, unrelated texts pass by chance, as the square of their number), what it leaves is judged on the
shingles themselves, and the links judged make the components.

Defined cases: a null text and a text without words have fingerprint zero, which links like any other; a text of
fewer words than a shingle is one shingle; rows may repeat (each gets its row in the result); a null doc_id never
becomes a component's id while another member has one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from biblioflow.llm.common import release, row_key, sized, small_batches, spare, table, utf8

BITS = 64
#: Buckets of up to so many fingerprints are compared by shifted columns, larger ones by search.
SMALL_BUCKET = 8
#: Fingerprints a bucket should hold on average; decides the number of blocks, never the result.
BUCKET_TARGET = 16
#: A bucket of more fingerprints is dealt again inside its task, by keys of FINE_BLOCKS blocks.
LARGE_BUCKET, FINE_BLOCKS = 4096, 9

#: Words of 64 bits in a wide fingerprint, and its blocks, of 12 bits. Up to 63 of its 768 bits may differ without leaving no
#: block untouched; at similarity 0.8, where each differs with probability 0.15, one is with probability 0.9999.
WIDE, WIDE_BLOCKS = 12, 64
WIDE_FACTORS = np.array([(0x9E3779B97F4A7C15 * (2 * k + 1)) % (1 << 64) for k in range(WIDE)], "u8")
#: Words of a wide fingerprint that the Hamming check reads.
HELD = ("fp", "more", "third", "fourth")
#: Differing bits of the first two words and of the four of HELD up to which texts in a block are judged on their shingles (about 19 and 39 at
#: similarity 0.8, 64 and 128 between unrelated texts), and of the first word.
NEAR_BITS, HELD_BITS, WIDE_BITS = 42, 72, 24
#: Pairs that the Hamming check of a block looks at in one step.
CELLS = 1 << 18
#: Shingles for a word of an odd sketch, and its fewest words.
SKETCH_SHINGLES, SKETCH_WORDS = 24, 8


def shingles(text: bytes, words: int = 4, seed: int = 42) -> np.ndarray:
    """Hashes of the word shingles in their order; none for a text without words."""
    w = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not w:
        return np.empty(0, "<u8")
    joined = [b" ".join(x) for x in zip(*(w[i:] for i in range(words)), strict=False)] if len(w) >= words else [b" ".join(w)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, seed) for s in joined], dtype="<u8")


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """SimHash of the word shingles, as a signed 64-bit integer."""
    return majority(shingles(text, words, seed))


def majority(h: np.ndarray) -> int:
    """The bits that most hashes have; zero for none."""
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """``docs`` with the column ``fp`` (signed 64-bit) in place of the text."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words, seed) for t in utf8(texts)], dtype="int64")

    return docs.withColumn("fp", of(F.col(text))).drop(text)


def block_count(n: int, bits: int) -> int:
    """The fewest blocks whose keys leave about BUCKET_TARGET unrelated fingerprints in a bucket."""
    return next((b for b in range(bits + 2, 2 * bits + 1) if n / 2 ** (BITS * (b - bits) / b) <= BUCKET_TARGET), 2 * bits)


def block_masks(blocks: int, bits: int) -> list[int]:
    """One signed mask for each choice of ``blocks - bits`` blocks."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    unsigned = [sum(c) for c in combinations(parts, blocks - bits)]
    assert len(unsigned) == comb(blocks, bits)
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in unsigned]


def forest(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Index pairs that span every component of the links of at most ``bits`` bits.

    A member found leaves the set that later members are compared with, so a dense bucket costs little more than
    one pass over it.
    """
    found: list[tuple[int, int]] = []
    left = np.arange(len(fps))
    while left.size > 1:
        queue, left = [left[0]], left[1:]
        while queue and left.size:
            u = queue.pop()
            near = np.bitwise_count(fps[left] ^ fps[u]) <= bits
            if near.any():
                hit = left[near]
                found += [(int(u), int(v)) for v in hit]
                queue += list(hit)
                left = left[~near]
    return found


def large_forest(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that connect what ``forest`` connects, by the pigeonhole again: each close pair shares a finer key.

    A key that still holds more than half of the members is so dense that one search spans it.
    """
    left, right = [], []
    for mask in block_masks(FINE_BLOCKS, bits):
        key = fps & np.uint64(mask % (1 << BITS))
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        lengths = np.diff(np.r_[starts, len(key)])
        for at, n in zip(starts[lengths > 1], lengths[lengths > 1], strict=True):
            own = order[at : at + n]
            if pairs := forest(fps[own], bits):
                u, v = np.array(pairs).T
                left.append(own[u])
                right.append(own[v])
    return np.concatenate([np.empty(0, int), *left]), np.concatenate([np.empty(0, int), *right])


def bucket_links(run: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside runs of equal ``run`` values: all of a small bucket, a forest of a large one."""
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    lengths = np.diff(np.r_[starts, len(run)])
    of_row = np.repeat(lengths, lengths)
    left, right = [], []
    small = np.flatnonzero((of_row > 1) & (of_row <= SMALL_BUCKET))
    for shift in range(1, SMALL_BUCKET):
        i = small[small + shift < len(run)]
        i = i[run[i] == run[i + shift]]
        i = i[np.bitwise_count(fps[i] ^ fps[i + shift]) <= bits]
        left.append(fps[i])
        right.append(fps[i + shift])
    for at, n in zip(starts[lengths > SMALL_BUCKET], lengths[lengths > SMALL_BUCKET], strict=True):
        bucket = fps[at : at + n]
        u, v = large_forest(bucket, bits) if n > LARGE_BUCKET else np.array(forest(bucket, bits), int).reshape(-1, 2).T
        left.append(bucket[u])
        right.append(bucket[v])
    return np.concatenate(left), np.concatenate(right)


def links(distinct: DataFrame, bits: int = 4, blocks: int | None = None) -> DataFrame:
    """Links (a, b), a < b, that connect all fingerprints of at most ``bits`` differing bits; ``distinct`` has fp."""
    blocks = blocks or block_count(distinct.count(), bits)
    masks = block_masks(blocks, bits)
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("choice", "key"))
    dealt = keyed.repartition("choice", "key").sortWithinPartitions("choice", "key")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.empty(0, "i4"), np.empty(0, "i8"), np.empty(0, "u8")]
        parts: list[list[np.ndarray]] = []

        def merged() -> list[np.ndarray]:
            return [np.concatenate(x) for x in zip(held, *parts, strict=True)]

        def out(n: int) -> pa.RecordBatch:
            choice, key, fp = (x[:n] for x in held)
            run = np.cumsum(np.r_[0, (choice[1:] != choice[:-1]) | (key[1:] != key[:-1])]) if n else choice
            a, b = bucket_links(run, fp, bits) if n > 1 else (fp[:0], fp[:0])
            a, b = a.view("i8"), b.view("i8")
            return pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        waiting = 0
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("choice", "key", "fp")]
            new[2] = new[2].view("u8")  # numpy counts the bits of a signed number's absolute value
            parts.append(new)
            waiting += len(new[0])
            if waiting > max(50_000, len(held[0])):
                held, parts, waiting = merged(), [], 0
                whole = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))  # the last bucket may go on
                n = int(whole[-1]) + 1 if whole.size else 0
                yield out(n)
                held = [x[n:] for x in held]
        held = merged()
        yield out(len(held[0]))

    return dealt.select("choice", "key", "fp").mapInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label): a node of its component, the same one for all its nodes, for each node of ``edges`` (a, b).

    Every round takes each node into the least of its neighbours and itself, then into what that one was taken into, and goes on with the
    links between what these have become, so only links that still join two are read again. Nodes are compared with some bits turned, other ones each round, so that no numbering
    of them makes a long chain shrink by its end alone. Links are tables in the shared folder, each replacing the one before. The joins meet
    many rows of one node with a single row of it, so adaptive execution can split them.
    """
    left, rounds = table(edges.select("a", "b"), "links"), []
    while True:
        turned = lambda c: F.col(c).bitwiseXOR(F.lit((0x9E3779B97F4A7C15 * (len(rounds) + 1) & (1 << 64) - 1) - (1 << 63)))  # noqa: B023, E731
        both = left.select(turned("a").alias("node"), turned("b").alias("other")).union(left.select(turned("b"), turned("a")))
        taken = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label"))
        further = taken.join(taken.select(F.col("node").alias("label"), F.col("label").alias("root")), "label")
        rounds.append(table(further.select(turned("node").alias("node"), turned("root").alias("label")), "labels"))
        side = lambda c: rounds[-1].select(F.col("node").alias(c), F.col("label").alias(f"of_{c}"))
        met = left.join(side("a"), "a").join(side("b"), "b").where("of_a <> of_b")
        after = table(met.select(F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b")).distinct(), "links")
        release(left)
        left = after
        if left.isEmpty():
            release(left)
            break
    label = rounds[-1]
    for before in rounds[-2::-1]:
        whole = before.join(label.select(F.col("node").alias("label"), F.col("label").alias("root")), "label", "left")
        label = whole.select("node", F.coalesce("root", "label").alias("label"))
    if len(rounds) > 1:
        label = table(label, "labels")
        for before in rounds:
            release(before)
    return label


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, seed: int = 42, bits: int = 4, blocks: int | None = None) -> DataFrame:
    """(doc_id, fp, component_id) for every row; component_id is the smallest doc_id that links reach."""
    prints = table(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", words, seed), "fingerprints")
    distinct = table(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    label = components(links(distinct.select("fp"), bits, blocks)).select(F.col("node").alias("fp"), "label")
    labelled = distinct.join(label, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"), "first")
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    of_fp = labelled.join(smallest, "label").select("fp", "component_id")
    return prints.join(of_fp, "fp").select("doc_id", "fp", "component_id")


def wide_majority(h: np.ndarray) -> np.ndarray:
    """The wide SimHash of shingle hashes, as WIDE words: a bit is set if most of the hashes made from them have it.

    The first word is that of ``majority``.
    """
    ones = np.zeros(64 * WIDE, np.int64)
    for at in range(0, len(h), 255):  # as many bits as a byte can count
        own = h[at : at + 255, None]
        x = own * WIDE_FACTORS
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x[:, :1] = own
        ones += np.add.reduce(np.unpackbits(x.astype("<u8", copy=False).view("u1"), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(h), bitorder="little").view("<u8")


def wide_blocks(words: np.ndarray) -> np.ndarray:
    """A key for each block of a wide fingerprint: its place and its bits."""
    bits = np.unpackbits(words.astype("<u8").view("u1"), bitorder="little").reshape(WIDE_BLOCKS, -1)
    width = bits.shape[1]
    return (bits @ (1 << np.arange(width))) + (np.arange(WIDE_BLOCKS) << width)


def sketches(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """(key, doc_id, node, HELD, blocks) for every row; node: hash of the set of shingles; HELD: the wide fingerprint's
    first words; blocks: its block keys, none without shingles."""
    small_batches(docs.sparkSession)

    @F.pandas_udf(f"node long, {' long, '.join(HELD)} long, blocks array<int>")
    def of(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in utf8(texts):
            h = np.unique(shingles(t, words))
            node = int(np.frombuffer(xxhash.xxh64_digest(h.tobytes()), ">i8")[0])
            wide = wide_majority(h)
            out.append((node, *wide[: len(HELD)].view("<i8").tolist(), wide_blocks(wide).tolist() if len(h) else []))
        return pd.DataFrame(out, columns=["node", *HELD, "blocks"])

    keyed = docs.select(row_key(docs).alias("key"), F.col(doc_id).alias("doc_id"), of(F.col(text)).alias("s"))
    return keyed.select("key", "doc_id", "s.*")


def wide_forest(words: np.ndarray, bits: int, held_bits: int = 64 * len(HELD)) -> list[tuple[int, int]]:
    """Index pairs that span every component of the links of at most ``bits`` bits in the first two words and ``held_bits`` in all.

    words: a row for each member.

    Many members are compared with all that are left in one step; those near nobody are done with, and from the others a search
    takes their components out, so a dense bucket costs little more than one pass over it.
    """
    found: list[tuple[int, int]] = []
    left, alive = np.arange(len(words)), np.ones(len(words), bool)

    def near(u: np.ndarray, v: np.ndarray) -> np.ndarray:
        n = np.bitwise_count(u ^ v)
        return (n[:, :2].sum(axis=1, dtype=np.int64) <= bits) & (n.sum(axis=1, dtype=np.int64) <= held_bits)

    while left.size > 1:
        some = left[: max(1, CELLS // left.size)]
        close = sum(np.bitwise_count(words[some, None, k] ^ words[None, left, k]) for k in range(2)) <= bits
        seeds: list[int] = []
        if np.count_nonzero(close) > some.size:  # each is near itself
            u, v = np.nonzero(close)
            u, v = u[u != v], v[u != v]  # some are the first of those left
            seeds = some[np.unique(u[near(words[some[u]], words[left[v]])])].tolist()
        for seed in seeds:
            if not alive[seed]:
                continue
            alive[seed] = False
            queue, others = [seed], left[alive[left]]
            while queue and others.size:
                u = queue.pop()
                close = near(words[others], words[u])
                if close.any():
                    hit = others[close].tolist()
                    found += [(u, v) for v in hit]
                    queue += hit
                    alive[others[close]] = False
                    others = others[~close]
        alive[some] = False
        left = left[alive[left]]
    return found


def odd_sketch(h: np.ndarray) -> bytes:
    """Parities of how many of the different shingles fall on each bit; the number of bits grows with the shingles.

    Two sketches differ in no more bits than the sets differ in shingles, so too many rule a pair out for certain.
    """
    words = SKETCH_WORDS
    while words * SKETCH_SHINGLES < len(h):
        words *= 2
    odd = np.bincount((h % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


class Bucket:
    """Members that share a block: fingerprints, labels, numbers of shingles and odd sketches."""

    def __init__(self, fps: np.ndarray, labels: np.ndarray, sizes: np.ndarray, sketches_: list[bytes], least: float):
        self.fps, self.labels, self.sizes, self.least = fps, labels, sizes, least
        self.words = np.array([len(x) // 8 for x in sketches_])
        self.folded: dict[int, np.ndarray] = {}
        self.row = np.zeros(len(fps), np.int64)
        for w in np.unique(self.words):  # alike sets are of one width or the next, so each is kept in both
            for width in (w, w // 2) if w > SKETCH_WORDS else (w,):
                self.folded.setdefault(int(width), np.zeros((len(fps), int(width)), "u8"))
        for k, x in enumerate(sketches_):
            own = np.frombuffer(x, "<u8")
            self.folded[len(own)][k] = own
            if len(own) // 2 in self.folded:
                self.folded[len(own) // 2][k] = own[: len(own) // 2] ^ own[len(own) // 2 :]

    def near(self, u: int, others: np.ndarray) -> np.ndarray:
        """Those of ``others`` that may be as similar to u as ``least``: none that is so is left out by size or sketch."""
        n = self.sizes[others]
        fits = (np.minimum(n, self.sizes[u]) >= self.least * np.maximum(n, self.sizes[u])) & (np.bitwise_count(self.fps[others] ^ self.fps[u]) <= WIDE_BITS)
        others = others[fits]
        out = []
        for wide in np.unique(self.words[others]):
            v = others[self.words[others] == wide]
            at = self.folded[int(min(wide, self.words[u]))]
            apart = np.bitwise_count(at[v] ^ at[u]).sum(axis=1, dtype=np.int64)
            out.append(v[apart * (1 + self.least) <= (1 - self.least) * (self.sizes[v] + self.sizes[u]) + 1e-9])
        return np.concatenate(out) if out else others

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All near index pairs between different labels; the commonest label is never searched from."""
        _, of, n = np.unique(self.labels, return_inverse=True, return_counts=True)
        rank = np.argsort(np.argsort(n, kind="stable"), kind="stable")[of]
        order = np.argsort(rank, kind="stable")
        ends = np.searchsorted(rank[order], rank[order], side="right")
        for k, u in enumerate(order):
            if ends[k] == len(order):
                return
            v = self.near(u, order[ends[k] :])
            if v.size:
                yield np.full(v.size, u), v


def in_buckets(members: DataFrame, fields: tuple[str, ...], of_bucket: Callable[..., Iterator[tuple[np.ndarray, np.ndarray]]]) -> DataFrame:
    """Distinct (a, b), a < b, of the pairs that ``of_bucket`` finds among the members of a bucket, given their ``fields``.

    members: bucket and ``fields``, longs or binaries; a bucket's members meet in one task.
    """
    kinds = dict(members.select("bucket", *fields).dtypes)
    dealt = members.select("bucket", *fields).repartition("bucket").sortWithinPartitions("bucket")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("bucket", *fields)
        held: list = [[] if kinds[c] == "binary" else np.empty(0, "i8") for c in names]
        parts: list[list] = []

        def out(n: int) -> Iterator[pa.RecordBatch]:
            starts = np.flatnonzero(np.r_[True, held[0][1:n] != held[0][: n - 1]]) if n else np.empty(0, int)
            sizes = np.diff(np.r_[starts, n])
            left, right, size = [np.empty(0, "i8")], [np.empty(0, "i8")], 0
            for at, m in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
                for a, b in of_bucket(*(x[at : at + m] for x in held[1:])):
                    left.append(a)
                    right.append(b)
                    size += len(a)
                    if size > 100_000:
                        yield batch_of(left, right)
                        left, right, size = [], [], 0
            if left:
                yield batch_of(left, right)

        def batch_of(left: list, right: list) -> pa.RecordBatch:
            a, b = np.concatenate(left), np.concatenate(right)
            return pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        def merge() -> None:
            nonlocal held, parts
            held = [[v for x in c for v in x] if kinds[name] == "binary" else np.concatenate(c) for name, c in zip(names, zip(held, *parts, strict=True), strict=True)]
            parts = []

        waiting = 0
        for batch in batches:
            parts.append([batch.column(c).to_pylist() if kinds[c] == "binary" else batch.column(c).to_numpy(zero_copy_only=False) for c in names])
            waiting += batch.num_rows
            if waiting > max(50_000, len(held[0])):
                merge()
                waiting = 0
                whole = int(np.searchsorted(held[0], held[0][-1]))  # the last bucket may go on
                yield from out(whole)
                held = [x[whole:] for x in held]
        merge()
        yield from out(len(held[0]))

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def near_links(prints: DataFrame, bits: int = NEAR_BITS, held_bits: int = HELD_BITS) -> DataFrame:
    """(a, b), a < b, of nodes that share a block and differ in at most ``bits`` bits of fp and more and ``held_bits`` of HELD: a forest in each block.

    prints: (node, HELD, blocks), of HELD at least the first two. Blocks never yield all their pairs, however many near copies they hold.
    """
    held = [c for c in HELD if c in prints.columns]

    def of_bucket(node: np.ndarray, *words: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if pairs := wide_forest(np.column_stack(words).view("u8"), bits, held_bits):  # numpy counts the bits of a signed number's absolute value
            u, v = np.array(pairs).T
            yield node[u], node[v]

    return in_buckets(prints.select("node", *held, F.explode("blocks").alias("bucket")), ("node", *held), of_bucket)


def candidates(members: DataFrame, least: float) -> DataFrame:
    """(a, b), a < b, of nodes of different labels that share a block; members: (bucket, node, fp, label, size, sketch).

    Sketches leave little more than the pairs that are linked.
    """

    def of_bucket(node: np.ndarray, fp: np.ndarray, label: np.ndarray, size: np.ndarray, sketch: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if (label != label[0]).any():
            yield from ((node[u], node[v]) for u, v in Bucket(fp.view("u8"), label, size, sketch, least).pairs())

    return in_buckets(members, ("node", "fp", "label", "size", "sketch"), of_bucket)


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs whose sets of shingles, from ``sets`` (node, hashes), have a Jaccard similarity of ``least`` or more."""

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8")
            both = len(np.intersect1d(x, y, assume_unique=True)) if min(len(x), len(y)) >= least * max(len(x), len(y)) else 0
            out.append(both / max(1, len(x) + len(y) - both) >= least)
        return pd.Series(out, dtype="bool")

    side = lambda c: sets.select(F.col("node").alias(c), F.col("hashes").alias(f"of_{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(alike("of_a", "of_b")).select("a", "b")


def near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, least: float = 0.8) -> DataFrame:
    """(key, doc_id, label) for every row: rows linked by shingle similarities of ``least`` or more share a label.

    Pairs come from the blocks and the Hamming check of wide fingerprints, in two steps: a forest of the near pairs of each block
    first, whose verified links make labels; then, where a pair of the forest was no link, all pairs of different labels that such pairs
    connect and that share a block are judged, so no pair goes unjudged because a forest took another one for it.
    """
    rows = table(sketches(docs, doc_id, text, words), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"].alias("key")
    alike = [F.min(c).alias(c) for c in (*HELD, "blocks")]
    distinct = table(rows.groupBy("node").agg(*alike, first), "distinct")
    near = table(near_links(distinct), "near")
    needed = table(near.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(distinct.select("node", "key"), "node"), "needed")

    @F.pandas_udf("size long, sketch binary, hashes binary")
    def set_of(texts: pd.Series) -> pd.DataFrame:
        found = [np.unique(shingles(t, words)) for t in utf8(texts)]
        return pd.DataFrame({"size": [len(h) for h in found], "sketch": [odd_sketch(h) for h in found], "hashes": [h.tobytes() for h in found]})

    keyed = docs.select(row_key(docs).alias("key"), F.col(text).alias("text")).join(sized(needed, 40), "key").dropDuplicates(["node"])
    sets = table(keyed.select("node", set_of("text").alias("s")).select("node", "s.size", "s.sketch", "s.hashes"), "sets")
    edges = table(verified(near, sets, least), "edges")
    label = components(edges)
    labelled = lambda df: df.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    found = labelled(rows.select("key", "doc_id", "node"))
    between = lambda pairs: pairs.join(label.toDF("a", "of_a"), "a", "left").join(label.toDF("b", "of_b"), "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).where("a <> b").distinct()
    apart = table(between(near.join(edges, ["a", "b"], "left_anti")), "apart")
    if not apart.isEmpty():
        reach = table(components(apart).toDF("label", "reach"), "reach")
        open_ = labelled(sets.select("node", "size", "sketch")).join(sized(reach, 16), "label")
        members = open_.join(distinct.select("node", "fp", "blocks"), "node").withColumn("block", F.explode("blocks"))
        again = table(between(verified(candidates(members.withColumn("bucket", F.xxhash64("reach", "block")), least), sets, least)), "again")
        if not again.isEmpty():
            joined = table(components(again).toDF("label", "now"), "joined")
            found = found.join(sized(joined, 16), "label", "left").withColumn("label", F.coalesce("now", "label"))
    return found.select("key", "doc_id", "label")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component of near copies: the first by doc_id (null last) and the row's hash.

    Rows are told apart by all their columns: a null or repeated doc_id takes no other row along. Of rows alike in
    every column one stays.
    """
    found = table(near_copies(docs, doc_id, text, **options), "labels")
    key = spare(docs, "_key")
    first = found.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"].alias("first"), F.count("*").alias("n")).where("n > 1")
    first = table(first.select("label", "first"), "first")
    grouped = table(found.select("key", "label").join(sized(first, 40), "label").select(F.col("key").alias(key), (F.col("key") == F.col("first")).alias("stays")), "grouped")
    repeated = table(grouped.where("stays").groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key), "repeated")
    out = table(grouped.where("not stays").select(key).distinct().union(repeated), "removed")
    keyed = docs.withColumn(key, row_key(docs))
    left = keyed.join(sized(out, 40), key, "left_anti")
    if not repeated.isEmpty():  # rows alike in every column, of which one stays
        left = left.unionByName(keyed.join(sized(repeated, 40), key, "left_semi").dropDuplicates([key]))
    return left.drop(key)
