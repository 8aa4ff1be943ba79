"""Importance resampling towards a target distribution, by exact ranks.

Features are runs of one and two words, hashed to BUCKETS. A bucket's gain is 1000 times the logarithm of its smoothed
frequency in the target over that in the documents; a document's weight is the floored mean of its features' gains, looked
up in one array. Gumbel noise that depends on the id only makes the highest scores a draw without replacement in
proportion to exp(weight / 1000).

Scores are integers of a bounded range, so their histogram is small and exact: summed from the top it says how many documents
lie above each score, and which score is the last that is drawn from. Within each surviving score documents are numbered by
id; a score of more than CROWD documents is dealt over ranges of ids first, whose counts are added up as well. So nothing sorts
all documents, and no score meets in one task. The cut points between ranges come from a small sample by hash and decide
only where rows are dealt.

Defined cases: a null or empty text has no features and weight 0; a document of fewer than ``least`` words is never drawn, but
scored; a null id is the empty text in the noise and comes first in ties; rows of one id tie by features, weight, then a number
of the row; repeated rows are drawn each; an empty target or table counts nothing; other columns are left aside.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblioflow.llm.common import small_batches, table

BUCKETS = 10_000
#: Bytes as they stand in words: A-Z lower-cased, what parts words a space.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Documents of one score that are numbered in one task.
CROWD = 250_000
#: Words up to this length have a table of what they do to the crc of the word before.
TABLED = 64


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(WORDS).split() if text else []


@cache
def after(length: int) -> np.ndarray:
    """4 x 256: what each byte of a crc becomes when ``length`` zero bytes follow; their xor is the crc's."""
    if length == 0:
        bits = [1 << k for k in range(32)]
    else:
        before = after(length - 1)
        bits = [int(before[k // 8, 1 << k % 8]) for k in range(32)]
        bits = [(_step(b & 255)) ^ (b >> 8) for b in bits]
    out = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for k in range(8):
            out[byte, 1 << k : 2 << k] = out[byte, : 1 << k] ^ np.uint32(bits[8 * byte + k])
    return out


def _step(byte: int) -> int:
    """The crc of a byte by itself, without the first and last complement."""
    return zlib.crc32(bytes([byte]), 0xFFFFFFFF) ^ 0xFFFFFFFF


def hashed(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of single words and of pairs (that of a text's last word is no pair: -1), and words of each text."""
    rows = [words_of(t) for t in texts]
    sizes = np.array([len(r) for r in rows], np.int64)
    place = {w: k for k, w in enumerate({w for r in rows for w in r})}
    at = np.fromiter((k for r in rows for k in map(place.__getitem__, r)), np.int64, int(sizes.sum()))
    alone = np.fromiter(map(zlib.crc32, place), np.uint32, len(place))
    behind = np.fromiter((zlib.crc32(b" " + w) for w in place), np.uint32, len(place))
    length = np.fromiter((len(w) + 1 for w in place), np.int64, len(place))
    pairs = np.full(len(at), -1, np.int64)
    ends = np.cumsum(sizes[sizes > 0]) - 1
    inner = np.ones(len(at), bool)
    inner[ends] = False
    first = np.flatnonzero(inner)
    a, b = at[first], at[first + 1]
    crc = np.empty(len(first), np.uint32)
    short = length[b] <= TABLED
    tables = np.stack([after(k) for k in range(TABLED + 1)])
    x, n = alone[a[short]], length[b[short]]
    crc[short] = tables[n, 0, x & 255] ^ tables[n, 1, x >> 8 & 255] ^ tables[n, 2, x >> 16 & 255] ^ tables[n, 3, x >> 24] ^ behind[b[short]]
    if not short.all():
        names = list(place)
        for k in np.flatnonzero(~short).tolist():
            crc[k] = zlib.crc32(b" " + names[b[k]], int(alone[a[k]]))
    pairs[first] = crc % BUCKETS
    return (alone % BUCKETS)[at].astype(np.int64), pairs, sizes


def bucket_counts(docs: DataFrame, text: str) -> np.ndarray:
    """Features in each bucket, over all rows."""

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            single, pair, _ = hashed(batch["text"])
            total += np.bincount(single, minlength=BUCKETS) + np.bincount(pair[pair >= 0], minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    found = docs.select(F.col(text).alias("text")).mapInPandas(local, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()  # at most BUCKETS rows
    out = np.zeros(BUCKETS, np.int64)
    for r in found:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of each bucket's smoothed frequency in the target over that in the source, floored."""
    s, t, all_s, all_t = source.astype(float), target.astype(float), float(source.sum()), float(target.sum())
    return np.floor(1000 * np.log((t + 1) * (all_s + BUCKETS) / ((s + 1) * (all_t + BUCKETS)))).astype(np.int64)


def weigher(gain: np.ndarray):
    """A column function of the text: its words, features and weight."""

    @F.pandas_udf("n_words long, n_features long, weight long")
    def weigh(texts: pd.Series) -> pd.DataFrame:
        single, pair, sizes = hashed(texts)
        value = gain[single] + np.where(pair >= 0, gain[pair], 0)
        starts = np.cumsum(sizes) - sizes
        sums = np.zeros(len(sizes), np.int64)
        some = sizes > 0
        if some.any():
            sums[some] = np.add.reduceat(value, starts[some])
        features = np.maximum(2 * sizes - 1, 0)
        return pd.DataFrame({"n_words": sizes, "n_features": features, "weight": np.where(some, sums // np.maximum(features, 1), 0)})

    return weigh


def noise(doc_id: Column, seed: int) -> Column:
    """1000 times a standard Gumbel variate of the id, floored."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(F.encode(key, "UTF-8"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def ranked(rows: DataFrame, share: int, crowd: int = CROWD) -> DataFrame:
    """``rows`` (doc_id, n_features, weight, score, fit, number) with rank: 1, 2, ... by falling score, then doc_id, of the
    floor(share * N / 100) first of the N that are ``fit``; null for the others."""
    spark = rows.sparkSession
    counts = sorted(((r["score"], r["n"]) for r in rows.where("fit").groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)  # integers of a bounded range
    drawn = share * sum(n for _, n in counts) // 100
    above, held = 0, []
    for score, n in counts:
        if above >= drawn:
            break
        held.append((score, above))
        above += n
    ranges = max([1, *(-(-n // crowd) for _, n in counts[: len(held)])])
    order = F.struct("doc_id", "n_features", "weight", "number")
    cuts = []
    if ranges > 1:
        # sorted where Spark compares: ids may be of any type
        some = rows.where("fit").orderBy(F.xxhash64("number"), "number").limit(64 * ranges).select(order.alias("o")).agg(F.sort_array(F.collect_list("o")).alias("o"))  # 64 a range
        cuts = [F.get("_cuts", F.lit(64 * k)) for k in range(1, ranges)]
        rows = rows.crossJoin(F.broadcast(some.withColumnRenamed("o", "_cuts")))  # one row
    part = F.lit(0)
    for c in cuts:
        part = part + F.when(order >= c, 1).otherwise(0)
    offsets = F.broadcast(spark.createDataFrame(held, "score long, _above long"))  # a row for each surviving score
    met = rows.withColumn("_part", part).drop("_cuts").join(offsets, "score", "left")
    live = F.col("fit") & F.col("_above").isNotNull()
    rest = met.where(~live).withColumn("rank", F.lit(None).cast("long"))
    alive = met.where(live)
    sizes = alive.groupBy("score", "_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("score").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(Window.partitionBy("score", "_part").orderBy("doc_id", "n_features", "weight", "number"))
    numbered = alive.withColumn("_place", place).join(sizes.select("score", "_part", before.alias("_before")), ["score", "_part"])
    rank = F.col("_above") + F.col("_before") + F.col("_place")
    numbered = numbered.withColumn("rank", F.when(rank <= drawn, rank))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return numbered.select(*columns).union(rest.select(*columns))


def resampled(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", share: int = 25, least: int = 20, seed: int = 7, crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; ``share`` percent of those of ``least`` words or more are drawn."""
    small_batches(docs.sparkSession)
    gain = gains(bucket_counts(docs, text), bucket_counts(target, text))
    own = docs.select(F.col(doc_id).alias("doc_id"), weigher(gain)(F.col(text)).alias("w"))
    score = F.col("w.weight") + noise(F.col("doc_id"), seed)
    rows = own.select("doc_id", "w.n_features", "w.weight", score.alias("score"), (F.col("w.n_words") >= least).alias("fit"), F.monotonically_increasing_id().alias("number"))
    return ranked(table(rows, "weighed"), share, crowd)
