"""Token ids as directly addressable codes: random access to any token without decoding a block.

An id is split into chunks of fixed widths, lowest first. A level holds the chunks of the ids that reach it and one
continuation bit for each: whether the id goes on in the next level. A rank directory counts the set bits before every
DIRECTORY positions, so the place in the next level is one directory entry and the bits after it.

A file is a row of a Parquet table in the shared folder (any store that Spark writes to): ``data`` is the code, beside
it the ids of its documents and where they begin. The table is written without compression or dictionaries, so a code's
bytes lie in the store as they are. Rows are numbered by (bucket, segment) in ascending doc_id order; a bucket is a range
of doc_id, equal ids being dealt on by the hash of their text. A task streams its bucket, whatever its size. A segment
ends with the document that takes it to SEGMENT tokens or more. ``tokens_at`` looks single positions up.

Layout of ``data``, little-endian: MAGIC, uint32 number of levels, uint64 number of ids; for each level uint32 width in
bits, uint64 number of chunks; then for each level its chunks, its bits (lowest first) and its directory (uint32).

Defined cases: a null or empty text is the end id alone; doc_id is read as a whole number (others count as null); equal
doc_ids follow each other in the order of their texts' hashes; a null doc_id comes first; other columns are left aside;
an empty table gives no files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biblioflow.llm import token_ids
from biblioflow.llm.common import sized, small_batches, table

MAGIC = b"DACTOKN1"
WIDTHS = (8, 8, 16)
DIRECTORY = 512
SEGMENT = 1 << 20
#: Bytes of text a bucket should hold, up to MANY_BUCKETS; from there on they grow to MOST_BYTES, then their number.
BUCKET_BYTES, MOST_BYTES, MANY_BUCKETS = 8 << 20, 1 << 30, 4096
KINDS = {8: "<u1", 16: "<u2", 32: "<u4"}


def encode(ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> bytes:
    rest = np.asarray(ids, dtype="<u4").astype("<u8")
    heads, bodies = [], []
    for k, width in enumerate(widths):
        more = rest >> width
        goes_on = more > 0 if k + 1 < len(widths) else np.zeros(len(rest), bool)
        if k + 1 == len(widths) and more.any():
            raise ValueError("an id is wider than all levels")
        heads.append(struct.pack("<IQ", width, len(rest)))
        before = np.r_[0, np.cumsum(np.add.reduceat(goes_on, np.arange(0, len(rest), DIRECTORY), dtype="<u4"))] if len(rest) else np.zeros(1)
        bodies += [(rest & ((1 << width) - 1)).astype(KINDS[width]).tobytes(), np.packbits(goes_on, bitorder="little").tobytes(), before.astype("<u4").tobytes()]
        rest = more[goes_on]
    return MAGIC + struct.pack("<IQ", len(widths), len(ids)) + b"".join(heads) + b"".join(bodies)


class Reader:
    """Random access to an encoded file; nothing is decoded but what is asked for."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        levels, self.size = struct.unpack_from("<IQ", data, 8)
        at = 20 + 12 * levels
        self.levels = []
        for k in range(levels):
            width, n = struct.unpack_from("<IQ", data, 20 + 12 * k)
            parts = []
            for kind, count in ((KINDS[width], n), ("<u1", -(-n // 8)), ("<u4", -(-n // DIRECTORY) + 1)):
                parts.append(np.frombuffer(data, kind, count, at))
                at += parts[-1].nbytes
            self.levels.append((width, *parts))

    def _rank(self, level: int, i: int) -> int:
        """Continuation bits before position i."""
        _, _, bits, before = self.levels[level]
        block = i // DIRECTORY
        first = block * DIRECTORY // 8
        n = int(before[block]) + int(np.bitwise_count(bits[first : i // 8]).sum(dtype=np.int64))
        return n + (int(bits[i // 8]) & ((1 << i % 8) - 1)).bit_count() if i % 8 else n

    def token(self, i: int) -> int:
        """The id at position i."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = shift = 0
        for level, (width, chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[i]) << shift
            if not int(bits[i // 8]) >> (i % 8) & 1:
                break
            i, shift = self._rank(level, i), shift + width
        return value

    def slice(self, start: int, end: int) -> np.ndarray:
        """The ids at positions start to end - 1: a stretch of each level."""
        out = np.zeros(end - start, dtype="<u4")
        where, a, b, shift = np.arange(end - start), start, end, 0
        for level, (width, chunks, bits, _) in enumerate(self.levels):
            if a >= b:
                break
            out[where] |= chunks[a:b].astype("<u4") << np.uint32(shift)
            goes_on = np.unpackbits(bits[a // 8 : -(-b // 8)], bitorder="little")[a % 8 : a % 8 + b - a].astype(bool)
            where, shift = where[goes_on], shift + width
            a = self._rank(level, a)
            b = a + len(where)
        return out


def checksums(reader: Reader, bounds: list[int]) -> list[int]:
    """crc32 of the ids between each two bounds, as little-endian unsigned 32-bit integers; the whole stretch is decoded in one step."""
    ids = reader.slice(bounds[0], bounds[-1])
    return [zlib.crc32(ids[a - bounds[0] : b - bounds[0]].data) for a, b in zip(bounds, bounds[1:], strict=False)]


def ordered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text), dealt by ranges of doc_id and sorted in them; a range that one id fills is cut by text and row."""
    ids = F.col(doc_id) if isinstance(docs.schema[doc_id].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)) else F.col(doc_id).try_cast("long")
    rows = docs.select(ids.cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"), F.monotonically_increasing_id().alias("row"))
    size = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 16)).first()[0] or 0
    keys = [F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("row")]
    return rows.repartitionByRange(max(1, min(MANY_BUCKETS, -(-size // BUCKET_BYTES)), -(-size // MOST_BYTES)), *keys).sortWithinPartitions(*keys).select("doc_id", "text")


def write(docs: DataFrame, tokenizer: str, end_id: int, doc_id: str = "doc_id", text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """Encode all documents in ascending doc_id order; the files, one a row, read back from the table.

    (bucket, segment, n_tokens, doc_ids, starts, data); starts: the documents' first positions in the file.
    """
    small_batches(docs.sparkSession)
    end = np.array([end_id], dtype="<u4").tobytes()
    shipped = token_ids.ship(docs.sparkSession, tokenizer)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, bucket = token_ids.encoder(shipped).encode, TaskContext.get().partitionId()
        number, ids, starts, parts, n = 0, [], [], [], 0

        def file() -> pa.RecordBatch:
            data = encode(np.frombuffer(b"".join(parts), "<u4"))
            return pa.record_batch([pa.array([bucket], pa.int32()), pa.array([number], pa.int64()), pa.array([n], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([starts], pa.list_(pa.int64())), pa.array([data], pa.binary())], names=["bucket", "segment", "n_tokens", "doc_ids", "starts", "data"])

        for batch in batches:
            for i, data in zip(batch.column("doc_id").to_pylist(), tokens(batch.column("text").to_pylist()), strict=True):
                if ids and n >= segment:
                    yield file()
                    number, ids, starts, parts, n = number + 1, [], [], [], 0
                ids.append(i)
                starts.append(n)
                parts.append(data + end)
                n += len(data) // 4 + 1
        if ids:
            yield file()

    return table(ordered(docs, doc_id, text).mapInArrow(pack, "bucket int, segment long, n_tokens long, doc_ids array<long>, starts array<long>, data binary"), "token-files", "uncompressed", {"parquet.enable.dictionary": "false"})


def read(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files; start counts over all files."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader, starts = Reader(row["data"]), [*row["starts"], row["n_tokens"]]
                crc = checksums(reader, starts)
                k = len(crc)
                yield pa.record_batch([pa.array([row["bucket"]] * k, pa.int32()), pa.array([row["segment"]] * k, pa.int64()), pa.array(row["doc_ids"], pa.int64()), pa.array(row["starts"], pa.int64()), pa.array(np.diff(starts)), pa.array(crc, pa.int64())], names=["bucket", "segment", "doc_id", "at", "n_tokens", "ids_crc32"])

    docs = files.mapInArrow(unpack, "bucket int, segment long, doc_id long, at long, n_tokens long, ids_crc32 long")
    return docs.join(bases(files), ["bucket", "segment"]).select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def bases(files: DataFrame) -> DataFrame:
    """(bucket, segment, base): tokens in all files before."""
    sizes = files.select("bucket", "segment", "n_tokens")
    by_bucket = sizes.groupBy("bucket").agg(F.sum("n_tokens").alias("n"))  # a row for each bucket
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    above = by_bucket.select("bucket", F.coalesce(F.sum("n").over(before(Window.orderBy("bucket"))), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n_tokens").over(before(Window.partitionBy("bucket").orderBy("segment"))), F.lit(0))
    return sizes.withColumn("inside", inside).join(above, "bucket").select("bucket", "segment", (F.col("base") + F.col("inside")).alias("base"))


def tokens_at(files: DataFrame, positions: DataFrame, position: str = "position", segment: int = SEGMENT) -> DataFrame:
    """(position, token) of each different position that lies in the corpus, read from the codes without decoding them."""
    held = files.select("bucket", "segment", "n_tokens").join(bases(files), ["bucket", "segment"])
    last = F.col("base") + F.col("n_tokens") - 1
    stretch = lambda c: F.floor(c / F.lit(segment))
    where = held.select("bucket", "segment", "base", last.alias("last"), F.explode(F.sequence(stretch(F.col("base")), stretch(last))).alias("stretch"))
    asked = positions.select(F.col(position).cast("long").alias("position")).distinct().withColumn("stretch", stretch(F.col("position")))
    met = asked.join(where, "stretch").where("position between base and last")
    by_file = met.groupBy("bucket", "segment", F.pmod(F.xxhash64("position"), F.lit(64)).alias("part")).agg(F.collect_list("position").alias("positions"), F.first("base").alias("base"))
    by_file = sized(table(by_file, "asked"), F.size("positions") * 8 + 64)  # few positions go to the files, not the files to them

    @F.pandas_udf("array<struct<position: long, token: long>>")
    def look(data: pd.Series, base: pd.Series, wanted: pd.Series) -> pd.Series:
        out = []
        for d, b, ps in zip(data, base, wanted, strict=True):
            reader = Reader(d)
            out.append([{"position": int(p), "token": reader.token(int(p) - int(b))} for p in ps])
        return pd.Series(out)

    found = by_file.join(files.select("bucket", "segment", "data"), ["bucket", "segment"])
    return found.select(F.inline(look("data", "base", "positions")))
