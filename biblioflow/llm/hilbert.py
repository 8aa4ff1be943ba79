"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised at its own quantiles; the cell of a row lies somewhere on the curve, rows are laid out in
curve order, and the order is cut into shards and files. Rows near each other in all dimensions share files, so the
files' minima and maxima prune reads on any of them.

The order is never sorted as a whole. Counts by cell (at most 2 ** (bits * dimensions)) give each cell its place;
crowded cells are split by a hash of all the row's columns, and where rows that are alike in every column still crowd a
group, by the row's number in a table written for that. So there are at most CELLS + GROUPS groups, and none holds more
than about a GROUPS-th of the rows. A file is a stretch of whole groups: one shuffle brings its rows together, and a
row's rank is the file's first rank plus its place in it.

Laws: ``rows`` cuts shards at equal ranks (counts at most one apart), ``bytes`` at equal sums of sizes (UTF-8 bytes of
the text plus one), to the group.

Defined cases: a null in a dimension counts as the smallest value; a null text has size 1; repeated rows are rows;
input columns named like the layout's own (shard, slot, rank) are replaced, other columns stay; few different values in
the dimensions give few cells, not fewer files; an empty table gives empty shards.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from biblioflow.llm.common import new_path, deal_key, spare, table

GROUPS = 1 << 17
#: Fewest rows for which a cell is split.
LEAST_GROUP = 256
#: A file holds about so many rows or bytes of text, whichever are fewer.
ROWS_A_FILE, BYTES_A_FILE = 8192, 64 << 20
#: Beyond so many files they grow to MOST_BYTES of text first, then their number.
MANY_FILES, MOST_BYTES = 10_000, 1 << 30
#: A group this many times as large as planned holds copies of one row.
CROWDED = 8
#: Bits of a cell's number over all dimensions; more dimensions get fewer bits each.
CELL_BITS = 20


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of cells (n x dimensions, each below 2 ** bits), by Skilling's transform."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(dims):
            up = (x[i] & q) > 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(up, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[dims - 1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= t
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            index = index << 1 | x[i] >> b & 1
    return index


def sort_key(df: DataFrame, name: str) -> Column:
    """A number in the order of the column: itself, or the first seven bytes of a text."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    text = F.hex(F.substring(F.encode(F.col(name).cast("string"), "UTF-8"), 1, 7))
    return F.conv(F.rpad(text, 14, "0"), 16, 10).cast("double")


def cell_of(docs: DataFrame, dims: list[str], bits: int) -> Column:
    """The row's cell as one number; cut points are each dimension's approximate quantiles."""
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = docs.agg(*[F.percentile_approx(sort_key(docs, d), shares, 10_000).alias(f"c{i}") for i, d in enumerate(dims)]).first()
    cell = F.lit(0).cast("long")
    for i, d in enumerate(dims):
        points = sorted(set(cuts[f"c{i}"] or []))
        above = F.lit(0)
        for p in points:
            above = above + (sort_key(docs, d) > p).cast("int")
        cell = cell * (1 << bits) + F.coalesce(above, F.lit(0))
    return cell


def size_of(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def layout(docs: DataFrame, dims: list[str], text: str = "text", shards: int = 8, law: str = "rows", bits: int = 4) -> DataFrame:
    """``docs`` with shard, slot and rank, dealt and sorted in curve order: one partition for each file."""
    if len(dims) > CELL_BITS:
        raise ValueError(f"at most {CELL_BITS} dimensions")
    bits = min(bits, CELL_BITS // len(dims))
    own = docs.drop("shard", "slot", "rank")
    cell, salt = cell_of(own, dims, bits), deal_key(own)
    found = sorted((r["cell"], r["count"]) for r in own.groupBy(cell.alias("cell")).count().collect())  # at most 2 ** CELL_BITS cells
    cells, counts = np.array(found, np.int64).reshape(-1, 2).T
    n = int(counts.sum())
    place = curve_index(np.stack([cells >> bits * (len(dims) - 1 - i) & (1 << bits) - 1 for i in range(len(dims))], axis=1), bits)
    share = max(LEAST_GROUP, -(-n // GROUPS))
    parts = -(-counts // share)
    order = np.argsort(place)
    first = np.zeros(len(counts), np.int64)
    first[order] = np.cumsum(parts[order]) - parts[order]  # number of a cell's first group

    @F.pandas_udf("long")
    def group(of: pd.Series, hashes: pd.Series) -> pd.Series:
        c = np.searchsorted(cells, of.to_numpy("i8"))
        return pd.Series(first[c] + hashes.to_numpy("i8") % np.maximum(1, parts[c]))

    def counted(rows_: DataFrame, named_: Column) -> tuple[np.ndarray, np.ndarray]:
        rows, load = np.zeros(int(parts.sum()), np.int64), np.zeros(int(parts.sum()), np.int64)
        for r in rows_.groupBy(named_.alias("g")).agg(F.count("*").alias("n"), F.sum(size_of(F.col(text))).alias("load")).collect():  # at most CELLS + GROUPS rows
            rows[r["g"]], load[r["g"]] = r["n"], r["load"]
        return rows, load

    named = group(cell, salt)
    rows, load = counted(own, named)
    number = spare(own, "_number")
    if rows.max(initial=0) > CROWDED * share:
        own = table(own.withColumn(number, F.monotonically_increasing_id()), "numbered")
        named = group(cell, F.xxhash64(number))
        rows, load = counted(own, named)
    total = int(load.sum())
    files = max(1, -(-n // ROWS_A_FILE), -(-total // BYTES_A_FILE))
    files = min(files, max(MANY_FILES, -(-total // MOST_BYTES)))
    base = np.cumsum(rows) - rows
    if law == "rows":
        starts = [-(-k * n // shards) for k in range(shards)]
    elif law == "bytes":
        middle = np.cumsum(load) - load / 2
        starts = [int(rows[: np.searchsorted(middle, k * total / shards)].sum()) for k in range(shards)]
    else:
        raise ValueError(f"unknown law {law}")
    file = ((np.cumsum(load) - load) / max(1, total) * files).astype(np.int64).clip(0, files - 1)  # equal bytes, so that tasks are even
    opening = np.full(files, n, np.int64)
    np.minimum.at(opening, file, base)

    @F.pandas_udf("file int, opening long")
    def target(groups: pd.Series) -> pd.DataFrame:
        f = file[groups.to_numpy("i8")]
        return pd.DataFrame({"file": f.astype("i4"), "opening": opening[f]})

    g, to = spare(own, "_g"), spare(own, "_t")
    dealt = own.withColumn(g, named).withColumn(to, target(g)).repartitionById(files, F.col(f"{to}.file")).sortWithinPartitions(g, *dims)
    rank = F.col(f"{to}.opening") + F.monotonically_increasing_id() % F.lit(1 << 33)  # its low 33 bits count the partition's rows
    ranked = dealt.withColumn("rank", rank).drop(g, to, number)
    shard = sum(((F.col("rank") >= s).cast("int") for s in starts[1:]), F.lit(0))
    return ranked.withColumn("shard", shard).withColumn("slot", F.col("rank") - F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), F.col("shard") + 1))


def write(docs: DataFrame, dims: list[str], text: str = "text", shards: int = 8, law: str = "rows", bits: int = 4, path: str | None = None) -> DataFrame:
    """Write the layout as Parquet, a folder for each shard, and read it back."""
    spark = docs.sparkSession
    path = path or new_path(spark, "shards")
    laid = layout(docs, dims, text, shards, law, bits)
    laid.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    kinds = T.StructType([f for f in laid.schema if f.name != "shard"] + [T.StructField("shard", T.IntegerType())])
    return spark.read.schema(kinds).parquet(path)
