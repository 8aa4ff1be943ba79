"""Embedding whitening by TSQR: the covariance matrix is never formed.

Vectors are laid on a grid, x = floor(256 c), so that sums are exact. The fit list is each different x once; n and the sums S of
its dimensions are added up as integers. A task takes the rows x - S / n of its partition to an upper triangular R by QR,
block by block; R factors are stacked and taken to one R in a tree of FAN children a node. The singular values s of the last
R and its right vectors are those of all centred rows, so the eigenvalues of the covariance are s^2 / n.

What meets in a task is a block of rows, or FAN factors of dimension x dimension; the driver gets one such factor.

Defined cases: a vector that is null, empty, or holds null or non-finite entries is dropped, and one that has not the most
frequent number of dimensions (of several such the larger); entries beyond a long's range are its ends; components are
numbered up to the smaller of ``most`` and the dimensions; one whose singular value is zero, to double precision, has a null
``whitened``; where all are zero ``explained`` is null; ``identity_error`` is over the others; ``deviation`` is null where it
does not fit a long; repeated rows are whitened each; the id may be of any type; other columns are left aside.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioflow.llm.common import small_batches, table

GRID = 256
FAN = 16
COMPONENTS = 4


@dataclass
class Whitener:
    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues by falling size
    vectors: np.ndarray  # a column each
    trace: float

    @property
    def live(self) -> int:
        """Components that are not zero."""
        if not len(self.values) or self.values[0] <= 0:
            return 0
        least = self.values[0] * (max(self.n, len(self.sums)) * np.finfo(float).eps) ** 2
        return int((self.values > least).sum())


def on_grid(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x), written once: the rows that remain."""
    real = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf"))
    fine = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", real)
    x = F.transform("v", lambda e: F.floor(F.lit(float(GRID)) * e))
    rows = table(vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(fine).select("vec_id", x.alias("x")), "grid", "lz4")
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    best = sizes.agg(F.max_by("d", F.struct("n", "d"))).first()[0]
    return rows.where(F.size("x") == F.lit(best or 0))


def reduced(rows: np.ndarray, above: np.ndarray | None) -> np.ndarray:
    """R of the rows below an R."""
    return np.linalg.qr(rows if above is None else np.vstack([above, rows]), mode="r")


def factors(fit: DataFrame, mean: np.ndarray) -> DataFrame:
    """(node, r): the R factor of each partition."""

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = None
        for batch in batches:
            if len(batch):
                r = reduced(np.array(batch["x"].tolist(), dtype=float) - mean, r)
        if r is not None:
            yield pd.DataFrame({"node": [TaskContext.get().partitionId()], "r": [r.tobytes()]})

    return table(fit.select("x").mapInPandas(local, "node long, r binary"), "factors")


def merged(parts: DataFrame, dimensions: int) -> np.ndarray:
    """The R factor of all, by a tree of FAN children a node."""

    def joined(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        r = None
        for part in group.sort_values("node")["r"]:
            r = reduced(np.frombuffer(part).reshape(-1, dimensions), r)
        return pd.DataFrame({"node": [key[0]], "r": [r.tobytes()]})

    last = parts.agg(F.max("node")).first()[0] or 0
    while last:
        parts = parts.groupBy(F.expr(f"node div {FAN}").alias("up")).applyInPandas(joined, "node long, r binary")
        last //= FAN
    found = parts.collect()  # one factor
    return np.frombuffer(found[0]["r"]).reshape(-1, dimensions)


def fitted(rows: DataFrame) -> tuple[Whitener | None, DataFrame]:
    """The whitener of ``on_grid`` rows, and the fit list (x)."""
    fit = table(rows.select("x").distinct(), "fit", "lz4")
    n = fit.count()
    if not n:
        return None, fit
    exact = fit.select(F.posexplode("x").alias("i", "e")).groupBy("i").agg(F.sum("e").alias("s"))
    sums = [r["s"] for r in exact.orderBy("i").collect()]  # one for each dimension
    r = merged(factors(fit, np.array(sums) / n), len(sums))
    _, s, vt = np.linalg.svd(r, full_matrices=False)
    largest = vt[np.arange(len(vt)), np.abs(vt).argmax(axis=1)]
    vt = vt * np.where(largest < 0, -1.0, 1.0)[:, None]  # a vector's sign is free: its largest entry is positive
    values = s * s / n
    return Whitener(n, sums, values, vt.T, float(values.sum())), fit


def projection(w: Whitener, most: int):
    """A column function of x: its whitened entries, null where a component is zero."""
    k = min(most, len(w.sums))
    live = min(k, w.live)
    mean, scaled = np.array(w.sums) / w.n, w.vectors[:, :live] / np.sqrt(w.values[:live])

    @F.pandas_udf("array<double>")
    def project(x: pd.Series) -> pd.Series:
        z = (np.array(x.tolist(), dtype=float).reshape(len(x), len(mean)) - mean) @ scaled
        return pd.Series([[*row, *[None] * (k - live)] for row in z.tolist()])

    return project


def deviation(x: Column, w: Whitener) -> Column:
    """Sum over dimensions of (n x - S)^2, exact; null beyond a long."""
    off = lambda e, s: F.try_subtract(F.try_multiply(F.lit(w.n).cast("long"), e), s)
    squares = F.zip_with(x, F.array(*[F.lit(s).cast("long") for s in w.sums]), lambda e, s: F.try_multiply(off(e, s), off(e, s)))
    return F.aggregate(squares, F.lit(0).cast("long"), lambda a, b: F.try_add(a, b))


def identity_error(fit: DataFrame, w: Whitener, most: int) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = min(most, w.live)
    if not k:
        return None
    z = fit.select(projection(w, most)("x").alias("z"))
    means = z.agg(*[F.avg(F.get("z", F.lit(i))).alias(f"m{i}") for i in range(k)]).first()
    part = lambda i: F.get("z", F.lit(i)) - F.lit(means[i])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = z.agg(*[F.avg(part(i) * part(j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for (i, j), c in zip(pairs, found, strict=True))


def whitened(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every remaining row and component up to ``most``."""
    small_batches(vectors.sparkSession)
    rows = on_grid(vectors, vec_id, vector)
    w, fit = fitted(rows)
    if w is None:
        null = lambda kind: F.lit(None).cast(kind)
        return rows.select("vec_id", null("int").alias("component"), null("long").alias("n"), null("long").alias("deviation"), *[null("double").alias(c) for c in ("whitened", "explained", "identity_error")]).where("false")
    shares = F.array(*[F.lit(float(v / w.trace) if w.trace else None).cast("double") for v in [*w.values, *[0.0] * len(w.sums)][: min(most, len(w.sums))]])
    own = rows.select("vec_id", deviation(F.col("x"), w).alias("deviation"), F.posexplode(F.arrays_zip(projection(w, most)("x").alias("z"), shares.alias("e"))).alias("i", "p"))
    error = F.lit(identity_error(fit, w, most)).cast("double")
    return own.select("vec_id", (F.col("i") + 1).alias("component"), F.lit(w.n).cast("long").alias("n"), "deviation", F.col("p.z").alias("whitened"), F.col("p.e").alias("explained"), error.alias("identity_error"))
