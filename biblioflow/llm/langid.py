"""Language identification by a bidirectional gated recurrent network over UTF-8 bytes.

The network is trained in numpy by backpropagation through time and labels every byte position; a document's
probabilities are the mean over all positions of its whole text. Both directions carry their state from the beginning
of a text to its end and back. Only a text of more than SEGMENT bytes is cut: its segments run side by side as rows of
one matrix, each read WARM bytes further on both sides, so that its states come from the text around it. The gates
are piecewise linear (a hard sigmoid and a hard tanh), which makes a position cheap enough to read whole corpora.

Fitting uses a bounded sample: of the ``most`` languages with the most different documents, ties by name, at most ``sample``
documents each, those of the smallest hash of doc_id and text, and ``windows`` windows of WINDOW bytes of each. Prediction reads whole texts.

Defined cases: a text that is null or has no letter is ``und`` with score 0; with nothing to learn from every text is
``und``; rows of null language are not learned from; doc_id may be of any type, and rows alike in doc_id and text are
learned from once; repeated rows are predicted each; columns named lang_pred and score are replaced, other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from biblioflow.llm.common import small_batches, spare, table

WINDOW = 64
HIDDEN = 16
SEGMENT, WARM = 2048, 128
#: Segments that run side by side at most, and numbers in a block of logits (steps x segments x languages): these bound memory,
#: whatever the batch and however many languages there are.
ROWS, CELLS = 512, 5_000_000
UNKNOWN = "und"


@dataclass
class Direction:
    """One direction's parameters: input by byte for gates (reset, update) and candidate, and recurrent weights."""

    gates: np.ndarray  # 256 x 2H
    candidate: np.ndarray  # 256 x H
    to_gates: np.ndarray  # H x 2H
    to_candidate: np.ndarray  # H x H

    def parts(self) -> list[np.ndarray]:
        return [self.gates, self.candidate, self.to_gates, self.to_candidate]


@dataclass
class Network:
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # 2H x C
    bias: np.ndarray  # C

    def parts(self) -> list[np.ndarray]:
        return [*self.forward.parts(), *self.backward.parts(), self.out, self.bias]


def start(languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)

    def some(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype("f4")

    def direction() -> Direction:
        return Direction(some(256, 2 * hidden, scale=0.2), some(256, hidden, scale=0.5), some(hidden, 2 * hidden, scale=0.2), some(hidden, hidden, scale=0.4))

    return Network(languages, direction(), direction(), some(2 * hidden, len(languages), scale=0.3), np.zeros(len(languages), "f4"))


def run(d: Direction, x: np.ndarray, out: np.ndarray, kept: list | None = None) -> None:
    """States of one direction over x (steps x rows) into out (steps x rows x H); ``kept`` gets what training needs."""
    rows, hidden = x.shape[1], d.candidate.shape[1]
    h = np.zeros((rows, hidden), "f4")
    g, gx = np.empty((rows, 2 * hidden), "f4"), np.empty((rows, 2 * hidden), "f4")
    c, r = np.empty((rows, hidden), "f4"), np.empty((rows, hidden), "f4")
    for t, at in enumerate(x):
        np.take(d.gates, at, axis=0, out=gx, mode="clip")
        np.matmul(h, d.to_gates, out=g)
        g += gx
        g *= 0.25  # hard sigmoid: clip(x / 4 + 1/2)
        g += 0.5
        np.maximum(g, 0, out=g)
        np.minimum(g, 1, out=g)
        np.multiply(g[:, :hidden], h, out=r)
        np.matmul(r, d.to_candidate, out=c)
        c += np.take(d.candidate, at, axis=0, mode="clip")
        np.maximum(c, -1, out=c)
        np.minimum(c, 1, out=c)
        if kept is not None:
            kept.append((h.copy(), g.copy(), r.copy(), c.copy()))
        c -= h
        c *= g[:, hidden:]
        h += c
        out[t] = h


def read(d: Direction, w: np.ndarray, x: np.ndarray, active: np.ndarray) -> np.ndarray:
    """What the states of ``run`` add to the logits (steps x rows x classes); ``active``: how many rows, from the first on,
    still go on at each step. Gates lie one after the other, so that every operation runs over one block of memory."""
    (steps, rows), hidden = x.shape, d.candidate.shape[1]
    tables = np.stack([0.25 * d.gates[:, :hidden] + 0.5, 0.25 * d.gates[:, hidden:] + 0.5]).astype("f4")
    to_gates = np.stack([0.25 * d.to_gates[:, :hidden], 0.25 * d.to_gates[:, hidden:]]).astype("f4")
    candidate, to_candidate = np.ascontiguousarray(d.candidate, "f4"), np.ascontiguousarray(d.to_candidate, "f4")
    states, flat = np.zeros((rows, hidden), "f4"), np.empty((6, rows * hidden), "f4")
    out = np.zeros((steps, rows, w.shape[1]), "f4")
    n = -1
    for t in range(steps):
        if active[t] != n:
            n = int(active[t])
            h, size = states[:n], n * hidden
            g, gx = flat[:2].reshape(-1)[: 2 * size].reshape(2, n, hidden), flat[2:4].reshape(-1)[: 2 * size].reshape(2, n, hidden)
            c, r = flat[4, :size].reshape(n, hidden), flat[5, :size].reshape(n, hidden)
        at = x[t, :n]
        np.matmul(h, to_gates, out=g)
        g += np.take(tables, at, axis=1, out=gx, mode="clip")
        np.maximum(g, 0, out=g)
        np.minimum(g, 1, out=g)
        np.multiply(g[0], h, out=r)
        np.matmul(r, to_candidate, out=c)
        c += np.take(candidate, at, axis=0, out=r, mode="clip")
        np.maximum(c, -1, out=c)
        np.minimum(c, 1, out=c)
        c -= h
        c *= g[1]
        h += c
        np.matmul(h, w, out=out[t, :n])
    return out


def back(d: Direction, x: np.ndarray, kept: list, upstream: np.ndarray) -> list[np.ndarray]:
    """Gradients of one direction by backpropagation through time; ``upstream``: by state, steps x rows x H."""
    steps, rows, hidden = upstream.shape
    dgs, dcs = np.empty((steps, rows, 2 * hidden), upstream.dtype), np.empty_like(upstream)
    dh = np.zeros_like(upstream[0])
    for t in range(steps - 1, -1, -1):
        h, g, _, c = kept[t]
        reset, update = g[:, :hidden], g[:, hidden:]
        dh += upstream[t]
        dcs[t] = dh * update * (np.abs(c) < 1)
        dr = dcs[t] @ d.to_candidate.T
        dgs[t, :, :hidden], dgs[t, :, hidden:] = dr * h, dh * (c - h)
        dgs[t] *= 0.25 * ((g > 0) & (g < 1))
        dh = dh * (1 - update) + dr * reset + dgs[t] @ d.to_gates.T
    every = lambda i: np.concatenate([k[i] for k in kept])
    flat_g, flat_c = dgs.reshape(-1, 2 * hidden), dcs.reshape(-1, hidden)
    order = np.argsort(x, axis=None, kind="stable")
    at = x.ravel()[order]
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    grads = [np.zeros_like(d.gates), np.zeros_like(d.candidate), every(0).T @ flat_g, every(2).T @ flat_c]
    grads[0][at[first]] = np.add.reduceat(flat_g[order], first, axis=0)
    grads[1][at[first]] = np.add.reduceat(flat_c[order], first, axis=0)
    return grads


def states(net: Network, x: np.ndarray, kept: tuple[list, list] | None = None) -> np.ndarray:
    """Both directions' states, steps x rows x 2H."""
    hidden = net.forward.candidate.shape[1]
    both = np.empty((*x.shape, 2 * hidden), "f4")
    run(net.forward, x, both[:, :, :hidden], kept and kept[0])
    run(net.backward, x[::-1], both[::-1, :, hidden:], kept and kept[1])
    return both


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=-1, keepdims=True))
    return z / z.sum(axis=-1, keepdims=True)


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over the positions and its gradient; x: steps x rows bytes, y: a class for each row."""
    hidden, kept = net.forward.candidate.shape[1], ([], [])
    both = states(net, x, kept)
    p = softmax(both @ net.out + net.bias)
    loss = -float(np.log(p[:, np.arange(len(y)), y] + 1e-9).mean())
    p[:, np.arange(len(y)), y] -= 1
    dz = p / (x.shape[0] * x.shape[1])
    up = dz @ net.out.T
    flat = dz.reshape(-1, dz.shape[-1])
    ahead = back(net.forward, x, kept[0], up[:, :, :hidden])
    behind = back(net.backward, x[::-1], kept[1], up[::-1, :, hidden:])
    return loss, [*ahead, *behind, both.reshape(-1, 2 * hidden).T @ flat, flat.sum(axis=0)]


def fit(windows: np.ndarray, classes: np.ndarray, languages: list[str], steps: int = 300, rows: int = 256, rate: float = 0.02, seed: int = 7) -> Network:
    """Adam over batches of windows (n x WINDOW bytes)."""
    net, rng = start(languages, seed=seed), np.random.default_rng(seed)
    parts = net.parts()
    m, v = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    by_class = [np.flatnonzero(classes == c) for c in range(len(languages))]
    by_class = [c for c in by_class if len(c)]
    for t in range(1, steps + 1):
        pick = np.concatenate([rng.choice(c, max(1, rows // len(by_class))) for c in by_class])
        _, grads = gradients(net, windows[pick].T.astype(np.intp), classes[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        step = rate * (1 - t / (steps + 1))
        for p, g, a, b in zip(parts, grads, m, v, strict=True):
            g = g * min(1.0, 1.0 / (norm + 1e-9))
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= step * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.99**t)) + 1e-8)
    return net


def stretches(texts: list[bytes]) -> list[tuple[int, int, int, int, int]]:
    """(text, first byte read, first byte labelled, byte after the last labelled, byte after the last read), longest first."""
    out = []
    for k, t in enumerate(texts):
        for at in range(0, len(t), SEGMENT):
            end = min(len(t), at + SEGMENT)
            out.append((k, max(0, at - WARM), at, end, min(len(t), end + WARM)))
    return sorted(out, key=lambda s: s[1] - s[4])


def exponents(net: Network, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of segments: (text of each, exponents of the logits steps x rows x classes, their sums, positions labelled)."""
    parts, hidden = stretches(texts), net.forward.candidate.shape[1]
    every = np.ones(len(net.languages), "f4")
    at = 0
    while at < len(parts):
        n = max(1, min(ROWS, CELLS // ((parts[at][4] - parts[at][1]) * len(every))))
        own, first, start, end, last = np.array(parts[at : at + n]).T
        at += n
        length = last - first
        steps = np.arange(length[0])
        x, turned = (np.zeros((len(own), length[0]), np.uint8) for _ in range(2))
        for r, (k, a, n) in enumerate(zip(own.tolist(), first.tolist(), length.tolist(), strict=True)):
            x[r, :n] = np.frombuffer(texts[k], np.uint8, n, a)
            turned[r, :n] = x[r, :n][::-1]
        active = np.searchsorted(-length, -steps, side="left")
        side = lambda d, w, seen: read(d, np.ascontiguousarray(w, "f4"), np.ascontiguousarray(seen.T).astype(np.intp), active)
        z, behind = side(net.forward, net.out[:hidden], x), side(net.backward, net.out[hidden:], turned)
        for r, n in enumerate(length.tolist()):
            z[:n, r] += behind[n - 1 :: -1, r] if n < len(behind) else behind[::-1, r]
        z += net.bias
        top = z[:, :, 0].copy()
        for c in range(1, z.shape[2]):
            np.maximum(top, z[:, :, c], out=top)
        z -= top[:, :, None]
        np.exp(z, out=z)
        yield own, z, z @ every, (steps[:, None] >= start - first) & (steps[:, None] < end - first)


def label_positions(net: Network, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of segments: (text of each, probabilities steps x rows x classes, positions that it labels)."""
    for own, e, total, labelled in exponents(net, texts):
        yield own, e / total[:, :, None], labelled


def probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    """Pooled probabilities, texts x classes; zero for a text of no bytes."""
    pooled = np.zeros((len(texts), len(net.languages)))
    for own, e, total, labelled in exponents(net, texts):
        np.add.at(pooled, own, np.einsum("trc,tr->rc", e, labelled / total))
    return pooled / np.maximum(1, np.array([len(t) for t in texts]))[:, None]


def train(docs: DataFrame, eligible: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = 400, windows: int = 6, most: int = 512) -> Network | None:
    """Fit on at most ``sample`` documents of each of at most ``most`` languages; None if there are none.

    One scan counts the languages' different rows, by a mergeable sketch; one more takes, by hash, about four times as many
    as needed, and the first of these are kept. No language meets in one task before that.
    """
    spark = docs.sparkSession
    small_batches(spark)
    known = docs.where(eligible & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    known = known.withColumn("hash", F.xxhash64("id", "text"))
    sizes = known.groupBy("lang").agg(F.approx_count_distinct("hash", 0.02).alias("n")).orderBy(F.desc("n"), "lang").limit(most)
    counts = [(r["lang"], r["n"]) for r in sizes.collect()]  # at most ``most`` rows
    if not counts:
        return None
    cuts = spark.createDataFrame([(name, (1 << 63) - 1 if n <= 4 * sample else (1 << 64) * 4 * sample // n - (1 << 63)) for name, n in counts], "lang string, cut long")
    some = known.join(F.broadcast(cuts), "lang").where("hash <= cut").groupBy("lang", "hash").agg(F.min("text").alias("text"))
    rows = some.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("hash"))).where(F.col("place") <= sample).select("lang", "hash", "text")

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, i, t in zip(batch["lang"], batch["hash"], batch["text"], strict=True):
                data = t.encode("utf-8", "surrogatepass")
                places = sorted({round(k * max(0, len(data) - WINDOW) / max(1, windows - 1)) for k in range(windows)})
                out += [(name, i, p, data[p : p + WINDOW].ljust(WINDOW, b"\0")) for p in places]
            yield pd.DataFrame(out, columns=["lang", "i", "p", "bytes"])

    got = table(rows.mapInPandas(spread, "lang string, i long, p long, bytes binary"), "windows").collect()  # sample x windows rows for each of ``most`` languages
    got = sorted((r["i"], r["p"], r["lang"], bytes(r["bytes"])) for r in got)
    x = np.frombuffer(b"".join(r[3] for r in got), np.uint8).reshape(-1, WINDOW)
    names = sorted({r[2] for r in got})
    return fit(x, np.array([names.index(r[2]) for r in got]), names)


def predictor(net: Network | None):
    """The network as a column function of the text: struct of lang_pred and score."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        fit_for = [t is not None and any(map(str.isalpha, t)) for t in texts]
        p = probabilities(net, [t.encode("utf-8", "surrogatepass") if ok else b"" for t, ok in zip(texts, fit_for, strict=True)]) if net else np.zeros((len(texts), 1))
        best = p.argmax(axis=1)
        names = [net.languages[k] if net and ok else UNKNOWN for k, ok in zip(best, fit_for, strict=True)]
        return pd.DataFrame({"lang_pred": names, "score": np.clip(p.max(axis=1), 0, 1)})

    return predict


def predicted(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score."""
    small_batches(docs.sparkSession)
    found = spare(docs, "_p")
    own = docs.withColumn(found, predictor(net)(F.col(text))).drop("lang_pred", "score")
    return own.withColumns({"lang_pred": F.col(f"{found}.lang_pred"), "score": F.col(f"{found}.score")}).drop(found)


def least_score(net: Network | None, margin: float) -> float:
    """The score ``margin`` of the way from chance, one over the number of languages, to certainty."""
    chance = 1 / len(net.languages) if net else 1.0
    return chance + margin * (1 - chance)


def reject_unknown(docs: DataFrame, net: Network | None, text: str = "text", margin: float = 0.2) -> DataFrame:
    """``docs`` without rows of no language: ``und``, or a pooled probability below ``least_score``."""
    small_batches(docs.sparkSession)
    found = predictor(net)(F.col(text))
    return docs.where((found["lang_pred"] != UNKNOWN) & (found["score"] >= least_score(net, margin)))
