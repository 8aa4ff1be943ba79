"""Toxicity: a logistic classifier with counterfactual regularisation.

Features are the different words of a whole text and the beginnings of its words, so that inflected forms share
weight. The loss is the class-balanced log loss, an L2 term, and a counterfactual term: in the labelled sentences, every
mention of a term is swapped for each other term of its sets, and the squared change of the score's logit is penalised.
A mention by itself then moves a score little, so neutral mentions of a group are not taken for toxicity.

The sets are those of IDENTITY and DERIVED ones: ``derived`` words of the labelled rows that are common and whose share
of rows is alike in both classes, four a set. These speak for no class, so a swap must not move the score either; they
let the term act on a corpus that names no group. Of a swap only the features that differ count; equal differences are
added up before they leave the executors, so the driver gets at most one row for each of them.

The score is shifted so that THRESHOLD is the cut of fewest errors for logits of rows that a model of the other half of
the sample gives, mentions of IDENTITY left out. Fitting uses a bounded sample of labelled rows: at most ``sample`` of each class, those of the smallest hash of their
doc_id, and the ``features`` most frequent features in them. Scoring reads every whole text.

Defined cases: a null or empty text has no features and gets the score of the intercept; labels that are null or not
0 or 1 are ignored, a doc_id labelled both ways counts as toxic; of several rows of a labelled doc_id, that of the smallest
hash of all its columns is fitted on; with fewer than two labelled rows of a class
the model is the constant share of toxic rows (0 if there are none); repeated rows are scored each; a column named like
the score is replaced, other columns stay.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from biblioflow.llm.common import row_key, small_batches, table

#: Sets of identity terms; the first of each is the neutral term a mention is also swapped for.
IDENTITY = (
    ("people", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("person", "muslim", "christian", "jew", "hindu", "buddhist", "atheist", "catholic"),
    ("people", "women", "men", "girls", "boys", "gays", "lesbians", "transsexuals"),
    ("person", "woman", "man", "girl", "boy", "gay", "lesbian", "transgender"),
    ("people", "blacks", "whites", "asians", "africans", "latinos", "arabs", "immigrants", "refugees"),
    ("person", "black", "white", "asian", "african", "latino", "arab", "immigrant", "refugee"),
    ("leute", "frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge", "schwule"),
    ("gens", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "étrangers", "réfugiés", "homosexuels"),
    ("gente", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "extranjeros", "refugiados", "homosexuales"),
)
THRESHOLD = 0.7
WORD = re.compile(r"[^\W_]+").findall
SENTENCE = re.compile(r"[.!?\n]+").split
#: Lengths of the word beginnings that are features; shorter words are features only as they are.
STEMS = (4, 5, 6)
#: Derived words in the swap sets, and in each set.
DERIVED, TOGETHER = 16, 4
#: Standard errors below which shares are alike.
ALIKE = 2.0


def features(text: str) -> set[str]:
    words = set(WORD(text.lower()))
    return words | {"^" + w[:n] for n in STEMS for w in words if len(w) >= n}


def forms(word: str) -> set[str]:
    """The features that a word brings to a text."""
    return {word, *("^" + word[:n] for n in STEMS if len(word) >= n)}


def swap_partners(groups: Iterable[Iterable[str]]) -> dict[str, list[str]]:
    """The terms that each term is swapped for."""
    out: dict[str, set[str]] = {}
    for group in groups:
        for term in group:
            out.setdefault(term, set()).update(t for t in group if t != term)
    return {t: sorted(s) for t, s in out.items()}


def counterfactuals(text: str, partners: dict[str, list[str]]) -> Iterator[tuple[frozenset[str], frozenset[str]]]:
    """For every swap in every sentence: the features that only the sentence has, and those that only the swapped one has."""
    for sentence in SENTENCE(text.lower()):
        words = set(WORD(sentence))
        for term in words & partners.keys():
            rest = set().union(*map(forms, words - {term}))
            own = forms(term) - rest
            for other in partners[term]:
                new = forms(other) - rest
                if own != new:
                    yield frozenset(own - new), frozenset(new - own)


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    pairs: int = 0  # counterfactual pairs it was fitted with

    def __post_init__(self):
        self.starts = {f.removeprefix("^")[: STEMS[0]] for f in self.weights}

    def logit(self, text: str | None) -> float:
        found: set[str] = set()
        for w in set(WORD(text.lower())) if text else ():
            if w[: STEMS[0]] in self.starts:
                found.add(w)
                found.update("^" + w[:n] for n in STEMS if len(w) >= n)
        return self.bias + math.fsum(self.weights.get(f, 0.0) for f in found)

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.logit(text)))))


def _sum(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, values, n)


def _sparse(rows: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(r, "<i4") for r in rows]
    return np.repeat(np.arange(len(parts)), [len(p) for p in parts]), np.concatenate(parts) if parts else np.empty(0, "<i4")


def significance(row: np.ndarray, col: np.ndarray, labels: np.ndarray, n: int, least: float = 4.0, full: float = 12.0) -> np.ndarray:
    """A feature's value where it is present: 0 if the classes' shares of rows with it differ by chance, up to 1."""
    n1, n0 = labels.sum(), (1 - labels).sum()
    a, b = _sum(labels[row], col, n), _sum(1 - labels[row], col, n)
    share = (a + b) / (n1 + n0)
    z = np.abs(a / n1 - b / n0) / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / n1 + 1 / n0))
    return np.where(z < least, 0, np.minimum(1, z / full))


def fit_logistic(docs: list[bytes], labels: np.ndarray, pairs: list[tuple[bytes, bytes, int]], n: int, l2: float = 2e-4, swap: float = 1.0, steps: int = 250, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam over all rows at once; a row is its features' indices (little-endian int32).

    pairs: features of a sentence, of its counterfactual, and how often; ``swap`` weighs their mean penalty.
    """
    row, col = _sparse(docs)
    value = significance(row, col, labels, n)
    pair_a, pair_b = _sparse(a for a, _, _ in pairs), _sparse(b for _, b, _ in pairs)
    times = np.array([k for _, _, k in pairs], dtype=float)
    times /= max(1.0, times.sum())
    balance = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, steps + 1):
        x = w[:n] * value
        z = _sum(x[col], row, len(docs)) + w[n]
        slope = (1 / (1 + np.exp(-z)) - labels) * balance
        gx = _sum(slope[row], col, n)
        if pairs:
            change = (_sum(x[pair_a[1]], pair_a[0], len(pairs)) - _sum(x[pair_b[1]], pair_b[0], len(pairs))) * (2 * swap * times)
            gx += _sum(change[pair_a[0]], pair_a[1], n) - _sum(change[pair_b[0]], pair_b[1], n)
        g = np.append(gx * value + l2 * w[:n], slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:n] * value, float(w[n])


def calibrate(z: np.ndarray, labels: np.ndarray, threshold: float) -> float:
    """What to add to logits so that the cut with the fewest errors falls on ``threshold``: the middle of the widest such gap."""
    order = np.argsort(z, kind="stable")
    z, y = z[order], labels[order]
    errors = np.r_[0, np.cumsum(y)] + np.r_[np.cumsum((1 - y)[::-1])[::-1], 0]  # cut before position i
    edges = np.r_[z[0] - 2, z, z[-1] + 2]
    errors = np.where(np.diff(edges) > 1e-9, errors, len(z) + 1)  # no cut parts equal logits
    best = np.flatnonzero(errors == errors.min())
    cut = max(best, key=lambda i: edges[i + 1] - edges[i])
    return math.log(threshold / (1 - threshold)) - (edges[cut] + edges[cut + 1]) / 2


def neutral_sets(often: list[tuple[str, int, int]], toxic: int, clean: int, words: int) -> list[list[str]]:
    """Sets of TOGETHER words whose share of rows is alike in both classes, from (feature, rows, toxic rows).

    Of the words in a fiftieth to a quarter of the rows those whose difference is least, and below ALIKE standard
    errors; neighbours by frequency share a set.
    """
    n = toxic + clean
    if not words or not toxic or not clean:
        return []
    error = math.sqrt(1 / toxic + 1 / clean)
    own = [(abs(k / toxic - (m - k) / clean) / (error * math.sqrt(m / n * (1 - m / n))), f, m) for f, m, k in often if f[0] != "^" and n / 50 <= m <= n / 4]
    chosen = sorted(sorted(x for x in own if x[0] < ALIKE)[:words], key=lambda x: (-x[2], x[1]))
    return [[f for _, f, _ in chosen[at : at + TOGETHER]] for at in range(0, len(chosen) - 1, TOGETHER)]


def train(docs: DataFrame, labels: DataFrame, eligible: Column, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = 2000, vocabulary: int = 40_000, threshold: float = THRESHOLD, identity: Iterable[Iterable[str]] = IDENTITY, derived: int = DERIVED, swap: float = 1.0) -> Model:
    """Fit on at most ``sample`` rows of each class among the labelled rows for which ``eligible`` holds (over doc_id)."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).where(eligible).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).alias("_label"))
    chosen = [known.where(F.col("_label") == c).orderBy(F.xxhash64("_id"), "_id").limit(sample) for c in (0, 1)]
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), row_key(docs).alias("_key")).join(F.broadcast(chosen[0].union(chosen[1])), "_id")  # 2 x sample ids
    one = rows.groupBy("_id", "_label").agg(F.min_by("_text", "_key").alias("_text"))
    rows = table(one.select("_label", "_text"), "labelled")

    @F.pandas_udf("array<string>")
    def seen(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: list(features(t or "")))

    shares = rows.select("_label", F.explode(seen("_text")).alias("f")).groupBy("f").agg(F.count("*").alias("n"), F.sum("_label").alias("toxic"))
    often = [(r["f"], r["n"], r["toxic"]) for r in shares.where("n >= 4").orderBy(F.desc("n"), "f").limit(vocabulary).collect()]  # at most ``vocabulary`` rows
    names = [f for f, _, _ in often]
    index = {f: i for i, f in enumerate(names)}
    sizes = {r["_label"]: r["count"] for r in rows.groupBy("_label").count().collect()}
    partners = swap_partners([*identity, *neutral_sets(often, sizes.get(1, 0), sizes.get(0, 0), derived)])

    def code(found: Iterable[str]) -> bytes:
        return np.array(sorted(index[f] for f in found if f in index), dtype="<i4").tobytes()

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"y": batch["_label"].astype("int32"), "a": [code(features(t or "")) for t in batch["_text"]]})

    def swapped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Counter((code(a), code(b)) for t in batch["_text"] for a, b in counterfactuals(t or "", partners))
            yield pd.DataFrame([(a, b, k) for (a, b), k in found.items()], columns=["a", "b", "k"])

    labelled = sorted((r["y"], bytes(r["a"])) for r in rows.mapInPandas(coded, "y int, a binary").collect())  # at most 2 x sample rows
    differences = rows.mapInPandas(swapped, "a binary, b binary, k long").groupBy("a", "b").agg(F.sum("k").alias("k"))
    pairs = sorted((bytes(r["a"]), bytes(r["b"]), r["k"]) for r in differences.where("a <> b").collect())  # one for each different swap
    y = np.array([a for a, _ in labelled], dtype=float)
    if min(y.sum(), len(y) - y.sum()) < 2:
        share = y.mean() if len(y) else 0.0
        return Model({}, math.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    w, bias = fit_logistic([x for _, x in labelled], y, pairs, len(names), swap=swap)
    mentions = [index[f] for t in swap_partners(identity) for f in forms(t) if f in index] if swap else []
    z = np.zeros(len(y))  # of each row, by a model of the other half; mentions do not decide where the cut lies
    for half in (0, 1):
        own = np.flatnonzero(np.arange(len(y)) % 2 == half)
        rest = np.flatnonzero(np.arange(len(y)) % 2 != half)
        u, b = fit_logistic([labelled[i][1] for i in rest], y[rest], pairs, len(names), swap=swap)
        row, col = _sparse(labelled[i][1] for i in own)
        u[mentions] = 0
        z[own] = _sum(u[col], row, len(own)) + b
    return Model({f: float(x) for f, x in zip(names, w, strict=True) if abs(x) > 0.01}, bias + calibrate(z, y, threshold), sum(k for _, _, k in pairs))


def scorer(model: Model):
    """The model as a column function of the text."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(model.score).astype("float64")

    return lambda text: score(F.coalesce(text, F.lit("")))


def scored(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the column ``out``, 0 to 1."""
    small_batches(docs.sparkSession)
    return docs.withColumn(out, scorer(model)(F.col(text)))


def reject_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold."""
    small_batches(docs.sparkSession)
    return docs.where(scorer(model)(F.col(text)) < threshold)
