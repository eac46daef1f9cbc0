"""Counterfactual-regularised toxicity classifier.

A logistic regression over the presence of character n-grams of words is fit
on labelled texts.  For every labelled text that names a group, its
counterfactuals (the same sentences with each identity term replaced by the
others of its group) are made, and the squared change of the logit between a
text and its counterfactuals is added to the loss.  Weight therefore moves off
the identity terms and onto what tells toxic from neutral mentions of them.

Fitting uses at most ``max_rows`` labelled rows (those with the smallest hash
of their id, a documented bound); feature statistics over them are counted by
Spark, scoring runs over every whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from cadence.llm.common import prepared, staged, text_or_empty

MAX_ROWS = 20_000
MAX_FEATURES = 2_000
MIN_CHI2 = 25.0
MIN_DOCS = 4
THRESHOLD = 0.3
PENALTY = 1.0
RIDGE = 0.5
GRAMS = (3, 4, 5, 6)

#: Identity terms by group; a term is swapped for the others of its group.
IDENTITY_GROUPS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("female", "male"),
    ("gay", "lesbian", "straight", "bisexual"),
    ("transgender", "cisgender"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("african", "european", "american", "mexican", "chinese", "arab"),
    ("immigrants", "natives", "refugees"),
    ("disabled", "blind", "deaf"),
    ("old", "young"),
    ("frauen", "männer"),
    ("christen", "muslime", "juden"),
    ("femmes", "hommes"),
    ("chrétiens", "musulmans", "juifs"),
    ("mujeres", "hombres"),
    ("cristianos", "musulmanes", "judíos"),
)
_WORD = re.compile(r"[^\W\d_]+")
_GROUP = {t: g for g in IDENTITY_GROUPS for t in g}


def _grams(word: str) -> list[str]:
    w = f"^{word}$"
    return [w] + [w[i : i + n] for n in GRAMS for i in range(len(w) - n + 1)]


def _tokens(text: str) -> set[str]:
    return set(text.lower().split())


def features(text: str) -> set[str]:
    """The n-grams of the words of a text."""
    out: set[str] = set()
    for token in _tokens(text):
        for word in _WORD.findall(token):
            out.update(_grams(word))
    return out


def counterfactuals(text: str) -> list[str]:
    """The text with its identity terms moved 1, 2, ... places round their
    groups; none if it names no group."""
    low = text.lower()
    turns = max((len(_GROUP[w]) - 1 for w in _WORD.findall(low) if w in _GROUP), default=0)

    def swapped(k: int) -> str:
        def other(m: re.Match) -> str:
            g = _GROUP.get(m[0])
            return g[(g.index(m[0]) + k) % len(g)] if g else m[0]

        return _WORD.sub(other, low)

    return [swapped(k) for k in range(1, turns + 1)]


@dataclass
class Model:
    """Weights by n-gram, and the bias."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -50.0
    _seen: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)
    _index: dict[str, int] = field(default_factory=dict, repr=False)

    def score(self, text: str) -> float:
        if not self._index:
            self._index = {g: i for i, g in enumerate(sorted(self.weights))}
            self._w = np.array([self.weights[g] for g in sorted(self.weights)] + [0.0])
        active: set[int] = set()
        for token in _tokens(text):
            got = self._seen.get(token)
            if got is None:
                got = tuple({self._index[g] for w in _WORD.findall(token) for g in _grams(w) if g in self._index})
                if len(token) <= 64:
                    if len(self._seen) > 400_000:
                        self._seen.clear()
                    self._seen[token] = got
            active.update(got)
        z = self.bias + float(self._w[sorted(active)].sum()) if active else self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "_seen": {}, "_index": {}}


def _fit(rows: list[np.ndarray], y: np.ndarray, swaps: list[tuple[np.ndarray, np.ndarray]], k: int, penalty: float):
    """Gradient descent with momentum on log loss + ridge + penalty·mean (w·(x-x'))²."""
    n, at = len(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.concatenate([*rows, np.zeros(0, int)]).astype(int)
    plus, minus = [s[0] for s in swaps], [s[1] for s in swaps]
    d_at = np.repeat(np.arange(len(swaps)), [len(p) + len(m) for p, m in swaps])
    d_col = np.concatenate([np.concatenate(s) for s in swaps] + [np.zeros(0, int)]).astype(int)
    d_val = np.concatenate([np.r_[np.ones(len(p)), -np.ones(len(m))] for p, m in zip(plus, minus)] + [np.zeros(0)])
    w, b = np.zeros(k), np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    vw, vb = np.zeros(k), 0.0
    # step by feature: the curvature of a feature is at most its share of rows,
    # and features of one word move together
    width = max(1.0, np.mean([len(r) for r in rows if len(r)] or [1]))
    share = np.bincount(col, minlength=k) / n
    change = np.bincount(d_col, minlength=k) / max(1, len(swaps))
    step = 1.0 / (width * (0.25 * share + 2 * penalty * change + RIDGE / n) + 1e-9)
    for _ in range(400):
        z = b + np.bincount(at, w[col], minlength=n)
        e = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - y
        g = np.bincount(col, e[at], minlength=k) / n + RIDGE / n * w
        if len(swaps):
            dz = np.bincount(d_at, w[d_col] * d_val, minlength=len(swaps))
            g += 2 * penalty * np.bincount(d_col, dz[d_at] * d_val, minlength=k) / len(swaps)
        vw, vb = 0.9 * vw - 0.2 * step * g, 0.9 * vb - 0.2 * e.mean()
        w, b = w + vw, b + vb
    return w, float(b)


def train(labelled: DataFrame, max_rows: int = MAX_ROWS, penalty: float = PENALTY) -> Model:
    """labelled: (doc_id, text, label 0/1).  Null labels and ids teach nothing;
    of rows that repeat an id one is used (largest label, smallest text).
    Without rows of both labels the model scores every text near 0."""
    spark = prepared(labelled.sparkSession)
    one = (
        labelled.where("label is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"), F.min(text_or_empty()).alias("text"))
    )
    sample = staged(one, "toxicity-sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = {0: Counter(), 1: Counter()}
        for b in batches:
            for text, label in zip(b["text"], b["label"]):
                df[int(label > 0)].update(features(text))
        both = df[0].keys() | df[1].keys()
        yield pd.DataFrame(
            {"g": list(both), "pos": [df[1][g] for g in both], "neg": [df[0][g] for g in both]}
        )

    totals = sample.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("label") > 0).cast("long")).alias("p")).first()
    n, p = int(totals["n"]), int(totals["p"] or 0)
    if not p or p == n:
        return Model()
    counts = (
        sample.select("text", "label")
        .mapInPandas(count, "g string, pos long, neg long")
        .groupBy("g")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    a, c = F.col("pos"), F.col("neg")
    df = a + c
    chi2 = F.lit(float(n)) * F.pow(a * F.lit(n - p) - c * F.lit(p), 2) / (
        df * (F.lit(n) - df) * F.lit(float(p) * (n - p)) + 1e-9
    )
    named = [f"^{t}$" for g in IDENTITY_GROUPS for t in g]
    chosen = (
        counts.where(df >= MIN_DOCS)
        .withColumn("chi2", chi2)
        .where((F.col("chi2") >= MIN_CHI2) | F.col("g").isin(named))
        .orderBy(F.desc("chi2"), "g")
        .limit(MAX_FEATURES)
    )
    vocab = sorted(r["g"] for r in chosen.select("g").collect())
    index = {g: i for i, g in enumerate(vocab)}

    def active(text: str) -> list[int]:
        return sorted(index[g] for g in features(text) if g in index)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for i, text, label in zip(b["doc_id"], b["text"], b["label"]):
                own = active(text)
                plus, minus = [], []
                for other in counterfactuals(text):
                    o = set(active(other))
                    plus.append(sorted(set(own) - o))
                    minus.append(sorted(o - set(own)))
                out.append((i, int(label > 0), own, plus, minus))
            yield pd.DataFrame(out, columns=["doc_id", "y", "own", "plus", "minus"])

    made = sample.mapInPandas(
        encode, "doc_id long, y int, own array<int>, plus array<array<int>>, minus array<array<int>>"
    )
    rows = sorted(made.collect(), key=lambda r: r["doc_id"])  # at most max_rows rows of chosen features
    swaps = [
        (np.array(q, int), np.array(m, int)) for r in rows for q, m in zip(r["plus"], r["minus"]) if len(q) + len(m)
    ]
    w, b = _fit([np.array(r["own"], int) for r in rows], np.array([r["y"] for r in rows], float), swaps, len(vocab), penalty)
    return Model({g: float(x) for g, x in zip(vocab, w)}, b)


def held_out(doc_id="doc_id"):
    """Rows that must not teach: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled ids outside the
    held-out quarter, those with the smallest hash of the id."""
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .where(~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    # at most max_rows ids: sent to every task, so no text but the sample's is shuffled
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")


def score_udf(model: Model):
    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return score(text_or_empty())


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; null text is empty,
    an empty text gets the model's base rate.  Further columns are ignored."""
    prepared(docs.sparkSession)
    return docs.select("doc_id", held_out().alias("held_out"), score_udf(model).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all their columns, that are not predicted toxic."""
    prepared(docs.sparkSession)
    return docs.where(score_udf(model) < threshold)
