"""Quality classifier by co-training of two views.

The text view sees what a text is made of: shares of byte values, lengths of words and lines, repetition.
The metadata view sees what is known about a document beside its text: source, language, stated length.
Both are logistic regressions in numpy. They start from the labelled documents; in each round each view
labels the unlabelled documents it is most certain of, by calibrated probability, for the other view.
Both are calibrated on labelled documents kept out of training (Platt), and the final score adds
their log-odds, taking the prior once.

Training works on bounded samples: at most `sample_docs` documents of each label and as many without
label, chosen by a hash of the identifier; only their features reach the driver. Every document is scored.

Defined cases: null and empty texts have the features of an empty text; null metadata is a value of its
own; labels that are null or contradict each other count as none, repeated equal labels as one; without
labels, or with labels of one kind only, every document scores 0.5 and stays; an empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

SAMPLE_DOCS = 4000
ROUNDS = 3
NEW_PER_ROUND = 200
CERTAIN = 0.95
KEEP_AT = 0.5
SLOTS = 64  # hashed values of source and language
_CLASSES = 96  # byte classes of the text view
_BYTE_CLASS = np.array([b - 32 if 32 <= b < 127 else 95 for b in range(256)])
_BYTE_CLASS[[9, 10, 13]] = 0
TEXT_SIZE = _CLASSES + 10
META_SIZE = 2 * SLOTS + 12


def text_features(text: str | None) -> np.ndarray:
    raw = (text or "").encode()
    out = np.zeros(TEXT_SIZE, dtype=np.float32)
    if not raw:
        out[-1] = 1
        return out
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    out[:_CLASSES] = np.sqrt(np.bincount(_BYTE_CLASS, weights=counts, minlength=_CLASSES) / len(raw))
    words = raw.split()
    n = max(1, len(words))
    upper = int(counts[65:91].sum())
    letters = upper + int(counts[97:123].sum() + counts[128:].sum())
    lines = raw.split(b"\n")
    out[_CLASSES:-1] = (
        upper / max(1, letters), letters / len(raw), len(set(words)) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        math.log1p(len(words)) / 10, math.log1p(len(raw) / n) / 3, len(set(lines)) / len(lines),
        math.log1p(len(raw) / len(lines)) / 10, sum(not w[-1:].isalnum() and w[-1:] < b"\x80" for w in words) / n)
    return out


def meta_features(source: str | None, lang: str | None, n_chars: float | None) -> np.ndarray:
    out = np.zeros(META_SIZE, dtype=np.float32)
    out[zlib.crc32(f"s{source}".encode()) % SLOTS] = 1
    out[SLOTS + zlib.crc32(f"l{lang}".encode()) % SLOTS] = 1
    known = n_chars is not None and n_chars == n_chars
    out[2 * SLOTS + (min(10, max(0, int(math.log2(max(1.0, n_chars)) - 4))) if known else 11)] = 1
    return out


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 25, ridge: float = 1.0) -> np.ndarray:
    """Weights with intercept, classes weighted alike: Newton steps on the penalised likelihood."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty * beta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(bend, slope)
        beta -= move
        if np.abs(move).max() < 1e-6:
            break
    return beta


@dataclass
class View:
    beta: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.scale * (x.astype(np.float64) @ self.beta[:-1] + self.beta[-1]) + self.shift

    def calibrated(self, x: np.ndarray, y: np.ndarray) -> "View":
        """Platt scaling with his smoothed targets; a view that tells nothing ends near the prior."""
        raw = np.clip(View(self.beta).logit(x), -30, 30)
        good, bad = (y == 1).sum(), (y == 0).sum()
        target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
        a, b = 0.0, math.log((good + 1) / (bad + 1))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
            w = p * (1 - p) + 1e-9
            g = np.array([((p - target) * raw).sum() + 1e-3 * a, (p - target).sum()])
            h = np.array([[(w * raw * raw).sum() + 1e-3, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-9]])
            move = np.linalg.solve(h, g)
            a, b = a - move[0], b - move[1]
            if np.abs(move).max() < 1e-8:
                break
        return View(self.beta, float(a), float(b))


@dataclass
class Model:
    text: View
    meta: View
    prior: float  # log-odds

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """Calibrated views combined: their log-odds added, the prior counted once."""
        z = self.text.logit(text) + self.meta.logit(meta) - self.prior
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, new: int = NEW_PER_ROUND,
             certain: float = CERTAIN) -> Model | None:
    """y: 1 good, 0 bad, -1 unknown, in a fixed order. None without both labels in both folds."""
    labelled = np.flatnonzero(y >= 0)
    held = labelled[np.arange(len(labelled)) % 4 == 3]
    core = np.setdiff1d(labelled, held)
    if any(len(set(y[part].tolist())) < 2 for part in (core, held)):
        return None
    views = (text, meta)
    given = [dict(zip(core.tolist(), y[core].tolist())) for _ in views]
    pool = set(np.flatnonzero(y < 0).tolist())
    models: list[View] = []
    for turn in range(rounds + 1):
        models = []
        for x, known in zip(views, given):
            rows = np.array(sorted(known))
            models.append(View(_logistic(x[rows], np.array([known[r] for r in rows]))).calibrated(x[held], y[held]))
        if turn == rounds or not pool:
            break
        rows = np.array(sorted(pool))
        for teacher in (0, 1):
            z = models[teacher].logit(views[teacher][rows])
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            order = np.argsort(z, kind="stable")
            share = max(1, int(new * (y[core] == 0).mean()))
            for row in [r for r in order[::-1][:new - share] if p[r] >= certain]:
                given[1 - teacher].setdefault(int(rows[row]), 1)
                pool.discard(int(rows[row]))
            for row in [r for r in order[:share] if p[r] <= 1 - certain]:
                given[1 - teacher].setdefault(int(rows[row]), 0)
                pool.discard(int(rows[row]))
    good = (y[labelled] == 1).mean()
    return Model(models[0], models[1], math.log(good / (1 - good)))


def _features(text: Column, source: Column, lang: Column, n_chars: Column) -> Column:
    @F.arrow_udf(ArrayType(FloatType()))
    def of(t: pa.Array, s: pa.Array, g: pa.Array, n: pa.Array) -> pa.Array:
        rows = [np.concatenate([text_features(a), meta_features(b, c, d)])
                for a, b, c, d in zip(t.to_pylist(), s.to_pylist(), g.to_pylist(), n.to_pylist())]
        return pa.array([r.tolist() for r in rows], pa.list_(pa.float32()))

    return of(text, source, lang, n_chars)


def _meta_columns(docs: DataFrame) -> list[Column]:
    """text, source, lang, n_chars; a column that the documents lack is null."""
    kinds = {"text": "string", "source": "string", "lang": "string", "n_chars": "double"}
    return [F.col(f"`{c}`").cast(k) if c in docs.columns else F.lit(None).cast(k) for c, k in kinds.items()]


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                    sample_docs: int = SAMPLE_DOCS) -> pd.DataFrame:
    """(label, features) of the sampled documents, in a fixed order."""
    known = (labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"))
             .where("id IS NOT NULL AND label IN (0, 1)").groupBy("id")
             .agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most"))
    order = F.xxhash64("id", F.lit(23))
    parts = [known.where(F.col("label") == v).orderBy(order, "id").limit(sample_docs) for v in (0, 1)]
    ids = docs.select(F.col(f"`{id_col}`").alias("id")).where("id IS NOT NULL")
    # As many again, some of which turn out to be labelled: the pool of unlabelled documents.
    pool = ids.distinct().orderBy(order, "id").limit(2 * sample_docs).join(known.select("id"), "id", "left_anti")
    chosen = parts[0].unionByName(parts[1]).unionByName(pool.select("id", F.lit(-1).alias("label")))
    text, source, lang, n_chars = _meta_columns(docs)
    few = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), source.alias("source"), lang.alias("lang"),
                      n_chars.alias("n_chars")).join(F.broadcast(chosen), "id")  # at most 4 * sample_docs rows of 12 bytes
    # Of repeated ids one row stays, before any feature is made.
    content = F.xxhash64("text", "source", "lang", "n_chars")
    few = (few.groupBy("id", "label").agg(F.min_by(F.struct("text", "source", "lang", "n_chars"), content).alias("row"))
           .select("id", "label", "row.*"))
    return (few.select("id", "label", _features(F.col("text"), F.col("source"), F.col("lang"), F.col("n_chars")).alias("x"))
            .toPandas().assign(o=lambda d: [zlib.crc32(str(i).encode()) for i in d["id"]])
            .sort_values(["o", "id"], kind="stable"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        sample_docs: int = SAMPLE_DOCS) -> Model | None:
    rows = training_sample(docs, labels, id_col, label_col, sample_docs)
    if rows.empty:
        return None
    x = np.array(rows["x"].tolist(), dtype=np.float32)
    return co_train(x[:, :TEXT_SIZE], x[:, TEXT_SIZE:], rows["label"].to_numpy())


def score(docs: DataFrame, model: Model | None) -> Column:
    """Probability that a document is good."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf(DoubleType())
    def of(t: pa.Array, s: pa.Array, g: pa.Array, n: pa.Array) -> pa.Array:
        text = np.array([text_features(x.as_py()) for x in t])
        meta = np.array([meta_features(a, b, c) for a, b, c in zip(s.to_pylist(), g.to_pylist(), n.to_pylist())])
        return pa.array(model.score(text, meta) if len(t) else [], pa.float64())

    return of(*_meta_columns(docs))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """One row per document: doc_id, score, accepted."""
    model = fit(docs, labels, id_col, **how)
    scored = docs.select(F.col(f"`{id_col}`").alias("doc_id"), score(docs, model).alias("score"))
    return scored.withColumn("accepted", F.col("score") >= KEEP_AT)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The accepted documents with all their columns."""
    return docs.where(score(docs, fit(docs, labels, id_col, **how)) >= KEEP_AT)
