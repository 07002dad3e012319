"""Language identification with a byte convolutional network, trained in numpy.

Filters of several widths slide over embedded bytes, each keeps its largest response in a window of
fixed length, and a softmax over these maxima names the language. A text of any length is cut into
windows, all of them are scored in batches, and the probabilities are averaged by the bytes they hold.

The network is fitted on the driver on a bounded sample: at most `docs_per_language` documents of each
language, chosen by a hash of their identifier, and at most `windows_per_doc` windows of each. Only
text and language are learned from. At most MAX_LANGUAGES languages are learned, those with the most documents; documents of a
rarer language always get one of these.

At prediction the responses come from tables: an embedded byte times a slice of a filter is a constant
of that byte, and two neighbours share one table of 65,536 rows, so a filter of width 4 costs two
lookups.

Defined cases: null text and text without letters are `und` with score 0; rows without language or
identifier are not learned from; with nothing to learn from every text is `und` with score 0; one
language only is predicted with score 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

UNDETERMINED = "und"
WINDOW = 256
EMBEDDING = 8
WIDTHS = (2, 3, 4)
FILTERS = 8
MAX_LANGUAGES = 500  # the most frequent ones are learned
DOCS_PER_LANGUAGE = 800
WINDOWS_PER_DOC = 3
EPOCHS = 5
BATCH = 64
RATE = 0.01


def as_windows(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(windows, bytes in each), A-Z folded, the last window padded with zero bytes."""
    raw = np.frombuffer(text.lower(), dtype=np.uint8)
    n = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(n * WINDOW, dtype=np.uint8)
    out[:len(raw)] = raw
    held = np.full(n, WINDOW)
    held[-1] = max(1, len(raw) - (n - 1) * WINDOW)
    return out.reshape(n, WINDOW), held


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # per width: width x EMBEDDING x FILTERS
    bias: np.ndarray  # all filters
    out: np.ndarray  # all filters x languages
    out_bias: np.ndarray

    def tables(self) -> list[list[tuple[int, int, np.ndarray]]]:
        """Per width the lookups that add up to its responses: (offset, 1 or 2 bytes, table)."""
        single = [[(self.embedding @ f[i]).astype(np.float32) for i in range(len(f))] for f in self.filters]
        out = []
        for parts in single:
            steps = []
            for i in range(0, len(parts) - 1, 2):
                steps.append((i, 2, (parts[i][:, None, :] + parts[i + 1][None, :, :]).reshape(65536, -1)))
            if len(parts) % 2:
                steps.append((len(parts) - 1, 1, parts[-1]))
            out.append(steps)
        return out

    def probabilities(self, windows: np.ndarray, tables: list, step: int = 128) -> np.ndarray:
        found = []
        for i in range(0, len(windows), step):
            x = windows[i:i + step].astype(np.int32)
            pairs = x[:, :-1] * 256 + x[:, 1:]
            pooled = []
            for width, steps in zip(WIDTHS, tables):
                places = WINDOW - width + 1
                total = None
                for at, n, table in steps:
                    part = np.take(table, (pairs if n == 2 else x)[:, at:at + places], axis=0)
                    total = part if total is None else np.add(total, part, out=total)
                pooled.append(total.max(axis=1))
            hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
            found.append(_softmax(hidden @ self.out + self.out_bias))
        return np.concatenate(found)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on the cross-entropy, classes weighted alike; gradients flow through each filter's largest response."""
    rng = np.random.default_rng(seed)
    n_out = FILTERS * len(WIDTHS)
    net = Network(languages, rng.normal(0, 0.5, (256, EMBEDDING)),
                  [rng.normal(0, 1 / np.sqrt(w * EMBEDDING), (w, EMBEDDING, FILTERS)) for w in WIDTHS],
                  np.zeros(n_out), rng.normal(0, 1 / np.sqrt(n_out), (n_out, len(languages))), np.zeros(len(languages)))
    weights = 1 / np.maximum(1, np.bincount(labels, minlength=len(languages)))
    weights = weights / weights[labels].mean()
    held = [net.embedding, *net.filters, net.bias, net.out, net.out_bias]
    first, second = [np.zeros_like(p) for p in held], [np.zeros_like(p) for p in held]
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(windows)), max(1, len(windows) // BATCH)):
            x, y = windows[rows], labels[rows]
            each = np.arange(len(rows))
            emb = net.embedding[x].astype(np.float32)
            pooled, places = [], []
            for w, f in zip(WIDTHS, net.filters):
                span = WINDOW - w + 1
                wide = np.concatenate([emb[:, i:i + span] for i in range(w)], axis=2)
                response = wide @ f.reshape(w * EMBEDDING, FILTERS).astype(np.float32)
                best = response.argmax(axis=1)
                places.append(best)
                pooled.append(np.take_along_axis(response, best[:, None, :], axis=1)[:, 0])
            hidden = np.concatenate(pooled, axis=1) + net.bias
            active = np.maximum(hidden, 0)
            wrong = _softmax(active @ net.out + net.out_bias)
            wrong[each, y] -= 1
            wrong *= (weights[y] / len(rows))[:, None]
            back = (wrong @ net.out.T) * (hidden > 0)
            grads = [np.zeros_like(net.embedding), *[np.zeros_like(f) for f in net.filters],
                     back.sum(0), active.T @ wrong, wrong.sum(0)]
            for k, (w, f) in enumerate(zip(WIDTHS, net.filters)):
                g = back[:, k * FILTERS:(k + 1) * FILTERS]
                for i in range(w):
                    seen = x[each[:, None], places[k] + i]  # rows x filters: the byte under each filter's best place
                    grads[1 + k][i] = np.einsum("rfe,rf->ef", net.embedding[seen], g)
                    np.add.at(grads[0], seen, g[:, :, None] * f[i].T[None])
            step += 1
            for p, g, m, v in zip(held, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def sample(docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str,
           docs_per_language: int = DOCS_PER_LANGUAGE, windows_per_doc: int = WINDOWS_PER_DOC) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Bounded training windows: (windows, label numbers, languages), in a fixed order."""
    order = F.xxhash64(F.col(f"`{id_col}`"), F.lit(11))
    learned = docs.where(learn & F.col(f"`{lang_col}`").isNotNull()).select(
        F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"), order.alias("o"))
    counts = {r.lang: r.n for r in learned.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col("n").desc(), "lang").limit(MAX_LANGUAGES).collect()}
    if not counts:
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, int), []
    # Of each language only hashes below twice its share are looked at, so a handful of rows is left for the ranking
    # however many documents there are.
    share = F.create_map(*[F.lit(v) for lang, n in counts.items() for v in (lang, min(1.0, 2.0 * docs_per_language / n))])
    rows = learned.where((F.pmod("o", F.lit(1 << 40)) < F.element_at(share, F.col("lang")) * float(1 << 40)) & F.col("text").rlike(r"\p{L}"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("o", F.lit(1 << 40)), "o", F.xxhash64("text")))
    offset = lambda i: F.pmod(F.xxhash64("o", F.lit(i)), F.greatest(F.length("text") - F.lit(WINDOW // 2), F.lit(1)))
    parts = F.array(*[F.substr("text", (offset(i) + 1).cast("int"), F.lit(WINDOW)) for i in range(windows_per_doc)])
    chosen = (rows.withColumn("rank", rank).where(F.col("rank") <= docs_per_language)
              .select("lang", "rank", F.posexplode(F.array_distinct(parts)).alias("i", "part"))
              .orderBy("lang", "rank", "i").select("lang", "part").toPandas())
    languages = sorted(set(chosen["lang"]))
    if not languages:  # no text with a letter
        return np.zeros((0, WINDOW), np.uint8), np.zeros(0, int), []
    windows = np.concatenate([as_windows(p.encode())[0][:1] for p in chosen["part"]])
    number = {lang: i for i, lang in enumerate(languages)}
    return windows, np.array([number[lang] for lang in chosen["lang"]]), languages


def predict(text: Column, net: Network | None) -> Column:
    """struct<lang: string, score: double>; the score is the mean probability of the language."""
    if net is None:
        return F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"))
    kept: dict = {}

    @F.arrow_udf(StructType().add("lang", StringType()).add("score", DoubleType()))
    def of(texts: pa.Array) -> pa.Array:
        if "tables" not in kept:
            kept["tables"] = net.tables()
        langs: list = [UNDETERMINED] * len(texts)
        scores = [0.0] * len(texts)
        block, owners, sizes = [], [], []

        def flush() -> None:
            if not block:
                return
            p = net.probabilities(np.concatenate(block), kept["tables"])
            weight = np.concatenate(sizes)
            start = 0
            for who, held in zip(owners, sizes):
                totals[who] = totals.get(who, 0) + (p[start:start + len(held)] * weight[start:start + len(held), None]).sum(0)
                start += len(held)
            block.clear(), owners.clear(), sizes.clear()

        totals: dict[int, np.ndarray] = {}
        waiting = 0
        for i, t in enumerate(texts):
            if not t.is_valid:
                continue
            windows, held = as_windows(t.as_py().encode())
            block.append(windows), owners.append(i), sizes.append(held)
            waiting += len(windows)
            if waiting >= 4096:
                flush()
                waiting = 0
        flush()
        for i, total in totals.items():
            total = total / total.sum()
            best = int(total.argmax())
            langs[i], scores[i] = net.languages[best], float(min(1.0, total[best]))
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    # Text without a letter is not looked at: it goes in as null and comes out undetermined.
    return of(F.when(text.rlike(r"\p{L}"), text))


def identify(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """All columns of the documents and `prediction` (struct lang, score), learned from the rows where `learn` holds."""
    windows, labels, languages = sample(docs, learn, id_col, text_col, lang_col, docs_per_language)
    net = train(windows, labels, languages) if languages else None
    return docs.withColumn("prediction", predict(F.col(f"`{text_col}`"), net))
