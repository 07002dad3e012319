"""Hard negatives by segment summary filtering.

Every vector is stored with the mean and the deviation (norm of what is left without the mean) of its segments, for 1,
2, 4 and 8 segments. With a segment of length L, means p and q and deviations s and t, the part of an inner product that
falls into it lies within L*p*q -/+ s*t. A pair of vectors is bounded by the whole first, and only pairs that could
still matter are refined, level by level, before the exact score is taken.

Anchors are a stated share of the rows. They are searched in groups of at most GROUP_BYTES of vectors, each
group a broadcast of that proven size, against all rows in blocks; what a task sends on is the best few rows per anchor.
One pass finds each anchor's positives, a second the negatives of each positive, with its score as the upper limit.

Scores are integers and exact. Defined cases: rows without identifier or label, without a vector, or with a null or
non-finite component take no part; of rows with one identifier the least by (label, vector) counts; ties go to the
smaller identifier; a shorter vector is filled up with zeros; scores beyond a long stay at its limits; an anchor without
other rows of its label, and a positive without rows in its range, give no rows; an empty table gives an empty table.
Columns other than the three named ones are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, written

LEVELS = (1, 2, 4, 8)
GROUP_BYTES = 8 << 20
BLOCK_ROWS = 2048
_ANCHORS_AT_ONCE = 256
# Above this share of pairs left, one product over the whole block is less work than the pairs one by one.
_DENSE = 0.1
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _segments(width: int, n: int) -> list[tuple[int, int]]:
    cuts = [round(i * width / n) for i in range(n + 1)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def summaries(vectors: np.ndarray) -> np.ndarray:
    """Row by row, for all levels: the means times the root of the length, then the deviations.

    With these the bound of a level is (means . means) +/- (deviations . deviations).
    """
    out = []
    for n in LEVELS:
        means, devs = [], []
        for a, b in _segments(vectors.shape[1], n):
            part = vectors[:, a:b]
            mean = part.mean(axis=1)
            means.append(mean * np.sqrt(b - a))
            devs.append(np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1)))
        out += means + devs
    return np.stack(out, axis=1) if out else np.zeros((len(vectors), 0))


def _bounds(a: np.ndarray, b: np.ndarray, width: int, pairs: tuple[np.ndarray, np.ndarray] | None, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of one level, of all pairs of two blocks or of the pairs given."""
    at = 2 * sum(len(_segments(width, n)) for n in LEVELS[:level])
    n = len(_segments(width, LEVELS[level]))
    ma, da, mb, db = a[:, at:at + n], a[:, at + n:at + 2 * n], b[:, at:at + n], b[:, at + n:at + 2 * n]
    if pairs is None:
        middle, spread = ma @ mb.T, da @ db.T
    else:
        middle = np.einsum("ij,ij->i", ma[pairs[0]], mb[pairs[1]])
        spread = np.einsum("ij,ij->i", da[pairs[0]], db[pairs[1]])
    slack = 1 + 1e-9 * (np.abs(middle) + spread)  # rounding of the summaries
    return middle - spread - slack, middle + spread + slack


def _exact(a: np.ndarray, b: np.ndarray, pairs: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """Integer inner products; doubles where they are exact, else integers of any size."""
    width = max(a.shape[1], 1)
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)) if pairs is None else len(pairs[0]), dtype=np.int64)
    if width * np.abs(a).max() * np.abs(b).max() < 2.0 ** 53:
        score = a @ b.T if pairs is None else np.einsum("ij,ij->i", a[pairs[0]], b[pairs[1]])
        return score.astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    p, q = whole(a), whole(b)
    score = p @ q.T if pairs is None else np.array([p[i] @ q[j] for i, j in zip(*pairs)], dtype=object)
    return np.clip(score, _LEAST, _MOST).astype(np.int64)


def candidates(a: np.ndarray, sa: np.ndarray, b: np.ndarray, sb: np.ndarray, wanted: np.ndarray, least: np.ndarray, most: np.ndarray):
    """(i, j, score) of the wanted pairs whose score may lie in [least, most] of anchor i, bounds refined level by level."""
    width = a.shape[1]
    low, high = _bounds(sa, sb, width, None, 0)
    left = wanted & (high >= least[:, None]) & (low <= most[:, None])
    i, j = np.nonzero(left)
    for level in range(1, len(LEVELS)):
        if len(i) > _DENSE * left.size or not len(i):
            break
        low, high = _bounds(sa, sb, width, (i, j), level)
        keep = (high >= least[i]) & (low <= most[i])
        i, j = i[keep], j[keep]
    if len(i) > _DENSE * left.size:
        return i, j, _exact(a, b, None)[i, j]
    return i, j, _exact(a, b, (i, j))


class _Best:
    """The first k (score descending, identifier ascending) per list, blocks coming in order of identifier."""

    def __init__(self, lists: int, k: int):
        self.k = k
        self.score = np.full((lists, k), _LEAST, dtype=np.int64)
        self.id = np.zeros((lists, k), dtype=np.int64)
        self.n = np.zeros(lists, dtype=np.int64)

    def needed(self) -> np.ndarray:
        """What a score must reach; a list that is full needs more than its last, as later identifiers lose ties."""
        last = self.score[:, -1]
        return np.where(self.n < self.k, _LEAST, np.where(last == _MOST, _MOST, last + 1))

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids, np.invert(score), rows))
        rows, score, ids = rows[order], score[order], ids[order]
        start = np.r_[0, np.nonzero(np.diff(rows))[0] + 1, len(rows)]
        for a, b in zip(start, start[1:]):
            if a == b:
                continue
            r, b = rows[a], min(b, a + self.k)
            n = self.n[r]
            s, d = np.r_[self.score[r, :n], score[a:b]], np.r_[self.id[r, :n], ids[a:b]]
            first = np.lexsort((d, np.invert(s)))[:self.k]
            self.n[r] = len(first)
            self.score[r, :len(first)], self.id[r, :len(first)] = s[first], d[first]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of one matrix, filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, lengths = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def stored(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           label: Column | None = None, scale: int = 256) -> DataFrame:
    """(id, label, v, summary), one row per identifier: components floor(scale * x), and the segments' means and deviations."""
    x = F.col("x").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), (F.col(f"`{label_col}`") if label is None else label).cast("long").alias("label"),
                          F.col(f"`{vector_col}`").alias("x"))
    finite = F.forall(x, lambda c: F.coalesce((F.abs(c) < float("inf")) & ~F.isnan(c), F.lit(False)))
    # floor() of Spark gives a long; a double beyond its range is an integer as it is.
    part = lambda c: F.when(F.abs(c * scale) < 2.0 ** 62, F.floor(c * scale).cast("double")).otherwise(c * scale)
    valid = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).where(finite)
    once = valid.select("id", "label", F.transform(x, part).alias("v")).groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"))
    plain = written(once.select("id", "r.label", "r.v"))
    width = plain.agg(F.max(F.size("v"))).first()[0] or 0

    def with_summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = summaries(_matrix(batch.column("v"), width))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(s) + 1) * s.shape[1], pa.int32()), pa.array(s.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["id", "label", "v", "summary"])

    out = written(plain.mapInArrow(with_summary, "id long, label long, v array<double>, summary array<double>").sortWithinPartitions("id"))
    dropped(plain)
    out._width = width
    return out


_FOUND = "anchor long, of long, of_score long, id long, score long"


def _search(rows: DataFrame, anchors: list[tuple], width: int, same: bool, limits: dict[int, list[tuple]] | None, k: int, percent: int) -> DataFrame:
    """Of each task's rows the best k per list: of an anchor (rows of its label), or of one of its positives
    (rows of other labels, scores from `percent` of the positive's up to it)."""
    spark = rows.sparkSession
    ids = np.array([a[0] for a in anchors], dtype=np.int64)
    labels = np.array([a[1] for a in anchors], dtype=np.int64)
    v = np.zeros((len(anchors), width))
    for n, a in enumerate(anchors):
        v[n, :len(a[2])] = a[2]
    lists = [(n, None, None) for n in range(len(anchors))] if same else [(n, p, s) for n in range(len(anchors)) for p, s in limits.get(int(ids[n]), [])]
    shared = spark.sparkContext.broadcast((ids, labels, v, summaries(v), lists))
    schema = pa.schema([(c.split()[0], pa.int64()) for c in _FOUND.split(", ")])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, v, summary, lists = shared.value
        best = _Best(len(lists), k)
        who = np.array([n for n, _, _ in lists], dtype=np.int64)
        top = np.array([_MOST if s is None else s for _, _, s in lists], dtype=np.int64)
        floor = np.array([_LEAST if s is None else -(-percent * s // 100) for _, _, s in lists], dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                b, sb = _matrix(part.column("v"), width), _matrix(part.column("summary"), summary.shape[1])
                bid, blabel = part.column("id").to_numpy(), part.column("label").to_numpy()
                for start in range(0, len(lists), _ANCHORS_AT_ONCE):
                    span = slice(start, start + _ANCHORS_AT_ONCE)
                    w = who[span]
                    alike = labels[w][:, None] == blabel
                    wanted = (alike & (ids[w][:, None] != bid)) if same else ~alike
                    least = np.maximum(best.needed()[span], floor[span])
                    i, j, score = candidates(v[w], summary[w], b, sb, wanted, least.astype(np.float64), top[span].astype(np.float64))
                    fits = (score >= least[i]) & (score <= top[span][i])
                    best.add(i[fits] + start, score[fits], bid[j[fits]])
        at, place = np.nonzero(np.arange(k) < best.n[:, None])
        of = np.array([-1 if p is None else p for _, p, _ in lists], dtype=np.int64)
        for s in range(0, len(at), 10_000):
            r, c = at[s:s + 10_000], place[s:s + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[who[r]], of[r], top[r], best.id[r, c], best.score[r, c])], schema=schema)

    return rows.mapInArrow(search, _FOUND)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")  # k rows per task at most
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """rows of `stored`; (anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each of an
    anchor's first `positives` rows of its label the first `negatives` rows of other labels that score from `percent`
    per cent of the positive's score up to it."""
    spark, width = rows.sparkSession, rows._width
    anchors = rows.where(is_anchor).select("id", "label", "v")
    per_group = max(1, GROUP_BYTES // (8 * max(width, 1)))
    groups = 1 + int(anchors.count() / (0.9 * per_group))  # dealt out by hash, so not quite full
    spread = written(anchors.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups))))
    out = []
    for g in [r.group for r in spread.select("group").distinct().orderBy("group").collect()]:
        mine_of = [tuple(r) for r in spread.where(F.col("group") == g).select("id", "label", "v").collect()]
        for at in range(0, len(mine_of), per_group):
            part = mine_of[at:at + per_group]
            near = _first(_search(rows, part, width, True, None, positives, percent), ["anchor"], positives)
            limits: dict[int, list[tuple]] = {}
            for r in near.select("anchor", "id", "score").collect():  # `positives` rows per anchor of the group
                limits.setdefault(r.anchor, []).append((r.id, r.score))
            far = _first(_search(rows, part, width, False, limits, negatives, percent), ["anchor", "of"], negatives)
            out.append(written(far.select(F.col("anchor").alias("anchor_id"), F.col("of").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                                          F.col("id").alias("negative_id"), F.col("of_score").alias("positive_score"), F.col("score").alias("negative_score"))))
    dropped(spread)
    if not out:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    whole = out[0]
    for o in out[1:]:
        whole = whole.unionByName(o)
    return whole


def sql() -> str:
    return """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank, id AS negative_id,
  positive_score, score AS negative_score FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score QUALIFY rank <= 5"""
