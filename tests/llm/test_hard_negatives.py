"""Hard negatives against brute force; bounds against exact scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanlight.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v int, summary string, rank int"


def _table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA)


def _brute(rows):
    best = {}
    for i, x, label in rows:
        if i is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        v = [math.floor(256 * float(np.float32(c))) for c in x]
        best[i] = min(best.get(i, (label, v)), (label, v))
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for a, (label, v) in best.items():
        if a % 10:
            continue
        scored = sorted((-dot(v, w), i, m) for i, (m, w) in best.items() if i != a)
        for s, p, m in [r for r in scored if r[2] == label][:5]:
            hard = [(i, -t) for t, i, m in scored if m != label and 80 * -s <= 100 * -t <= 100 * -s][:5]
            out += [(a, p, n, i, -s, t) for n, (i, t) in enumerate(hard, 1)]
    return sorted(out)


def _found(spark, rows):
    got = hn.mine(hn.stored(_table(spark, rows)), F.col("id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def test_brute_force_with_hot_vector_ties_and_gaps(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 19))
    rows = [(int(i), (centres[i % 6] + rng.normal(size=19) * 0.4).astype(np.float32).tolist(), int(i * 7 % 4)) for i in range(300)]
    rows += [(int(i), centres[0].astype(np.float32).tolist(), int(i % 3)) for i in range(300, 450)]  # a third of all rows alike
    rows += [(1, None, 1), (None, [1.0] * 19, 1), (500, [1.0] * 18 + [None], 1), (510, [float("nan")] + [1.0] * 18, 1), (520, [float("inf")] * 19, 2),
             (530, [1.0] * 19, None), (540, [], 1), (550, [2.0] * 5, 2), (20, rows[20][1], rows[20][2]), (30, [9.0] * 19, 0), (-100, [0.5] * 19, 3), (560, [-1e9] * 19, 7)]
    want = _brute(rows)
    assert len(want) > 500 and _found(spark, rows) == want
    monkeypatch.setattr(hn, "GROUP_BYTES", 8 * 19 * 10)  # ten anchors to a group
    monkeypatch.setattr(hn, "BLOCK_ROWS", 7)
    assert _found(spark, rows) == want


def test_huge_components_stay_exact(spark):
    rows = [(i, [float(2 ** 20 + i), float(2 ** 18 - 3 * i)], i % 2) for i in range(30)]
    assert _found(spark, rows) == _brute(rows) != []


def test_empty_and_lonely(spark):
    assert _found(spark, []) == []
    assert _found(spark, [(10, [1.0], 1)]) == [] and _found(spark, [(10, [1.0], 1), (11, [1.0], 2)]) == []


@pytest.mark.parametrize("width", [1, 3, 8, 64])
def test_bounds_hold_and_prune(width):
    rng = np.random.default_rng(width)
    a, b = np.floor(rng.normal(size=(40, width)) * 99), np.floor(rng.normal(size=(50, width)) * 99 + rng.normal(size=(50, 1)) * 300)
    exact, last = a @ b.T, None
    i, j = (x.reshape(-1) for x in np.indices(exact.shape))
    for level in range(len(hn.LEVELS)):
        low, high = hn._bounds(hn.summaries(a), hn.summaries(b), width, (i, j), level)
        score = exact[i, j]
        assert (low <= score).all() and (score <= high).all()
        spread = (high - low).mean()
        assert last is None or spread <= last * 1.001 + 1
        last = spread
    least = np.full(40, np.quantile(exact, 0.99))
    found = hn.candidates(a, hn.summaries(a), b, hn.summaries(b), np.ones(exact.shape, bool), least, np.full(40, np.inf))
    assert {(p, q) for p, q, s in zip(*found) if s >= least[0]} == set(zip(*np.nonzero(exact >= least[0])))


def test_query_matches_sql(spark, duck, data_dir):
    from spanlight.llm.queries import ORACLE_SQL, QUERIES

    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = QUERIES["op11_hard_negatives"](spark, data_dir).select(*cols).collect()
    assert sorted(map(tuple, got)) == sorted(duck.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE_SQL['op11_hard_negatives']})").fetchall())
