"""Cells and probes against brute force: exact with all cells, recall with few, a hot cell in blocks, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanlight.operators import vector_search as vs


def _brute(rows, queries, k):
    ids = np.array([r[0] for r in rows])
    m = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    out = {}
    for q in queries:
        s = np.round(m @ m[list(ids).index(q)], 9)
        out[q] = [int(ids[i]) for i in sorted(np.flatnonzero(ids != q), key=lambda i: (-s[i], ids[i]))[:k]]
    return out


def _lists(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r.neighbour_id)
    return out


@pytest.mark.parametrize("block", [16, 4096])
def test_exact_with_all_cells_and_recall_with_few(spark, monkeypatch, block):
    monkeypatch.setattr(vs, "BLOCK_ROWS", block)  # 16: every cell has several blocks on both sides
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(12, 16))
    rows = [(i, [float(x) for x in middle[0 if i % 3 == 0 else i % 12] + 0.3 * rng.normal(size=16)]) for i in range(1200)]
    rows += [(2000 + i, rows[3][1]) for i in range(25)]  # ties
    vectors = vs.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    centres = vs.fit_cells(vectors, 12)
    indexed = vs.index(vectors, centres)
    asked = vectors.where("id % 40 = 0 OR id = 3")
    want = _brute(rows, [r.id for r in asked.collect()], 10)
    assert _lists(vs.nearest(indexed, centres, asked, 10, len(centres))) == want
    few = _lists(vs.nearest(indexed, centres, asked, 10, 4))
    assert sum(len(set(few[q]) & set(want[q])) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (None, [1.0, 1.0]), (7, [2.0, 0.0]), (7, [2.0, 0.0])]
    vectors = vs.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    centres = vs.fit_cells(vectors)
    assert len(centres) == 1
    indexed = vs.index(vectors, centres)
    assert _lists(vs.nearest(indexed, centres, vectors.where("id = 1"), 10)) == {1: [7, 7]}
    assert _lists(vs.nearest(indexed, centres, vectors.where("id = 7").limit(1), 10)) == {7: [1]}
    none = vectors.where("false")
    centres = vs.fit_cells(none)
    assert vs.nearest(vs.index(none, centres), centres, none).count() == 0


def test_recall_over_the_given_table(spark, data_dir):
    table = spark.read.parquet(f"{data_dir}/embeddings.parquet")
    keys = table.select(F.col("label").cast("string").alias("corpus"), F.col("vec_id").alias("query_id"))
    rows = vs.search_recall(vs.usable(table), F.col("id") % 100 == 0, keys).collect()
    asked = sum(r.queries for r in rows)
    assert asked == table.where("vec_id % 100 = 0").count() and sum(r.queries * r.recall_at_k for r in rows) / asked >= 0.9
