"""Nearest vectors by cosine similarity: cells around centroids, exact scores inside the cells that a query probes.

`fit_cells` learns centroids (spherical k-means) from at most `sample_rows` rows; `index` puts every row into its nearest cell.
A search scores the rows of a query's `probes` nearest cells; with as many probes as cells it is exact. Rows and probing
queries of a cell are cut into blocks by a hash of row and identifier, so a cell that holds a third of all rows is spread
over many tasks: a task multiplies one block of rows by one block of queries and hands on the best k per query.

Defined cases: vectors that are null, empty, of length zero or with a null or non-finite component, and null identifiers,
take no part; a row is no neighbour of its own identifier; equal similarities (to nine digits) go by smaller identifier; a
repeated row is a neighbour once per copy; empty tables give no rows. All vectors must have one dimension.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .order_stats import top_per_group

CELLS = 32
PROBES = 24  # of 32 cells; see the module's text
SAMPLE_ROWS = 20_000  # bounds what the driver reads to fit the centroids; every row is indexed
BLOCK_ROWS = 4096


def usable(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(id, vec) of the rows that take part."""
    v = F.col(embedding)
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return rows.select(F.col(vec_id).cast("long").alias("id"), v.cast("array<float>").alias("vec")).where(
        F.col("id").isNotNull() & F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False)))


def _matrix(vecs: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Unit vectors, one per row."""
    whole = vecs.combine_chunks() if isinstance(vecs, pa.ChunkedArray) else vecs
    m = whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(whole), -1)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def fit_cells(vectors: DataFrame, cells: int = CELLS, sample_rows: int = SAMPLE_ROWS, rounds: int = 10) -> np.ndarray:
    """Centroids as unit vectors; fewer than `cells` if the sample has fewer distinct vectors."""
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("vec").toArrow()
    if not sample.num_rows:
        return np.zeros((0, 0))
    x = _matrix(sample["vec"])
    distinct = np.unique(x, axis=0)
    centres = distinct[np.random.default_rng(0).permutation(len(distinct))[:cells]]
    for _ in range(rounds):
        near = np.argmax(x @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(norms > 0, sums / np.where(norms > 0, norms, 1), centres)
    return centres


def _in_cells(vectors: DataFrame, centres: np.ndarray, n: int) -> DataFrame:
    """(id, vec, cell): a row for each of the n nearest cells."""
    held = vectors.sparkSession.sparkContext.broadcast(centres)  # cells x dimension numbers

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                near = np.argsort(-(_matrix(b.column(1)) @ held.value.T), axis=1, kind="stable")[:, :n]
                rows = pa.array(np.repeat(np.arange(b.num_rows), near.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(rows), b.column(1).take(rows), pa.array(near.ravel().astype(np.int32))], names=["id", "vec", "cell"])

    return vectors.select("id", "vec").mapInArrow(of, "id long, vec array<float>, cell int")


def index(vectors: DataFrame, centres: np.ndarray) -> DataFrame:
    """(id, vec, cell, salt) of every row, written once; the salt tells copies of one identifier apart."""
    placed = _in_cells(vectors, centres, 1)
    return cut_lineage(placed.withColumn("salt", F.xxhash64("id", F.monotonically_increasing_id())))


def _blocks(rows: DataFrame, name: str) -> DataFrame:
    """(cell, blocks) of a table; one row per cell."""
    return rows.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias(name))


def nearest(indexed: DataFrame, centres: np.ndarray, queries: DataFrame, k: int = 10, probes: int = PROBES) -> DataFrame:
    """(query_id, neighbour_id, similarity, rank) of queries (id, vec)."""
    asked = cut_lineage(_in_cells(queries, centres, probes).withColumn("salt", F.xxhash64("id")))
    # One row per cell, whatever the size of the data.
    counts = F.broadcast(_blocks(indexed, "n_rows").join(_blocks(asked, "n_asked"), "cell"))
    own = lambda n: F.pmod("salt", F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["cell", "row_block", "asked_block"]
    left = indexed.join(counts, "cell").select("id", "vec", "cell", own("n_rows").alias("row_block"), every("n_asked").alias("asked_block"))
    right = asked.join(counts, "cell").select("id", "vec", "cell", own("n_asked").alias("asked_block"), every("n_rows").alias("row_block"))

    def best(rows: pa.Table, questions: pa.Table) -> pa.Table:
        q_out, id_out, s_out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if rows.num_rows and questions.num_rows:
            ids, asking = rows["id"].to_numpy(), questions["id"].to_numpy()
            scores = np.round(_matrix(questions["vec"]) @ _matrix(rows["vec"]).T, 9)
            scores[asking[:, None] == ids[None, :]] = -np.inf
            kth = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else np.full(len(asking), -2.0)
            for i, q in enumerate(asking):
                at = np.flatnonzero((scores[i] >= kth[i]) & (scores[i] > -2))
                at = at[np.lexsort((ids[at], -scores[i][at]))[:k]]
                q_out.append(np.full(len(at), q))
                id_out.append(ids[at])
                s_out.append(scores[i][at])
        return pa.table({"query_id": np.concatenate(q_out), "neighbour_id": np.concatenate(id_out), "similarity": np.concatenate(s_out)})

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best, "query_id long, neighbour_id long, similarity double")
    return top_per_group(found, ["query_id"], [F.col("similarity").desc(), F.col("neighbour_id")], k)


def search_recall(vectors: DataFrame, is_query: Column, keys: DataFrame, k: int = 10, cells: int = CELLS, probes: int = PROBES) -> DataFrame:
    """Recall@k of the probing search against the exact one, per value of `corpus` in keys (corpus, query_id)."""
    from .quality import recall_at_k
    centres = fit_cells(vectors, cells)
    indexed = index(vectors, centres)
    asked = vectors.where(is_query)
    exact = nearest(indexed, centres, asked, k, len(centres)).join(keys, "query_id").select("corpus", "query_id", F.col("neighbour_id").alias("doc_id"))
    found = nearest(indexed, centres, asked, k, probes).select("query_id", F.col("neighbour_id").alias("doc_id"), F.col("similarity").alias("score"))
    return recall_at_k(found, exact, k)
