"""Language-model scoring from a log-frequency Bloom filter.

The filter stores quantised counts: an n-gram seen c times has level q = 1 + floor(log2 c), and the pairs
(n-gram, 1) .. (n-gram, q) are members. A count is read back by probing levels until one is missing; the
middle of the level's range stands for the count. Bigrams and words are stored, and the smoothed probability
of word w after h is (c(h w) + MU * p(w)) / (c(h) + MU) with p(w) = (c(w) + 1) / (N + V + 1).

Counting: each task counts its bigrams by 64-bit hash and sends them to buckets by hash, already summed, so a
frequent bigram costs a row per task; a bucket merges its sums and turns them into its part of the bits. All
n-grams of training documents are counted, so the filter grows with the corpus. It is cut into groups by the
last word, each at most about FILTER_BYTES, and a group is broadcast to the workers while all documents pass by.
log P is a sum of a term of w's group and a term of h's group, so the groups' results add up; a corpus whose
filter fits one group needs one pass.

The base score needs exact counts. The HOT_WORDS most frequent words are looked up in a broadcast table of that
size; the rest, at most a few per document, meet their counts in a join by word.

Defined cases: null text is empty and has the end token alone; rows without identifier are scored but not learned
from; repeated rows count and are scored each; without training rows all probabilities are 1 / (N + V + 1) = 1;
an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

END = "\n"  # ends each text, and is the context of its first word; no word can be a line feed
MU = 100.0
HASHES = 4
BITS_PER_ITEM = HASHES / math.log(2)
FILTER_BYTES = 128 * 1024 * 1024
BUCKET_NGRAMS = 2_000_000
HOT_WORDS = 200_000
CHUNK_TOKENS = 600_000
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def word_keys(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))


def bigram_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mixed(first * _M1 + (second ^ _M3))


@dataclass(frozen=True)
class Layout:
    """Groups by last word, and buckets of a group by n-gram."""

    groups: int
    buckets: int

    def group(self, last: np.ndarray) -> np.ndarray:
        return _mixed(last + _M1) % np.uint64(self.groups)

    def bucket(self, group: np.ndarray, key: np.ndarray) -> np.ndarray:
        return (group * np.uint64(self.buckets) + _mixed(key ^ _M1) % np.uint64(self.buckets)).astype(np.int64)


# the filter ------------------------------------------------------------
def level(count: np.ndarray) -> np.ndarray:
    return np.frexp(count.astype(np.float64))[1]  # 1 + floor(log2 c)


def stands_for(levels: np.ndarray) -> np.ndarray:
    """Middle of the counts of a level: 0, 1, 2.5, 5.5, ..."""
    return np.where(levels > 0, (3 * 2.0 ** (levels - 1) - 1) / 2, 0.0)


def _places(keys: np.ndarray, at_level: int, size: np.ndarray) -> Iterator[np.ndarray]:
    a = _mixed(keys + np.uint64(at_level * int(_M1) % 2**64))
    b = _mixed(a ^ _M2) | np.uint64(1)
    for i in range(HASHES):
        yield (a + np.uint64(i) * b) % size


def build_bits(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """The bits of one bucket from its distinct n-grams."""
    levels = level(counts)
    size = np.uint64(max(64, math.ceil(float(levels.sum()) * BITS_PER_ITEM)))
    marks = np.zeros(int(size), dtype=bool)
    for j in range(1, int(levels.max(initial=0)) + 1):
        for place in _places(keys[levels >= j], j, size):
            marks[place] = True
    return int(size).to_bytes(8, "little") + np.packbits(marks, bitorder="little").tobytes()


class Filter:
    """The buckets of one group, as the workers hold them."""

    def __init__(self, parts: Iterable[tuple[int, bytes]], first: int, buckets: int):
        self.first = first
        self.size, lengths, bits = np.zeros(buckets, dtype=np.uint64), np.zeros(buckets, dtype=np.int64), []
        for bucket, part in sorted(parts):
            self.size[bucket - first] = int.from_bytes(part[:8], "little")
            lengths[bucket - first] = len(part) - 8
            bits.append(memoryview(part)[8:])
        self.start = np.concatenate([[0], np.cumsum(lengths)]).astype(np.uint64)
        self.bits = np.frombuffer(b"".join(bits), dtype=np.uint8)

    def counts(self, keys: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Counts by repeated probes: level after level until one is missing."""
        levels = np.zeros(len(keys), dtype=np.int64)
        local = buckets - self.first
        alive = np.flatnonzero(self.size[local] > 0)
        j = 1
        while len(alive):
            size, start = self.size[local[alive]], self.start[local[alive]]
            hit = np.ones(len(alive), dtype=bool)
            for place in _places(keys[alive], j, size):
                hit &= (self.bits[start + (place >> np.uint64(3))] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            alive = alive[hit]
            levels[alive] = j
            j += 1
        return stands_for(levels)


# tokens ------------------------------------------------------------------
@dataclass
class Chunk:
    """Tokens of some documents: word numbers with an end before the first and after each document."""

    words: list[bytes]
    numbers: np.ndarray
    doc: np.ndarray  # of each token
    rows: list[tuple]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """Cut the stream (.., text) into chunks of bounded size; the text is the last column."""
    end = END.encode()
    flat, doc, rows = [end], [], []

    def chunk() -> Chunk:
        coded = pa.array(flat, pa.binary()).dictionary_encode()
        lengths = np.array(doc, dtype=np.int64)
        return Chunk(coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.repeat(np.arange(len(lengths)), lengths), rows)

    for batch in batches:
        others = [c.to_pylist() for c in batch.columns[:-1]]
        for i, text in enumerate(batch.columns[-1]):
            words = (text.as_py() or "").encode().lower().split()
            flat += words
            flat.append(end)
            doc.append(len(words) + 1)
            rows.append(tuple(c[i] for c in others))
            if len(flat) >= CHUNK_TOKENS:
                yield chunk()
                flat, doc, rows = [end], [], []
    if rows:
        yield chunk()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts of (text), ends included."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            n = np.bincount(c.numbers[1:], minlength=len(c.words))
            yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in c.words]), pa.array(n)], names=["word", "n"])

    return texts.select("text").mapInArrow(of, "word string, n long").where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))


def _buckets_of(keys: np.ndarray, counts: np.ndarray, group: np.ndarray, layout: Layout) -> pa.RecordBatch:
    """Rows (bucket, keys, counts) of packed n-grams, summed by key."""
    bucket = layout.bucket(group, keys)
    order = np.lexsort((keys, bucket))
    keys, counts, bucket = keys[order], counts[order], bucket[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = (keys[1:] != keys[:-1]) | (bucket[1:] != bucket[:-1])
    at = np.flatnonzero(first)
    counts = np.add.reduceat(counts, at) if len(at) else counts
    keys, bucket = keys[at], bucket[at]
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = [*cut[1:].tolist(), len(keys)]
    return pa.RecordBatch.from_arrays([
        pa.array(bucket[cut], pa.int64()),
        pa.array([keys[a:b].astype("<u8").tobytes() for a, b in zip(cut.tolist(), ends)], pa.binary()),
        pa.array([counts[a:b].astype("<u8").tobytes() for a, b in zip(cut.tolist(), ends)], pa.binary())],
        names=["bucket", "keys", "counts"])


_BUCKETED = "bucket long, keys binary, counts binary"


def bigram_buckets(texts: DataFrame, layout: Layout) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches):
            key = word_keys(c.words)[c.numbers]
            last = key[1:]
            pair = bigram_keys(key[:-1], last)
            order = np.argsort(pair, kind="stable")
            pair, last = pair[order], last[order]
            at = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
            yield _buckets_of(pair[at], np.diff(at, append=len(pair)).astype(np.uint64), layout.group(last[at]), layout)

    return texts.select("text").mapInArrow(of, _BUCKETED)


def word_buckets(counts: DataFrame, layout: Layout) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = word_keys([w.encode() for w in batch.column(0).to_pylist()])
                yield _buckets_of(keys, batch.column(1).to_numpy().astype(np.uint64), layout.group(keys), layout)

    return counts.select("word", "n").mapInArrow(of, _BUCKETED)


def filter_parts(bucketed: DataFrame) -> DataFrame:
    """(bucket, bits): each bucket merges what the tasks counted and builds its bits."""
    def of(rows: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(k, "<u8") for k in rows["keys"].to_pylist()])
        counts = np.concatenate([np.frombuffer(c, "<u8") for c in rows["counts"].to_pylist()])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return pa.table({"bucket": pa.array([rows["bucket"][0].as_py()], pa.int64()),
                         "bits": pa.array([build_bits(keys[at], np.add.reduceat(counts, at))], pa.binary())})

    return bucketed.groupBy("bucket").applyInArrow(of, "bucket long, bits binary")


# scoring -------------------------------------------------------------------
_SCORED = ("n long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double, "
           "rare array<struct<word:string,tf:long>>")


def _hot_words(counts: DataFrame, most: int) -> dict[str, int]:
    """The most frequent words, at most so many, by whole steps of count (about one in a hundred each)."""
    step = F.floor(F.log(F.col("n")) * 100).cast("long")
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.col("step").desc()).collect()
    taken, least = 0, None
    for s in steps:  # a few thousand steps at any size
        taken += s.words
        if taken > most:
            break
        least = s.step
    return {} if least is None else {r.word: r.n for r in counts.where(step >= least).collect()}


def _score_pass(docs: DataFrame, bits: Filter, layout: Layout, group: int, hot: dict[str, int] | None,
                total: int, kinds: int) -> DataFrame:
    """Partial scores of all documents from one group; with `hot` also the base score of its words and the rare words."""
    held = docs.sparkSession.sparkContext.broadcast((bits, hot))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, frequent = held.value
        room = total + kinds + 1
        for c in chunks(batches):
            n_docs = len(c.rows)
            keys = word_keys(c.words)
            mine = layout.group(keys) == group
            of_word = np.zeros(len(keys))
            of_word[mine] = counts.counts(keys[mine], layout.bucket(np.full(mine.sum(), group, np.uint64), keys[mine]))
            context = np.where(mine, -np.log10(of_word + MU), 0.0)  # the term of a context in this group
            spread = (of_word + 1) / room
            last = c.numbers[1:]
            here = np.flatnonzero(mine[last])
            pair, back = np.unique(c.numbers[:-1][here].astype(np.int64) * len(keys) + last[here], return_inverse=True)
            before, after = pair // max(1, len(keys)), pair % max(1, len(keys))
            pair_keys = bigram_keys(keys[before], keys[after])
            seen = counts.counts(pair_keys, layout.bucket(np.full(len(pair), group, np.uint64), pair_keys))
            joint = np.log10(np.minimum(seen, of_word[after]) + MU * spread[after])
            score = (np.bincount(c.doc[here], weights=joint[back], minlength=n_docs)
                     + np.bincount(c.doc, weights=context[c.numbers[:-1]], minlength=n_docs))
            n_tokens, known, base = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64), np.zeros(n_docs)
            rare = pa.ListArray.from_arrays(np.zeros(n_docs + 1, np.int32), pa.array([], rare_kind))
            if frequent is not None:
                exact = np.array([frequent.get(w.decode(), -1) for w in c.words], dtype=np.int64)
                is_hot = exact[last] >= 0
                n_tokens = np.bincount(c.doc, minlength=n_docs)
                known = np.bincount(c.doc[is_hot], minlength=n_docs)
                base = np.bincount(c.doc[is_hot], weights=np.log10((exact[last[is_hot]] + 1) / room), minlength=n_docs)
                cold, tf = np.unique(c.doc[~is_hot] * len(keys) + last[~is_hot], return_counts=True)
                words = pa.array(c.words, pa.binary()).cast(pa.string()).take(pa.array(cold % len(keys)))
                starts = np.searchsorted(cold // len(keys), np.arange(n_docs + 1)).astype(np.int32)
                rare = pa.ListArray.from_arrays(starts, pa.StructArray.from_arrays([words, pa.array(tf, pa.int64())], fields=list(rare_kind)))
            cols = [[r[0] for r in c.rows], [r[1] for r in c.rows], [r[2] for r in c.rows]]
            yield pa.RecordBatch.from_arrays([
                pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.bool_()),
                pa.array(n_tokens, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64()), rare],
                names=["n", "doc_id", "held_out", "n_tokens", "known", "base", "score", "rare"])

    rare_kind = pa.struct([pa.field("word", pa.string()), pa.field("tf", pa.int64())])
    return docs.select("n", "doc_id", "held_out", "text").mapInArrow(of, _SCORED)


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
          filter_bytes: int = FILTER_BYTES, hot_words: int = HOT_WORDS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `held_out` is a condition on the documents; rows where it is false are learned from, where it is null not.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("n"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"), held_out.alias("h"), F.col(f"`{text_col}`").alias("text"))
    training = rows.where("NOT h")
    counts = written(word_counts(training))
    facts = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("kinds")).first()
    # An upper bound of the filter: every token a new bigram, every level of every word.
    groups = max(1, math.ceil(1.5 * facts.total * BITS_PER_ITEM / 8 / filter_bytes))
    layout = Layout(groups, max(8, math.ceil(facts.total / groups / BUCKET_NGRAMS)))
    parts = written(filter_parts(bigram_buckets(training, layout).unionByName(word_buckets(counts, layout))))
    hot = _hot_words(counts, hot_words)
    passes = None
    for group in range(groups):
        of_group = F.col("bucket").between(group * layout.buckets, (group + 1) * layout.buckets - 1)
        bits = Filter(map(tuple, parts.where(of_group).toLocalIterator()), group * layout.buckets, layout.buckets)  # about filter_bytes
        part = _score_pass(rows, bits, layout, group, hot if group == 0 else None, facts.total, facts.kinds)
        passes = part if passes is None else passes.unionByName(part)

    at = F.posexplode_outer("rare").alias("at", "r")
    once = lambda c: F.when(F.coalesce(F.col("at"), F.lit(0)) == 0, F.col(c))
    spread = passes.select("*", at).select(
        "n", "doc_id", "held_out", *[once(c).alias(c) for c in ("n_tokens", "known", "base", "score")],
        # a document without rare words has a key of its own, which no word can be
        F.coalesce("r.word", F.concat(F.lit(END), F.col("n").cast("string"))).alias("word"), F.coalesce("r.tf", F.lit(0)).alias("tf"))
    joined = spread.join(counts.withColumnRenamed("n", "c"), "word", "left")
    room = facts.total + facts.kinds + 1
    return joined.groupBy("n").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        (F.sum("known") + F.sum(F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0))).alias("n_known"),
        F.lit(facts.total).cast("long").alias("train_tokens"),
        (F.sum("base") + F.sum(F.col("tf") * F.log10((F.coalesce("c", F.lit(0)) + 1) / F.lit(float(room))))).alias("base_score"),
        F.sum("score").alias("score")).drop("n")
