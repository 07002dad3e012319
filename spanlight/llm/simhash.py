"""SimHash near-dedup with pigeonring filtering.

A fingerprint has 64 bits on 3-word shingles. Two fingerprints link when at most `max_bits` bits
differ. Pigeonring principle: cut the ring of 64 bits into m segments; if two fingerprints differ in
at most t bits, some start exists from which every chain of l consecutive segments differs in at most
floor(l*t/m) bits. The chains whose budget is zero form the join key (for t=2, m=16: seven segments,
28 bits); the longer chains prune a pair before its full Hamming check.

Copies share a fingerprint, so all work is on distinct fingerprints. A key shared by more than
DENSE of them (a cloud of near copies) is not expanded into pairs: its members are
linked through the fingerprints that lie one flipped bit away, which connects exactly the pairs
within two bits by at most 65 rows each. Components come from alternating star contraction, each
round written to the shared folder.

Defined cases: null text and text without words have fingerprint 0 and are linked like any other;
null identifiers sort last; of repeated rows one stays; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, written

BITS = 64
SEGMENTS = 16
MAX_BITS = 2
SHINGLE = 3
DENSE = 8
_SEED = 42


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the shingles' XXH64; repeats count. bytes.lower and bytes.split act on ASCII only."""
    words = text.lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), _SEED)
    line = b" ".join(words)
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = [s - 1 for s in starts[shingle:]] + [len(line)]
    hashes = np.array([digest(line[a:b], _SEED) for a, b in zip(starts, ends)], dtype="<u8")
    planes = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.zeros((8, 8), dtype=np.int64)
    for i in range(0, len(planes), 65536):
        ones += np.unpackbits(planes[i:i + 65536], axis=1, bitorder="little").sum(0, dtype=np.int64).reshape(8, 8)
    return int(np.packbits(ones.reshape(-1) * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a signed long."""
    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        out = np.fromiter((fingerprint(t.as_py().encode(), shingle) for t in texts), dtype=np.uint64, count=len(texts))
        return pa.array(out.view(np.int64))

    return of(F.coalesce(text, F.lit("")))


def _signed(v: int) -> int:
    return v - (1 << BITS) if v >> (BITS - 1) else v


def _mask(start: int, length: int, segments: int) -> int:
    width = BITS // segments
    return _signed(sum(((1 << width) - 1) << (width * ((start + j) % segments)) for j in range(length)))


def _budget(length: int, max_bits: int, segments: int) -> int:
    return length * max_bits // segments


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints `fp` within max_bits (1 or 2) of each other."""
    if BITS % segments or segments <= max_bits or not 1 <= max_bits <= 2:
        raise ValueError("segments must divide 64 and exceed max_bits, which is 1 or 2")
    clean = max(n for n in range(1, segments) if _budget(n, max_bits, segments) == 0)
    keys = F.explode(F.array(*[
        F.struct(F.lit(i).alias("start"), F.col("fp").bitwiseAND(F.lit(_mask(i, clean, segments))).alias("key"))
        for i in range(segments)])).alias("k")
    placed = fps.select("fp", keys).select("fp", "k.start", "k.key")
    shared = placed.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    hits = written(placed.join(shared, ["start", "key"]))

    few = hits.where(F.col("n") <= dense).select("start", "key", "fp")
    pairs = few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), ["start", "key"]).where("a < b")
    differs = F.col("a").bitwiseXOR(F.col("b"))
    # The chains beyond the key, each judged by the masks of the pair's own start.
    for length in range(clean + 1, segments):
        masks = F.array(*[F.lit(_mask(i, length, segments)) for i in range(segments)])
        within = F.bit_count(differs.bitwiseAND(F.element_at(masks, F.col("start") + 1)))
        if _budget(length, max_bits, segments) < _budget(length + 1, max_bits, segments) or length == clean + 1:
            pairs = pairs.where(within <= _budget(length, max_bits, segments))
    near = pairs.where(F.bit_count(differs) <= max_bits).select("a", "b")

    flips = [0] + [_signed(1 << i) for i in range(BITS)]
    cloud = hits.where(F.col("n") > dense).select("fp").distinct()
    if max_bits == 2:
        around = cloud.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(f)) for f in flips])).alias("variant"))
        stars = (around.groupBy("variant").agg(F.array_sort(F.collect_list("fp")).alias("members"))  # 65 members at most
                 .where(F.size("members") > 1)
                 .select(F.element_at("members", 1).alias("a"), F.explode(F.slice("members", 2, BITS)).alias("b")))
    else:
        around = cloud.select("fp", F.explode(F.array(*[
            F.struct(F.lit(i).alias("bit"), F.col("fp").bitwiseAND(F.lit(_signed(((1 << BITS) - 1) ^ (1 << i)))).alias("rest"))
            for i in range(BITS)])).alias("v"))
        stars = (around.groupBy("v").agg(F.array_sort(F.collect_list("fp")).alias("members"))  # 2 members at most
                 .where(F.size("members") > 1)
                 .select(F.element_at("members", 1).alias("a"), F.element_at("members", 2).alias("b")))
    edges = written(near.unionByName(stars).distinct())
    dropped(hits)
    return edges


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has an edge.

    Alternating large-star and small-star contraction; each round is two joins, written, and rounds
    grow with the logarithm of the diameter, not with the size of a component.
    """
    state = written(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi > lo").distinct())
    while True:
        both = state.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            state.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(least, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .unionByName(least.select("hi", F.col("m").alias("lo"))).where("hi > lo").distinct())
        after = written(small)
        mark = [F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("hi", "lo")), F.lit(0))]
        done = after.agg(*mark).first() == state.agg(*mark).first()
        dropped(state)
        state = after
        if done:
            return state.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
                state.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())


def _keepers(printed: DataFrame, max_bits: int) -> DataFrame:
    """(fp, rep): of each distinct fingerprint, the row that stays in its component."""
    order = F.struct(F.col("id").isNull().alias("unknown"), F.col("id"), F.col("n"))
    fps = written(printed.groupBy("fp").agg(F.min(order).alias("rep")))
    roots = components(links(fps.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = fps.join(roots, "fp", "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    stays = rooted.groupBy("root").agg(F.min("rep").alias("rep"))
    return rooted.select("fp", "root").join(stays, "root").select("fp", "rep")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS,
                shingle: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    printed = written(docs.select(F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("n"),
                                  fingerprints(F.col(f"`{text_col}`"), shingle).alias("fp")))
    return printed.join(_keepers(printed, max_bits), "fp").select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("rep.id").alias("component_id"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS,
               shingle: int = SHINGLE) -> DataFrame:
    """One row of each component, the one with the smallest id, with all its columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    printed = written(docs.select(row.alias("row"), F.monotonically_increasing_id().alias("n"))
                      .select("row", "n", F.col("row")[id_col].alias("id"), fingerprints(F.col("row")[text_col], shingle).alias("fp")))
    stays = _keepers(printed.select("id", "n", "fp"), max_bits).select(F.col("rep.n").alias("n")).distinct()
    return printed.join(stays, "n", "left_semi").select("row.*")
