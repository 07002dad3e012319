"""Prefix trie of conversations by parallel tree contraction.

Nodes are the distinct sequences of first turns. A turn is known by the SHA-256 of role and text, a sequence by
the exclusive or of the SHA-256 of (position, turn), so the keys of all prefixes are running exclusive ors. These and
the positions are made in two steps, per range of rows and inside one, so that no task holds a whole conversation.

Subtree totals: each round takes all leaves away (rake: their totals go to their parents, added up before the
shuffle) and, of the unary chains, nodes that are the least of their neighbours by a hash of the round (compress: the
only child moves up and carries the removed node's value on its edge). Rounds grow with the logarithm of the size,
whatever the shape. Then the rounds are undone in reverse order: the total of a removed chain node is that of the child
it had, plus what was kept aside. All joins but those to a parent are one row to one row.

The identifiers of the conversations that end at a node are joined to texts of at most 4,096 neighbouring identifiers;
these are hashed one after another, so that a node where a third of all conversations end is never held in one piece.

Defined cases: a null role or text is empty; a null turn comes first; turns of one number are ordered by the SHA-256 of
(length of role, role, text); fully repeated rows are turns of their own; rows without a conversation identifier take
no part; turns and texts may be of any length; an empty table gives an empty table, without a root. Columns other than
the four named ones are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, written

_WORD = r"[^\x20\x09-\x0D]+"
LANES = ["k1", "k2", "k3", "k4"]
_BLOCK = 1024
_ID_BITS = 12


# --------------------------------------------------------------------------
# Turns
# --------------------------------------------------------------------------
def positions(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, turn_sha, words), each conversation in the order of its turns.

    Rows are range-partitioned by that order, so a long conversation fills several tasks; a row's position is its place
    inside its task plus the conversation's rows in the tasks before.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    sha = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    thin = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(sha).alias("turn_sha"), F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("turn_sha")]
    placed = written(thin.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
                     .select("conv_id", "turn_sha", "words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    inside = Window.partitionBy("conv_id", "part").orderBy("at")
    parts = placed.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task that holds some of it
    shifts = parts.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")).where("shift > 0")
    return (placed.withColumn("place", F.row_number().over(inside)).join(shifts, ["conv_id", "part"], "left")
            .select("conv_id", (F.col("place") + F.coalesce("shift", F.lit(0))).cast("long").alias("pos"), "turn_sha", "words"))


def with_shared_starts(turns: DataFrame, period: int = 20, longest: int = 4) -> DataFrame:
    """(conv_id, pos, turn_sha, words): conversation c begins with the first h turns of c - c % period (all of them if
    there are fewer), h = crc32(c as text) % longest, and goes on with its own turns after its first h. Conversations
    that are left without turns have one row at position 0.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).cast("long")
    lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    convs = lengths.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % period).alias("base"))
    bases = lengths.where(F.col("conv_id") % period == 0).select(F.col("conv_id").alias("base"), "n")
    convs = written(convs.join(bases, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("taken")))
    # At most `longest` - 1 turns of a base go to the 2 * period - 1 identifiers around it at most.
    heads = turns.where((F.col("conv_id") % period == 0) & (F.col("pos") < longest)).withColumnRenamed("conv_id", "base")
    begun = convs.where("taken > 0").join(heads, "base").where("pos <= taken").select("conv_id", "pos", "turn_sha", "words")
    own = turns.join(convs, "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn_sha", "words")
    empty = convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("turn_sha"), F.lit(0).cast("long").alias("words"))
    return begun.unionByName(own).unionByName(empty)


# --------------------------------------------------------------------------
# Nodes
# --------------------------------------------------------------------------
def _keyed(turns: DataFrame) -> DataFrame:
    """Each turn with the key k1..k4 of the sequence up to and with it, and its own part o1..o4 of that key."""
    sha = F.sha2(F.concat(F.col("pos").cast("string").cast("binary"), F.lit(b":"), F.col("turn_sha")), 256)
    part = lambda i: F.conv(F.substring("own", 16 * i + 1, 16), 16, -10).cast("long")
    lanes = [F.when(F.col("pos") > 0, part(i)).otherwise(F.lit(0)).alias(f"o{i + 1}") for i in range(4)]
    own = written(turns.withColumn("own", sha).select("conv_id", "pos", "words", *lanes, F.floor(F.col("pos") / _BLOCK).alias("block")))
    running = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per _BLOCK turns
    sums = own.where(F.col("pos") >= 0).groupBy("conv_id", "block").agg(*[F.bit_xor(f"o{i}").alias(f"b{i}") for i in range(1, 5)])
    carried = sums.select("conv_id", "block", *[F.coalesce(F.bit_xor(f"b{i}").over(before), F.lit(0)).alias(f"b{i}") for i in range(1, 5)]).where("block > 0")
    inside = own.select("*", *[F.bit_xor(f"o{i}").over(running).alias(f"r{i}") for i in range(1, 5)])
    return inside.join(carried, ["conv_id", "block"], "left").select(
        "conv_id", "pos", "words", *[F.col(f"o{i}") for i in range(1, 5)],
        *[F.col(f"r{i}").bitwiseXOR(F.coalesce(f"b{i}", F.lit(0))).alias(f"k{i}") for i in range(1, 5)])


def _digests(ends: DataFrame) -> DataFrame:
    """ends (pos, keys, conv_id) -> (pos, keys, ends_sha256): the ascending identifiers, comma-joined, hashed."""
    texts = ends.groupBy("pos", *LANES, F.shiftright("conv_id", _ID_BITS).alias("block")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))  # 4,096 identifiers at most
    schema = pa.schema([("pos", pa.int64()), *[(k, pa.int64()) for k in LANES], ("ends_sha256", pa.string())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            done = []
            columns = [batch.column(n).to_pylist() for n in ["pos", *LANES, "ids"]]
            for *node, ids in zip(*columns):
                if node == now:
                    sha.update(b"," + ids.encode())
                else:
                    if now is not None:
                        done.append([*now, sha.hexdigest()])
                    now, sha = node, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema) if done else pa.RecordBatch.from_pylist([], schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, [*now, sha.hexdigest()]))], schema=schema)

    placed = texts.repartition("pos", *LANES).sortWithinPartitions("pos", *LANES, "block")
    return placed.mapInArrow(hashed, "pos long, k1 long, k2 long, k3 long, k4 long, ends_sha256 string")


# --------------------------------------------------------------------------
# Tree contraction
# --------------------------------------------------------------------------
def subtree_sums(tree: DataFrame, values: list[str]) -> DataFrame:
    """(id, one sum per value over the node and all below it) of a forest (id, parent or null at a root, values long)."""
    weights = [f"w_{v}" for v in values]
    active = written(tree.select("id", "parent", *values, *[F.lit(0).cast("long").alias(w) for w in weights]))
    tables, rounds = [active], []
    while True:
        kids = active.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("child"))
        nodes = written(active.join(kids, "id", "left"))
        leaves = nodes.where("n IS NULL")
        if nodes.where("n IS NOT NULL").isEmpty():
            rounds.append((leaves, None))
            tables.append(nodes)
            break
        folded = written(_chosen(nodes, values, len(rounds)))
        given = leaves.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
            *[F.sum(F.col(v) + F.col(w)).alias(f"g_{v}") for v, w in zip(values, weights)])
        lifted = folded.select(F.col("child").alias("id"), F.col("parent").alias("up"), *[F.col(f"l_{v}") for v in values])
        active = written(
            nodes.where("n IS NOT NULL").join(folded.select("id"), "id", "left_anti").join(given, "id", "left").join(lifted, "id", "left").select(
                "id", F.coalesce("up", "parent").alias("parent"),
                *[(F.col(v) + F.coalesce(f"g_{v}", F.lit(0))).alias(v) for v in values],
                *[(F.col(w) + F.coalesce(f"l_{v}", F.lit(0))).alias(w) for v, w in zip(values, weights)]))
        rounds.append((leaves, folded))
        tables += [nodes, folded, active]
    known, parts = None, []
    for leaves, folded in reversed(rounds):  # `known`: totals of the nodes that were there after this round
        now = leaves.select("id", *values)
        if folded is not None:
            child = known.select(F.col("id").alias("child"), *[F.col(v).alias(f"c_{v}") for v in values])
            grown = written(folded.join(child, "child").select("id", *[(F.col(f"a_{v}") + F.col(f"c_{v}")).alias(v) for v in values]))
            now = now.unionByName(grown)
            parts.append(grown)
        known = now if known is None else known.unionByName(now)
    totals = written(known)
    dropped(*tables, *parts)
    return totals


def _chosen(nodes: DataFrame, values: list[str], turn: int) -> DataFrame:
    """Chain nodes to be removed now, no two of them neighbours: (id, parent, child, a_: to be added to the child's
    total for the own one, l_: what the edge of the child gets on top).

    A chain node has one child, which is no leaf, and is no root; of neighbouring ones the least by hash is taken.
    """
    rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)), c)
    single = nodes.where("n = 1 AND parent IS NOT NULL")
    below = nodes.where("n IS NOT NULL").select(F.col("id").alias("child"), (F.col("n") == 1).alias("chained"), *[F.col(f"w_{v}").alias(f"u_{v}") for v in values])
    above = single.select(F.col("child").alias("id"), F.col("id").alias("over"))
    both = single.join(below, "child").join(above, "id", "left")
    least = (~F.col("chained") | (rank(F.col("id")) < rank(F.col("child")))) & (F.col("over").isNull() | (rank(F.col("id")) < rank(F.col("over"))))
    return both.where(least).select("id", "parent", "child", *[(F.col(v) + F.col(f"u_{v}")).alias(f"a_{v}") for v in values],
                                    *[(F.col(v) + F.col(f"w_{v}")).alias(f"l_{v}") for v in values])


# --------------------------------------------------------------------------
# Trie
# --------------------------------------------------------------------------
def trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of all conversations (conv_id, pos, turn_sha, words), each with a row at position 0."""
    keyed = written(_keyed(turns))
    parents = [F.col(k).bitwiseXOR(F.col(f"o{i}")).alias(f"p{i}") for i, k in enumerate(LANES, 1)]
    nodes = written(keyed.select("*", *parents).groupBy(F.col("pos").alias("depth"), *LANES).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"), *[F.min(f"p{i}").alias(f"p{i}") for i in range(1, 5)]))
    above = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(k).alias(f"p{i}") for i, k in enumerate(LANES, 1)], F.col("conv_id").alias("parent_conv_id"))
    linked = written(nodes.join(above, ["depth", "p1", "p2", "p3", "p4"], "left").select(
        F.struct("depth", "conv_id").alias("id"), F.when(F.col("depth") > 0, F.struct((F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id"))).alias("parent"),
        "depth", *LANES, "n_convs", ((F.col("n_convs") - 1) * F.col("words")).alias("own")))
    children = linked.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    full = written(linked.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    sums = subtree_sums(full.select("id", "parent", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), F.col("own").alias("saved_tokens")),
                        ["n_leaves", "saved_tokens"])
    last = keyed.groupBy("conv_id").agg(F.max(F.struct("pos", *LANES)).alias("last")).select("conv_id", "last.*")
    ends = _digests(last).withColumnRenamed("pos", "depth")
    return full.join(sums, "id").join(ends, ["depth", *LANES], "left").select(
        "id.conv_id", "depth", F.col("parent.conv_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))


def shared_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations (`with_shared_starts`): conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256."""
    return trie(written(with_shared_starts(written(positions(conversations)))))


def sql() -> str:
    """DuckDB SQL for `shared_trie`: whole sequences as keys, subtree sums over every node's prefixes."""
    step = "list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: xor(c >> 1, (c & 1) * 3988292384))"
    crc = (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))), "
           f"lambda s, b: {step.replace('[x,', '[xor(s, b),')}), 4294967295)")
    return rf"""
WITH o AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(concat(strlen(role), ':', role, text))) AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {crc} % 4 AS h FROM (SELECT DISTINCT conv_id FROM o)),
l AS (SELECT conv_id AS base, count(*) AS n FROM o GROUP BY ALL),
r AS (SELECT c.conv_id, o.pos, o.role, o.text FROM c JOIN o ON o.conv_id = c.base WHERE o.pos <= c.h
  UNION ALL SELECT c.conv_id, o.pos - c.h + least(c.h, coalesce(l.n, 0)), o.role, o.text FROM c JOIN o USING (conv_id) LEFT JOIN l USING (base) WHERE o.pos > c.h),
s AS (SELECT c.conv_id, coalesce(list([r.role, r.text] ORDER BY r.pos) FILTER (r.pos IS NOT NULL), []) AS turns FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
m AS (SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM s),
g AS (SELECT depth, turns[1:depth] AS node, min(conv_id) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(turns) = depth), '')) AS ends_sha256 FROM m GROUP BY ALL),
k AS (SELECT g.*, up.conv_id AS parent_conv_id, coalesce(d.n, 0) AS n_children,
  CASE WHEN g.depth = 0 THEN 0 ELSE (g.n_convs - 1) * len(regexp_extract_all(g.node[-1][2], '[^\x20\x09-\x0D]+')) END AS own
  FROM g LEFT JOIN g up ON up.depth = g.depth - 1 AND up.node = g.node[1:g.depth - 1]
  LEFT JOIN (SELECT depth - 1 AS depth, node[1:depth - 1] AS node, count(*) AS n FROM g WHERE depth > 0 GROUP BY ALL) d ON d.depth = g.depth AND d.node = g.node),
t AS (SELECT depth, node[1:depth] AS node, sum(own) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT unnest(range(0, depth + 1)) AS depth, node, own, n_children FROM k) GROUP BY ALL)
SELECT k.conv_id, k.depth, k.parent_conv_id, k.n_convs, k.n_children, t.n_leaves, CAST(t.saved_tokens AS BIGINT) AS saved_tokens, k.ends_sha256
FROM k JOIN t ON t.depth = k.depth AND t.node = k.node"""
