"""Prefix trie against brute force: random conversations, one long one, hot turns, nulls, ties."""

import hashlib
import random
import re
import zlib

import pytest

from spanlight.llm import prefix_trie
from spanlight.llm.common import written

SCHEMA = "conv_id long, turn long, role string, text string, id string, parent int, n int, words string, depth int"


def _table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "w", 3) for r in rows], SCHEMA)


def _sha(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def _brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, _sha(role or "", text or ""), (role or "", text or "")))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 * (1 if c >= 0 else -1))
        whole[c] = own.get(base, [])[:h] + ts[h:]
    nodes = {}
    for c, ts in whole.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in nodes:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node in sorted(nodes, key=len, reverse=True):
        leaves[node] = leaves.get(node, 0) or 1
        saved[node] = saved.get(node, 0) + ((len(nodes[node]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0)
        if node:
            leaves[node[:-1]] = leaves.get(node[:-1], 0) + leaves[node]
            saved[node[:-1]] = saved.get(node[:-1], 0) + saved[node]
    ends = {}
    for c in sorted(whole):
        ends.setdefault(tuple(whole[c]), []).append(str(c))
    return sorted((min(cs), len(n), min(nodes[n[:-1]]) if n else None, len(cs), children.get(n, 0), leaves[n], saved[n],
                   hashlib.sha256(",".join(ends.get(n, [])).encode()).hexdigest()) for n, cs in nodes.items())


def _same(spark, rows):
    found = prefix_trie.shared_trie(_table(spark, rows))
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, found.collect())) == _brute(rows)


def test_random_conversations(spark):
    rnd = random.Random(5)
    rows = []
    for c in [*range(-45, 130), 10**12, 10**12 + 3]:
        for turn in range(rnd.choice([1, 1, 2, 3, 5])):
            rows.append((c, turn, rnd.choice(["user", "assistant", None]), rnd.choice(["a b  c", "a", "", None, "x\ty\x1fz é", "one two three four"])))
    rows += [(7, None, "user", "first"), (7, 0, "user", "tie"), (7, 0, "user", "tie"), (None, 0, "user", "nobody"), (None, 1, "user", "nobody")]
    _same(spark, rows)


def test_shared_turns_and_many_ends(spark):
    """Every conversation begins alike, thousands end at the same node, over several blocks of identifiers."""
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 9000, 3) for t in range(3)]
    rows += [(c, 3, "assistant", f"own answer {c}") for c in range(0, 9000, 300)]
    _same(spark, rows)


def test_one_long_conversation(spark, monkeypatch):
    """A third of the rows in one conversation, a chain of as many nodes, over several blocks and tasks."""
    monkeypatch.setattr(prefix_trie, "_BLOCK", 16)
    rows = [(40, t, "user", f"{t % 7} words of turn {t}") for t in range(150)]
    rows += [(c, t, "user", f"{t % 7} words of turn {t}") for c in range(400, 500) for t in range(3)]
    _same(spark, rows)


def test_turnless_and_empty(spark):
    short = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    _same(spark, [(short, 0, "user", "gone")])
    assert prefix_trie.shared_trie(_table(spark, [])).count() == 0
    assert prefix_trie.shared_trie(_table(spark, [(None, 1, "user", "x")])).count() == 0


@pytest.mark.parametrize("shape", ["random", "caterpillar", "forest"])
def test_subtree_sums(spark, shape):
    rnd = random.Random(3)
    n = 120
    parent = {"random": lambda i: rnd.randrange(i), "caterpillar": lambda i: i - 1 if i % 2 else max(i - 2, 0),
              "forest": lambda i: None if i % 50 == 0 else rnd.randrange(i - i % 50, i)}[shape]
    rows = [(i, parent(i) if i else None, rnd.randrange(-5, 100), 1) for i in range(n)]
    sums = {i: [v, w] for i, _, v, w in rows}
    for i, p, _, _ in reversed(rows):
        if p is not None:
            sums[p] = [a + b for a, b in zip(sums[p], sums[i])]
    tree = spark.createDataFrame(rows, "id long, parent long, v long, w long")
    found = {r.id: [r.v, r.w] for r in prefix_trie.subtree_sums(tree, ["v", "w"]).collect()}
    assert found == sums


def test_query_matches_sql(spark, duck, data_dir):
    from spanlight.llm.queries import ORACLE_SQL, QUERIES

    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = written(QUERIES["op12_prefix_trie"](spark, data_dir)).select(*cols).collect()
    want = duck.sql(f"SELECT {', '.join(cols)} FROM ({ORACLE_SQL['op12_prefix_trie']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
