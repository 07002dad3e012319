"""Exact and near dedup against brute force, and the defined cases."""

import hashlib
import random
import re

import pytest

from spanlight.llm import exact_dedup, queries, simhash
from spanlight.llm.simhash import fingerprint


def _words(rng, n):
    return " ".join(rng.choice("the of and alpha beta gamma delta omega to in".split()) + str(rng.randrange(30)) for _ in range(n))


def _brute_components(fps, max_bits=2):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(fps))]


def test_exact_groups_match_sql(spark, duck, data_dir):
    got = queries.QUERIES["op10_exact_dedup"](spark, data_dir).toPandas().sort_values("doc_id").reset_index(drop=True)
    want = duck.sql(queries.ORACLE_SQL["op10_exact_dedup"]).df().sort_values("doc_id").reset_index(drop=True)
    assert got[sorted(got)].astype(str).equals(want[sorted(want)].astype(str))


def test_exact_hot_group_over_many_tasks(spark, documents):
    rng = random.Random(1)
    rows = [(i, "same  text\there" if i % 3 else _words(rng, 3)) for i in range(600)]
    rng.shuffle(rows)
    got = {r.doc_id: r for r in exact_dedup.exact_groups(documents(rows).repartition(8)).collect()}
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t) for i, t in rows}
    for i, t in norm.items():
        same = [j for j, u in norm.items() if u == t]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (min(same), len(same), i == min(same))
        assert got[i].text_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_exact_groups_that_cross_tasks_amid_one_prefix(spark, documents):
    """All texts begin alike, so the keys that split tasks go by digest while a task sorts by content."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    given = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        ends = [i % 7 if i % 3 else 100 for i in range(1200)] + [1000 + i for i in range(200)]
        rows = [(i, "same start " * 10 + f"{end:04d}") for i, end in enumerate(ends)]
        docs = documents(rows).repartition(8)
        assert exact_dedup._sorted_runs(docs, "doc_id", "text").groupBy("sha").agg({"pid": "max"}).count() == len(set(ends))
        parts = exact_dedup._sorted_runs(docs, "doc_id", "text").where("id % 3 = 0 AND id < 1200").select("pid").distinct().count()
        assert parts > 1  # the largest group fills several tasks
        members = {}
        for i, end in enumerate(ends):
            members.setdefault(end, []).append(i)
        got = {r.doc_id: r for r in exact_dedup.exact_groups(docs).collect()}
        assert len(got) == len(rows)
        for i, end in enumerate(ends):
            r, least = got[i], min(members[end])
            assert (r.keep_id, r.group_size, r.kept) == (least, len(members[end]), i == least)
        assert sorted(r.doc_id for r in exact_dedup.dedup(docs).collect()) == sorted(map(min, members.values()))
    finally:
        spark.conf.set(key, given)


def test_exact_defined_cases(spark, documents):
    rows = [(1, None), (2, ""), (3, " "), (4, "\t\n"), (5, "a b"), (5, "a b"), (None, "a b"), (7, "x" * 300_000), (8, "x" * 300_000)]
    got = exact_dedup.exact_groups(documents(rows)).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id or 0, r.keep_id, r.group_size) for r in got) == [
        (0, 5, 3), (1, 1, 2), (2, 1, 2), (3, 3, 2), (4, 3, 2), (5, 5, 3), (5, 5, 3), (7, 7, 2), (8, 7, 2)]
    assert sum(r.kept for r in got) == 4
    kept = exact_dedup.dedup(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 5, 7]
    assert exact_dedup.exact_groups(documents([])).count() == 0
    assert exact_dedup.dedup(documents([])).count() == 0


def test_fingerprint_against_definition():
    import xxhash
    for text in ["", "  ", "One", "one two", "a b c", "The cat  sat\ton THE mat the cat sat on É é"]:
        words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()))
        sh = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hs = [xxhash.xxh64_intdigest(s, seed=42) for s in sh]
        assert fingerprint(text.encode()) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("max_bits,dense", [(2, 8), (2, 1000), (2, 1), (1, 8), (1, 1)])
def test_links_lose_nothing(spark, max_bits, dense):
    rng = random.Random(3)
    fps = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        fps |= {base} | {base ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (2**64 - 1) for _ in range(25)}
    fps = sorted(simhash._signed(f % 2**64) for f in fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = simhash.links(df, max_bits, dense=dense)
    for a, b in edges.collect():
        assert bin((a ^ b) & (2**64 - 1)).count("1") <= max_bits
    root = dict(simhash.components(edges).collect())
    want = _brute_components([f & (2**64 - 1) for f in fps], max_bits)
    assert [root.get(f, f) for f in fps] == [fps[w] for w in want]


def test_near_groups_on_all_documents(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    rows = sorted(docs.select("doc_id", "text").collect())
    fps = [fingerprint((r.text or "").encode()) for r in rows]
    got = {r.doc_id: r for r in queries.QUERIES["op1_simhash_near_dedup"](spark, data_dir).collect()}
    for r, f, root in zip(rows, fps, _brute_components(fps)):
        assert got[r.doc_id].fingerprint == f"{f:016x}"
        assert got[r.doc_id].component_id == rows[root].doc_id


def test_near_chain_and_defined_cases(spark, documents):
    rows = [(9, None), (4, ""), (6, " \t"), (3, "solo"), (8, "solo"), (None, "solo"), (8, "solo"), (11, "w " * 50_000)]
    got = sorted((r.doc_id or 0, r.component_id) for r in simhash.near_groups(documents(rows)).collect())
    assert got == [(0, 3), (3, 3), (4, 4), (6, 4), (8, 3), (8, 3), (9, 4), (11, 11)]
    kept = simhash.near_dedup(documents(rows))
    assert kept.columns == documents(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 11]
    assert simhash.near_groups(documents([])).count() == 0
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r.root for r in simhash.components(chain).collect()} == {0}
