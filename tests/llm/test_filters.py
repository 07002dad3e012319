"""Licence scan, URL filter and decontamination: SQL, brute force, defined cases."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

from spanlight.llm import decontaminate, license_scan, queries, url_filter


# licences -------------------------------------------------------------------
def _rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(str(round(v, 6)) if isinstance(v, float) else str(v) for v in r) for r in df.itertuples(index=False, name=None))


def test_license_scan_matches_unpruned_sql(spark, duck, data_dir):
    got = queries.QUERIES["op4_license_scan"](spark, data_dir).toPandas()
    assert len(got) and _rows(got) == _rows(duck.sql(queries.ORACLE_SQL["op4_license_scan"]).df())


def _dice(a, b):
    x, y = license_scan._plain_words(a), license_scan._plain_words(b)
    x, y = set(zip(x, x[1:])), set(zip(y, y[1:]))
    return 2 * len(x & y) / (len(x) + len(y)) if x and y else 0


def test_license_bounds_lose_nothing(spark, documents):
    rng, rows = random.Random(2), []
    notices = list(license_scan.TEMPLATES.values())
    for i in range(300):
        words = rng.choice(notices).split()
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(words))
            words[at:at + rng.randrange(2)] = [rng.choice(["the", "any", "license", "Ünder", "x"])] * rng.randrange(3)
        rows.append((i, " ".join(words).upper() if i % 7 == 0 else " ".join(words)))
    got = {(r.doc_id, r.license): r.dice for r in license_scan.scan(documents(rows)).collect()}
    want = {(i, n): round(d, 6) for i, t in rows for n, v in license_scan.TEMPLATES.items() if (d := _dice(t, v)) >= 0.8}
    assert got == want and len(want) > 100


def test_license_defined_cases(spark, documents):
    rows = [(1, None), (2, ""), (3, "word"), (4, "Text.\nReleased under the MIT License.\nMore."), (4, "x\n\nReleased under\nthe MIT License."),
            (None, "Released under the MIT License."), (6, "lorem ipsum " * 40_000 + "\nAll rights reserved.")]
    got = license_scan.scan(documents(rows)).collect()
    assert sorted(((r.doc_id or 0), r.license) for r in got) == [
        (0, "MIT"), (4, "MIT"), (4, "MIT"), (6, "All-rights-reserved")]
    assert license_scan.scan(documents([])).count() == 0
    assert license_scan.scan(documents(rows), templates={}).count() == 0


# urls -----------------------------------------------------------------------
CASES = [
    ("http://Foo.NET/x?y#z", "foo.net", "/x", "net/", "block"),
    ("https://net/", "net", "/", "net/", "block"),
    ("https://net", "net", "", None, None),
    ("https://notnet/", "notnet", "/", None, None),
    ("http://a.example.net/en/1", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://a.example.net/EN/1", "a.example.net", "/EN/1", "net/", "block"),
    ("http://example.com/de/?q", "example.com", "/de/", "example.com/de/", "block"),
    ("http://myexample.com/de/", "myexample.com", "/de/", None, None),
    ("x://w.org/fr/a://b", "w.org", "/fr/a://b", "org/fr/", "allow"),
    ("http://h.example.com#/de/", "h.example.com", "", None, None),
    ("no scheme", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None),
]


def test_rules(spark):
    rows = [(i, c[0], "h") for i, c in enumerate(CASES)]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(CASES):
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_url_scores_against_brute_force(spark, data_dir):
    got = queries.QUERIES["op5_url_filter"](spark, data_dir).collect()
    assert len(got) == spark.read.parquet(f"{data_dir}/pages.parquet").count()
    k, sides = url_filter.ORDER, ("allow", "block")
    rule_verdict = dict(url_filter.RULES)
    grams = lambda t: [("\x02" * k + t + "\x03")[i:i + k + 1] for i in range(len(t) + 1)]
    held = lambda r: r.rule is not None and int(hashlib.sha256((r.host + r.path).encode()).hexdigest()[:7], 16) % url_filter.FOLDS == 0
    counts = {s: Counter() for s in sides}
    for r in got:
        if r.rule and not held(r):
            counts[rule_verdict[r.rule]].update(grams(r.host + r.path))
    tables = {s: [defaultdict(Counter) for _ in range(k + 1)] for s in sides}
    for s in sides:
        for g, n in counts[s].items():
            for o in range(k + 1):
                tables[s][o][g[k - o:k]][g[k]] += n

    def p(s, g):
        out = 1 / url_filter.ALPHABET
        for o in range(k + 1):
            seen = tables[s][o].get(g[k - o:k])
            if seen:
                n, kinds = sum(seen.values()), len(seen)
                out = (seen[g[k]] + kinds * out) / (n + kinds)
        return out

    score = lambda r: np.mean([math.log10(p("allow", g) / p("block", g)) for g in grams(r.host + r.path)])
    decided = [(round(float(score(r)), 3), rule_verdict[r.rule]) for r in got if held(r)]
    good, bad = sum(v == "allow" for _, v in decided), sum(v == "block" for _, v in decided)
    limit = 0.0
    if good and bad:
        limit = min({t for t, _ in decided}, key=lambda t: (
            -round(sum(s >= t for s, v in decided if v == "allow") / good + sum(s < t for s, v in decided if v == "block") / bad, 9), abs(t), t))
    for r in got:
        if r.rule:
            assert r.verdict == rule_verdict[r.rule] and r.score is None
        else:
            assert r.score == pytest.approx(score(r), abs=2e-6)
            assert abs(r.score - limit) < 1e-5 or r.verdict == ("allow" if r.score >= limit else "block")


def test_urls_match_sql(spark, duck, data_dir):
    got = queries.QUERIES["op5_url_filter"](spark, data_dir).toPandas()
    assert _rows(got) == _rows(duck.sql(queries.ORACLE_SQL["op5_url_filter"]).df())


def test_url_defined_cases(spark):
    kind = "page_id long, url string, n int, gram string, score double"
    rows = [(1, None), (1, None), (None, "http://a.b/" + "x" * 20_000), (3, "http://é.b/ü")]
    got = url_filter.judge(spark.createDataFrame([(*r, 1, "g", 0.5) for r in rows], kind)).collect()
    assert len(got) == 4 and all(r.verdict == "allow" and r.score == 0 for r in got)
    assert url_filter.judge(spark.createDataFrame([], kind)).count() == 0


# benchmarks -----------------------------------------------------------------
ITEM = ("Anna Smith bought 12 red apples and 7 green pears at the market near Boston. Later Smith gave 12 apples to a "
        "friend who lives 30 km away and paid 4.50 dollars for the bus ticket home.")
AGAIN = ("Peter Jones bought 15 red apples and 9 green pears at the market near Denver. Later Jones gave 15 apples to a "
         "friend who lives 80 km away and paid 6.25 dollars for the bus ticket home.")
TWISTED = AGAIN.replace("gave 15", "gave 9")


def _items(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_reparameterised_questions_are_found(spark, documents):
    shell = "Some other words stand before it and nobody minds.\n%s\nAnd other words stand behind it as well."
    rows = [(1, shell % ITEM), (2, shell % AGAIN), (3, shell % TWISTED), (4, shell % "nothing here"), (5, ITEM.lower()),
            (6, shell % " ".join(ITEM.split()[:12])), (7, shell % (AGAIN + " " + ITEM))]
    got = {r.doc_id: r for r in decontaminate.leaks(documents(rows), _items(spark, ITEM)).collect()}
    assert set(got) == {1, 2, 7}
    assert (got[1].coverage, got[1].reparameterised, got[2].reparameterised) == (1.0, False, True)
    assert (got[7].n_occurrences, got[7].reparameterised) == (2, False)


def test_filtered_path_equals_joined_path(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    fast = sorted(map(tuple, decontaminate.leaks(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "MAX_HASHES", -1)
    assert fast and fast == sorted(map(tuple, decontaminate.leaks(docs, bench).collect()))


def test_planted_passages_against_brute_force(spark):
    """Every document that holds a whole item word for word is found, and nothing that holds no eight words of one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    items = {r.item_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id) for r in queries.QUERIES["op6_benchmark_decontamination"](spark, "/root/testdata/sf0.01").collect()}
    squeeze = lambda t: " ".join(t.split())
    plain = lambda t: [decontaminate.bare(w).lower() for w in t.split() if decontaminate.bare(w)]
    whole = {(d.doc_id, i) for d in docs for i, t in items.items() if squeeze(t) in squeeze(d.text or "")}
    assert whole and whole <= got
    grams = {i: {tuple(w[k:k + 8]) for k in range(len(w) - 7)} for i, t in items.items() for w in [plain(t)]}
    text = {d.doc_id: plain(d.text or "") for d in docs}
    for d, i in got:
        w = text[d]
        assert len(grams[i] & {tuple(w[k:k + 8]) for k in range(len(w) - 7)}) >= 0.5 * len(grams[i])


def test_leaks_match_sql(spark, documents):
    """The SQL knows no hashes, anchors or vocabulary; on the small data and on re-parameterised items."""
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    got = queries.QUERIES["op6_benchmark_decontamination"](spark, "/root/testdata/sf0.01").toPandas()
    assert len(got) and _rows(got) == _rows(con.sql(decontaminate.sql()).df())
    rows = [(1, "x\n%s\ny" % ITEM), (2, AGAIN), (3, TWISTED), (4, None), (5, AGAIN + " " + ITEM), (6, ITEM.upper()), (7, "a short item of words, (Bob) 3 kg.")]
    items = pd.DataFrame({"item_id": [0, 1, 2], "text": [ITEM, None, "a short item of words, (Eve) 5 kg."]})  # noqa: F841
    small = pd.DataFrame({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})  # noqa: F841
    con.execute("CREATE OR REPLACE VIEW documents AS SELECT * FROM small")
    con.execute("CREATE OR REPLACE VIEW benchmark AS SELECT * FROM items")
    got = decontaminate.leaks(documents(rows), _items(spark, ITEM, None, "a short item of words, (Eve) 5 kg.")).toPandas()
    assert len(got) == 4 and _rows(got) == _rows(con.sql(decontaminate.sql()).df())


def test_decontamination_defined_cases(spark, documents):
    rows = [(1, None), (2, ""), (3, ITEM), (3, ITEM), (None, ITEM), (6, "word " * 60_000 + ITEM), (7, "a clean text of plain words")]
    bench = _items(spark, ITEM, None, "", "one two", "a single short item of words", ITEM)
    got = sorted((r.doc_id or 0, r.item_id) for r in decontaminate.leaks(documents(rows), bench).collect())
    assert got == [(0, 0), (0, 5), (3, 0), (3, 0), (3, 5), (3, 5), (6, 0), (6, 5)]
    kept = decontaminate.decontaminate(documents(rows), bench)
    assert kept.columns == documents(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 7]
    assert decontaminate.decontaminate(documents([]), bench).count() == 0
    assert decontaminate.decontaminate(documents(rows), bench.where("false")).count() == len(rows)
    short = decontaminate.leaks(documents([(1, "this is a single short item of words indeed")]), bench).collect()
    assert [(r.doc_id, r.item_id) for r in short] == [(1, 4)]
