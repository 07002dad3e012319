"""Language id, quality and language-model scoring: held-out accuracy, brute force, defined cases."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pyspark.sql import functions as F
from spanlight.llm import language_id, lm_score, quality, queries
from spanlight.llm.common import crc_mod

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def _texts(spark, data_dir):
    return {r.doc_id: r for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()}


# language -----------------------------------------------------------------
def test_language_held_out_accuracy(spark, data_dir):
    docs = _texts(spark, data_dir)
    got = queries.QUERIES["op3_language_id"](spark, data_dir).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.9 * len(held)


def test_language_never_sees_held_out_labels(spark, documents):
    rows = [(i, "the and of is that " * 9 if i % 2 else "der und die das ein " * 9, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else "en" if i % 2 else "de")
            for i in range(60)]
    got = language_id.identify(documents(rows), ~(crc_mod(F.col("doc_id"), 4) == 2)).collect()
    assert {r.prediction.lang for r in got} == {"en", "de"}
    assert sum(r.prediction.lang == ("en" if r.doc_id % 2 else "de") for r in got) >= 58


def test_response_tables_equal_convolution():
    rng = np.random.default_rng(1)
    windows = rng.integers(0, 256, (5, language_id.WINDOW)).astype(np.uint8)
    net = language_id.train(windows, np.array([0, 1, 0, 1, 1]), ["a", "b"], epochs=2)
    emb, pooled = net.embedding[windows], []
    for w, f in zip(language_id.WIDTHS, net.filters):
        span = language_id.WINDOW - w + 1
        pooled.append(sum(emb[:, i:i + span] @ f[i] for i in range(w)).max(axis=1))
    z = np.maximum(np.concatenate(pooled, axis=1) + net.bias, 0) @ net.out + net.out_bias
    want = np.exp(z - z.max(1, keepdims=True))
    np.testing.assert_allclose(net.probabilities(windows, net.tables()), want / want.sum(1, keepdims=True), atol=1e-4)


def test_gradients_of_training_reduce_the_loss():
    rng = np.random.default_rng(2)
    texts = [("abcab" if i % 2 else "xyzzy") * rng.integers(3, 40) for i in range(120)]
    windows = np.concatenate([language_id.as_windows(t.encode())[0][:1] for t in texts])
    net = language_id.train(windows, np.arange(120) % 2, ["x", "a"])
    assert (net.probabilities(windows, net.tables()).argmax(1) == np.arange(120) % 2).mean() > 0.98


def test_language_defined_cases(spark, documents):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !?", "en"), (None, "the cat", None), (5, "the cat " * 30_000, "en"), (5, "the cat", "en")]
    got = [(r.doc_id, r.prediction.lang) for r in language_id.identify(documents(rows), F.col("doc_id").isNotNull()).collect()]
    assert sorted(got, key=str) == sorted([(1, "und"), (2, "und"), (3, "und"), (None, "en"), (5, "en"), (5, "en")], key=str)
    none = language_id.identify(documents([(1, "the cat", None)]), F.lit(True)).first().prediction
    assert (none.lang, none.score) == ("und", 0.0)
    assert language_id.identify(documents([]), F.lit(True)).count() == 0


# quality ------------------------------------------------------------------
def test_quality_held_out_accuracy(spark):
    """Documents whose labels are hidden from training are judged as their labels say."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    hidden = labels.where(crc_mod(F.col("doc_id"), 3) == 0)
    got = quality.classify(docs, labels.join(hidden, "doc_id", "left_anti")).join(hidden, "doc_id").collect()
    good = [r for r in got if r.quality == 1]
    bad = [r for r in got if r.quality == 0]
    assert sum(r.accepted for r in good) >= 0.98 * len(good)
    assert sum(not r.accepted for r in bad) >= 0.8 * len(bad)


def test_co_training_uses_pseudo_labels():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 600)
    a = np.stack([y + rng.normal(0, 0.15, 600), rng.normal(size=600)], 1)
    b = np.stack([rng.normal(size=600), y + rng.normal(0, 0.4, 600)], 1)
    shown = np.where(np.arange(600) < 60, y, -1)
    model = quality.co_train(a, b, shown, rounds=3, new=60, certain=0.8)
    assert ((model.score(a, b) >= 0.5) == y).mean() > 0.95
    alone = quality.co_train(a, b, shown, rounds=0)
    assert not np.allclose(alone.meta.beta, model.meta.beta)


def test_uninformative_view_counts_little():
    rng = np.random.default_rng(3)
    y = (rng.random(800) < 0.85).astype(int)
    text = (y + rng.normal(0, 0.2, 800))[:, None]
    model = quality.co_train(text, rng.normal(size=(800, 5)), y)
    assert ((model.score(text, np.zeros((800, 5))) >= 0.5) == y).mean() > 0.95


def test_quality_defined_cases(spark, documents):
    rows = [(i, "A fine text with words of all kinds, number %d." % i if i % 3 else "junk junk junk junk", "en", "s", 40) for i in range(1, 90)]
    rows += [(None, None, None, None, None), (500, "", None, None, -5), (501, "word " * 60_000, "en", "s", 300_000), (501, None, "en", None, 1)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(1, 60)] + [(1, 1), (2, 0), (None, 1), (4, None)], "doc_id long, quality int")
    got = quality.classify(documents(rows), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.accepted == (r.doc_id % 3 > 0) for r in got if r.doc_id and r.doc_id < 90)
    kept = quality.keep_good(documents(rows), labels)
    assert kept.columns == documents(rows).columns
    for few in (labels.where("false"), labels.where("quality = 1")):
        assert quality.keep_good(documents(rows), few).count() == len(rows)
    assert quality.classify(documents([]), labels).count() == 0


# language model --------------------------------------------------------------
def _base(docs, held):
    train = Counter()
    tokens = {i: WORD.findall(_lower(t)) + ["\n"] for i, t in docs.items()}
    for i, t in tokens.items():
        if not held[i]:
            train.update(t)
    n, v = sum(train.values()), len(train)
    return tokens, train, n, {i: sum(math.log10((train[w] + 1) / (n + v + 1)) for w in t) for i, t in tokens.items()}


@pytest.mark.parametrize("hot", [200_000, 50])
def test_base_score_against_brute_force(spark, data_dir, hot):
    docs = {i: r.text for i, r in _texts(spark, data_dir).items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in docs}
    tokens, train, n, base = _base(docs, held)
    table = spark.read.parquet(f"{data_dir}/documents.parquet")
    got = lm_score.score(table, crc_mod(F.col("doc_id"), 7) == 2, hot_words=hot).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(tokens[r.doc_id]), n)
        assert r.n_known == sum(train[w] > 0 for w in tokens[r.doc_id])
        assert r.base_score == pytest.approx(base[r.doc_id], rel=1e-9)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # contexts help on unseen documents


def test_score_follows_the_smoothed_counts(spark, documents):
    """With few n-grams hardly any probe errs: the score is that of the quantised counts, in one group or many."""
    rows = [(i, " ".join("the cat sat on a mat of red wool and the dog ran".split()[j % 13] for j in range(i, i + 5 + i % 9))) for i in range(1, 60)]
    held = F.col("doc_id") % 5 == 0
    docs = documents(rows)
    one = {r.doc_id: r.score for r in lm_score.score(docs, held).collect()}
    many = {r.doc_id: r.score for r in lm_score.score(docs, held, filter_bytes=300).collect()}
    words, pairs = Counter(), Counter()
    for i, t in rows:
        if i % 5:
            w = ["\n", *t.split(), "\n"]
            words.update(w[1:])
            pairs.update(zip(w, w[1:]))
    q = lambda c: float(lm_score.stands_for(lm_score.level(np.array([c])))[0]) if c else 0.0
    room = sum(words.values()) + len(words) + 1
    close = 0
    for i, t in rows:
        w = ["\n", *t.split(), "\n"]
        want = sum(math.log10((min(q(pairs[a, b]), q(words[b])) + lm_score.MU * (q(words[b]) + 1) / room) / (q(words[a]) + lm_score.MU))
                   for a, b in zip(w, w[1:]))
        close += abs(one[i] - want) < 1e-6
        assert abs(one[i] - want) < 0.15 * abs(want) and abs(many[i] - want) < 0.15 * abs(want)
    assert close > 0


def test_filter_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    counts = np.minimum(rng.geometric(0.3, len(keys)) ** 3, 5000).astype(np.uint64)
    part = lm_score.Filter([(0, lm_score.build_bits(keys, counts))], 0, 1)
    read = part.counts(keys, np.zeros(len(keys), np.int64))
    exact = lm_score.stands_for(lm_score.level(counts))
    assert (read >= exact).all() and (read > exact).mean() < 0.1
    absent = rng.integers(2**63, 2**64 - 1, 20_000, dtype=np.uint64)
    assert (part.counts(absent, np.zeros(len(absent), np.int64)) > 0).mean() < 0.1


def test_lm_defined_cases(spark, documents):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "A c"), (7, "w " * 100_000)]
    got = {(r.doc_id, r.n_tokens): r for r in lm_score.score(documents(rows), F.col("doc_id") == 7).collect()}
    assert lm_score.score(documents(rows), F.col("doc_id") == 7).count() == len(rows)
    assert got[1, 1].train_tokens == 1 + 1 + 3 + 3 and got[7, 100_001].held_out and not got[None, 3].held_out
    assert got[None, 3].n_known == 2 and got[7, 100_001].n_known == 1
    nothing = lm_score.score(documents(rows), F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.base_score == 0 and r.n_known == 0 for r in nothing)
    assert lm_score.score(documents([]), F.lit(False)).count() == 0
