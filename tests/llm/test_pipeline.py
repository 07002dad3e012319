"""The pipeline's stages, one after another, against brute force on each stage's own input."""

import base64
import re

import corpus_pipeline
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from spanlight.llm import bpe, quality
from spanlight.llm.common import written
from spanlight.llm.simhash import fingerprint


def _norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_stages_and_run(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before, at = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, before, sf))
        assert after.columns == docs.columns
        at[name] = ({r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()})
        assert set(at[name][1].items()) <= set(at[name][0].items())
        before = after

    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scores = {r.doc_id: r.accepted for r in quality.classify(docs, labels).collect()}
    assert set(at["quality classifier"][1]) == {d for d, ok in scores.items() if ok}

    given, kept = at["exact dedup"]
    first = {}
    for d in sorted(given):
        first.setdefault(_norm(given[d].text), d)
    assert set(kept) == set(first.values())

    given, kept = at["SimHash near-dedup"]
    ids = sorted(given)
    fps = [fingerprint((given[d].text or "").encode()) for d in ids]
    root = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    assert set(kept) == {ids[r] for r in root}

    given, kept = at["benchmark decontamination"]
    items = [" ".join(r.text.split()) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    held = {d for d, r in given.items() if any(t in " ".join((r.text or "").split()) for t in items)}
    assert not held & set(kept)
    assert len(kept) >= len(given) - len(held) - 2

    out = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in out} == set(kept) and all(r.round_trip for r in out)
    ranks = bpe.vocabulary(bpe.rank_file(spark).value).ranks
    library = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert all(r.n_tokens == len(library.encode_ordinary(kept[r.doc_id].text or "")) for r in out)


def test_empty_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, "/root/testdata/sf0.001"))
        assert docs.count() == 0


def test_one_python_worker_encodes_and_checks(spark, documents):
    """A second function of the same task would double the workers, and with them the vocabularies and pieces they hold."""
    out = corpus_pipeline.encoded(spark, documents([(1, "Ein Wort, 12 words"), (2, None), (3, "漢字 \U0001f600")]), "")
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert out.columns == ["doc_id", "n_tokens", "ids", "round_trip"]
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == {1, 2, 3} and all(r.round_trip and len(r.ids) == 4 * r.n_tokens for r in got.values())
    assert got[2].n_tokens == 0 < got[3].n_tokens


def test_check_finds_ids_that_decode_to_another_text(spark, documents):
    ranks = [(bytes([i]), i) for i in range(256) if i != 98] + [(b"b", 97)]  # "a" and "b" share an id
    content = spark.sparkContext.broadcast(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks))
    rows = documents([(1, "c"), (2, "a"), (3, "b")]).select("doc_id", bpe.encode(F.col("text"), content, checked=True).alias("e"))
    assert {r.doc_id: (r.e.n_tokens, r.e.round_trip) for r in rows.collect()} == {1: (1, True), 2: (1, False), 3: (1, True)}
