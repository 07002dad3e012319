"""Encoding against the public library, decoding and packing as exact round trips."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken

import public_tokenizers
from pyspark.sql import functions as F
from spanlight.llm import bpe, packing, queries

ALPHABET = [*"ab  \n\t'stredllvm.,!?#09éß中文😀　\x1c\x85İǅ\0", "the ", "ing", "'re", "'ll", "  "]


@pytest.fixture(scope="module")
def content():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(content):
    return _library(content)


def _library(content):
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.vocabulary(content).ranks, special_tokens={})


@pytest.mark.parametrize("leaf,leaf_bytes,window", [(7, 4, 1), (1, 1, 1), (50, 16, 4)])
def test_tree_equals_library_at_every_cut(monkeypatch, content, library, leaf, leaf_bytes, window):
    monkeypatch.setattr(bpe, "LEAF_CHARS", leaf)
    monkeypatch.setattr(bpe, "LEAF_BYTES", leaf_bytes)
    monkeypatch.setattr(bpe, "WINDOW_CHARS", window)
    monkeypatch.setattr(bpe, "WINDOW_TOKENS", window)
    vocab, rng = bpe.Vocabulary(content), random.Random(leaf)
    for _ in range(1500):
        some = rng.sample(ALPHABET, rng.randrange(1, 12))
        text = "".join(rng.choice(some) for _ in range(rng.choice([0, 1, 5, 30, 200])))
        ids = vocab.encode(text).tolist()
        assert ids == library.encode_ordinary(text), text
        assert vocab.decode(ids) == text.encode()


@pytest.mark.parametrize("n", [1, 63, 64, 65, 5000, 60_000])
def test_long_pieces(content, library, n):
    rng = random.Random(n)
    for text in ("a" * n, "".join(rng.choice("abcdefg") for _ in range(n)), " " * n, "é" * n):
        vocab = bpe.vocabulary(content)
        assert vocab.encode(text).tolist() == library.encode_ordinary(text)
        pure = vocab._merged_long(text.encode())
        assert n > 5000 or vocab._merged_short(text.encode()) == pure
        assert vocab._piece_tree(text.encode()) == pure


def test_op8_on_all_documents(spark, data_dir, library):
    got = {r.doc_id: r for r in queries.QUERIES["op8_byte_bpe"](spark, data_dir).collect()}
    rows = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4")
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert g.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_defined_cases(spark, documents):
    ranks = bpe.rank_file(spark)
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (5, "word " * 60_000)]
    out = documents(rows).select("doc_id", bpe.encode(F.col("text"), ranks).alias("e")).select(
        "doc_id", "e", bpe.decode(F.col("e.ids"), ranks).alias("d")).collect()
    assert sorted((r.doc_id or 0, bytes(r.d).decode()) for r in out) == sorted((r[0] or 0, r[1] or "") for r in rows)
    assert [r.e.n_tokens for r in out if r.doc_id == 1] == [0]
    assert documents([]).select(bpe.encode(F.col("text"), ranks)).count() == 0
    with pytest.raises(KeyError):
        bpe.vocabulary(ranks.value).decode([10**9])


def test_best_fit_decreasing_against_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        capacity = rng.choice([1, 2, 7, 64, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randrange(60))]
        rows = packing.best_fit_decreasing(lengths, capacity)
        free, want = [], []
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fits = [j for j in range(len(free)) if free[j] >= lengths[i]]
            if fits:
                j = min(fits, key=lambda j: free[j])
            else:
                j = len(free)
                free.append(capacity)
                want.append([])
            free[j] -= lengths[i]
            want[j].append(i)
        assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
        assert sorted(sum(lengths[i] for i in r) for r in rows) == sorted(sum(lengths[i] for i in r) for r in want)


@pytest.mark.parametrize("row_tokens,block", [(64, 500), (2048, 4_000_000)])
def test_packing_is_lossless(spark, data_dir, library, row_tokens, block):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").limit(120)
    packs = packing.pack(docs, bpe.rank_file(spark), row_tokens=row_tokens, block_tokens=block)
    rows = packs.collect()
    assert len({r.pack_id for r in rows}) == len(rows)
    for r in rows:
        assert len(r.ids) == len(r.position_ids) == 2 * row_tokens and r.cu_seqlens[-1] == r.n_tokens <= row_tokens
        position = np.frombuffer(r.position_ids, "<u2")
        for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]):
            assert b > a and position[a:b].tolist() == list(range(b - a))
        assert set(np.frombuffer(r.ids, "<u2")[r.n_tokens:].tolist()) <= {packing.PAD_ID}
    back = {}
    for s in packing.unpack(packs).collect():
        back.setdefault(s.doc_id, []).append((s.start, bytes(s.ids)))
    for r in docs.collect():
        ids = np.frombuffer(b"".join(p for _, p in sorted(back.get(r.doc_id, []))), "<u2").tolist()
        assert ids == library.encode_ordinary(r.text or "")


def test_packing_defined_cases(spark, documents, tmp_path):
    ranks = bpe.rank_file(spark)
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "a b c"), (3, "a b c"), (4, "word " * 20_000)]
    packs = packing.pack(documents(rows), ranks)
    packing.write_packed(packs, str(tmp_path / "packs"))
    packs = spark.read.parquet(str(tmp_path / "packs"))
    n = len(_library(ranks.value).encode_ordinary("word " * 20_000))
    assert packs.agg(F.sum("n_tokens")).first()[0] == 9 + n
    assert packing.unpack(packs).where("doc_id = 3").count() == 2
    assert packing.pack(documents([]), ranks).count() == 0
