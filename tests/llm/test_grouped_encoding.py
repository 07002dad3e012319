"""Leaves of many texts encoded together: the narrow split, merges a round at a time, pieces kept and passing."""

import random

import public_tokenizers
import pytest
import regex
import tiktoken

from spanlight.llm import bpe


@pytest.fixture(scope="module")
def content():
    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(content):
    return tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.Vocabulary(content).ranks, special_tokens={})


def test_narrow_split_is_the_split():
    narrow, rng = bpe.narrow_pattern(public_tokenizers.PATTERN), random.Random(3)
    wide = regex.compile(public_tokenizers.PATTERN)
    low = list(map(chr, range(256)))
    kinds = ["a", "é", "ß", "ª", "1", "²", "½", "_", "'", "'s", "'ll", "'S", " ", "  ", "\n", "\t", "\x1c", "\x1f", "\x85", "\xa0", "\xad", "-", "\0"]
    texts = ["".join(a + b for b in low) for a in low]
    texts += ["".join(rng.choice(kinds) for _ in range(rng.randrange(12))) for _ in range(20_000)]
    for text in texts:
        assert narrow.findall(text) == wide.findall(text)
    assert bpe.narrow_pattern(r"\S+|\s+") is None


def test_pieces_merged_together_are_merged_alone(content):
    vocab, rng = bpe.Vocabulary(content), random.Random(4)
    tokens = list(vocab.ranks)
    pieces = [b"".join(rng.choice(tokens) for _ in range(rng.randrange(1, 6)))[:bpe.LEAF_BYTES + rng.randrange(8)] for _ in range(6000)]
    pieces += [bytes(rng.randrange(256) for _ in range(rng.randrange(1, 20))) for _ in range(3000)] + [b"a" * n for n in range(1, 80)]
    for piece, packed in zip(pieces, vocab.packed_pieces(pieces)):
        assert memoryview(packed).cast("I").tolist() == vocab.piece(piece)


@pytest.mark.parametrize("kept", [0, 40, 10_000])
def test_groups_equal_the_library(content, library, kept, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", kept)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 700)
    monkeypatch.setattr(bpe, "LEAF_CHARS", 50)
    vocab, rng = bpe.Vocabulary(content), random.Random(kept)
    words = ["geschzulich", "anheinntha", "ciónñgaci", "don't", "x" * 90, "Ünï", "漢字", "😀", "42", "\n\n", " ", "--", "½", "\x1c"]
    texts = ["", " "] + ["".join(rng.choice(words) + rng.choice(["", " ", "  "]) for _ in range(rng.randrange(200))) for _ in range(60)]
    got = list(vocab.encode_many(iter(texts)))
    assert [ids.tolist() for ids in got] == [library.encode_ordinary(text) for text in texts]
    assert len(vocab.pieces) <= kept


def test_vocabulary_without_all_bytes():
    """Merges of parts that are no tokens themselves, as before; a byte that stays over is refused."""
    import base64
    ranks = {b"a": 0, b"ab": 1, b"abc": 2, b" ": 3}
    vocab = bpe.Vocabulary(b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items()))
    assert vocab.encode("abca").tolist() == [2, 0]
    with pytest.raises(KeyError):
        vocab.encode("abx")


def test_pieces_kept_as_asked(content, library):
    texts = [" ".join(f"wort{i}" for i in range(k, k + 60)) for k in range(0, 600, 60)]
    few, many = bpe.vocabulary(content, kept=25), bpe.vocabulary(content)
    for vocab in (few, many):
        assert [vocab.encode(t).tolist() for t in texts] == [library.encode_ordinary(t) for t in texts]
    assert len(few.pieces) <= 25 < len(many.pieces)


def test_only_new_pieces_are_learned(content, monkeypatch):
    """Pieces are looked up once where they are split off; the set of a group holds the new ones alone."""
    asked, learn = [], bpe.Pieces.learn
    monkeypatch.setattr(bpe.Pieces, "learn", lambda self, pieces: (asked.append(set(pieces)), learn(self, pieces))[1])
    vocab = bpe.Vocabulary(content)
    first = vocab.encode("aufenthal ciónjaja 42").tolist()
    assert vocab.encode("aufenthal ciónjaja 42 neuwortig").tolist()[:len(first)] == first
    assert asked == [{"aufenthal", " ciónjaja", " 42"}, {" neuwortig"}]


def test_a_merge_looks_up_two_pairs(content, monkeypatch):
    """Merging together asks for the two new pairs of each merge only; pairs of single bytes come from a table."""
    vocab, rng, asked = bpe.Vocabulary(content), random.Random(6), []
    pieces = [p for n in range(500) if (p := bytes(rng.choice(b"aehinrst") for _ in range(2 + n % 60))) not in vocab.ranks]
    expected = [vocab.piece(p) for p in pieces]
    vocab.packed_pieces([b"zzxqv"])  # makes the tables
    ranks_of = vocab._ranks_of
    monkeypatch.setattr(vocab, "_ranks_of", lambda left, right: (asked.append(left.size), ranks_of(left, right))[1])
    assert [memoryview(p).cast("I").tolist() for p in vocab.packed_pieces(pieces)] == expected
    assert sum(asked) <= 2 * sum(len(p) - len(ids) for p, ids in zip(pieces, expected))
