"""Byte-level BPE encoding and decoding by monoid tree reduction.

A text is halved until its parts are small; the pieces of each part are merged alone (new short ones of many parts a
round at a time in numpy, as each takes the same steps), and neighbours are joined by
re-encoding a window around the seam. The window grows until what lies outside is proven stable:

* Between pieces of the split pattern: a place where a space or line feed follows a character that is
  no white space always starts a piece, whatever stands before it. Left of such a place the window
  changes nothing, right of one neither, so the window grows to the nearest one on each side.
* Within one long piece: a token sequence is the encoding of its bytes exactly when every two
  neighbours, merged alone, stay as they are (the first merge across any boundary would also be the
  first one when these two tokens are merged alone). The halves fulfil this inside; the window grows
  until it also holds at its two edges.

Joining is associative, so the tree may be cut anywhere. Decoding concatenates bytes up the same tree.

Defined cases: null text is empty and has no tokens; an unknown id cannot be decoded and raises.
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from itertools import chain, compress, count, repeat, tee
from operator import not_

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StructType

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LEAF_CHARS = 1024  # a text part this short is a leaf: its pieces are merged one by one
LEAF_BYTES = 64  # and a part of one long piece
GROUP_CHARS = 1 << 20  # leaves whose pieces are looked up, and merged if new, together
MERGED_AT_ONCE = 1024  # short pieces merged together
LEAF_TOKENS = 4096  # ids that are decoded at once
CACHED_PIECES = 1_000_000  # short pieces whose ids a worker keeps
WINDOW_CHARS = 32
WINDOW_TOKENS = 4
_SYNC = re.compile(r"(?<=[^\s\x1c-\x1f\x85])[ \n]")
# The public pattern, written so that each alternative starts with other characters than the one before can.
_SPLIT = {r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+":
          " ?[{L}]+|'(?:[stmd]|re|ve|ll)| ?[{N}]+| ?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"}


def rank_file(spark: SparkSession, path: str | None = None) -> Broadcast:
    """The rank file (under a megabyte for 50,000 tokens), read by the driver and sent to the workers."""
    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def narrow_pattern(pattern: str) -> re.Pattern | None:
    """The split pattern for texts of characters below U+0100, where a class is a small table and `re` is faster.

    The classes hold the characters that `regex` gives them, so both split alike. None if the pattern has no such form.
    """
    if pattern not in _SPLIT:
        return None
    low = "".join(map(chr, range(256)))
    members = {name: "".join(map(re.escape, regex.findall(kind, low))) for name, kind in (("L", r"\p{L}"), ("N", r"\p{N}"), ("S", r"\s"))}
    return re.compile(_SPLIT[pattern].format(**members))


@lru_cache(maxsize=2)
def vocabulary(content: bytes, pattern: str = public_tokenizers.PATTERN, kept: int | None = None) -> "Vocabulary":
    return Vocabulary(content, pattern, kept)


class Pieces(dict):
    """Packed ids of pieces met before. Holds a bounded number of short pieces; others are encoded each time, or
    kept in `passing` for as long as one group of leaves lasts.
    """

    def __init__(self, encode, encode_many, kept: int | None = None):
        super().__init__()
        self.encode, self.encode_many, self.kept = encode, encode_many, kept
        self.passing: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        """Encode the short ones of new pieces, all together."""
        new = [p for p in pieces if len(p) <= LEAF_BYTES]
        found = dict(zip(new, self.encode_many([p.encode() for p in new])))
        room = len(self) + len(found) <= (CACHED_PIECES if self.kept is None else self.kept)
        self.passing = {} if room else found
        if room:
            self.update(found)

    def __missing__(self, piece: str) -> bytes:
        ids = self.passing.get(piece)
        if ids is None:
            ranks = self.encode(piece.encode())
            ids = struct.pack(f"<{len(ranks)}I", *ranks)
        return ids


class Vocabulary:
    """Ranks of a vocabulary, with the encoder of pieces, the joins and the decoder."""

    def __init__(self, content: bytes, pattern: str = public_tokenizers.PATTERN, kept: int | None = None):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines()) if a}
        self.bytes_of = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.narrow = narrow_pattern(pattern)
        self.no_rank = max(self.ranks.values(), default=0) + 1
        self.pieces = Pieces(self.piece, self.packed_pieces, kept)

    # many short pieces ---------------------------------------------------
    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Every two tokens that merge, as (left << 32 | right) in order, and what they merge to."""
        get, found = self.ranks.get, {}
        for token, rank in self.ranks.items():
            for i in range(1, len(token)):
                if (a := get(token[:i])) is not None and (b := get(token[i:])) is not None:
                    found[a << 32 | b] = rank
        keys = np.fromiter(found.keys(), np.int64, len(found))
        order = np.argsort(keys)
        return keys[order], np.fromiter(found.values(), np.int64, len(found))[order]

    @cached_property
    def single(self) -> np.ndarray:
        """The token of every byte."""
        return np.array([self.ranks[bytes([c])] for c in range(256)])

    @cached_property
    def single_pairs(self) -> np.ndarray:
        """What every two bytes merge to."""
        return self._ranks_of(*np.broadcast_arrays(self.single[:, None], self.single))

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What two tokens merge to, `no_rank` if they do not."""
        keys, merged = self.pairs
        if not len(keys):
            return np.full(left.shape, self.no_rank)
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, merged[at], self.no_rank)

    def _merged_together(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of short pieces by the steps of `merged`, in every piece one merge a round.

        A piece is a column of cells between two that hold no token; a cell knows the cells before and behind it, so a
        merge moves nothing. Where a part starts, `pair` is (what it and the next one merge to) << 8 | row, so that the
        least of a column is the lowest rank, leftmost first (LEAF_BYTES keeps rows below 256). `no_rank` stands for no
        token and for no merge.
        """
        n, none = len(pieces), self.no_rank
        height = max(map(len, pieces)) + 2
        sizes = np.array([len(p) for p in pieces])
        given = np.frombuffer(b"".join(p.ljust(height - 2, b"\0") for p in pieces), np.uint8).reshape(n, -1).T
        numbers = np.arange(height)[:, None]
        parts = np.full((height, n), none)
        parts[1:-1] = np.where(numbers[:-2] < sizes, self.single[given], none)
        pair = np.full((height, n), none << 8)
        pair[1:-2] = np.where(numbers[1:-2] < sizes, self.single_pairs[given[:-1], given[1:]], none) << 8
        pair |= numbers
        behind = np.arange(height * n) + n
        before = behind - 2 * n
        parts, flat, columns = parts.ravel(), pair.ravel(), np.arange(n)
        while True:
            least = pair.min(0)[columns]
            merges = least < none << 8
            if not merges.all():
                columns, least = columns[merges], least[merges]
            if not len(columns):
                break
            token, at = least >> 8, (least & 255) * n + columns
            gone, left = behind[at], before[at]
            right = behind[gone]
            parts[at], parts[gone] = token, none
            behind[at], before[right] = right, at
            flat[gone] = none << 8
            places = np.concatenate([left, at])
            flat[places] = self._ranks_of(parts[places], np.concatenate([token, parts[right]])) << 8 | places // n
        table = parts.reshape(height, n).T
        left_over = table != none
        ends = np.cumsum(left_over.sum(1) * 4).tolist()
        packed = table[left_over].astype("<u4").tobytes()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def packed_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each piece, as `piece` gives them; short ones are merged together.

        A vocabulary without a token for every byte has merges of parts that are no tokens, so `pairs` is not enough for it.
        """
        alone = not all(bytes([c]) in self.ranks for c in range(256))
        out: list[bytes] = [b""] * len(pieces)
        short: list[int] = []
        for i, p in enumerate(pieces):
            if alone or p in self.ranks or not 1 < len(p) <= LEAF_BYTES:
                ranks = self.piece(p)
                out[i] = struct.pack(f"<{len(ranks)}I", *ranks)
            else:
                short.append(i)
        lengths = list(map(len, pieces))
        short.sort(key=lengths.__getitem__)
        for k in range(0, len(short), MERGED_AT_ONCE):
            part = short[k:k + MERGED_AT_ONCE]
            for i, ids in zip(part, self._merged_together([pieces[i] for i in part])):
                out[i] = ids
        return out

    # one piece ----------------------------------------------------------
    def merged(self, piece: bytes) -> list[int]:
        """Merge neighbours by lowest rank, leftmost first, until no two can merge."""
        return self._merged_short(piece) if len(piece) <= LEAF_BYTES else self._merged_long(piece)

    def _merged_short(self, piece: bytes) -> list[int]:
        get, none = self.ranks.get, self.no_rank
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pair = [get(piece[i:i + 2], none) for i in range(len(piece) - 1)]  # of each part and its right neighbour
        while pair and (least := min(pair)) < none:
            i = pair.index(least)
            parts[i] += parts.pop(i + 1)
            del pair[i]
            if i < len(pair):
                pair[i] = get(parts[i] + parts[i + 1], none)
            if i:
                pair[i - 1] = get(parts[i - 1] + parts[i], none)
        return [self.ranks[part] for part in parts]

    def _merged_long(self, piece: bytes) -> list[int]:
        n, ranks = len(piece), self.ranks
        if n == 1:
            return [ranks[piece]]
        end = list(range(1, n + 1))  # end of the part that starts here; 0 once it has been merged away
        before = list(range(-1, n - 1))

        def rank(a: int) -> int | None:
            b = end[a]
            return ranks.get(piece[a:end[b]]) if b < n else None

        heap = [(r, a, end[end[a]]) for a in range(n - 1) if (r := rank(a)) is not None]
        heapq.heapify(heap)
        while heap:
            _, a, upto = heapq.heappop(heap)
            b = end[a]
            if not b or b >= n or not end[b] or end[b] != upto:
                continue
            end[a], end[b] = upto, 0
            if upto < n:
                before[upto] = a
                if (r := rank(a)) is not None:
                    heapq.heappush(heap, (r, a, end[upto]))
            if (p := before[a]) >= 0 and (r := rank(p)) is not None:
                heapq.heappush(heap, (r, p, upto))
        out, a = [], 0
        while a < n:
            out.append(ranks[piece[a:end[a]]])
            a = end[a]
        return out

    def _text(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def _holds(self, a: int, b: int) -> bool:
        return self.merged(self.bytes_of[a] + self.bytes_of[b]) == [a, b]

    def join_tokens(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring parts of one piece, from their encodings."""
        k = WINDOW_TOKENS
        while True:
            window = self.merged(self._text(left[-k:] + right[:k]))
            if ((k >= len(left) or self._holds(left[-k - 1], window[0]))
                    and (k >= len(right) or self._holds(window[-1], right[k]))):
                return left[:-k] + window + right[k:]
            k *= 2

    def _piece_tree(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF_BYTES:
            return self.merged(piece)
        half = len(piece) // 2
        return self.join_tokens(self._piece_tree(piece[:half]), self._piece_tree(piece[half:]))

    def piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)  # a piece that is a token stays whole, even if no merge leads there
        return [whole] if whole is not None else self._piece_tree(piece)

    # a text -------------------------------------------------------------
    def split(self, text: str) -> list[str]:
        """The matches of the pattern, one after the other."""
        if self.narrow is not None:
            try:
                text.encode("latin-1")
                return self.narrow.findall(text)
            except UnicodeEncodeError:
                pass
        return self.pattern.findall(text)

    def _leaf(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text))), dtype="<u4")

    def _without(self, ids: np.ndarray, n_bytes: int, last: bool) -> np.ndarray:
        """ids without the tokens of the last (or first) n_bytes, which end at a token's edge."""
        k = 0
        while n_bytes:
            k += 1
            n_bytes -= len(self.bytes_of[int(ids[-k if last else k - 1])])
            if n_bytes < 0:
                raise AssertionError("the window does not end at a token")
        return ids[:len(ids) - k] if last else ids[k:]

    def join_texts(self, left: str, left_ids: np.ndarray, right: str, right_ids: np.ndarray) -> np.ndarray:
        """The encoding of two neighbouring parts of a text, from their encodings."""
        if _SYNC.match(left[-1:] + right[:1], 1):
            return np.concatenate([left_ids, right_ids])
        size = WINDOW_CHARS
        while True:
            a = max((m.start() for m in _SYNC.finditer(left, max(0, len(left) - size))), default=None)
            b = m.start() if (m := _SYNC.search(right, 0, size)) else None
            a = 0 if a is None and size >= len(left) else a
            b = len(right) if b is None and size >= len(right) else b
            if a is not None and b is not None:
                break
            size *= 2
        window = self._leaf(left[a:] + right[:b])
        return np.concatenate([self._without(left_ids, len(left[a:].encode()), True), window,
                               self._without(right_ids, len(right[:b].encode()), False)])

    def _cut(self, text: str) -> int:
        """Where a text is halved, at a start of a piece if one is near; 0 if it is a leaf."""
        if len(text) <= LEAF_CHARS or not _SYNC.search(text):
            return 0
        half = len(text) // 2
        return m.start() if (m := _SYNC.search(text, half, half + WINDOW_CHARS)) else half

    def _leaves(self, text: str) -> Iterator[str]:
        ahead = [text]
        while ahead:
            text = ahead.pop()
            if at := self._cut(text):
                ahead += [text[at:], text[:at]]
            else:
                yield text

    def _encoded(self, leaves: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of leaves, group by group."""
        group, chars = [], 0
        for last, leaf in chain(zip(repeat(False), leaves), [(True, "")]):
            pieces = self.split(leaf)
            found = list(map(self.pieces.get, pieces))  # looked up while at hand; the new ones wait for the group
            places = list(compress(count(), map(not_, found)))
            group.append((found, places, [pieces[i] for i in places]))
            chars += len(leaf)
            if last or chars >= GROUP_CHARS:
                self.pieces.learn(set().union(*(new for _, _, new in group)))
                for found, places, new in group[:-1] if last else group:
                    for i, piece in zip(places, new):
                        found[i] = self.pieces[piece]
                    yield np.frombuffer(b"".join(found), dtype="<u4")
                group, chars = [], 0

    def _tree(self, text: str, leaves: Iterator[np.ndarray]) -> np.ndarray:
        if not (at := self._cut(text)):
            return next(leaves)
        left = self._tree(text[:at], leaves)
        return self.join_texts(text[:at], left, text[at:], self._tree(text[at:], leaves))

    def encode_many(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text; leaves of several texts are encoded together, so `texts` is read one group ahead."""
        ahead, texts = tee(texts)
        leaves = self._encoded(leaf for text in ahead for leaf in self._leaves(text))
        for text in texts:
            yield self._tree(text, leaves)

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_many([text]))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_TOKENS:
            return self._text(ids)
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def encode(text: Column, ranks: Broadcast, checked: bool = False, kept: int | None = None) -> Column:
    """struct<ids: binary of little-endian unsigned 32-bit integers, n_tokens: long>, if `checked` also round_trip: boolean,
    whether the ids decode to the bytes of the text.

    `decode` behind `encode` runs in a second Python worker of the same task. Idle workers serve either function, so in
    time all of them keep pieces and a vocabulary; the check in the same call needs no second one. `kept`: the most pieces
    that a worker keeps, CACHED_PIECES if not given; others are merged anew.
    """
    kind = StructType().add("ids", BinaryType()).add("n_tokens", LongType())
    if checked:
        kind = kind.add("round_trip", BooleanType())

    @F.arrow_udf(kind)
    def of(texts: pa.Array) -> pa.Array:
        vocab = vocabulary(ranks.value, kept=kept)
        packed, same = [], []
        for text, ids in zip(texts, vocab.encode_many(t.as_py() for t in texts)):
            packed.append(ids.astype("<u4").tobytes())
            if checked:
                same.append(vocab.decode(ids.tolist()) == text.as_py().encode())
        out = [pa.array(packed, pa.binary()), pa.array([len(p) // 4 for p in packed], pa.int64())]
        return pa.StructArray.from_arrays(out + [pa.array(same, pa.bool_())] * checked, kind.names)

    return of(F.coalesce(text, F.lit("")))


def decode(ids: Column, ranks: Broadcast) -> Column:
    """The bytes of packed ids, as `encode` gives them; null stays null."""
    @F.arrow_udf(BinaryType())
    def of(packed: pa.Array) -> pa.Array:
        vocab = vocabulary(ranks.value)
        return pa.array([vocab.decode(np.frombuffer(p.as_buffer(), "<u4").tolist()) if p.is_valid else None for p in packed],
                        pa.binary())

    return of(ids)
