"""Benchmark decontamination by template canonicalisation.

Numbers, units after numbers and names become typed placeholders; what is left of a text is its template,
and the replaced words are the fillers of its slots. Templates of benchmark items are cut into windows of
`window` tokens and joined by hash with the windows of all documents. A match counts for the item and
the offset at which it lies, so each occurrence of an item in a document is judged by itself: it
must cover the item, and its slots must be consistent, that is one filler of the item always became the
same filler in the document and two fillers never became one. So a question asked again with other
numbers and names is found, while a text that only has the same shape is left alone.

`leaks` (op6) reads names strictly: a name that starts a sentence is a plain word there, each capitalised word is a slot of its
own, and names go by their case, so an item whose names start its sentences can be missed when it is asked again, and
a copy in lower case or in capitals is missed. `decontaminate` (the pipeline) removes what `leaks` finds and what two more readings
find: "folded", in which names are plain words and case does not count, and "wide", in which a capitalised word that
is a name elsewhere in the same text is one at the start of a sentence too and a run of name words is one slot. In both one
occurrence also joins offsets within NEAR of each other, so a word put in or left out does not part it.

Documents stream through the workers. As long as the benchmark has at most MAX_HASHES windows the workers
hold their hashes (8 bytes each) and let pass only windows that are among them; a text that holds none of the
words of which a match needs one is not cut into windows at all. A larger benchmark is joined with all windows
by shuffle. The join, the grouping by occurrence and the slot check are Spark's. Windows of one
occurrence are bounded by the length of the item, so no group grows with the data.

Defined cases: null and empty documents and items match nothing; an item shorter than a window is one
window of its own length; a window needs LITERALS plain words (an item without any such window matches
nothing); repeated rows of documents are each judged; repeated items are reported each; empty tables
give no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import small_side
from .common import written

WINDOW = 8
LITERALS = 4  # plain words a window must have; fewer say nothing about the text
COVERAGE = 0.8
MAX_HASHES = 1_000_000
CACHED_WORDS = 200_000
# Units of measure that may follow a number.
UNITS = frozenset(
    "mm cm m km inch inches ft feet foot yard yards mile miles mg g kg ton tons tonnes lb lbs pound pounds oz ml l liter "
    "liters litre litres s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "% percent dollar dollars euro euros cent cents usd eur kmh mph hz kb mb gb tb watt watts volt volts degree degrees".split())
_SIGNS = "!\"#&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„‘’‚–—…·•¡¿"
_CLOSERS = "\"')]}»”’"
_IS_NUMBER = re.compile(r"[$€£]?\d[\d.,:/]*%?$")
_BREAK = "\x02"  # stands for a line feed among the words
READINGS = ("strict", "folded", "wide")
NEAR = 8
_IS_NUM, _IS_UNIT, _IS_CAPITAL, _IS_END, _IS_SIGN, _IS_FOREIGN = 1, 2, 4, 8, 16, 32
_NUMBER, _UNIT, _NAME = 1, 2, 3  # tokens of the placeholders; a plain word's token is its hash
_FACTOR = 0x9E3779B97F4A7C15


def bare(raw: str) -> str:
    """A word without the signs at its edges."""
    return raw.strip(_SIGNS)


class Words(dict):
    """Packed facts of a raw word: 57 bits of hash of its plain form and six flags. Holds a bounded number of words."""

    def __init__(self, vocabulary: frozenset[str] | None = None):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, raw: str) -> int:
        word = raw.strip(_SIGNS)
        low = word.lower()
        flags = _IS_END if raw == _BREAK or raw.rstrip(_CLOSERS)[-1:] in (".", "!", "?", ":") else 0
        known = False
        if not word or raw == _BREAK:
            flags |= _IS_SIGN
        elif (word[0].isdigit() or word[0] in "$€£") and _IS_NUMBER.match(word):
            flags |= _IS_NUM
        else:
            if low in UNITS:
                flags |= _IS_UNIT
            if word[0] != low[0] and len(word) > 1 and word[1:] == low[1:]:
                flags |= _IS_CAPITAL
            known = self.vocabulary is None or low in self.vocabulary
            if not known:
                flags |= _IS_FOREIGN
        packed = (xxhash.xxh64_intdigest(low) >> 7 << 6) | flags if known else flags
        if len(self) < CACHED_WORDS:
            self[raw] = packed
        return packed


def canonical(text: str, facts: Words, reading: str = "strict") -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(raw words, places, tokens, foreign): the places of the words that are not mere signs, their template
    tokens (1, 2 and 3 are number, unit and name), and which are plain words outside the vocabulary.

    A name is a capitalised word of two or more letters, the rest in lower case, that does not start a
    sentence or line; a unit is a unit word right after a number. Other readings see the module's text; in the wide one
    the raw word of a run's first place holds the whole run.
    """
    raw = text.replace("\n", f" {_BREAK} ").split()
    packed = np.fromiter(map(facts.__getitem__, raw), dtype=np.int64, count=len(raw))
    flags = (packed & 63).astype(np.uint8)
    kept = np.flatnonzero(flags & _IS_SIGN == 0)
    ends = (flags & _IS_END) > 0
    ends_before = (np.cumsum(ends) - ends)[kept]
    flags = flags[kept]
    starts = np.ones(len(kept), dtype=bool)
    starts[1:] = np.diff(ends_before) > 0
    number = (flags & _IS_NUM) > 0
    unit = (flags & _IS_UNIT) > 0
    unit[1:] &= number[:-1]
    unit[:1] = False
    capital = ((flags & _IS_CAPITAL) > 0) & ~unit
    name = capital & ~starts if reading != "folded" else np.zeros(len(kept), dtype=bool)
    if reading == "wide":
        names = {bare(raw[k]) for k in kept[name]}
        for i in np.flatnonzero(capital & starts):
            name[i] = bare(raw[kept[i]]) in names
    tokens = packed[kept] & ~np.int64(63)
    tokens[number], tokens[unit], tokens[name] = _NUMBER, _UNIT, _NAME
    foreign = ((flags & _IS_FOREIGN) > 0) & ~(number | unit | name)
    if reading == "wide":
        on = np.zeros(len(kept), dtype=bool)  # goes on with the run of the word before it
        on[1:] = name[1:] & name[:-1] & ~starts[1:]
        head = 0
        for i in np.flatnonzero(on):
            if raw[kept[i] - 1][-1:] in _SIGNS:  # a sign parts two names
                on[i] = False
                continue
            head = head if on[i - 1] else i - 1
            raw[kept[head]] = f"{raw[kept[head]]} {raw[kept[i]]}"
        kept, tokens, foreign = kept[~on], tokens[~on], foreign[~on]
    return raw, kept, tokens, foreign


def windows(tokens: np.ndarray, foreign: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the windows of n tokens with enough plain words, all of them in the vocabulary."""
    if n < 1 or len(tokens) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    count = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    plain, outside = count((tokens < _NUMBER) | (tokens > _NAME)), count(foreign)
    at = np.flatnonzero((plain[n:] - plain[:-n] >= LITERALS) & (outside[n:] == outside[:-n]))
    h = np.full(len(at), n, dtype=np.uint64)
    for j in range(n):
        h = (h ^ tokens[at + j].view(np.uint64)) * np.uint64(_FACTOR)
        h ^= h >> np.uint64(29)
    return at, h.view(np.int64)


def _fillers(raw: list[str], kept: np.ndarray, tokens: np.ndarray, at: int, n: int) -> list[str]:
    """Of each token of a window the word that fills its slot; empty for a plain word."""
    return [bare(raw[kept[i]]).strip("$€£%") if _NUMBER <= tokens[i] <= _NAME else "" for i in range(at, at + n)]


def _anchors(found: list[list[str]], coverage: float) -> dict[int, str]:
    """Windows of an item, by number, of which a document must hold at least one, each with a word it must then hold.

    A match lacks at most 1 - coverage of the windows, so of one window more than that one must be there; those
    with the longest plain words are taken. A word with a sigma is passed over, as its lower case depends on its
    neighbours; an empty word says that the window can be anywhere.
    """
    best = [max((w for w in words if "σ" not in w and "ς" not in w), key=len, default="") for words in found]
    must = len(found) - math.ceil(Fraction(str(coverage)) * len(found)) + 1
    return {i: best[i] for i in sorted(range(len(best)), key=lambda i: -len(best[i]))[:must]}


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
                 coverage: float = COVERAGE, reading: str = "strict") -> DataFrame:
    """(item_row, item_id, size, n_windows, item_at, hash, item_slots, words, anchor): all windows of all items."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = Words()
        for batch in batches:
            out = []
            for row, item, text in zip(*[c.to_pylist() for c in batch.columns]):
                raw, kept, tokens, foreign = canonical(text or "", facts, reading)
                n = min(window, len(tokens))
                at, hashes = windows(tokens, foreign, n)
                words = [bare(raw[k]).lower() for k in kept]
                plain = [[words[i] for i in range(a, a + n) if not _NUMBER <= tokens[i] <= _NAME] for a in at.tolist()]
                anchor = _anchors(plain, coverage)
                out += [(row, item, n, len(at), a, h, _fillers(raw, kept, tokens, a, n), plain[i], anchor.get(i))
                        for i, (a, h) in enumerate(zip(at.tolist(), hashes.tolist()))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    names = ["item_row", "item_id", "size", "n_windows", "item_at", "hash", "item_slots", "words", "anchor"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string()]
    return benchmark.select(F.monotonically_increasing_id().alias("r"), F.col(f"`{id_col}`").cast("long").alias("i"),
                            F.col(f"`{text_col}`").alias("t")).mapInArrow(
        of, "item_row long, item_id long, size int, n_windows int, item_at int, hash long, item_slots array<string>, words array<string>, anchor string")


@dataclass(frozen=True)
class Known:
    """What the workers hold of a benchmark of proven size: hashes of its windows, their plain words, the anchors."""

    hashes: np.ndarray
    vocabulary: frozenset[str]
    anchors: frozenset[str]


def _may_match(known: Known | None):
    """Whether a text holds any anchor; every text may match if there are none or a window has none."""
    if known is None or not known.anchors or "" in known.anchors:
        return lambda text: True
    search = ahocorasick.Automaton()
    for word in known.anchors:
        search.add_word(word, True)
    search.make_automaton()
    return lambda text: next(search.iter(text.lower()), None) is not None


def document_windows(docs: DataFrame, sizes: list[int], known: Known | None, reading: str = "strict") -> DataFrame:
    """(doc_row, doc_id, doc_at, hash, doc_slots) from (doc_row, doc_id, text); only known hashes if these are given."""
    held = docs.sparkSession.sparkContext.broadcast(known)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        may_match, wanted = _may_match(held.value), held.value.hashes if held.value else None
        vocab = held.value.vocabulary if held.value else None
        facts = Words(vocab)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for row, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if not text.is_valid or not may_match(text.as_py()):
                    continue
                raw, kept, tokens, foreign = canonical(text.as_py(), facts, reading)
                for n in sizes:
                    at, hashes = windows(tokens, foreign, n)
                    if wanted is not None and len(at):
                        place = np.minimum(np.searchsorted(wanted, hashes), len(wanted) - 1)
                        hit = wanted[place] == hashes
                        at, hashes = at[hit], hashes[hit]
                    for a, h in zip(at.tolist(), hashes.tolist()):
                        for col, v in zip(out, (row, doc, a, h, _fillers(raw, kept, tokens, a, n))):
                            col.append(v)
                if len(out[0]) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
                    out = [[], [], [], [], []]
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    names = ["doc_row", "doc_id", "doc_at", "hash", "doc_slots"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string())]
    return docs.select("doc_row", "doc_id", "text").mapInArrow(
        of, "doc_row long, doc_id long, doc_at int, hash long, doc_slots array<string>")


def matches(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, window: int = WINDOW,
            reading: str = "strict") -> DataFrame:
    """One row per document row and item found in it: doc_row, doc_id, item_id, coverage, reparameterised,
    n_occurrences. Takes (doc_row, doc_id, text)."""
    items = written(item_windows(benchmark, window=window, coverage=coverage, reading=reading))
    facts = items.agg(F.count_distinct("hash").alias("n"), F.collect_set("size").alias("sizes")).first()
    if not facts.n:
        return docs.sparkSession.createDataFrame(
            [], "doc_row long, doc_id long, item_id long, coverage double, reparameterised boolean, n_occurrences long")
    known = None
    if facts.n <= MAX_HASHES:  # proven size: so many hashes, and the words of so many windows
        each = lambda c: [r.v for r in items.select(c.alias("v")).where("v IS NOT NULL").distinct().collect()]
        known = Known(np.sort(np.array(each(F.col("hash")), dtype=np.int64)), frozenset(each(F.explode("words"))),
                      frozenset(each(F.col("anchor"))))
    found = document_windows(docs, sorted(facts.sizes), known, reading)
    both = found.join(small_side(items.drop("words", "anchor")), "hash")
    offset = F.struct(F.lit(0).alias("grid"), (F.col("doc_at") - F.col("item_at")).cast("long").alias("cell"))
    if reading != "strict":  # each offset by itself and two grids of cells, so offsets within NEAR share a cell
        cells = [F.struct(F.lit(g).alias("grid"), F.floor((offset["cell"] + (g - 1) * NEAR) / (2 * NEAR)).alias("cell")) for g in (1, 2)]
        both = both.withColumn("offset", F.explode(F.array(offset, *cells)))
        offset = F.col("offset")
    occurrence = both.groupBy("doc_row", "doc_id", "item_row", "item_id", "n_windows", offset.alias("offset")).agg(
        F.count_distinct("item_at").alias("n"),
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("item_slots", "doc_slots")))).alias("slots"))  # at most the item's words
    side = lambda name: F.size(F.array_distinct(F.transform("slots", lambda s: s[name])))
    consistent = (side("item_slots") == F.size("slots")) & (side("doc_slots") == F.size("slots"))
    share = F.col("n") / F.col("n_windows")
    return (occurrence.where((share >= coverage) & consistent)
            .groupBy("doc_row", "doc_id", "item_row", "item_id")
            .agg(F.round(F.max(share), 6).alias("coverage"),
                 F.min(F.exists("slots", lambda s: s["item_slots"] != s["doc_slots"])).alias("reparameterised"),
                 F.count(F.lit(1)).alias("n_occurrences")).drop("item_row"))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per document and benchmark item found in it; documents without a match have no row."""
    rows = docs.select(F.monotonically_increasing_id().alias("doc_row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").alias("text"))
    return matches(rows, benchmark, **how).drop("doc_row")


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents in which no benchmark item was found, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered = written(docs.select(row.alias("row"), F.monotonically_increasing_id().alias("doc_row")))
    seen = numbered.select("doc_row", F.col("row")[id_col].cast("long").alias("doc_id"), F.col("row")[text_col].alias("text"))
    bad = None
    for reading in READINGS:  # what an earlier reading found is not read again
        left = seen if bad is None else seen.join(small_side(bad), "doc_row", "left_anti")
        found = matches(left, benchmark, reading=reading, **how).select("doc_row").distinct()
        bad = written(found if bad is None else bad.unionByName(found))
    kept = numbered.join(small_side(bad), "doc_row", "left_anti").select("row.*")
    return kept


def sql(window: int = WINDOW, literals: int = LITERALS, coverage: float = COVERAGE) -> str:
    """`leaks` of documents against benchmark without hashes and prefilters, as DuckDB SQL."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    white = r"[\s\x0b\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
    cut = "array_to_string(toks[spot + 1:spot + n], ' ') AS win, fills[spot + 1:spot + n] AS slots"
    enough = f"list_sum(list_transform(plain[spot + 1:spot + n], lambda x: CAST(x AS INT))) >= {literals}"
    return f"""
WITH src AS (SELECT 'd' AS side, row_number() OVER () AS r, doc_id AS id, text FROM documents
  UNION ALL SELECT 'i', row_number() OVER (), item_id, text FROM benchmark),
raw AS (SELECT side, r, id, unnest(w) AS raw, generate_subscripts(w, 1) AS pos FROM (
  SELECT *, list_filter(regexp_split_to_array(replace(coalesce(text, ''), chr(10), ' ' || chr(2) || ' '), '{white}'), lambda x: x <> '') AS w FROM src)),
f AS (SELECT *, trim(raw, {quoted(_SIGNS)}) AS word, raw = chr(2) OR right(rtrim(raw, {quoted(_CLOSERS)}), 1) IN ('.', '!', '?', ':') AS ends FROM raw),
g AS (SELECT *, lower(word) AS low, word = '' OR raw = chr(2) AS sign,
  coalesce(sum(CAST(ends AS INT)) OVER (PARTITION BY side, r ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS eb FROM f),
k AS (SELECT side, r, id, word, low, eb, row_number() OVER (PARTITION BY side, r ORDER BY pos) AS spot,
  regexp_full_match(word, '[$€£]?[+-]?[0-9][0-9.,:/]*%?') AS num, low IN ({", ".join(quoted(u) for u in sorted(UNITS))}) AS is_unit,
  length(word) > 1 AND substr(word, 1, 1) <> substr(low, 1, 1) AND substr(word, 2) = substr(low, 2) AS capital FROM g WHERE NOT sign),
t AS (SELECT *, NOT num AND is_unit AND coalesce(lag(num) OVER o, FALSE) AS unit, coalesce(eb - lag(eb) OVER o, 1) > 0 AS starts
  FROM k WINDOW o AS (PARTITION BY side, r ORDER BY spot)),
p AS (SELECT *, NOT num AND NOT unit AND capital AND NOT starts AS name FROM t),
a AS (SELECT side, r, id, list(CASE WHEN num THEN '<1>' WHEN unit THEN '<2>' WHEN name THEN '<3>' ELSE low END ORDER BY spot) AS toks,
  list(CASE WHEN num OR unit OR name THEN trim(word, '$€£%') ELSE '' END ORDER BY spot) AS fills, list(NOT (num OR unit OR name) ORDER BY spot) AS plain FROM p GROUP BY ALL),
sizes AS (SELECT DISTINCT least({window}, len(toks)) AS n FROM a WHERE side = 'i'),
iw AS (SELECT r, id, n, spot, {cut} FROM (SELECT *, unnest(generate_series(0, len(toks) - n)) AS spot FROM (SELECT *, least({window}, len(toks)) AS n FROM a WHERE side = 'i')) WHERE {enough}),
ic AS (SELECT *, count(*) OVER (PARTITION BY r) AS n_windows FROM iw),
dw AS (SELECT r, id, n, spot, {cut} FROM (SELECT *, unnest(generate_series(0, len(toks) - n)) AS spot FROM (SELECT * FROM a, sizes WHERE side = 'd' AND len(toks) >= n)) WHERE {enough}),
b AS (SELECT d.r AS dr, d.id AS doc_id, i.r AS ir, i.id AS item_id, i.n_windows, d.spot - i.spot AS away, i.spot AS item_at, list_zip(i.slots, d.slots) AS pairs
  FROM dw d JOIN ic i ON d.win = i.win AND d.n = i.n),
c AS (SELECT dr, doc_id, ir, item_id, n_windows, count(DISTINCT item_at) AS n, list_distinct(flatten(list(pairs))) AS pairs FROM b GROUP BY dr, doc_id, ir, item_id, n_windows, away)
SELECT doc_id, item_id, round(max(n / n_windows), 6) AS coverage, bool_and(len(list_filter(pairs, lambda x: x[1] <> x[2])) > 0) AS reparameterised, count(*) AS n_occurrences
FROM c WHERE n / n_windows >= {coverage} AND len(list_distinct(list_transform(pairs, lambda x: x[1]))) = len(pairs)
  AND len(list_distinct(list_transform(pairs, lambda x: x[2]))) = len(pairs) GROUP BY dr, doc_id, ir, item_id"""
