"""Error rules of a catalogue of any size, matched by an inverted index of literal factors.

A regular expression that must contain a literal text can only match a message that holds it. Of each top-level alternative
of a rule the longest such text is taken, of this the three letters that fewest other rules have; messages are joined on
their own triples of letters, then checked for the whole text, then by the regular expression, and the
first rule by (priority, code) wins. Rules without such a text are folded into an expression, as all rules are in
`lookups.with_error_code`, whose result this has. Each distinct message is matched once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..session import cut_lineage, small_side

GRAM = 3
_FOLDED_AT_ONCE = 100
# Escapes of one letter that stand for a class, a position or a control character.
_CLASSES = "dDwWsSbBhHvVRAZzGXtnrfae"


def _alternatives(pattern: str) -> list[str] | None:
    """The top-level alternatives; None if quoting or inline flags make the pattern's letters mean something else."""
    out, depth, at, inside = [""], 0, 0, False
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            if pattern[at + 1:at + 2] in ("Q", "E", ""):
                return None
            out[-1] += pattern[at:at + 2]
            at += 2
            continue
        if inside:
            inside = c != "]"
        elif c == "[":
            if pattern[at + 1:at + 2] in ("[", "]") or "&&" in pattern:
                return None
            inside = True
        elif c == "(":
            if pattern[at + 1:at + 2] == "?" and pattern[at + 2:at + 3] not in (":", "=", "!", "<", ">"):
                return None
            depth += 1
        elif c == ")":
            depth -= 1
        elif c == "|" and depth == 0:
            out.append("")
            at += 1
            continue
        out[-1] += c
        at += 1
    return None if depth or inside else out


def _factor(alternative: str) -> str:
    """The longest lower-case ASCII text that every match of an alternative holds; '' if none is certain."""
    runs, run, at, depth = [], "", 0, 0
    while at < len(alternative):
        c, step, literal = alternative[at], 1, None
        if c == "\\":
            following, step = alternative[at + 1], 2
            if not following.isalnum():
                literal = following
            elif following not in _CLASSES:
                return ""  # a code point, a property or a reference, which goes on
        elif c == "[":
            end = at + 1
            while alternative[end] != "]":
                end += 2 if alternative[end] == "\\" else 1
            step = end + 1 - at
        elif c == "{":
            step = (alternative.find("}", at) + 1 or len(alternative)) - at
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c not in ".^$*+?}":
            literal = c
        after = alternative[at + step:at + step + 1]
        certain = literal is not None and literal.isascii() and not depth and after not in ("*", "?", "{")
        run += literal.lower() if certain else ""
        if not certain or after == "+":
            runs.append(run)
            run = ""
        at += step
    return max([*runs, run], key=len)


def factors(pattern: str) -> list[str]:
    """A text for each alternative, of which a match must hold one; empty if some alternative has none of GRAM letters."""
    parts = _alternatives(pattern)
    found = [] if parts is None else [_factor(p) for p in parts]
    return sorted(set(found)) if found and all(len(f) >= GRAM for f in found) else []


def indexed_rules(catalogue: DataFrame) -> DataFrame:
    """(error_code, category, pattern, priority, retryable, factor, gram) of the usable active rules, a row per factor;
    factor and gram are null for rules without one."""
    cols = ["error_code", "category", "pattern", "priority", "retryable"]
    active = (catalogue.where("status = 'active'") if "status" in catalogue.columns else catalogue).select(*cols)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["factors"] = [factors(p) or [None] for p in b["pattern"]]
            yield b

    kinds = {"priority": "int", "retryable": "boolean"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in cols)
    parsed = active.select(*[F.col(c).cast(kinds.get(c, "string")) for c in cols]).where("pattern IS NOT NULL").mapInPandas(
        split, f"{schema}, factors array<string>")
    rules = cut_lineage(_usable(parsed).select(*cols, F.explode("factors").alias("factor")))
    grams = rules.where("factor IS NOT NULL").select(
        *cols, "factor", F.explode(F.transform(F.sequence(F.lit(1), F.length("factor") - (GRAM - 1)), lambda i: F.substring(F.col("factor"), i, F.lit(GRAM)))).alias("gram"))
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = grams.join(often, "gram").groupBy(*cols, "factor").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    return rarest.unionByName(rules.where("factor IS NULL").withColumn("gram", F.lit(None).cast("string")))


def _usable(rules: DataFrame) -> DataFrame:
    """Without the rules whose pattern does not compile: one bad catalogue row must not stop enrichment.

    The patterns go by the driver one after another; only the bad ones are kept.
    """
    compiler, bad = rules.sparkSession._jvm.java.util.regex.Pattern, []
    for r in rules.select("pattern").distinct().toLocalIterator():
        try:
            compiler.compile(r.pattern)
        except Exception:  # noqa: BLE001  the JVM's PatternSyntaxException
            bad.append(r.pattern)
    if not bad:
        return rules
    return rules.join(F.broadcast(rules.sparkSession.createDataFrame([(p,) for p in bad], "pattern string")), "pattern", "left_anti")


def first_matches(bodies: DataFrame, catalogue: DataFrame) -> DataFrame:
    """bodies (body), distinct -> (body, rule: code, category, retryable) of the first rule by priority, then code."""
    rules = cut_lineage(indexed_rules(catalogue))
    pick = F.struct("priority", "error_code", "category", "retryable")
    low = F.lower("body")
    triples = F.transform(F.sequence(F.lit(1), F.greatest(F.length(low) - (GRAM - 1), F.lit(1))), lambda i: F.substring(low, i, F.lit(GRAM)))
    placed = bodies.select("body", F.explode(F.array_distinct(triples)).alias("gram"))
    keyed = small_side(rules.where("gram IS NOT NULL"))
    # The Kelvin sign and the long s are k and s when case is ignored.
    plain = F.translate(low, "Kſ", "ks")
    hits = (placed.withColumn("gram", F.translate("gram", "Kſ", "ks")).join(keyed, "gram").where(plain.contains(F.col("factor")))
            .where(F.expr("rlike(body, concat('(?i)', pattern))")).select("body", pick.alias("rule")))
    rest = rules.where("gram IS NULL").orderBy("priority", "error_code").toLocalIterator()
    chunk: list = []
    for r in rest:
        chunk.append(r)
        if len(chunk) == _FOLDED_AT_ONCE:
            hits, chunk = hits.unionByName(_folded(bodies, chunk)), []
    if chunk:
        hits = hits.unionByName(_folded(bodies, chunk))
    return hits.groupBy("body").agg(F.min("rule").alias("rule"))


def _folded(bodies: DataFrame, rules: list) -> DataFrame:
    arms = [F.when(F.col("body").rlike(f"(?i){r.pattern}"), F.struct(
        F.lit(r.priority).alias("priority"), F.lit(r.error_code).alias("error_code"), F.lit(r.category).alias("category"),
        F.lit(r.retryable).cast("boolean").alias("retryable"))) for r in rules]
    return bodies.select("body", F.coalesce(*arms).alias("rule")).where("rule IS NOT NULL")


def with_error_code(events: DataFrame, catalogue: DataFrame) -> DataFrame:
    """As `lookups.with_error_code`, with the rules as a table of any size (error_code, category, pattern, priority,
    retryable and, if there is one, status)."""
    concerned = (F.col("status") == "failed") | F.nullif("error_code", F.lit("")).isNotNull()
    stated = events.withColumn("_body", F.when(concerned, text.error_text(F.col("error_code"), F.col("error_message"))))
    bodies = cut_lineage(stated.where("_body IS NOT NULL").select(F.col("_body").alias("body")).distinct())
    found = cut_lineage(first_matches(bodies, catalogue).select(F.col("body").alias("_body"), "rule"))
    rule = F.col("rule.error_code")
    return stated.join(small_side(found), "_body", "left").withColumns({
        "raw_error_code": F.when(rule.isNotNull() & ~rule.eqNullSafe(F.col("error_code")), F.col("error_code")),
        "error_category": F.col("rule.category"), "error_retryable": F.col("rule.retryable"),
        "error_code": F.coalesce(rule, F.col("error_code")),
    }).drop("_body", "rule")
