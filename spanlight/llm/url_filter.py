"""URL filter: explicit rules first, else the ratio of two character language models.

URLs that the rules accept and reject train two variable-order Markov models over the characters of
host and path. Contexts up to ORDER characters are interpolated with Witten-Bell weights, so a context
that was never seen passes its whole weight to the shorter one. The score of a URL is the difference
of its two log10 likelihoods divided by its length; the threshold is the one with the best balanced
accuracy on a fifth of the rule-decided URLs that took no part in training.

Everything is DataFrame work. A position of a URL is one gram of ORDER + 1 characters; grams are counted
once with partial sums, all lower orders follow from that small table, and only distinct grams get a
likelihood. The table of grams grows with the alphabet, not with the pages; it is broadcast when its
written size is under the limit and joined by shuffle otherwise.

Defined cases: null url or no `://` gives empty host and path, which the models judge as an empty
text; without rule-decided URLs all scores are 0 and the threshold is 0 (allow); repeated rows are
judged alike; null page ids are carried; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import small_side
from .common import ascii_lower, dropped, written

# The rules of the contract, in its order.
RULES = [
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
]
ORDER = 4
ALPHABET = 256
FOLDS = 5
BROADCAST_BYTES = 8 * 1024 * 1024  # as written; a multiple of it in memory
_START, _END = "\u0002", "\u0003"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    tail = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return (ascii_lower(F.regexp_extract(tail, r"^[^/?#]*", 0)), F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; both null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at, _, rest = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _grams(text: Column, order: int) -> Column:
    """One gram per character of the text and one for its end: the character after its context."""
    chars = F.split(F.concat(F.lit(_START * order), text, F.lit(_END)), "")
    return F.transform(F.sequence(F.lit(1), F.length(text) + 1), lambda i: F.array_join(F.slice(chars, i, order + 1), ""))


def gram_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(gram, ratio) from (gram, accepted, rejected): log10 of the accepted over the rejected probability."""
    before = None
    for k in range(order + 1):
        level = counts.groupBy(F.substring("gram", order + 1 - k, k + 1).alias("g")).agg(
            F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
        of_context = Window.partitionBy(F.substring("g", 1, k))  # one row per character of the alphabet
        if before is None:
            level = level.withColumns({"p_accepted": F.lit(1.0 / ALPHABET), "p_rejected": F.lit(1.0 / ALPHABET)})
        else:
            level = level.withColumn("shorter", F.substring("g", 2, k)).join(before, "shorter")
        for side in ("accepted", "rejected"):
            n, kinds = F.sum(side).over(of_context), F.sum(F.when(F.col(side) > 0, 1).otherwise(0)).over(of_context)
            level = level.withColumn(f"q_{side}", F.when(n > 0, (F.col(side) + kinds * F.col(f"p_{side}")) / (n + kinds))
                                     .otherwise(F.col(f"p_{side}")))
        before = level.select(F.col("g").alias("shorter"), F.col("q_accepted").alias("p_accepted"), F.col("q_rejected").alias("p_rejected"))
    return before.select(F.col("shorter").alias("gram"), (F.log10("p_accepted") - F.log10("p_rejected")).alias("ratio"))


def _threshold(scored: DataFrame) -> float:
    """Best balanced accuracy over scores rounded to thousandths; ties go to the value nearest zero."""
    bins = scored.groupBy(F.round("score", 3).alias("t")).agg(
        F.sum(F.when(F.col("decided") == "allow", 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("decided") == "block", 1).otherwise(0)).alias("bad"))
    below = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, -1)  # a few thousand bins at any size
    total = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    passed = F.sum("good").over(total) - F.coalesce(F.sum("good").over(below), F.lit(0))
    stopped = F.coalesce(F.sum("bad").over(below), F.lit(0))
    accuracy = F.try_divide(passed, F.sum("good").over(total)) + F.try_divide(stopped, F.sum("bad").over(total))
    best = (bins.select("t", F.round(accuracy, 9).alias("a")).where("a IS NOT NULL")
            .orderBy(F.col("a").desc(), F.abs("t"), "t").first())
    return float(best.t) if best else 0.0


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
          order: int = ORDER) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, score (null where a rule decided)."""
    host, path = host_and_path(F.coalesce(F.col(f"`{url_col}`"), F.lit("")))
    urls = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, decided = matching_rule(F.col("host"), F.col("path"), rules)
    fold = F.conv(F.substring(F.sha2(F.concat("host", "path"), 256), 1, 7), 16, 10).cast("long") % FOLDS == 0
    urls = written(urls.select("page_id", "host", "path", rule.alias("rule"), decided.alias("decided"),
                               (decided.isNotNull() & fold).alias("held_back"), F.monotonically_increasing_id().alias("n")))
    places = urls.select("n", "decided", "held_back", F.explode(_grams(F.concat("host", "path"), order)).alias("gram"))
    trains = F.col("decided").isNotNull() & ~F.col("held_back")
    counts = written(places.groupBy("gram").agg(
        F.sum(F.when(trains & (F.col("decided") == "allow"), 1).otherwise(0)).alias("accepted"),
        F.sum(F.when(trains & (F.col("decided") == "block"), 1).otherwise(0)).alias("rejected")))
    ratios = written(gram_ratios(counts, order))
    judged = places.where(F.col("decided").isNull() | F.col("held_back")).join(small_side(ratios, BROADCAST_BYTES), "gram")
    scores = written(judged.groupBy("n").agg((F.sum("ratio") / F.count(F.lit(1))).alias("score")))
    dropped(counts)
    scored = urls.join(scores, "n", "left")
    limit = _threshold(scored.where("held_back"))
    by_model = F.when(F.col("score") >= limit, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("decided", by_model).alias("verdict"),
                         F.when(F.col("decided").isNull(), F.round("score", 6)).alias("score"))


def sql(rules: Sequence[tuple[str, str]] = RULES, order: int = ORDER) -> str:
    """`judge` over pages as DuckDB SQL."""
    rule = verdict = "NULL"
    for text, what in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at, _, rest = text.partition("/")
        fits = f"(host = '{at}' OR ends_with(host, '.{at}')) AND starts_with(path, '/{rest}')"
        rule, verdict = f"CASE WHEN {fits} THEN '{text}' ELSE {rule} END", f"CASE WHEN {fits} THEN '{what}' ELSE {verdict} END"
    levels = [f"""p0 AS (SELECT ''::VARCHAR AS shorter, {1.0 / ALPHABET}::DOUBLE AS pa, {1.0 / ALPHABET}::DOUBLE AS pr)"""]
    for k in range(order + 1):
        known = "CROSS JOIN p0" if k == 0 else f"JOIN p{k} ON p{k}.shorter = substr(g, 2, {k})"
        side = lambda n, p: f"CASE WHEN sum({n}) OVER w > 0 THEN ({n} + count(*) FILTER ({n} > 0) OVER w * {p}) / (sum({n}) OVER w + count(*) FILTER ({n} > 0) OVER w) ELSE {p} END"
        levels.append(f"""p{k + 1} AS (SELECT g AS shorter, {side('a', 'pa')} AS pa, {side('b', 'pr')} AS pr
  FROM (SELECT substr(gram, {order + 1 - k}, {k + 1}) AS g, sum(a) AS a, sum(b) AS b FROM counts GROUP BY g) x {known} WINDOW w AS (PARTITION BY substr(g, 1, {k})))""")
    return f"""
WITH tails AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS tail FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)),
parts AS (SELECT page_id, row_number() OVER () AS n, translate(regexp_extract(tail, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path FROM tails),
u AS (SELECT *, {rule} AS rule, {verdict} AS decided, CAST(('0x' || substr(sha256(host || path), 1, 7)) AS BIGINT) % {FOLDS} = 0 AS fold FROM parts),
places AS (SELECT n, decided, decided IS NOT NULL AND fold AS held, substr(t, CAST(i AS INT), {order + 1}) AS gram
  FROM (SELECT *, repeat(chr(2), {order}) || host || path || chr(3) AS t, unnest(generate_series(1, length(host || path) + 1)) AS i FROM u)),
counts AS (SELECT gram, count(*) FILTER (decided = 'allow' AND NOT held) AS a, count(*) FILTER (decided = 'block' AND NOT held) AS b FROM places GROUP BY gram),
{", ".join(levels)},
scores AS (SELECT n, sum(log10(pa) - log10(pr)) / count(*) AS score FROM places JOIN p{order + 1} ON shorter = gram WHERE decided IS NULL OR held GROUP BY n),
bins AS (SELECT round(score, 3) AS t, count(*) FILTER (decided = 'allow') AS good, count(*) FILTER (decided = 'block') AS bad FROM u JOIN scores USING (n) WHERE decided IS NOT NULL GROUP BY ALL),
accuracy AS (SELECT t, (sum(good) OVER () - coalesce(sum(good) OVER below, 0)) / nullif(sum(good) OVER (), 0) + coalesce(sum(bad) OVER below, 0) / nullif(sum(bad) OVER (), 0) AS a
  FROM bins WINDOW below AS (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
best AS (SELECT coalesce((SELECT t FROM accuracy WHERE a IS NOT NULL ORDER BY round(a, 9) DESC, abs(t), t LIMIT 1), 0.0) AS t)
SELECT page_id, host, path, rule, coalesce(decided, CASE WHEN score >= (SELECT t FROM best) THEN 'allow' ELSE 'block' END) AS verdict,
  CASE WHEN decided IS NULL THEN round(score, 6) END AS score FROM u LEFT JOIN scores USING (n)"""
