"""Exact percentiles and running sums that do not put one hot key into one task.

`percentile()` and an unbounded window both hold a whole group in a single task. Here the group
is cut by the value (percentiles) or by a time bucket (running sums): only per-bucket totals,
whose number per key is bounded, are ever ordered for a whole key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BINS_PER_E = 256  # value bins per factor of e: a bin is about 0.4 % wide


def value_bin(v: Column) -> Column:
    """Monotone logarithmic bin of a double; keeps the order of values across bins."""
    magnitude = F.floor(F.log(F.abs(v)) * _BINS_PER_E) + 250_000
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v) * magnitude).cast("long")


def _positions(p: float, n: Column, method: str) -> tuple[Column, Column, Column]:
    """(lower rank, upper rank, weight of the upper one), ranks from 0."""
    if method == "index":  # the element at int(n * p) of the sorted list
        rank = F.floor(n * F.lit(p)).cast("long")
        return rank, rank, F.lit(0.0)
    at = (n - 1) * F.lit(p)
    low = F.floor(at).cast("long")
    return low, F.ceil(at).cast("long"), at - low


def percentiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
                method: str = "continuous", weight: str | None = None) -> DataFrame:
    """Exact percentiles per key: one column per entry of `probs`.

    method="continuous" interpolates like percentile_cont; "index" takes the element at
    int(n*p). `weight` names a count column when the input is already compacted.

    Rows are first compacted to (key, value, count) with map-side combine; the hash of the value
    spreads a hot key over all tasks. A histogram of bounded size per key then finds the bins that
    hold the wanted ranks, and only those bins are sorted.
    """
    keys = list(keys)
    counted = (
        df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_c"))
        .withColumn("_bin", value_bin(F.col("_v")))
    )
    histogram = counted.groupBy(*keys, "_bin").agg(F.sum("_c").alias("_bc"))
    wanted = _wanted_bins(histogram, keys, probs, method).select(
        *[F.col(k).alias(f"_w_{k}") for k in keys], F.col("_bin").alias("_w_bin"), "_n", "_base")
    # Null-safe equality keeps Spark from adding a filter to one use of `counted` only; both uses then
    # share one scan and one shuffle.
    hits = counted.join(wanted, _same([*keys, "_bin"], "_w_", {"_bin": "_w_bin"})).select(*keys, "_bin", "_v", "_c", "_n", "_base")
    return _at_ranks(hits, keys, probs, method)


def trailing_percentiles(df: DataFrame, keys: Sequence[str], day: Column, value: str, probs: dict[str, float],
                         days: int, method: str = "continuous") -> DataFrame:
    """Exact percentiles per key and day of the values of the `days` days before it.

    A value is not copied into the days it counts for. Only the daily histograms are, whose size per key and day is
    bounded; together they tell the bins that hold the wanted ranks, and a value follows a day only if it lies in such
    a bin, which is 0.4 % wide. Days without values before them give no row; null and NaN values do not count.
    """
    keys = list(keys)
    counted = (
        df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(*keys, day.alias("_d"), F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
        .withColumn("_bin", value_bin(F.col("_v")))
    )
    later = F.explode(F.sequence(F.date_add("_d", 1), F.date_add("_d", days))).alias("day")
    histogram = counted.groupBy(*keys, "_d", "_bin").agg(F.sum("_c").alias("_dc")).select(*keys, later, "_bin", "_dc")
    histogram = histogram.groupBy(*keys, "day", "_bin").agg(F.sum("_dc").alias("_bc"))
    earlier = F.explode(F.sequence(F.date_sub("day", days), F.date_sub("day", 1))).alias("_w__d")
    wanted = _wanted_bins(histogram, [*keys, "day"], probs, method).select(
        *[F.col(k).alias(f"_w_{k}") for k in keys], "day", F.col("_bin").alias("_w_bin"), "_n", "_base", earlier)
    hits = counted.join(wanted, _same([*keys, "_d", "_bin"], "_w_", {"_bin": "_w_bin"}))
    hits = hits.groupBy(*keys, "day", "_bin", "_v", "_n", "_base").agg(F.sum("_c").alias("_c"))
    return _at_ranks(hits, [*keys, "day"], probs, method)


def _same(names: Sequence[str], prefix: str, named: dict[str, str]) -> Column:
    """Null-safe equality of columns with their prefixed namesakes."""
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col(named.get(name, f"{prefix}{name}")))
    return condition


def _wanted_bins(histogram: DataFrame, keys: Sequence[str], probs: dict[str, float], method: str) -> DataFrame:
    """(keys, _bin, _n, _base): of a histogram (keys, _bin, _bc) the bins in which a wanted rank lies, the number of all
    values of the key and of those below the bin."""
    part = [F.col(k) for k in keys] or [F.lit(1)]
    by_bin = Window.partitionBy(*part).orderBy("_bin")
    upto = by_bin.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = by_bin.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    binned = histogram.select(
        *keys, "_bin", F.sum("_bc").over(whole).alias("_n"), (F.sum("_bc").over(upto) - F.col("_bc")).alias("_base"), "_bc"
    )
    inside = F.lit(False)
    for p in probs.values():
        low, high, _ = _positions(p, F.col("_n"), method)
        for rank in (low, high):
            inside = inside | ((rank >= F.col("_base")) & (rank < F.col("_base") + F.col("_bc")))
    return binned.where(inside).select(*keys, "_bin", "_n", "_base")


def _at_ranks(hits: DataFrame, keys: Sequence[str], probs: dict[str, float], method: str) -> DataFrame:
    """The values at the wanted ranks, from the counted values (keys, _bin, _v, _c, _n, _base) of the wanted bins."""
    within = Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = hits.withColumn("_last", F.col("_base") + F.sum("_c").over(within) - 1).withColumn(
        "_first", F.col("_last") - F.col("_c") + 1
    )
    columns = []
    for name, p in probs.items():
        low, high, share = _positions(p, F.col("_n"), method)
        at_low = F.max(F.when((low >= F.col("_first")) & (low <= F.col("_last")), F.col("_v")))
        at_high = F.max(F.when((high >= F.col("_first")) & (high <= F.col("_last")), F.col("_v")))
        columns.append((at_low + (at_high - at_low) * F.max(share)).alias(name))
    return ranked.groupBy(*keys).agg(*columns)


def with_percentiles(rollup: DataFrame, df: DataFrame, keys: Sequence[str], value: str,
                     probs: dict[str, float], approximate: bool = False) -> DataFrame:
    """Attach percentile columns to a rollup over the same keys.

    The approximate mode is one pass of bounded sketches, for streams and quick looks.
    """
    if approximate:
        side = df.groupBy(*keys).agg(*[F.percentile_approx(value, p, 10_000).alias(n) for n, p in probs.items()])
    else:
        side = percentiles(df, keys, value, probs)
    if not keys:
        return rollup.join(F.broadcast(side), F.lit(True), "left")  # one row each
    renamed = side.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *probs)
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rollup.join(renamed, condition, "left").drop(*[f"_k_{k}" for k in keys])


def exact_avg(c: Column | str, scale: int = 3) -> Column:
    """Mean through an exact decimal sum, so the result does not depend on the order of rows."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c.cast(f"decimal(18,{scale})")).cast("double") / F.nullif(F.count(c), F.lit(0))


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """scale * part / whole, null when there is nothing to divide by."""
    return F.lit(scale) * part / F.nullif(whole, F.lit(0))


def running_sums(df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str | Column],
                 measures: dict[str, str]) -> DataFrame:
    """Running sums per key in `order`, inclusive: new column -> measure column.

    `bucket` is a non-decreasing function of the order (say the minute of the timestamp). Totals per
    (key, bucket) give each bucket its starting value, so the row-level window only spans one bucket.
    """
    keys = list(keys)
    kinds = {n: df.schema[m].dataType for n, m in measures.items()}
    kinds = {n: T.DecimalType(30, k.scale) if isinstance(k, T.DecimalType) else T.DoubleType() if isinstance(
        k, (T.DoubleType, T.FloatType)) else T.LongType() for n, k in kinds.items()}  # sums keep their scale
    totals = df.groupBy(*keys, bucket).agg(*[F.sum(m).cast(kinds[n]).alias(f"_t_{n}") for n, m in measures.items()])
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in [*keys, bucket]], *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).cast(kinds[n]).alias(f"_s_{n}") for n in measures]
    )
    upto = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    condition = F.lit(True)
    for k in [*keys, bucket]:  # a null key is a group like any other
        condition = condition & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    joined = df.join(starts, condition)
    return joined.withColumns(
        {n: (F.col(f"_s_{n}") + F.sum(m).over(upto).cast(kinds[n])).cast(kinds[n]) for n, m in measures.items()}
    ).drop(*[f"_s_{n}" for n in measures], *[f"_k_{k}" for k in [*keys, bucket]])


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows per key; Spark limits each map task to n rows per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)
