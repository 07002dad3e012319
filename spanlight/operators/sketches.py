"""Mergeable sketches per hour: distinct users and latency quantiles of any period without reading events again.

Distinct counts of days or applications cannot be added up, nor can percentiles; their sketches can be united. A Theta
sketch of 2^LG_USERS entries is exact up to so many users and beyond has a relative standard error of about
2^-(LG_USERS/2) (0.8 %); a KLL sketch of K_LATENCY has a rank error of about 1 % (99 % of the time). A sketch has a
bounded size, so an hour's row stays small however many events it stands for, and every task sends one per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import NTZ
from .order_stats import ratio

LG_USERS = 14
K_LATENCY = 300


def hourly_sketches(events: DataFrame, keys: Sequence[str], user: str = "user_id", latency: str = "latency_ms") -> DataFrame:
    """(keys, hour, events, users, latency): the last two as sketches, to be stored with the hourly rollup."""
    hour = F.date_trunc("hour", "event_ts").cast(NTZ).alias("hour")
    return events.groupBy(*keys, hour).agg(
        F.count(F.lit(1)).alias("events"), F.theta_sketch_agg(F.col(user), LG_USERS).alias("users"),
        F.kll_sketch_agg_double(F.col(latency).cast("double"), K_LATENCY).alias("latency"))


def user_set(rows: DataFrame, keys: Sequence[str], user: str = "user_id") -> DataFrame:
    """(keys, members): a set of users, such as those with access, as one sketch per key."""
    return rows.groupBy(*keys).agg(F.theta_sketch_agg(F.col(user), LG_USERS).alias("members"))


def over_period(hourly: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """Stored hours united per key and day, week, month or quarter: (keys, period_start, events, users, latency)."""
    start = F.date_trunc(period, "hour").cast("date").alias("period_start")
    return hourly.groupBy(*keys, start).agg(
        F.sum("events").alias("events"), F.theta_union_agg("users", LG_USERS).alias("users"), F.kll_merge_agg_double("latency").alias("latency"))


def active_users(united: DataFrame) -> Column:
    return F.theta_sketch_estimate(united["users"])


def quantile(sketch: str, q: float) -> Column:
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(q))


def adoption(united: DataFrame, access: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Active users among those with access, per key and period, from `over_period` and `user_set`; a key without any
    has no share."""
    both = united.join(access, list(keys), "left")
    used = F.when(F.col("members").isNotNull(), F.theta_sketch_estimate(F.theta_intersection("users", "members")))
    return both.withColumns({
        "active_users": F.theta_sketch_estimate("users"), "users_with_access": F.theta_sketch_estimate("members"), "active_with_access": used,
    }).withColumn("adoption_pct", ratio(F.col("active_with_access"), F.col("users_with_access"), 100.0)).drop("users", "members", "latency")
