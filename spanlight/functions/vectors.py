"""Embedding measures on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def l2_norm(v: Column) -> Column:
    return F.sqrt(_sum(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))


def l2_distance(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - dot(a, b) / F.nullif(l2_norm(a) * l2_norm(b), F.lit(0.0))
