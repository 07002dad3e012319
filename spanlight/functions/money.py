"""Token cost in exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..catalogs import DEFAULT_PRICE, MODEL_PRICES

COST = "decimal(20,8)"
TOTAL = "decimal(28,8)"
PER_1K = "decimal(12,8)"


def token_cost(input_tokens: Column, output_tokens: Column, input_price: Column, output_price: Column) -> Column:
    """in/1000 * p_in + out/1000 * p_out rounded to 8 digits; missing tokens count as 0."""
    def side(count: Column, price: Column) -> Column:
        return F.coalesce(count.cast("decimal(12,0)"), F.lit(0).cast("decimal(12,0)")) * price.cast(PER_1K)

    milli = (side(input_tokens, input_price) + side(output_tokens, output_price)) * F.lit("0.001").cast("decimal(3,3)")
    return F.round(milli, 8).cast(COST)


def producer_estimate(model: Column, input_tokens: Column, output_tokens: Column) -> Column:
    """The producer-side estimate from its built-in table, with a price for unknown models."""
    def price(side: int) -> Column:
        table = F.create_map(*[F.lit(x) for row in MODEL_PRICES for x in (row[0], row[side])])
        return F.coalesce(F.try_element_at(table, model), F.lit(DEFAULT_PRICE[side - 1])).cast(PER_1K)

    return token_cost(input_tokens, output_tokens, price(1), price(2))


def total_tokens(given: Column, input_tokens: Column, output_tokens: Column) -> Column:
    either = input_tokens.isNotNull() | output_tokens.isNotNull()
    both = F.coalesce(input_tokens, F.lit(0)) + F.coalesce(output_tokens, F.lit(0))
    return F.coalesce(given, F.when(either, both))


def cheaper_alternative(input_tokens: Column, output_tokens: Column, own_cost: Column,
                        catalog: list[tuple[str, str, str]]) -> Column:
    """The next cheaper model for the same tokens: struct(cost, model), null when none is cheaper.

    The price catalog is configuration, so it is folded into the expression instead of joined.
    """
    offers = F.array(*[
        F.struct(
            token_cost(input_tokens, output_tokens, F.lit(i).cast(PER_1K), F.lit(o).cast(PER_1K)).alias("cost"),
            F.lit(name).alias("model"),
        )
        for name, i, o in catalog
    ])
    return F.array_max(F.filter(offers, lambda x: x["cost"] < own_cost))
