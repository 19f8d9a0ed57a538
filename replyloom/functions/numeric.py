"""Safe arithmetic: ANSI mode raises on x/0, reports want a default."""

from __future__ import annotations

import math

from decimal import Decimal

from pyspark.sql import Column, functions as F

from replyloom.domain import PRICES


def ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    r = F.try_divide(num.cast("double"), den.cast("double"))
    return r if default is None else F.coalesce(r, F.lit(float(default)))


def half_even(c: Column, digits: int = 6) -> Column:
    return F.bround(c, digits)


def whole_ms(c: Column) -> Column:
    return F.rint(c).cast("bigint")


def share(flag: Column, default: float | None = 0.0) -> Column:
    """Aggregate: share of rows where ``flag`` holds; NULL counts as false."""
    return ratio(F.count_if(flag), F.count(F.lit(1)), default)


def order_position(n: Column, q: float) -> Column:
    """1-based rank of ``sorted[int(n*q)]``."""
    return F.floor(n * F.lit(float(q))) + 1


def _per_token(model: Column, side: int, prices) -> Column:
    out = F.lit(None).cast("double")
    for name, pair in prices.items():
        out = F.when(model == name, F.lit(float(pair[side]))).otherwise(out)
    return out


def call_cost(model: Column, tokens_in: Column, tokens_out: Column, prices=PRICES) -> Column:
    """USD of one call. The price list is driver-side configuration, so it becomes
    literals in the expression rather than a join; unknown model gives NULL."""
    million = F.lit(1_000_000.0)
    return (tokens_in / million) * _per_token(model, 0, prices) + (
        tokens_out / million
    ) * _per_token(model, 1, prices)


def nanos(usd: Column) -> Column:
    """Whole billionths of a dollar: sums of them are exact in any order, and list
    prices per million tokens with three decimals lose nothing."""
    return F.rint(usd * F.lit(1e9)).cast("bigint")


def usd_from_nanos(total: Column, digits: int = 6) -> Column:
    return F.bround(total.cast("decimal(28,0)") * F.lit(Decimal("0.000000001")), digits).cast("double")


def embed_cost(tokens: Column, price_per_1m: float = PRICES["text-embedding-3-small"][0]) -> Column:
    return tokens * F.lit(price_per_1m / 1_000_000)


def blended_cost(tokens: Column, prices: tuple[float, float] = PRICES["gpt-4o-mini"]) -> Column:
    """Estimate that ignores the in/out split of the tokens."""
    return tokens / F.lit(1_000_000.0) * F.lit(math.fsum(prices)) / F.lit(2.0)
