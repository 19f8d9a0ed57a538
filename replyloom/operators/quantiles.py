"""Order statistics by index (``sorted[int(n*q)]``) without sorting rows.

Values are reported in whole milliseconds and rounding keeps order, so counts by millisecond
give the same answer. They are made in two levels: first by a value's twelve leading binary digits,
at most some ten thousand counts a group however long a latency is, which tell the range that
an index falls into; then by millisecond inside that range only. No task holds the
histogram of a group.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from replyloom.functions.numeric import order_position
from replyloom.operators.common import counted
from replyloom.session import cut_lineage

P50_P95 = (("latency_p50_ms", 0.5), ("latency_p95_ms", 0.95))
DIGITS = 12


def leading(ms: str) -> Column:
    """A whole number with all binary digits after the first ``DIGITS`` set to zero; order is kept."""
    size, cut = f"abs({ms})", f"greatest(length(bin(abs({ms}))) - {DIGITS}, 0)"
    return F.expr(f"cast(signum({ms}) as bigint) * shiftleft(shiftright({size}, {cut}), {cut})")


def _same(left: list[str], right: list[str]) -> Column:
    return functools.reduce(operator.and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)])


def with_percentiles(sums: DataFrame, hist: DataFrame, by: list[str], quantiles=P50_P95, ms: str = "ms", n: str = "_c") -> DataFrame:
    """Add percentiles to ``sums`` (a row a group) from counts ``n`` of groups ``by`` and milliseconds.
    NULL milliseconds do not count; a group without any other has NULL percentiles."""
    keys = [f"_by{i}" for i in range(len(by))] + ["_all"]
    keyed = lambda df: df.withColumns({**{k: F.col(c) for k, c in zip(keys, by)}, "_all": F.lit(0)})
    counts = keyed(hist).filter(F.col(ms).isNotNull()).select(*keys, F.col(ms).cast("bigint").alias("_ms"), F.col(n).alias("_n")).withColumn("_lead", leading("_ms"))
    group = W.partitionBy(*keys)
    ranges = counts.groupBy(*keys, "_lead").agg(F.sum("_n").alias("_n"))
    ranges = ranges.withColumn("_upto", F.sum("_n").over(group.orderBy("_lead"))).withColumn("_total", F.sum("_n").over(group))
    places = F.array(*[F.struct(F.lit(name).alias("_q"), order_position(F.col("_total"), q).alias("_at")) for name, q in quantiles])
    met = ranges.select("*", F.inline(places)).filter("_at <= _upto and _at > _upto - _n")
    edges = met.select(*[F.col(k).alias(f"_e{i}") for i, k in enumerate(keys)], F.col("_lead").alias("_e"), "_q", (F.col("_at") - F.col("_upto") + F.col("_n")).alias("_left"))
    inside = counts.join(edges, (F.col("_lead") == F.col("_e")) & _same(keys, [f"_e{i}" for i in range(len(keys))]))
    run = inside.withColumn("_cum", F.sum("_n").over(W.partitionBy(*keys, "_q").orderBy("_ms"))).filter("_cum >= _left")
    found = run.groupBy(*keys).agg(*[F.min(F.when(F.col("_q") == name, F.col("_ms"))).alias(name) for name, _ in quantiles])
    found = found.select(*[F.col(k).alias(f"_f{i}") for i, k in enumerate(keys)], *[name for name, _ in quantiles])
    return keyed(sums).join(found, _same(keys, [f"_f{i}" for i in range(len(keys))]), "left").select(*sums.columns, *[name for name, _ in quantiles])


def index_percentiles(df: DataFrame, by: list[str], value: Column, quantiles=P50_P95) -> DataFrame:
    """Rows and percentiles of each group; the counts by millisecond are written once."""
    hist = cut_lineage(df.groupBy(*by, F.rint(value).cast("bigint").alias("ms")).agg(F.count(F.lit(1)).alias("_c")), "percentiles")
    return with_percentiles(counted(by, hist, F.sum("_c").alias("n")), hist, by, quantiles)
