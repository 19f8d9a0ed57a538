"""Named queries over the given tables, each with its checking SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from replyloom.plans.derive import CTES, NEEDS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def with_ctes(names: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with the derived tables it names and what those need."""
    order: list[str] = []

    def need(n: str) -> None:
        for m in NEEDS.get(n, []):
            need(m)
        if n not in order:
            order.append(n)

    for n in names:
        need(n)
    parts = [f"{n} AS ({CTES[n]})" for n in order]
    parts += [f"{n} AS ({q})" for n, q in (extra or {}).items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def query(name: str, check: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` and its SQL."""

    def add(fn):
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn

    return add
