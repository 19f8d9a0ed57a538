"""Pieces of checking SQL used by several families."""

from __future__ import annotations

from replyloom.domain import INTENTS, PRICES

CLASSES = "(" + ", ".join(f"'{c}'" for c in INTENTS) + ")"
CLASS_ROWS = "(VALUES " + ", ".join(f"('{c}')" for c in INTENTS) + ") AS c(label)"
WS = "(' ' || chr(9) || chr(10) || chr(13))"
PUNCT = """'.!?:;"''`'"""


def normal(raw: str) -> str:
    return f"lower(trim(trim({raw}, {WS}), {PUNCT}))"


def strict(raw: str) -> str:
    return f"trim({raw}, {WS}) IN {CLASSES}"


def parsed(source: str) -> str:
    """Rows of ``source`` with label, confidence and parse_error."""
    return f"""SELECT * EXCLUDE (doc, ct, cs),
      doc IS NULL OR coalesce(ct = 'VARCHAR' AND try_cast(cs AS double) IS NULL, false) AS parse_error,
      CASE WHEN doc IS NULL OR (ct = 'VARCHAR' AND try_cast(cs AS double) IS NULL) THEN ''
        ELSE {normal("coalesce(json_extract_string(doc, '$.label'), '')")} END AS label,
      CASE WHEN doc IS NULL OR ct IS NULL OR ct IN ('NULL', 'ARRAY', 'OBJECT') THEN 0.0::double
        WHEN ct = 'BOOLEAN' THEN CASE WHEN cs = 'true' THEN 1.0::double ELSE 0.0::double END
        ELSE coalesce(try_cast(cs AS double), 0.0::double) END AS confidence
    FROM (SELECT *, json_type(doc, '$.confidence') AS ct, json_extract_string(doc, '$.confidence') AS cs
      FROM (SELECT *, CASE WHEN raw = '' THEN '{{}}' WHEN NOT json_valid(raw) THEN NULL
        WHEN json_type(raw) <> 'OBJECT' THEN NULL ELSE raw END AS doc FROM {source}))"""


def parsed_strict(source: str) -> str:
    """The fallback tier's reading: label NULL unless usable and in the domain."""
    return f"""SELECT * EXCLUDE (doc, ct, cs, bad), bad AS parse_error,
      CASE WHEN NOT bad AND lower(trim(json_extract_string(doc, '$.label'), {WS})) IN {CLASSES}
        THEN lower(trim(json_extract_string(doc, '$.label'), {WS})) END AS label,
      CASE WHEN bad OR ct IS NULL THEN 0.0::double
        WHEN ct = 'BOOLEAN' THEN CASE WHEN cs = 'true' THEN 1.0::double ELSE 0.0::double END
        ELSE cast(cs AS double) END AS confidence
    FROM (SELECT *, doc IS NULL OR coalesce(ct IN ('NULL', 'ARRAY', 'OBJECT'), false)
        OR coalesce(ct = 'VARCHAR' AND try_cast(cs AS double) IS NULL, false) AS bad
      FROM (SELECT *, json_type(doc, '$.confidence') AS ct, json_extract_string(doc, '$.confidence') AS cs
        FROM (SELECT *, CASE WHEN raw = '' THEN '{{}}' WHEN NOT json_valid(raw) THEN NULL
          WHEN json_type(raw) <> 'OBJECT' THEN NULL ELSE raw END AS doc FROM {source})))"""


def price(side: int) -> str:
    return "CASE model " + " ".join(f"WHEN '{m}' THEN {p[side]!r}::double" for m, p in PRICES.items()) + " END"


COST = f"(input_tokens / 1000000.0::double) * ({price(0)}) + (output_tokens / 1000000.0::double) * ({price(1)})"


def share(num: str, den: str = "count(*)", digits: int = 6, default: str = "0.0") -> str:
    """A guarded ratio of two aggregates, rounded half to even."""
    return f"coalesce(round_even(({num})::double / nullif({den}, 0), {digits}), {default})"


def ratio_or_null(num: str, den: str, digits: int = 6) -> str:
    return f"round_even(({num})::double / nullif({den}, 0), {digits})"


def where(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def usd(cost: str) -> str:
    """Exact sum in billionths, rounded half to even at six digits."""
    n = f"sum(cast(round_even(({cost}) * 1e9, 0) AS bigint))"
    return f"""(({n} // 1000 + CASE WHEN {n} % 1000 > 500 OR ({n} % 1000 = 500 AND ({n} // 1000) % 2 = 1)
      THEN 1 ELSE 0 END)::double / 1000000)"""
