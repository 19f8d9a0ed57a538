"""Inputs for the registered queries, derived from the given tables.

The tables hold no model replies, so replies are derived by md5 arithmetic that
Spark and the checking database share. Each expression is written once and
rendered for both; only this scaffolding is shared, the operators and the checking
SQL are not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from replyloom.domain import INTENTS, LARGE_MODEL, SMALL_MODEL, TARGET_TYPES
from replyloom.functions.settle import settle

SPARK, DUCK = "spark", "duck"

# run -> calls (model, stage, call_no, percent of right answers)
RUNS = {
    "baseline": [(SMALL_MODEL, "plain", 1, 70)],
    "tuned": [(SMALL_MODEL, "plain", 1, 96)],
    "tuned_again": [(SMALL_MODEL, "plain", 1, 96)],
    "gate": [(SMALL_MODEL, "plain", 1, 75), (SMALL_MODEL, "plain", 2, 75), (SMALL_MODEL, "json", 3, 80)],
    "cheap": [(SMALL_MODEL, "json", 1, 80)],
    "cheap2": [(SMALL_MODEL, "json", 1, 80)],
    "mid": [(SMALL_MODEL, "json", 1, 84)],
    "strong": [(LARGE_MODEL, "json", 1, 88)],
}


# some replies of routed, baseline and extraction runs are not recorded
RECORDED = "(run_id IN ('tuned', 'tuned_again') OR (request_id + length(run_id)) % 41 <> 7)"


def hexnum(d: str, h: str, at: int) -> str:
    """Four hex digits of ``h`` as a number; ``at`` counts groups from 1."""
    part = f"substr({h}, {4 * (at - 1) + 1}, 4)"
    return f"cast(conv({part}, 16, 10) as bigint)" if d == SPARK else f"cast('0x' || {part} as bigint)"


def pick(values, n: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {n} {arms} END)"


def _k(d: str) -> str:
    path = "get_json_object" if d == SPARK else "json_extract_string"
    return f"cast({path}(props, '$.k') as bigint)"


def requests_columns(d: str) -> dict[str, str]:
    k = "k"
    cls = pick(INTENTS, f"{k} % 4")
    return {
        "request_id": "event_id",
        "user": f"""CASE {k} % 5
            WHEN 0 THEN 'find ' || user_id
            WHEN 1 THEN 'explain `fn_' || user_id || '()` in module ' || {k} || ' please'
            WHEN 2 THEN 'damn, why does item ' || {k} || ' of user ' || user_id || ' keep failing'
            WHEN 3 THEN 'describe the feature number ' || {k} || ' of project ' || user_id || ' in detail'
            ELSE 'fix it now' END""",
        "expected": f"""CASE event_type WHEN 'view' THEN 'search' WHEN 'click' THEN 'understand'
            WHEN 'purchase' THEN 'describe' WHEN 'error' THEN 'modify'
            ELSE CASE WHEN {k} % 3 = 0 THEN 'FAIL' ELSE {cls} END END""",
        "kind": f"""CASE WHEN event_type IN ('view', 'click', 'purchase', 'error') THEN 'holdout'
            ELSE 'adv-' || CASE {k} % 4 WHEN 1 THEN 'noise' WHEN 2 THEN 'off-topic' WHEN 3 THEN 'mixed'
            ELSE 'unknown' END END""",
        "lang": pick(("ru", "en", "mixed"), "user_id % 3"),
        "k": k,
        "value": "value",
        "user_id": "user_id",
    }


def reply_levels(d: str) -> list[dict[str, str]]:
    """Column expressions of a reply, in levels that build on one another. Input:
    request columns plus run_id, model, stage, call_no, acc."""
    cls = lambda n: pick(INTENTS, n)
    inside = "expected IN (" + ", ".join(f"'{c}'" for c in INTENTS) + ")"
    head = """'{"label": "' || said || '", "confidence": '"""
    odd = {
        0: "obj || ' thanks'",
        1: """'{''label'': ''' || said || ''', ''confidence'': ' || conf || '}'""",
        2: "'```json' || chr(10) || obj || chr(10) || '```'",
        3: "substr(obj, 1, 20)",
        4: "'[' || obj || ']'",
        5: f"""{head} || '"' || conf || '"}}'""",
        6: f"""{head} || 'true}}'""",
        7: f"""{head} || 'null}}'""",
        8: """'{"label": "' || said || '"}'""",
        9: f"""{head} || pct || '}}'""",
        10: """'{"label": "' || upper(said) || '.", "confidence": ' || conf || '}'""",
        11: """'{"label": "other", "confidence": ' || conf || '}'""",
        12: f"""{head} || '"abc"}}'""",
        13: f"""{head} || '[1]}}'""",
        14: """'{"label": null, "confidence": ' || conf || '}'""",
        15: "''",
        16: "' ' || obj || chr(10)",
        17: """'{"label": " ' || said || ' .", "confidence": ' || conf || '}'""",
    }
    plain = {
        0: "said || '.'", 1: "upper(said)", 2: "' ' || said || chr(10)", 3: "said || ' .'",
        4: "'It is ' || said", 5: "''", 6: """'"' || said || '"'""", 7: "'`' || said || '`!'",
    }
    case = lambda arms, n, other: f"CASE {n} " + " ".join(f"WHEN {i} THEN {e}" for i, e in arms.items()) + f" ELSE {other} END"
    early = {i: e for i, e in odd.items() if i <= 8}
    late = {i: e for i, e in odd.items() if i > 8}
    return [
        {"h": "md5(CASE WHEN run_id = 'tuned_again' THEN 'tuned' ELSE run_id END || call_no || ':' || request_id)"},
        {f"r{i}": hexnum(d, "h", i) for i in range(1, 6)},
        {
            "c2": "r2 % 4",
            "odd": "CASE WHEN stage = 'json' THEN r3 % 60 WHEN run_id LIKE 'tuned%' THEN 40 ELSE r3 % 40 END",
        },
        {"guess": cls("c2")},
        {"truth": f"CASE WHEN {inside} THEN expected ELSE guess END"},
        {"said": "CASE WHEN r1 % 100 < acc THEN truth ELSE guess END"},
        {"pct": "CASE WHEN said = truth THEN 50 + (k + r5) % 50 ELSE (k + r5) % 95 END"},
        {"conf": "'0.' || lpad(cast(pct as string), 2, '0')"},
        {"obj": f"{head} || conf || '}}'"},
        {"rare": f"CASE WHEN odd > 8 THEN {case(late, 'odd', 'obj')} ELSE '' END"},
        {"worded": case(plain, "odd", "said")},
        {
            "raw": f"CASE WHEN stage <> 'json' THEN worded WHEN odd > 8 THEN rare ELSE {case(early, 'odd', 'obj')} END",
            "latency_ms": "value * (8 + r4 % 5)",
            "input_tokens": "80 + r4 % 61",
            "output_tokens": "5 + r5 % 9",
        },
    ]


REPLY_COLUMNS = (
    "request_id", "run_id", "model", "stage", "call_no", "raw", "latency_ms", "input_tokens", "output_tokens",
)


def micro_levels(d: str) -> list[dict[str, str]]:
    r = lambda i: f"r{i}"
    w = {
        f"w{i}": f"1 + {r(i)} % 100 + CASE WHEN expected = '{c}' THEN {r(5)} % 200 ELSE 0 END"
        for i, c in enumerate(sorted(INTENTS), start=1)
    }
    arms = " ".join(f"WHEN w{i} = top THEN '{c}'" for i, c in enumerate(sorted(INTENTS), start=1))
    return [
        {"h": "md5('micro:' || request_id)"},
        {f"r{i}": hexnum(d, "h", i) for i in range(1, 7)},
        w,
        {"top": "greatest(w1, w2, w3, w4)", "mass": "w1 + w2 + w3 + w4"},
        {
            "micro_label": f"CASE {arms} END",
            "max_proba": "cast(top as double) / cast(mass as double)",
            "embed_tokens": f"10 + {r(6)} % 20",
            "embed_latency_ms": "value * 2",
        },
    ]


MICRO_COLUMNS = ("request_id", "micro_label", "max_proba", "embed_tokens", "embed_latency_ms")


def rich_levels(d: str) -> list[dict[str, str]]:
    r = lambda i: f"r{i}"
    return [
        {"h": "md5('rich:' || request_id)"},
        {f"r{i}": hexnum(d, "h", i) for i in range(1, 7)},
        {
            "primary_intent": pick(INTENTS, f"{r(1)} % 4"),
            "secondary_intent": pick(INTENTS + ("none",), f"{r(2)} % 5"),
            "target_type": pick(TARGET_TYPES, f"{r(3)} % 9"),
            "target_name": f"CASE {r(4)} % 4 WHEN 0 THEN NULL WHEN 1 THEN 'FN_' || user_id "
            "WHEN 2 THEN 'module ' || k ELSE 'ghost ' || k END",
            "urgency": pick(("low", "normal", "high"), f"{r(5)} % 3"),
            "negation": f"{r(6)} % 4 = 0",
        },
    ]


RICH = ("primary_intent", "secondary_intent", "target_type", "target_name", "urgency", "negation")
RICH_STAGES = {"mono": ["mono"], "multi": ["normalize", "classify", "target", "sentiment"]}


def rich_reply_levels(d: str) -> list[dict[str, str]]:
    """Extraction replies; input: rich item columns plus run_id and stage."""
    g = lambda i: f"g{i}"
    keep = "CASE WHEN run_id = 'mono' THEN 92 ELSE 80 END"
    swap = lambda i, gold, other: f"CASE WHEN {g(i)} % 100 < {keep} THEN {gold} ELSE {other} END"
    quoted = """coalesce('"' || p_name || '"', 'null')"""
    classify = """'"primary_intent": "' || s1 || '", "secondary_intent": "' || p2 || '"'"""
    target = """'"target_type": "' || s3 || '", "target_name": ' || j_name"""
    sentiment = """'"urgency": ' || j_urg || j_neg"""
    body = f"""CASE stage
        WHEN 'mono' THEN '{{' || {classify} || ', ' || {target} || ', ' || {sentiment} || '}}'
        WHEN 'classify' THEN '{{' || {classify} || '}}'
        WHEN 'target' THEN '{{' || {target} || '}}'
        WHEN 'sentiment' THEN '{{' || {sentiment} || '}}'
        ELSE '{{"verbs":["v' || k || '"],"nouns":["n' || user_id || '","m"],"tone":"flat","language":"' || lang || '"}}' END"""
    return [
        {"g": "md5(run_id || ':' || stage || ':' || request_id)"},
        {f"g{i}": hexnum(d, "g", i) for i in range(1, 9)},
        {
            "n": f"{g(7)} % 30",
            "p1": swap(1, "primary_intent", "'modify'"),
            "p2": swap(2, "secondary_intent", "'none'"),
            "p3": swap(3, "target_type", "'other'"),
            "p_name": swap(4, "target_name", "'thing ' || k"),
            "p_urg": swap(5, "urgency", "'normal'"),
            "p_neg": swap(6, "negation", "false"),
        },
        {
            "s1": "CASE n WHEN 1 THEN ' ' || upper(p1) || ' ' WHEN 2 THEN 'explain' ELSE p1 END",
            "s3": "CASE n WHEN 12 THEN 'Class' ELSE p3 END",
            "j_name": f"""CASE n WHEN 3 THEN '"none"' WHEN 4 THEN '"NULL"' WHEN 5 THEN '""' WHEN 6 THEN '5'
                WHEN 11 THEN '" padded "' WHEN 13 THEN '"5"' WHEN 14 THEN 'true' ELSE {quoted} END""",
            "j_urg": """CASE n WHEN 10 THEN 'null' ELSE '"' || p_urg || '"' END""",
            "j_neg": """CASE n WHEN 7 THEN ', "negation": "True"' WHEN 8 THEN ', "negation": "yes"' WHEN 9 THEN ''
                ELSE ', "negation": ' || CASE WHEN p_neg THEN 'true' ELSE 'false' END END""",
        },
        {"body": body},
        {
            "raw": "CASE n WHEN 0 THEN substr(body, 1, 15) ELSE body END",
            "model": f"'{SMALL_MODEL}'",
            "latency_ms": f"value * (3 + {g(8)} % 7)",
            "input_tokens": f"100 + {g(1)} % 50",
            "output_tokens": f"10 + {g(2)} % 30",
        },
    ]


def pair_levels(d: str) -> list[dict[str, str]]:
    r = lambda i: f"r{i}"
    return [
        {"h": "md5('pair:' || doc_id)"},
        {f"r{i}": hexnum(d, "h", i) for i in range(1, 5)},
        {
            "id": "doc_id",
            "label": f"CASE WHEN {r(1)} % 50 = 0 THEN 'other' ELSE {pick(INTENTS, r(2) + ' % 4')} END",
            "origin": f"CASE WHEN {r(3)} % 10 < 3 THEN 'real' ELSE 'synth' END",
            "conf": f"CASE WHEN {r(4)} % 3 = 0 THEN 'medium' ELSE 'high' END",
        },
    ]


PAIR_COLUMNS = ("id", "text", "label", "origin", "lang", "conf", "source")


# files of twenty conversations, so that there are more of them in larger tables
SHORT_FILES = "'part-' || (conv_id - conv_id % 20)"
# four files that each run through the whole table, so that a line's duplicates may be anywhere in it
LONG_FILES = "'part-' || (conv_id % 4)"


def line_levels(d: str, file: str = SHORT_FILES) -> list[dict[str, str]]:
    """Chat training lines, many broken, one per turn of a conversation."""
    r = lambda i: f"r{i}"
    if d == SPARK:
        obj = lambda role, content: f"to_json(named_struct('role', {role}, 'content', {content}))"
    else:
        obj = lambda role, content: f"cast(json_object('role', {role}, 'content', {content}) as varchar)"
    system, user = obj("'system'", "'prompt'"), obj("role", "text")
    answer = obj("'assistant'", "label")
    wrap = lambda *m: "'{\"messages\": [' || " + " || ', ' || ".join(m) + " || ']}'"
    whole = wrap(system, user, answer)
    hot = obj("'user'", "'repeat me please'")
    arms = {
        0: f"substr({whole}, 1, length({whole}) - 1)",
        1: """'{"messages": "none"}'""",
        2: wrap(system, user),
        3: wrap("'\"x\"'", user, answer),
        4: wrap(obj("'system'", "'  '"), user, answer),
        5: wrap(system, user, obj("'assistant'", "'other'")),
        6: "'[1, 2]'",
        7: wrap(system, user, """'{"role": "assistant", "content": 5}'"""),
        8: wrap(system, hot, answer),
        9: wrap(system, obj("'user'", "'  Repeat ME please '"), answer),
        10: wrap("""'{"content": "prompt"}'""", user, answer),
        11: "'  '",
        12: wrap(system, obj("'user'", "'abcd'"), answer),
        13: f"{whole} || ' tail'",
        14: """'{"message": []}'""",
        15: wrap(system, user, answer, answer),
    }
    cases = " ".join(f"WHEN {i} THEN {e}" for i, e in arms.items())
    return [
        {"h": "md5('line:' || conv_id || ':' || turn)"},
        {f"r{i}": hexnum(d, "h", i) for i in range(1, 3)},
        {
            "file": file,
            "line_no": "conv_id * 1000000000 + turn",
            "label": pick(INTENTS, r(1) + " % 4"),
            "n": f"{r(2)} % 32",
        },
        {"raw": f"CASE n {cases} ELSE {whole} END"},
    ]


# --- Spark side ---------------------------------------------------------------


KEYS = {
    "events": ("event_id",), "documents": ("doc_id",), "conversations": ("conv_id", "turn"), "embeddings": ("vec_id",),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as it is scanned. Sessions of one machine may ask for its rows to be dealt out by
    key (``spark.replyloom.deal``), since their tables are files of one row group."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    parts = spark.conf.get("spark.replyloom.deal", None)
    return df.repartition(int(parts), *KEYS[name]) if parts and name in KEYS else df


def apply_levels(df: DataFrame, levels: list[dict[str, str]], columns=("*",)) -> DataFrame:
    """All levels as one nested statement, so that they are analysed once."""
    text = _nest("<src>", levels, ", ".join(columns)).replace("{", "{{").replace("}", "}}")
    return df.sparkSession.sql(text.replace("<src>", "{src}"), src=df)


def settled_raw(df: DataFrame) -> DataFrame:
    """Derived text is long-winded to compute; compute it once per row."""
    return settle(df, {"raw": F.col("raw")}).select(*df.columns)


def as_requests(events: DataFrame, *more: str) -> DataFrame:
    with_k = events.withColumn("k", F.expr(_k(SPARK)))
    return with_k.select(*[F.expr(e).alias(n) for n, e in requests_columns(SPARK).items()], *more)


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_requests(table(spark, sf_dir, "events"))


def slim(reqs: DataFrame) -> DataFrame:
    """The request columns operators see."""
    return reqs.select("request_id", "user", "expected", "kind", "lang")


def replies(reqs: DataFrame, *runs: str) -> DataFrame:
    calls = [(run, *c) for run in runs for c in RUNS[run]]
    specs = F.array(
        *[
            F.struct(
                F.lit(run).alias("run_id"), F.lit(m).alias("model"), F.lit(s).alias("stage"),
                F.lit(n).alias("call_no"), F.lit(a).alias("acc"),
            )
            for run, m, s, n, a in calls
        ]
    )
    fanned = reqs.select("request_id", "expected", "k", "value", F.inline(specs))
    return settled_raw(apply_levels(fanned, reply_levels(SPARK), REPLY_COLUMNS))


def micro(reqs: DataFrame) -> DataFrame:
    return apply_levels(reqs, micro_levels(SPARK), MICRO_COLUMNS)


def rich_items(reqs: DataFrame) -> DataFrame:
    """Flat gold fields next to request columns."""
    return apply_levels(reqs.drop("expected"), rich_levels(SPARK))


def rich_expected(items: DataFrame) -> DataFrame:
    return items.select("request_id", "user", F.struct(*RICH).alias("expected"))


def rich_replies(items: DataFrame, run: str) -> DataFrame:
    stages = F.array(*[F.lit(s) for s in RICH_STAGES[run]])
    fanned = items.withColumn("run_id", F.lit(run)).withColumn("stage", F.explode(stages))
    columns = ["1 AS call_no" if c == "call_no" else c for c in REPLY_COLUMNS]
    return settled_raw(apply_levels(fanned, rich_reply_levels(SPARK), columns))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_levels(table(spark, sf_dir, "documents"), pair_levels(SPARK), PAIR_COLUMNS)


def lines(spark: SparkSession, sf_dir: str, file: str = SHORT_FILES) -> DataFrame:
    rows = apply_levels(table(spark, sf_dir, "conversations"), line_levels(SPARK, file), ("file", "line_no", "raw"))
    return settled_raw(rows)


# --- checking side ------------------------------------------------------------


def _nest(source: str, levels: list[dict[str, str]], final: str) -> str:
    inner = source
    for level in levels:
        new = ", ".join(f"{e} AS {n}" for n, e in level.items())
        inner = f"(SELECT *, {new} FROM {inner})"
    return f"SELECT {final} FROM {inner}"


def _ctes() -> dict[str, str]:
    req = ", ".join(f"{e} AS {n}" for n, e in requests_columns(DUCK).items())
    specs = ", ".join(
        f"('{run}', '{m}', '{s}', {n}, {a})" for run, calls in RUNS.items() for m, s, n, a in calls
    )
    rich_specs = ", ".join(f"('{run}', '{s}')" for run, stages in RICH_STAGES.items() for s in stages)
    return {
        "requests": f"SELECT {req} FROM (SELECT *, {_k(DUCK)} AS k FROM events)",
        "replies": _nest(
            f"(SELECT * FROM requests CROSS JOIN (VALUES {specs}) AS s(run_id, model, stage, call_no, acc))",
            reply_levels(DUCK),
            ", ".join(REPLY_COLUMNS),
        ),
        "micro": _nest("requests", micro_levels(DUCK), ", ".join(MICRO_COLUMNS)),
        "rich": _nest("(SELECT * EXCLUDE (expected) FROM requests)", rich_levels(DUCK), "*"),
        "rich_replies": _nest(
            f"(SELECT * FROM rich CROSS JOIN (VALUES {rich_specs}) AS s(run_id, stage))",
            rich_reply_levels(DUCK),
            "request_id, run_id, model, stage, raw, latency_ms, input_tokens, output_tokens",
        ),
        "pairs": _nest("documents", pair_levels(DUCK), ", ".join(PAIR_COLUMNS)),
        "lines": _nest("conversations", line_levels(DUCK), "file, line_no, raw"),
        "long_lines": _nest("conversations", line_levels(DUCK, LONG_FILES), "file, line_no, raw"),
    }


CTES = _ctes()
NEEDS = {"replies": ["requests"], "micro": ["requests"], "rich": ["requests"], "rich_replies": ["requests", "rich"]}
