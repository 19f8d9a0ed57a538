"""Reading replies: text normalisation and strict JSON."""

import math

import pytest
from pyspark.sql import functions as F

from replyloom.functions.numeric import call_cost, half_even, nanos, usd_from_nanos
from replyloom.functions.replies import enum_or_default, is_text_field, target_name, truthy, with_object, with_reply
from replyloom.functions.text import PY_WHITESPACE, domain_code, domain_label, normalize_reply, strict_format, strip

TEXTS = ["Search.", "search .", " search\n", "It is search", "", "  modify\x1c", "`describe`!", "UNDERSTAND", "'.?x"]

NORMAL = dict(zip(TEXTS, ["search", "search ", "search", "it is search", "", "modify", "describe", "understand", "x"], strict=True))


def test_whitespace_is_pythons():
    assert set(PY_WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_normalize_and_strict(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    rows = df.select("t", strip(F.col("t")).alias("s"), normalize_reply(F.col("t")).alias("n"), strict_format(F.col("t")).alias("f")).collect()
    for r in rows:
        assert r.s == r.t.strip()
        assert r.n == NORMAL[r.t]
        assert r.f == (r.t.strip() in ("search", "understand", "describe", "modify"))


def test_null_reply_is_not_strict(spark):
    row = spark.createDataFrame([(None,)], "t string").select(strict_format(F.col("t")).alias("f")).first()
    assert row.f is False


BAD = ("", 0.0, True)
CASES = [
    ('{"label":"Search.","confidence":0.9}', ("search", 0.9, False)),
    (' {"label":"search","confidence":" 0.9 "}\n', ("search", 0.9, False)),
    ('{"label":"search","confidence":0.9} thanks', BAD),
    ("{'label':'search','confidence':0.9}", BAD),
    ('```json\n{"label":"search"}\n```', BAD),
    ('{"label":"sea', BAD),
    ('[{"label":"search"}]', BAD),
    ("5", BAD),
    ('{"a":1}]}', BAD),
    ('{"a":1},{"b":2}', BAD),
    ('{"label":"a\nb"}', BAD),
    ('{"label":"x","label":"modify","confidence":"0.7"}', ("modify", 0.7, False)),
    ('{"label":"search","confidence":true}', ("search", 1.0, False)),
    ('{"label":"search","confidence":"true"}', BAD),
    ('{"label":"search","confidence":null}', ("search", 0.0, False)),
    ('{"label":"search"}', ("search", 0.0, False)),
    ('{"label":"search","confidence":NaN}', ("search", None, False)),
    ('{"label":"search","confidence":"-inf"}', ("search", None, False)),
    ('{"label":"search","confidence":90}', ("search", 90.0, False)),
    ('{"label":"search","confidence":"abc"}', BAD),
    ('{"label":"search","confidence":"0.9d"}', BAD),
    ('{"label":"search","confidence":"1_0"}', ("search", 10.0, False)),
    ('{"label":"search","confidence":[1]}', ("search", 0.0, False)),
    ('{"label":"search ."}', ("search ", 0.0, False)),
    ("", ("", 0.0, False)),
    (None, ("", 0.0, False)),
]


def test_parse_reply(spark):
    df = spark.createDataFrame([(i, raw) for i, (raw, _) in enumerate(CASES)], "i int, raw string")
    got = {r.i: (r.label, r.confidence, r.parse_error) for r in with_reply(df).collect()}
    for i, (raw, want) in enumerate(CASES):
        assert got[i] == want, raw


@pytest.mark.parametrize(
    "raw,want",
    [
        ('{"label":" SEARCH ","confidence":1}', ("search", 1.0, False)),
        ('{"label":"search.","confidence":1}', (None, 1.0, False)),
        ('{"label":"search","confidence":null}', (None, 0.0, True)),
        ('{"label":"search"}', ("search", 0.0, False)),
        ('{"label":"search","confidence":[1]}', (None, 0.0, True)),
        ('{"label":"search","confidence":true}', ("search", 1.0, False)),
        ("nope", (None, 0.0, True)),
    ],
)
def test_parse_strict(spark, raw, want):
    r = with_reply(spark.createDataFrame([(raw,)], "raw string"), strict=True).first()
    assert (r.label, r.confidence, r.parse_error) == want


def test_clamp(spark):
    df = spark.createDataFrame([('{"label":"search","confidence":90}',)], "raw string")
    assert with_reply(df, clamp=True).first().confidence == 1.0


def test_filter_does_not_repeat_the_parse(spark):
    df = with_reply(spark.createDataFrame([('{"label":"search","confidence":1}',)], "raw string"))
    plan = df.filter((F.col("label") == "search") & (F.col("confidence") > 0.5))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType") == 1


def test_codes_round_trip(spark):
    df = spark.createDataFrame([("search",), ("modify",), ("other",), (None,)], "c string")
    rows = df.select(domain_code(F.col("c")).alias("k"), domain_label(domain_code(F.col("c"))).alias("back")).collect()
    assert [tuple(r) for r in rows] == [(1, "search"), (4, "modify"), (0, None), (0, None)]


def test_cost_and_unknown_model(spark):
    df = spark.createDataFrame([("gpt-4o", 1000, 100), ("x", 1, 1)], "m string, i bigint, o bigint")
    a, b = [r.c for r in df.select(call_cost(F.col("m"), F.col("i"), F.col("o")).alias("c")).collect()]
    assert math.isclose(a, 0.0035) and b is None


def test_money_sums_exactly(spark):
    df = spark.range(1001).select(F.lit(1.5e-7 * 11).alias("c"))
    got = df.repartition(7).agg(usd_from_nanos(F.sum(nanos(F.col("c"))))).first()[0]
    assert got == 0.001652  # 0.00165165


def test_half_even(spark):
    r = spark.range(1).select(*[half_even(F.lit(v), 0).alias(str(i)) for i, v in enumerate((0.5, 1.5, 2.5))]).first()
    assert tuple(r) == (0.0, 2.0, 2.0)


def test_field_rules(spark):
    raws = [
        ('{"target_name":" fn "}', "fn"), ('{"target_name":"NULL"}', None), ('{"target_name":""}', None),
        ('{"target_name":5}', None), ('{"target_name":"5"}', "5"), ('{"target_name":true}', None),
        ('{"target_name":null}', None), ('{}', None), ('{"target_name":" none "}', "none"), ('{"target_name":["a"]}', None),
    ]
    df = with_object(spark.createDataFrame([(i, r) for i, (r, _) in enumerate(raws)], "i int, raw string"), "raw", "target_name:string", "o")
    text = F.col("o.target_name")
    got = {r.i: r.t for r in df.select("i", target_name(text, is_text_field(F.col("raw"), text, "target_name")).alias("t")).collect()}
    assert [got[i] for i in range(len(raws))] == [w for _, w in raws]
    one = spark.range(1).select(
        enum_or_default(F.lit(" Search "), ("search",), "modify").alias("a"),
        enum_or_default(F.lit(None).cast("string"), ("search",), "modify").alias("b"),
        truthy(F.lit("True")).alias("c"), truthy(F.lit(None).cast("string")).alias("d"),
    ).first()
    assert tuple(one) == ("search", "modify", True, False)
