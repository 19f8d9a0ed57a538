"""Building, validating, splitting and exporting data sets."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from replyloom.domain import CHAT_SCHEMA, PAIR_SCHEMA
from replyloom.operators import prep, split, validate
from replyloom.operators.skew import lookup_counted
from replyloom.sources import embeddings, jsonl


def chat(user, label="search", roles=("system", "user", "assistant")):
    return json.dumps({"messages": [{"role": r, "content": c} for r, c in zip(roles, ("p", user, label))]})


LINES = [
    ("", None),
    (chat("first request"), []),
    ("   ", None),
    (chat("  First REQUEST "), ["duplicate_user"]),
    (chat("abcd"), ["too_short"]),
    (chat("abcde"), []),
    (chat("x" * 500), []),
    (chat("y" * 501), ["too_long"]),
    (chat("abcd", "other"), ["label_outside", "too_short"]),
    ("{nope", ["invalid_json"]),
    ("[1, 2]", ["line_not_object"]),
    ('"text"', ["line_not_object"]),
    ('{"messages": "[1,2,3]"}', ["no_message_list"]),
    ('{"other": 1}', ["no_message_list"]),
    ('{"messages": [{"role":"system","content":"p"}]}', ["message_count"]),
    ('{"messages": ["a", {"role":"user","content":"five five"}, {"role":"assistant","content":"search"}]}', ["not_an_object"]),
    (chat("five five", roles=("user", "user", "assistant")), ["wrong_role"]),
    ('{"messages": [{"role":"system","content":"p"},{"role":"user","content":" "},{"role":"assistant","content":5}]}', ["empty_content"] * 2),
    (chat("first request", "other"), ["label_outside"]),  # has an error already, so no duplicate
    (chat("first request") + " tail", ["invalid_json"]),
    (chat("first request"), ["duplicate_user"]),
]


def test_validator_over_a_numbered_file(spark, tmp_path):
    path = tmp_path / "train.jsonl"
    path.write_text("\n".join(t for t, _ in LINES) + "\n", encoding="utf-8")
    v = validate.validate_lines(jsonl.read_numbered_lines(spark, str(path)))
    got = {}
    for x in validate.validation_errors(v).collect():
        got.setdefault(x.line_no, []).append(x.code)
    want = {n: errs for n, (_, errs) in enumerate(LINES, start=1) if errs}
    assert got == want
    firsts = {x.line_no: x.first_line for x in validate.duplicate_users(v).collect()}
    assert firsts == {4: 2, 21: 2}
    s = validate.validate_summary(v).first()
    assert (s.n_lines, s.n_errors, s.verdict) == (len([1 for _, e in LINES if e is not None]), sum(map(len, want.values())), "FAIL")


def test_line_numbers_over_many_blocks(spark, tmp_path):
    lines = [("" if i % 7 == 0 else f"line {i} " + "z" * (i % 50)) for i in range(1, 3001)]
    for name in ("a.txt", "b.txt"):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        df = jsonl.read_numbered_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
        rows = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    assert len(rows) == 2 * sum(1 for t in lines if t)
    assert all(lines[x.line_no - 1] == x.raw for x in rows)


def test_summary_of_missing_and_empty_files(spark):
    v = validate.validate_lines(spark.createDataFrame([("a", 1, chat("a fine request"))], "file string, line_no bigint, raw string"))
    expected = spark.createDataFrame([("a", True), ("gone", False), ("empty", True)], "file string, found boolean")
    got = {x.file: (x.n_lines, x.n_errors, x.verdict) for x in validate.validate_summary(v, expected_files=expected).collect()}
    assert got == {"a": (1, 0, "OK"), "gone": (0, 1, "FAIL"), "empty": (0, 0, "OK")}


def test_lookup_with_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("k")
    )
    groups = rows.groupBy("k").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    want = {(x.id, x.first) for x in rows.join(groups, "k").collect()}
    for parts in (2, 1000, 1):
        got = lookup_counted(rows, groups, ["k"], "n", F.col("id"), parts).collect()
        assert len(got) == 3000 and {(x.id, x.first) for x in got} == want


def pairs(spark, counts):
    rows = [(i, lab) for i, lab in enumerate(l for l, n in counts.items() for _ in range(n))]
    return spark.createDataFrame(rows, "id bigint, label string")


@pytest.mark.parametrize("digits", [1, 4])
def test_split_quota(spark, digits):
    counts = {"search": 1, "understand": 7, "describe": 503, "modify": 64, "other": 9}
    out = split.stratified_split(pairs(spark, counts), digits=digits).collect()
    assert len(out) == sum(n for l, n in counts.items() if l != "other") and len({x.id for x in out}) == len(out)
    got = Counter((x.label, x.split) for x in out)
    for label in ("search", "understand", "describe", "modify"):
        assert got[label, "eval"] == max(1, round(0.2 * counts[label]))
    assert got["search", "train"] == 0


def test_split_does_not_depend_on_layout_but_on_seed(spark):
    p = pairs(spark, {"search": 200, "modify": 100})
    chosen = lambda df: {x.id for x in df.collect() if x.split == "eval"}
    a = chosen(split.stratified_split(p.repartition(1)))
    assert a == chosen(split.stratified_split(p.repartition(7, "label")))
    assert a != chosen(split.stratified_split(p, seed=7))


def test_split_of_nothing(spark):
    assert split.stratified_split(pairs(spark, {"other": 3})).count() == 0


def test_prep_operators(spark):
    rows = [("find it please", "search", "en"), (" FIND it please", "search", "en"), ("tiny", "modify", "en"), ("   ", "modify", "en"), ("change that now", "bad", "en")]
    real = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "id bigint, text string, label string, lang string")
    synth = spark.createDataFrame([(9, "modify", "make it blue")], "id bigint, label string, text string")
    merged = prep.merge_pairs(real, synth)
    assert Counter(x.origin for x in merged.collect()) == {"real": 5, "synth": 1}
    assert [x.label for x in prep.bad_labels(merged).collect()] == ["bad"]
    assert sorted(x.id for x in prep.clean_pairs(merged, "id").collect()) == [0, 4, 9]
    with pytest.raises(Exception, match="label outside the domain"):
        prep.good_labels(merged, strict=True).collect()
    dist = {x.label: x.n for x in prep.class_distribution(merged).collect()}
    assert dist == {"search": 2, "understand": 0, "describe": 0, "modify": 3}
    assert {x.label: x.missing for x in prep.balance_topup(merged).collect()} == {"search": 1, "understand": 3, "describe": 3, "modify": 0}
    rules = prep.dataset_rules(merged).first()
    assert (rules.size_ok, rules.real_ok, rules.balance_ok) == (False, True, False)


def test_export_and_read_back(spark, tmp_path):
    rows = [(i, f"pröbe № {i} 漢", "search" if i % 2 else "modify") for i in range(40)]
    p = spark.createDataFrame(rows, "id bigint, text string, label string")
    parts = split.stratified_split(prep.to_chat(p))
    lines = jsonl.export_lines(parts, "id")
    out = str(tmp_path / "out")
    jsonl.write_jsonl(lines, out)
    man = {x.split: (x.n_lines, x.n_bytes) for x in jsonl.require_splits(jsonl.export_manifest(lines)).collect()}
    assert man["train"][0] == 32 and man["eval"][0] == 8
    files = list((tmp_path / "out" / "split=eval").glob("*.txt"))
    assert sum(f.stat().st_size for f in files) == man["eval"][1]
    assert "漢" in files[0].read_text(encoding="utf-8")
    back = jsonl.holdout_items(jsonl.read_jsonl(spark, out + "/split=train", CHAT_SCHEMA))
    assert {(x.user, x.expected) for x in back.collect()} <= {(t, l) for _, t, l in rows}
    with pytest.raises(Exception, match="a split is missing"):
        jsonl.require_splits(jsonl.export_manifest(lines.filter("split = 'train'"))).collect()


def test_sources(spark, tmp_path):
    (tmp_path / "eval.jsonl").write_text(chat("where is it") + "\n\n" + chat("rename this", "modify") + "\n", encoding="utf-8")
    assert {x.kind for x in jsonl.load_items(spark, str(tmp_path)).collect()} == {"holdout"}
    (tmp_path / "adversarial.jsonl").write_text('{"text":"??","label":"FAIL","kind":"noise"}\n{"text":"!!","label":"search"}\n')
    assert sorted(x.kind for x in jsonl.load_items(spark, str(tmp_path)).collect()) == ["adv-noise", "adv-unknown", "holdout", "holdout"]
    assert jsonl.load_items(spark, str(tmp_path), include_adversarial=False).count() == 2
    (tmp_path / "bad.jsonl").write_text('{"text":"a","label":"search"}\n{"text": oops\n')
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, str(tmp_path / "bad.jsonl"), PAIR_SCHEMA).collect()
    (tmp_path / "rich_eval.jsonl").write_text('{"text":"a","primary_intent":"search","secondary_intent":"none","target_type":"file","target_name":null,"urgency":"low","negation":true}\n')
    assert jsonl.load_rich_items(spark, str(tmp_path)).first().negation is True


def test_embedding_cache(spark, tmp_path):
    texts = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "text string")
    key = embeddings.text_key
    have = spark.createDataFrame([("m", "a", [1.0]), ("other", "b", [1.0])], "model string, text string, embedding array<double>")
    path = str(tmp_path / "cache")
    embeddings.append_vectors(have.select("model", key(F.col("text")).alias("text_key"), "embedding"), path)
    missing = embeddings.missing_texts(texts, spark.read.parquet(path), "m")
    assert missing.count() == 2
    embeddings.append_vectors(missing.select(F.lit("m").alias("model"), "text_key", F.array(F.lit(0.0)).alias("embedding")), path)
    assert embeddings.missing_texts(texts, spark.read.parquet(path), "m").count() == 0


def test_two_writers_store_a_text_once(spark, tmp_path):
    schema, path = "model string, text_key string, embedding array<double>", str(tmp_path / "cache")
    write = lambda rows, batch=None: embeddings.append_vectors(spark.createDataFrame(rows, schema), path, batch)
    first, second = embeddings.new_batch(), embeddings.new_batch()
    assert first < second
    write([("m", "b", [2.0]), ("m", "c", [2.0]), ("other", "a", [9.0])], second)
    write([("m", "a", [1.0]), ("m", "b", [1.0]), ("m", "b", [0.5])], first)
    write([("m", "a", [1.0]), ("m", "b", [1.0]), ("m", "b", [0.5])], first)  # tried again
    read = lambda **kw: {r.text_key: r.embedding for r in embeddings.read_cache(spark, path, "m", **kw).collect()}
    assert read() == {"a": [1.0], "b": [0.5], "c": [2.0]}
    assert spark.read.parquet(path).count() == 6
    wanted = spark.createDataFrame([("c",), ("z",), ("c",)], "text_key string")
    assert read(wanted=wanted) == {"c": [2.0]}
    assert embeddings.missing_texts(spark.createDataFrame([("x",)], "text string"), embeddings.read_cache(spark, path, "m"), "m").count() == 1
