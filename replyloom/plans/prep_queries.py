"""Queries: reading, building, validating, splitting and exporting data sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from replyloom.domain import CHAT_SCHEMA, RICH_SCHEMA
from replyloom.operators import prep, split as splitting, validate
from replyloom.plans import derive as d
from replyloom.plans.registry import query, with_ctes
from replyloom.plans.sqltext import CLASS_ROWS, CLASSES
from replyloom.session import shared_folder
from replyloom.sources import embeddings, jsonl


def _split(spark, sf):
    chat = prep.to_chat(prep.good_labels(d.pairs(spark, sf)), prep.SYSTEM_PROMPT)
    return splitting.stratified_split(chat)


SPLIT_SQL = {
    "good": f"SELECT * FROM pairs WHERE label IN {CLASSES}",
    "splits": """SELECT *, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY md5('42:' || id), id)
        <= greatest(1, cast(round_even(0.2::double * count(*) OVER (PARTITION BY label), 0) AS bigint))
        THEN 'eval' ELSE 'train' END AS split FROM good""",
    "chat": f"""SELECT *, '{{"messages":[' || json_object('role', 'system', 'content', '{prep.SYSTEM_PROMPT}')
        || ',' || json_object('role', 'user', 'content', text)
        || ',' || json_object('role', 'assistant', 'content', label) || ']}}' AS line FROM splits""",
}


@query(
    "jsonl_scan",
    with_ctes(["pairs"], f"SELECT sha1(text) AS fp, label FROM pairs WHERE label IN {CLASSES}"),
)
def jsonl_scan(spark, sf):
    """Chat rows written as JSON lines, read back typed."""
    path = shared_folder(spark, "jsonl")
    chat = prep.to_chat(prep.good_labels(d.pairs(spark, sf)))
    chat.select(jsonl.chat_line().alias("value")).write.text(path)
    items = jsonl.holdout_items(jsonl.read_jsonl(spark, path, CHAT_SCHEMA))
    return items.select(F.sha1("user").alias("fp"), F.col("expected").alias("label"))


_LONG = {"lines": d.CTES["long_lines"]}


@query(
    "numbered_lines",
    with_ctes(
        [],
        """SELECT file, n AS line_no, sha1(raw) AS fp FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY line_no) AS n FROM lines)
        WHERE trim(raw) <> ''""",
        _LONG,
    ),
)
def numbered_lines(spark, sf):
    """Lines written to files in a known order and read back with their numbers; blank ones count but are left out."""
    path = shared_folder(spark, "lines")
    rows = d.lines(spark, sf, d.LONG_FILES).repartition("file").sortWithinPartitions("file", "line_no")
    rows.select("file", F.col("raw").alias("value")).write.partitionBy("file").text(path)
    got = jsonl.read_numbered_lines(spark, path)
    return got.select(F.regexp_extract("file", "/file=([^/]+)/", 1).alias("file"), "line_no", F.sha1("raw").alias("fp"))


@query(
    "merge_pairs",
    with_ctes(["pairs"], "SELECT id, label, origin, lang, sha1(text) AS fp FROM pairs"),
)
def merge_pairs(spark, sf):
    p = d.pairs(spark, sf)
    real = p.filter(F.col("origin") == "real").select("id", "text", "label", "lang")
    synth = p.filter(F.col("origin") == "synth").select("lang", "label", "text", "id")
    return prep.merge_pairs(real, synth).select("id", "label", "origin", "lang", F.sha1("text").alias("fp"))


@query(
    "eval_items",
    with_ctes(
        ["requests", "pairs"],
        f"""SELECT text AS "user", label AS expected, 'holdout' AS kind FROM pairs WHERE label IN {CLASSES}
        UNION ALL SELECT "user", expected, kind FROM requests WHERE kind <> 'holdout'""",
    ),
)
def eval_items(spark, sf):
    held = jsonl.holdout_items(prep.to_chat(prep.good_labels(d.pairs(spark, sf))).select("messages"))
    reqs = d.requests(spark, sf).filter(F.col("kind") != "holdout")
    rows = reqs.select(
        F.col("user").alias("text"),
        F.col("expected").alias("label"),
        F.nullif(F.expr("substring(kind, 5)"), F.lit("unknown")).alias("kind"),
        "lang",
    )
    adversarial = jsonl.adversarial_items(rows).select("user", "expected", "kind")
    return held.unionByName(adversarial)


@query("rich_items", with_ctes(["rich"], 'SELECT "user", primary_intent, secondary_intent, target_type, target_name, urgency, negation FROM rich'))
def rich_items(spark, sf):
    """Gold fields written as JSON lines and loaded again."""
    folder = shared_folder(spark, "rich")
    rows = d.rich_items(d.requests(spark, sf)).withColumnRenamed("user", "text").select(*RICH_SCHEMA.fieldNames())
    rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.text(f"{folder}/rich_eval.jsonl")
    return jsonl.load_rich_items(spark, folder).withColumnRenamed("text", "user")


@query(
    "to_chat",
    with_ctes(
        ["pairs"],
        f"""SELECT id, '{prep.SYSTEM_PROMPT}' AS system_text, sha1(text) AS user_fp, label AS answer,
        'system,user,assistant' AS roles FROM pairs WHERE label IN {CLASSES}""",
    ),
)
def to_chat(spark, sf):
    chat = prep.to_chat(prep.good_labels(d.pairs(spark, sf)))
    at = lambda i: F.get("messages", F.lit(i))["content"]
    return chat.select(
        "id",
        at(0).alias("system_text"),
        F.sha1(at(1)).alias("user_fp"),
        prep.label_of().alias("answer"),
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
    )


@query("bad_labels", with_ctes(["pairs"], f"SELECT id, label FROM pairs WHERE label NOT IN {CLASSES}"))
def bad_labels(spark, sf):
    return prep.bad_labels(d.pairs(spark, sf)).select("id", "label")


_SLOT = lambda i: (
    f"json_type(doc, '$.messages[{i}]') AS et{i}, json_extract_string(doc, '$.messages[{i}].role') AS role{i}, "
    f"json_type(doc, '$.messages[{i}].content') AS ct{i}, json_extract_string(doc, '$.messages[{i}].content') AS c{i}"
)
_SHAPE = ", ".join(
    f"CASE WHEN et{i} <> 'OBJECT' THEN 'not_an_object' END, "
    f"CASE WHEN et{i} = 'OBJECT' AND role{i} IS DISTINCT FROM '{role}' THEN 'wrong_role' END, "
    f"CASE WHEN et{i} = 'OBJECT' AND (ct{i} IS DISTINCT FROM 'VARCHAR' OR trim(c{i}) = '') THEN 'empty_content' END"
    for i, role in enumerate(("system", "user", "assistant"))
)
VALIDATE_SQL = {
    "docs": """SELECT *, CASE WHEN NOT json_valid(raw) THEN NULL WHEN json_type(raw) <> 'OBJECT' THEN NULL ELSE raw END AS doc
        FROM lines WHERE trim(raw) <> ''""",
    "slots": f"""SELECT *, json_type(doc, '$.messages') AS mt, {_SLOT(0)}, {_SLOT(1)}, {_SLOT(2)} FROM docs""",
    "shaped": f"""SELECT *, CASE
        WHEN doc IS NULL THEN [CASE WHEN json_valid(raw) THEN 'line_not_object' ELSE 'invalid_json' END]
        WHEN mt IS DISTINCT FROM 'ARRAY' THEN ['no_message_list']
        WHEN json_array_length(doc, '$.messages') <> 3 THEN ['message_count']
        ELSE list_filter([{_SHAPE}], lambda x: x IS NOT NULL) END AS shape FROM slots""",
    "judged": f"""SELECT file, line_no, c1 AS "user", CASE WHEN len(shape) > 0 THEN shape ELSE list_filter([
        CASE WHEN c2 NOT IN {CLASSES} THEN 'label_outside' END,
        CASE WHEN length(c1) < 5 THEN 'too_short' END,
        CASE WHEN length(c1) > 500 THEN 'too_long' END], lambda x: x IS NOT NULL) END AS codes FROM shaped""",
    "clean": """SELECT file, line_no, min(line_no) OVER (PARTITION BY file, lower(trim("user"))) AS first_line
        FROM judged WHERE len(codes) = 0""",
}


@query(
    "validate_rows",
    with_ctes(
        ["lines"],
        "SELECT file, line_no, cast(len(codes) AS bigint) AS n_errors, array_to_string(codes, ',') AS codes FROM judged",
        VALIDATE_SQL,
    ),
)
def validate_rows(spark, sf):
    v = validate.validate_lines(d.lines(spark, sf))
    return v.select(
        "file",
        "line_no",
        F.size("errors").cast("bigint").alias("n_errors"),
        F.array_join(F.transform("errors", lambda e: e["code"]), ",").alias("codes"),
    )


@query(
    "duplicate_users",
    with_ctes([], "SELECT file, line_no, first_line FROM clean WHERE line_no > first_line", _LONG | VALIDATE_SQL),
)
def duplicate_users(spark, sf):
    return validate.duplicate_users(validate.validate_lines(d.lines(spark, sf, d.LONG_FILES)))


@query(
    "validation_errors",
    with_ctes(
        [],
        """SELECT file, line_no, code FROM (SELECT file, line_no, unnest(codes) AS code FROM judged)
        UNION ALL SELECT file, line_no, 'duplicate_user' FROM clean WHERE line_no > first_line""",
        _LONG | VALIDATE_SQL,
    ),
)
def validation_errors(spark, sf):
    return validate.validation_errors(validate.validate_lines(d.lines(spark, sf, d.LONG_FILES))).select("file", "line_no", "code")


@query(
    "validate_summary",
    with_ctes(
        ["lines"],
        """SELECT file, n_lines, n_errors, CASE WHEN n_errors = 0 THEN 'OK' ELSE 'FAIL' END AS verdict FROM (
        SELECT j.file, count(*) AS n_lines,
          cast(sum(len(j.codes)) + count(*) FILTER (c.line_no > c.first_line) AS bigint) AS n_errors
        FROM judged j LEFT JOIN clean c USING (file, line_no) GROUP BY 1)""",
        VALIDATE_SQL,
    ),
)
def validate_summary(spark, sf):
    return validate.validate_summary(validate.validate_lines(d.lines(spark, sf)))


@query(
    "class_distribution",
    with_ctes(
        ["pairs"],
        f"""SELECT c.label, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'eval') AS eval
        FROM {CLASS_ROWS} LEFT JOIN splits s ON s.label = c.label GROUP BY 1""",
        SPLIT_SQL,
    ),
)
def class_distribution(spark, sf):
    return prep.class_distribution(_split(spark, sf), split="split")


@query("stratified_split", with_ctes(["pairs"], "SELECT id, label, split FROM splits", SPLIT_SQL))
def stratified_split(spark, sf):
    return _split(spark, sf).select("id", "label", "split")


@query(
    "split_sizes",
    with_ctes(
        ["pairs"],
        """SELECT count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'eval') AS n_eval,
        round_even(count(*) FILTER (split = 'eval')::double / count(*), 6) AS eval_ratio FROM splits""",
        SPLIT_SQL,
    ),
)
def split_sizes(spark, sf):
    return prep.split_sizes(_split(spark, sf))


@query("export_chat", with_ctes(["pairs"], "SELECT split, md5(line) AS line_md5 FROM chat", SPLIT_SQL))
def export_chat(spark, sf):
    """Both splits written as JSON lines and listed by content."""
    path = shared_folder(spark, "export")
    jsonl.write_jsonl(jsonl.export_lines(_split(spark, sf), "id"), path)
    lines = spark.read.schema("value string, split string").text(path)
    return lines.select("split", F.md5("value").alias("line_md5"))


@query(
    "export_manifest",
    with_ctes(
        ["pairs"],
        "SELECT split, count(*) AS n_lines, cast(sum(strlen(line) + 1) AS bigint) AS n_bytes FROM chat GROUP BY 1",
        SPLIT_SQL,
    ),
)
def export_manifest(spark, sf):
    rows = _split(spark, sf).select("split", jsonl.chat_line().alias("line"))
    return jsonl.require_splits(jsonl.export_manifest(rows))


@query(
    "embed_cache_missing",
    """SELECT DISTINCT sha256(text) AS text_key FROM documents
    EXCEPT SELECT sha256(text) FROM documents JOIN labels USING (doc_id)""",
)
def embed_cache_missing(spark, sf):
    """Texts still to embed when the labelled documents have vectors already."""
    docs = d.table(spark, sf, "documents")
    labelled = docs.join(d.table(spark, sf, "labels").select("doc_id"), "doc_id")
    cache = labelled.select(F.lit("m").alias("model"), embeddings.text_key(F.col("text")).alias("text_key"))
    return embeddings.missing_texts(docs, cache, "m")


@query(
    "embed_cache_append",
    """SELECT sha256(text) AS text_key, min(w) AS writer, any_value(length(text)) AS size FROM (
      SELECT text, 1 AS w FROM documents WHERE doc_id % 3 <> 0 UNION ALL SELECT text, 2 FROM documents WHERE doc_id % 3 <> 1) GROUP BY 1""",
)
def embed_cache_append(spark, sf):
    """Two writers that each store most documents' vectors, many of the same texts; one vector a text is read."""
    path, docs = shared_folder(spark, "cache"), d.table(spark, sf, "documents")
    batches = [embeddings.new_batch() for _ in range(2)]
    # the later batch is written first
    for n in (2, 1):
        mine = docs.filter(F.col("doc_id") % 3 != n - 1)
        vector = F.array(F.lit(float(n)), F.length("text").cast("double"))
        embeddings.append_vectors(mine.select(F.lit("m").alias("model"), embeddings.text_key(F.col("text")).alias("text_key"), vector.alias("embedding")), path, batches[n - 1])
    got = embeddings.read_cache(spark, path, "m")
    return got.select("text_key", F.col("embedding")[0].cast("int").alias("writer"), F.col("embedding")[1].cast("bigint").alias("size"))


@query(
    "clean_pairs",
    with_ctes(
        ["pairs"],
        """SELECT min(id) AS id FROM pairs WHERE length(trim(text)) > 0 AND length(text) BETWEEN 5 AND 2000
        GROUP BY lower(trim(text, ' ' || chr(10) || chr(9) || chr(13)))""",
    ),
)
def clean_pairs(spark, sf):
    return prep.clean_pairs(d.pairs(spark, sf), "id", (5, 2000)).select("id")


@query(
    "dataset_rules",
    with_ctes(
        ["pairs"],
        f"""SELECT n_rows, n_real, round_even(n_real::double / n_rows, 6) AS real_share, smallest_class, largest_class,
        n_rows >= 50 AS size_ok, n_real::double / n_rows >= 0.2::double AS real_ok,
        smallest_class * 2 >= largest_class AS balance_ok FROM (
        SELECT (SELECT count(*) FROM pairs) AS n_rows, (SELECT count(*) FROM pairs WHERE origin = 'real') AS n_real,
        min(n) AS smallest_class, max(n) AS largest_class FROM (
          SELECT c.label, count(p.id) AS n FROM {CLASS_ROWS} LEFT JOIN pairs p ON p.label = c.label GROUP BY 1))""",
    ),
)
def dataset_rules(spark, sf):
    return prep.dataset_rules(d.pairs(spark, sf))


_DIST = f"SELECT c.label, count(p.id) AS n FROM {CLASS_ROWS} LEFT JOIN pairs p ON p.label = c.label GROUP BY 1"


@query(
    "balance_topup",
    with_ctes(["pairs"], "SELECT label, n, max(n) OVER () - n AS missing FROM dist", {"dist": _DIST}),
)
def balance_topup(spark, sf):
    return prep.balance_topup(d.pairs(spark, sf))


@query("class_support", with_ctes(["pairs"], "SELECT label, n, n >= 5 AS enough FROM dist", {"dist": _DIST}))
def class_support(spark, sf):
    return prep.class_support(d.pairs(spark, sf))


@query(
    "candidate_triage",
    with_ctes(
        ["pairs"],
        f"""SELECT label, count(*) AS n, count(*) FILTER (conf = 'high') AS take,
        count(*) FILTER (conf <> 'high') AS review FROM pairs WHERE label IN {CLASSES} GROUP BY 1""",
    ),
)
def candidate_triage(spark, sf):
    p = d.pairs(spark, sf)
    return prep.candidate_triage(p.select("text", "source", F.col("label").alias("agent_class"), "conf"))
