r"""Personal data by fixed patterns and bootstrapped contextual extraction, in DataFrame
operations only.

Base spans of four kinds come from patterns and checks. They are the seeds. Words shaped like
identifiers are instances; the words round an instance are its lexical patterns (two words
before it; one before and one after). Patterns and instances form a bipartite graph that is
scored in rounds: a pattern's confidence for a kind is the mean score of its distinct instances, an
instance's score is the noisy-or of its patterns' confidences, seeds stay at 1. Instances
outside base spans that reach ``accept`` through a pattern that reaches it too are new spans.

Matches are placed without a position function: the text between matches (split) and the
matches (extract) alternate, so running sums of lengths give every start. Repetitions of
groups, which could exhaust the matcher's stack on long texts, are replaced by one-character
marks of the same length set beforehand.

Edge cases: NULL texts are empty; a mark character that occurs in a text itself counts as
a character of no class; repeated rows get their spans each; NULL ids are kept; all sums
are over distinct instances, so copies of a document do not add weight; texts are searched
whole; other columns are ignored by ``find`` and passed through by ``redact``; empty tables
give empty results; without seeds nothing is added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replyloom.functions.settle import settle
from replyloom.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
#: Distinct seeds that a pattern needs, its least confidence to spread, and to discover.
SUPPORT, SPREAD, ACCEPT = 3, 0.5, 0.9
_CHUNK = 512
_GAP, _DOT, _OTHER = "\ue000", "\ue001", "\ue002"
_LOCAL = r"A-Za-z0-9._%+" + _DOT + "-"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++{_DOT}[A-Za-z0-9{_DOT}-]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": f"[0-9][0-9{_GAP}]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_SPACES = "\t\n\x0b\x0c\r"
_EDGES = ".,;:!?()[]{}<>\"'|*#$%&="


def running_sum(values: Column) -> Column:
    """Sum of the values before each element. In chunks, so that long arrays cost far less than a
    quadratic number of copies."""

    def sums(a: Column) -> Column:
        return F.aggregate(a, F.array(F.lit(0).cast("bigint")), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))

    n = F.size(values)
    chunks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((n - 1) / _CHUNK).cast("int"), F.lit(0))), lambda c: sums(F.slice(values, c * _CHUNK + 1, _CHUNK))
    )
    # each chunk with the total before it, carried along
    folded = F.aggregate(
        chunks, F.struct(F.lit(0).cast("bigint").alias("upto"), F.array().cast("array<array<bigint>>").alias("parts")),
        lambda acc, c: F.struct(
            (acc["upto"] + F.element_at(c, -1)).alias("upto"),
            F.array_append(acc["parts"], F.transform(F.slice(c, 1, F.size(c) - 1), lambda x: x + acc["upto"])).alias("parts"),
        ),
    )
    return F.flatten(folded["parts"])


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    return F.length(digits).between(8, 15)


def _source(kind: str) -> str:
    return {"email": "_dots", "card": "_gaps"}.get(kind, "_text")


def _found(source: Column, pattern: str) -> tuple[Column, Column]:
    return F.split(source, F.lit(pattern), -1), F.regexp_extract_all(source, F.lit(pattern), 0)


def with_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_text`` (NULL as empty) and ``_base``: array of (kind, start, end), by kind as listed, then start."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = F.translate(F.col("_text"), _GAP + _DOT, _OTHER + _OTHER)
    df = settle(docs, {"_text": text})
    df = settle(df, {
        "_gaps": F.regexp_replace(plain, r"(?<=[0-9])[ -](?=[0-9])", _GAP),
        "_dots": F.when(F.contains("_text", F.lit("@")), F.regexp_replace(plain, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", _DOT)).otherwise(""),
    })
    cols = {}
    for k in KINDS:
        cut, got = _found(F.col(_source(k)), PATTERNS[k])
        cols |= {f"_cut_{k}": F.transform(cut, lambda p: F.length(p)), f"_got_{k}": got}
    df = settle(df, cols, drop=("_gaps", "_dots"))
    df = settle(df, {f"_at_{k}": _starts(F.col(f"_cut_{k}"), F.col(f"_got_{k}")) for k in KINDS}, drop=tuple(f"_cut_{k}" for k in KINDS))
    spans = [_spans(k) for k in KINDS]
    return settle(df, {"_base": F.concat(*spans)}, drop=tuple(f"_{p}_{k}" for p in ("got", "at") for k in KINDS))


def _spans(kind: str) -> Column:
    found = F.filter(F.arrays_zip(F.col(f"_got_{kind}").alias("m"), F.col(f"_at_{kind}").alias("at")), lambda z: _valid(kind, z["m"]))
    return F.transform(found, lambda z: F.struct(F.lit(kind).alias("kind"), z["at"].alias("start"), (z["at"] + F.length(z["m"])).alias("end")))


def _starts(cut: Column, got: Column) -> Column:
    """Where each match begins: all lengths before it."""
    steps = F.zip_with(F.slice(cut, 1, F.size(got)), got, lambda c, m: (c + F.coalesce(F.length(m), F.lit(0))).cast("bigint"))
    before = running_sum(steps)
    return F.when(F.size(got) == 0, F.array().cast("array<bigint>")).otherwise(F.zip_with(before, F.slice(cut, 1, F.size(got)), lambda b, c: b + c))


def _candidates(df: DataFrame) -> DataFrame:
    """``_cand``: identifier-shaped words (start, end, token, kind of an overlapping base span, patterns)."""
    shape = r"(?<![^ ])[^ 0-9@]*+[0-9@][^ ]*+"
    flat = F.translate(F.col("_text"), _SPACES, " " * len(_SPACES))
    df = settle(df, {"_flat": F.when(F.col("_text").rlike("[0-9@]"), flat).otherwise("")})
    cut, got = _found(F.col("_flat"), shape)
    df = settle(df, {"_cut": cut, "_got": got}, drop=("_flat",))
    df = settle(df, {"_at": _starts(F.transform("_cut", lambda p: F.length(p)), F.col("_got"))})

    def one(z: Column, i: Column) -> Column:
        token = F.btrim(z["m"], F.lit(_EDGES))
        start = z["at"] + F.length(z["m"]) - F.length(F.ltrim(z["m"], F.lit(_EDGES)))
        end = start + F.length(token)
        left, right = F.rtrim(F.get(F.col("_cut"), i)), F.ltrim(F.get(F.col("_cut"), i + 1))
        two, last, first = F.lower(F.substring_index(left, " ", -2)), F.lower(F.substring_index(left, " ", -1)), F.lower(F.substring_index(right, " ", 1))
        patterns = F.array_compact(F.array(F.when(F.contains(two, F.lit(" ")), F.concat(F.lit("before:"), two)), F.when((last != "") & (first != ""), F.concat(F.lit("round:"), last, F.lit(" _ "), first))))
        kind = F.get(F.filter(F.col("_base"), lambda b: (b["start"] < end) & (b["end"] > start)), F.lit(0))["kind"]
        return F.struct(start.alias("start"), end.alias("end"), token.alias("token"), kind.alias("kind"), patterns.alias("patterns"))

    made = F.transform(F.arrays_zip(F.col("_got").alias("m"), F.col("_at").alias("at")), one)
    shaped = F.filter(made, lambda c: (F.length(c["token"]) >= 6) & (F.contains(c["token"], F.lit("@")) | (F.length(F.regexp_replace(c["token"], "[^0-9]", "")) >= 4)) & (F.size(c["patterns"]) > 0))
    return settle(df, {"_cand": shaped}, drop=("_cut", "_got", "_at"))


def score_graph(instances: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, spread: float = SPREAD) -> tuple[DataFrame, DataFrame]:
    """(patterns: pattern, kind, conf; tokens: token, kind, score) after ``rounds`` of scoring.
    ``instances``: token, kind (NULL if no seed), patterns."""
    links = instances.select(F.explode("patterns").alias("pattern"), "token", "kind").groupBy("pattern", "token").agg(F.max("kind").alias("kind"))
    size = links.groupBy("pattern").agg(F.count("*").alias("n"), F.count("kind").alias("seeds")).filter(F.col("seeds") >= support)
    links = cut_lineage(links.join(size, "pattern"), "pii-links")
    seeds = links.filter("kind is not null").groupBy("token", "kind").agg(F.lit(1.0).alias("score"))
    slim = links.select("pattern", "token", "n")
    tokens = seeds
    for n in range(rounds):
        patterns = slim.join(tokens, "token").groupBy("pattern", "kind").agg((F.sum("score") / F.max("n")).alias("conf")).filter(F.col("conf") >= spread)
        if n + 1 == rounds:
            patterns = cut_lineage(patterns, "pii-patterns")
        reached = slim.join(patterns, "pattern").groupBy("token", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.least(F.col("conf"), F.lit(0.999)))))).alias("score"))
        tokens = cut_lineage(reached.unionByName(seeds).groupBy("token", "kind").agg(F.max("score").alias("score")), "pii-tokens")
    return patterns, tokens


def _key() -> Column:
    return F.xxhash64("_id", "_text")


def find_all(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT, rounds: int = ROUNDS, support: int = SUPPORT) -> DataFrame:
    """doc_id, row_key (a hash of id and text), base and added: arrays of (kind, start, end)."""
    df = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_raw"))
    df = _candidates(with_spans(df, "_raw"))
    marked = cut_lineage(df.select(F.col("_id").alias("doc_id"), _key().alias("row_key"), F.col("_base").alias("base"), F.col("_cand").alias("cand")), "pii")
    inst = marked.select("row_key", F.explode("cand").alias("c")).select("row_key", "c.*")
    patterns, tokens = score_graph(inst, rounds, support)
    sure = patterns.filter(F.col("conf") >= accept).select("pattern", "kind")
    good = tokens.filter(F.col("score") >= accept).select("token", F.col("kind").alias("k"))
    new = (
        inst.filter("kind is null").drop("kind").withColumn("pattern", F.explode("patterns")).join(sure, "pattern").join(good, "token").filter("kind = k")
        .groupBy("row_key", "start", "end").agg(F.min("kind").alias("kind"))
        .groupBy("row_key").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    )
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return marked.select("doc_id", "row_key", "base").join(new, "row_key", "left").withColumn("added", F.coalesce("added", none))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` by kind as listed, then start, comma-joined."""
    rank = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(F.array_position(rank, s["kind"]).alias("r"), s["start"].alias("a"), s["end"].alias("b"), s["kind"].alias("k"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["k"], s["a"].cast("string"), s["b"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars", **params) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one. All
    columns stay; ``size_col`` is the new length. Texts without spans are unchanged."""
    found = find_all(docs, id_col, text_col, **params)
    extra = found.filter(F.size("added") > 0).select(F.col("row_key").alias("_rk"), F.col("added").alias("_added")).dropDuplicates(["_rk"])
    # the whole row travels in one struct, so no column of the input can clash
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), docs[id_col].cast("bigint").alias("_id"), docs[text_col].cast("string").alias("_raw"))
    df = with_spans(rows, "_raw").withColumn("_k", _key())
    df = df.join(extra, F.col("_k") == F.col("_rk"), "left")
    order = F.array_sort(F.transform(F.concat("_base", F.coalesce("_added", F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>"))), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    merged = F.aggregate(
        "_sorted", F.slice(F.col("_sorted"), 1, 0),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["start"] < F.element_at(F.concat(acc, F.array(s)), F.greatest(F.size(acc), F.lit(1)))["end"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
                F.get(acc, F.size(acc) - 1)["start"].alias("start"), F.greatest(F.get(acc, F.size(acc) - 1)["end"], s["end"]).alias("end"), F.get(acc, F.size(acc) - 1)["kind"].alias("kind"),
            ))),
        ).otherwise(F.array_append(acc, s)),
    )
    df = settle(settle(df, {"_sorted": order}), {"_merged": merged}, drop=("_sorted",))
    m = F.col("_merged")
    parts = F.transform(m, lambda s, i: F.concat(
        F.substr(F.col("_text"), F.coalesce(F.get(m, i - 1)["end"], F.lit(0)).cast("int") + 1, (s["start"] - F.coalesce(F.get(m, i - 1)["end"], F.lit(0))).cast("int")),
        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")),
    ))
    tail = F.substr(F.col("_text"), F.coalesce(F.get(m, F.size(m) - 1)["end"], F.lit(0)).cast("int") + 1)
    new = F.when(F.size(m) > 0, F.concat(F.array_join(parts, ""), tail))
    df = settle(df, {"_new": new}, drop=("_merged",))
    kind = dict(docs.dtypes)
    out = []
    for c in docs.columns:
        old = F.col("_row").getField(c)
        if c == text_col:
            old = F.coalesce("_new", old)
        elif c == size_col:
            old = F.when(F.col("_new").isNotNull(), F.length("_new").cast(kind[c])).otherwise(old)
        out.append(old.alias(c))
    return df.select(*out)
