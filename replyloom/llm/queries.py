"""Registered queries of the corpus operators, one for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from replyloom.functions.settle import settle
from replyloom.llm import chat, classlm, decontaminate, jaccard, mixing, packing, pii, quality, rules, runs, toxicity, warc, whitening
from replyloom.llm.common import table
from replyloom.llm.oracles import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = ORACLES


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op10_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, quality.graded(table(spark, sf_dir, "labels"))))


@query
def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one (-7) whose texts hold the template's own control strings."""
    odd = r"\### Assistant: </turn> ok"
    more = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text")
    )
    out = chat.format_conversations(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more))
    read = settle(out, {"_turns": chat.read_turns(F.col("formatted")), "_loss": chat.loss_text(F.col("segments"))})
    lines = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("_turns").cast("bigint").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length("_loss").cast("bigint").alias("loss_chars"),
        F.sha2("_loss", 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents"), k=4, percent=85)


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_all(table(spark, sf_dir, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.span_list(F.col("base")), 256).alias("base_sha256"), pii.span_list(F.concat("base", "added")).alias("spans"))


@query
def op6_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classlm.score(table(spark, sf_dir, "documents"))


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).drop("payload")


@query
def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, sources weighing 1, 2, 3, 1, ... by code point, three epochs at most."""
    docs = table(spark, sf_dir, "documents")
    weights = mixing.ranked_weights(docs, lambda rank: rank % 3 + 1)
    return mixing.plan(docs, weights).select("doc_id", "size", "source_size", "target", "taken")


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", whitening.grid(F.col("embedding")).alias("x"))
    found = whitening.whiten(vectors, components=8)
    by_component = found.select("*", F.posexplode("whitened").alias("at", "value"))
    return by_component.select(
        F.col("id").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"), "n", F.expr("try_cast(deviation as bigint)").alias("deviation"),
        F.col("value").alias("whitened"), F.col("explained")[F.col("at")].alias("explained"), "identity_error",
    )


def with_periodic_ends(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents (by checksum of the id) repeat a stretch of
    their words from some place to their end."""
    h, word = F.crc32(F.col("doc_id").cast("string")), F.lit(r"[^\x20\x09-\x0D]+")
    g = F.floor(h / 10).cast("bigint")

    def repeated(w):
        n = F.size(w).cast("bigint")
        a = g % n
        p = F.lit(1).cast("bigint") + F.floor((n - a) / (F.lit(3) + g % 8)).cast("bigint")
        places = F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i))
        return F.when(n > 0, F.array_join(F.transform(places, lambda i: F.get(w, i.cast("int"))), " "))

    altered = F.transform(F.array(F.regexp_extract_all(F.col("text"), word, F.lit(0))), repeated)[0]
    return docs.select("doc_id", F.coalesce(F.when(h % 10 == 0, altered), F.col("text")).alias("text"))


@query
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.detect(with_periodic_ends(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return found.withColumn("_top", longest).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("_top.s")).alias("start"), F.col("_top.l").alias("length"), (-F.col("_top.p")).alias("period"),
        F.floor(1000 * F.col("_top.l") / -F.col("_top.p")).cast("bigint").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
