r"""Chat formatting with DataFrame expressions only.

The turns of a conversation are collected as structs, sorted by turn, and adjacent turns
of one role are merged into a block by array functions. The template is

    ### <role>:\n<text></turn>\n<text></turn>\n### <role>: ...

with one header a block and one ``</turn>`` a turn, so merged turns can still be told
apart. Inside texts ``\`` becomes ``\\``, ``#`` becomes ``\#`` and ``</turn>`` becomes
``<\/turn>``; in role names a line feed gets a ``\`` before it too. Neither marker can then
occur inside a text, and dropping the first of every ``\x`` pair restores it.

The loss mask marks segments: the formatted text is the concatenation of ``segments.text``,
and ``segments.learn`` is true exactly for the escaped texts of the roles to learn.

Edge cases: NULL text and NULL role are empty; NULL turns sort first; ties of a turn
number are ordered by role, then text; repeated rows are turns of their own; rows with NULL
conv_id form one conversation; other columns are ignored; an empty table gives an
empty result. A conversation is one value of the output, so all its turns meet in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from replyloom.functions.settle import settle

HEADER, STOP = "### ", "</turn>\n"
LEARN_ROLES = ("assistant",)


def escape(c: Column, name: bool = False) -> Column:
    out = F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("#"), F.lit("\\#")), F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(out, F.lit("\n"), F.lit("\\\n")) if name else out


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def collect_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: array of (turn, role, text) in order."""
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return conversations.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def _blocks() -> tuple[Column, Column]:
    """Run starts, and the (role, texts) blocks made of them: each run of turns with one role: run starts, then slices between them."""
    turns = F.col("turns")
    starts = F.filter(F.sequence(F.lit(0), F.size(turns) - 1), lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]))
    nexts = F.concat(F.slice(F.col("_starts"), 2, F.size("_starts")), F.array(F.size(turns)))
    cut = F.zip_with(
        F.col("_starts"), nexts,
        lambda a, b: F.struct(F.get(turns, a)["role"].alias("role"), F.transform(F.slice(turns, a + 1, b - a), lambda t: t["text"]).alias("texts")),
    )
    return starts, cut


def format_conversations(conversations: DataFrame, learn_roles=LEARN_ROLES) -> DataFrame:
    """conv_id, formatted, segments (text, learn)."""
    starts, cut = _blocks()
    df = settle(collect_turns(conversations), {"_starts": starts})
    df = settle(df, {"blocks": cut}, drop=("turns", "_starts"))

    def seg(text: Column, learn: Column) -> Column:
        return F.struct(text.alias("text"), learn.alias("learn"))

    def block(b: Column) -> Column:
        learn = b["role"].isin(*learn_roles)
        head = F.array(seg(F.concat(F.lit(HEADER), escape(b["role"], name=True), F.lit(":\n")), F.lit(False)))
        body = F.flatten(F.transform(b["texts"], lambda t: F.array(seg(escape(t), learn), seg(F.lit(STOP), F.lit(False)))))
        return F.concat(head, body)

    df = settle(df, {"segments": F.flatten(F.transform("blocks", block))}, drop=("blocks",))
    return df.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """Back from a formatted text: array of (role, text) turns, blocks taken apart again."""
    blocks = F.slice(F.split(formatted, F.lit(HEADER)), 2, F.greatest(F.size(F.split(formatted, F.lit(HEADER))) - 1, F.lit(0)))

    def turns(b: Column) -> Column:
        role = unescape(F.substring_index(b, ":\n", 1))
        rest = F.split(F.substr(b, F.locate(":\n", b) + 2), F.lit(STOP))
        return F.transform(F.slice(rest, 1, F.size(rest) - 1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, in order, unescaped."""
    return unescape(F.array_join(F.transform(F.filter(segments, lambda s: s["learn"]), lambda s: s["text"]), ""))
