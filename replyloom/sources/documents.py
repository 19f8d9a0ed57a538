"""One large JSON document read by many tasks.

A run document is a single JSON object whose ``results`` array holds everything. It is read as pieces
that end in a closing brace, so Spark deals its file blocks to tasks, and each task finds the shape of
its own block. What a task cannot know is whether its block begins inside a string, and how
deep. A first pass finds for both cases where the block ends up; with that, one row a block, a second
pass cuts the array at the commas of its own depth. Elements that lie across blocks are put
together again from their parts; all others never move.
"""

from __future__ import annotations

import functools
import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from replyloom.session import cut_lineage

# how much deeper a character outside strings leads; bytes looked at together
_STEP = np.zeros(256, np.int8)
_STEP[[*b"{["]], _STEP[[*b"}]"]] = 1, -1
_SEGMENT = 1 << 20
_SUMMARY = "file string, block bigint, in0 boolean, depth0 int, in1 boolean, depth1 int"
_PARTS = "file string, block bigint, kind string, fresh boolean, ordinal bigint, closed boolean, whole boolean, text string"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """file, block, text of each file block; a task reads a block's pieces in order. The brace
    that is one too many after a file's last white space closes nothing."""
    here, held = None, []
    for batch in batches:
        files, block = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        file = files.indices.to_numpy()
        turns = [0, *(np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), batch.num_rows]
        for at, end in itertools.pairwise(turns):
            if at == end:
                continue
            now = files.dictionary[file[at]].as_py(), int(block[at])
            if here != now:
                if here:
                    yield *here, b"}".join([*held, b""])
                here, held = now, []
            values = batch.column(2).slice(at, end - at)
            held.append(b"}".join(values.cast(pa.binary()).to_pylist()))
    if here:
        yield *here, b"}".join([*held, b""])


def _segments(text: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """start, characters, quotes that begin or end a string, and whether an odd number of quotes
    came up to each character, by segments."""
    at, odd = 0, False
    while at < len(text):
        end = min(at + _SEGMENT, len(text))
        while end < len(text) and text[end - 1] == 92:
            end += 1
        chars = np.frombuffer(text, np.uint8, end - at, at)
        quotes = chars == 34
        slash = np.flatnonzero(chars == 92)
        if len(slash):
            # what follows an odd number of backslashes is escaped
            first = np.flatnonzero(np.diff(slash, prepend=-2) != 1)
            run = np.diff(np.append(first, len(slash)))
            after = slash[first] + run
            after = after[(run % 2 == 1) & (after < len(chars))]
            quotes[after] = False
        parity = (np.cumsum(quotes, dtype=np.uint8) & 1).astype(bool) ^ odd
        yield at, chars, quotes, parity
        at, odd = end, bool(parity[-1])


def _both_ends(text: bytes) -> tuple[tuple[bool, int], tuple[bool, int]]:
    """Whether a block ends inside a string and how much deeper: if it begins outside strings, and if inside one."""
    odd, outer, inner = False, 0, 0
    for _, chars, _, parity in _segments(text):
        step = _STEP[chars]
        within = int(step[parity].sum(dtype=np.int64))
        inner += within
        outer += int(step.sum(dtype=np.int64)) - within
        odd = bool(parity[-1])
    return (odd, outer), (not odd, inner)


def _ends(text: str | bytes, inside: bool) -> tuple[bool, int]:
    """Whether a block that begins inside a string, or not, ends in one, and how much deeper it ends."""
    return _both_ends(text.encode() if isinstance(text, str) else text)[inside]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for file, block, text in _blocks(batches):
        (in0, depth0), (in1, depth1) = _both_ends(text)
        rows = {"file": [file], "block": [block], "in0": [in0], "depth0": [depth0], "in1": [in1], "depth1": [depth1]}
        yield pa.RecordBatch.from_pydict(rows, pa.schema([("file", pa.string()), ("block", pa.int64()), ("in0", pa.bool_()), ("depth0", pa.int32()), ("in1", pa.bool_()), ("depth1", pa.int32())]))


def _marks(text: bytes, inside: bool, depth: int) -> Iterator[tuple[int, int, int, bool]]:
    """position, character, depth after it and whether it lies outside strings, of what gives the two
    upper levels their shape: brackets that lead there, their commas, and colons and quotes of the first."""
    for at, chars, quotes, parity in _segments(text):
        outside = parity == inside
        step = np.where(outside, _STEP[chars], 0)
        deep = np.cumsum(step, dtype=np.int32) + depth
        upper = ((step == 1) | (outside & (chars == 44))) & (deep <= 2)
        upper |= ((step == -1) | (outside & (chars == 58)) | quotes) & (deep <= 1)
        found = np.flatnonzero(upper)
        yield from zip((found + at).tolist(), chars[found].tolist(), deep[found].tolist(), outside[found].tolist(), strict=True)
        depth = int(deep[-1])


def _cut(text: str | bytes, inside: bool, depth: int, array: str) -> Iterator[tuple]:
    """kind, fresh, ordinal, closed, whole, text of what a block holds: parts of the array's elements,
    top-level string fields, and last where the block ends. ``fresh``: the array began in this block;
    otherwise the part is of whatever the block began in."""
    text = text.encode() if isinstance(text, str) else text
    fresh, wanted = False, depth >= 2
    start, whole, ordinal, key, word, quote = 0 if wanted else None, False, 0, None, None, None
    for at, char, after, outside in _marks(text, inside, depth):
        if char in b"{[":
            if after == 2:
                fresh, wanted = True, char == 91 and key == array
                start, whole, ordinal = (at + 1 if wanted else None), True, 0
        elif char in b"}]":
            if after == 1 and wanted:
                yield "part", fresh, ordinal, True, whole, text[start:at].decode()
                start, wanted = None, False
        elif char == 44:
            if after == 2 and wanted:
                yield "part", fresh, ordinal, True, whole, text[start:at].decode()
                start, whole, ordinal = at + 1, True, ordinal + 1
            elif after == 1:
                key = None
        elif after == 1:
            if char == 58:
                key = word
            elif not outside:
                quote = at
            elif quote is not None:
                word, quote = json.loads(text[quote : at + 1]), None
                if key is not None:
                    yield "field", True, 0, True, True, json.dumps([key, word])
    # an array that was begun and not closed goes on
    if wanted:
        yield "part", fresh, ordinal, False, False, text[start:].decode()
    yield "end", fresh, 0, wanted, False, None


def _parts(batches: Iterator[pa.RecordBatch], entry: dict[tuple[str, int], tuple[bool, int]], array: str) -> Iterator[pa.RecordBatch]:
    names = ["kind", "fresh", "ordinal", "closed", "whole", "text"]
    types = [pa.string(), pa.bool_(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]

    def batch(file: str, block: int, rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([file] * len(rows)), pa.array([block] * len(rows), pa.int64()), *(pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True))]
        return pa.RecordBatch.from_arrays(columns, ["file", "block", *names])

    for file, block, text in _blocks(batches):
        rows = []
        for row in _cut(text, *entry[file, block], array):
            rows.append(row)
            if len(rows) == 1000:
                yield batch(file, block, rows)
                rows = []
        if rows:
            yield batch(file, block, rows)


def array_elements(spark: SparkSession, path, array: str = "results") -> tuple[DataFrame, DataFrame]:
    """(file, position, text) of every element of the named top-level array of each document at ``path``,
    and (file, key, value) of their top-level string fields. The driver keeps a few numbers for each file block."""
    lines = spark.read.option("lineSep", "}").option("recursiveFileLookup", "true").text(path)
    pieces = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    entry, state, last = {}, (False, 0), None
    for r in sorted(pieces.mapInArrow(_summaries, _SUMMARY).collect(), key=lambda r: (r.file, r.block)):
        state, last = (state if r.file == last else (False, 0)), r.file
        entry[r.file, r.block] = state
        state = (r.in1, state[1] + r.depth1) if state[0] else (r.in0, state[1] + r.depth0)
    cut = cut_lineage(pieces.mapInArrow(functools.partial(_parts, entry=entry, array=array), _PARTS), "document")

    # which blocks begin in the array, and how many elements closed before each
    ends = cut.groupBy("file", "block").agg(
        F.max(F.when(F.col("kind") == "end", F.col("fresh"))).alias("fresh"), F.max(F.when(F.col("kind") == "end", F.col("closed"))).alias("stays"),
        *[F.count_if((F.col("kind") == "part") & F.col("closed") & (F.col("fresh") == f)).alias(f"n{int(f)}") for f in (False, True)],
    )
    starts, inside, before, last = [], False, 0, None
    for r in sorted(ends.collect(), key=lambda r: (r.file, r.block)):
        if r.file != last:
            inside, before, last = False, 0, r.file
        starts.append((r.file, r.block, inside, before, before + (r.n0 if inside else 0)))
        before += (r.n0 if inside else 0) + r.n1
        inside = r.stays and (r.fresh or inside)
    blocks = spark.createDataFrame(starts, "file string, block bigint, inside boolean, old bigint, new bigint")
    placed = cut.filter("kind = 'part'").join(F.broadcast(blocks), ["file", "block"]).filter("fresh or inside")
    placed = placed.select("file", "block", "whole", "closed", (F.col("ordinal") + F.when(F.col("fresh"), F.col("new")).otherwise(F.col("old"))).alias("position"), "text")
    split = placed.filter(~F.col("whole")).groupBy("file", "position").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts"))
    split = split.select("file", "position", F.array_join(F.col("parts.text"), "").alias("text"))
    elements = placed.filter("whole").select("file", "position", "text").unionByName(split)
    fields = cut.filter("kind = 'field'").select("file", F.from_json("text", "array<string>").alias("f")).select("file", F.col("f")[0].alias("key"), F.col("f")[1].alias("value"))
    return elements.filter(F.btrim("text", F.lit(" \t\r\n")) != ""), fields
