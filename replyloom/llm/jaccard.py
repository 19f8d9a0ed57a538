"""Similarity join of documents on word shingles, with several global token orders.

Two sets with Jaccard similarity >= t share a token in the first |x| - ceil(t |x|) + 1 tokens of
each, under any order of all tokens. One order alone lets through every pair that
meets in a frequent token; here a pair must meet in the prefixes of all ``ORDERS``
orders before it is verified. All orders put frequent tokens last: the frequency
comes from a table of ``1 << SKETCH_BITS`` counters over all shingles of all documents,
and only the order inside a frequency band differs. The table's size is fixed, so it can be
broadcast; any function of the token is a valid order, collisions cost work, not pairs.

Steps: documents with equal shingle sets become one class (their least doc_id and a count);
classes get prefixes; in each bucket of an order-1 prefix token every class is first paired
with one pivot, the class with the fewest rarer tokens, which is a number of pairs linear in the
postings; verified links are merged into components; then all remaining pairs of a bucket
whose components still differ are made, filtered by size, position and the
other orders, and verified. No pair that could join two components is left out. Tokens met by
the same classes are one bucket there.

Parity bits keep pairs just below the similarity from piling up: a class has at least
``PARITY`` bits a token, each the parity of the tokens hashed to it, so two sets differ in at
least as many tokens as their bits differ. What differs in too many bits cannot reach the
similarity and is dropped before sets are gathered; ``FOLD`` bits are compared inside the join.

Edge cases: NULL and empty texts have an empty set and are linked with nothing; a text
of fewer words than a shingle is one shingle; repeated rows and equal texts are one class and each
row is returned; rows with NULL doc_id are returned and never name a component with
other members; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType

from replyloom.llm import words as W
from replyloom.llm.common import giving_back, per_batch, two_columns
from replyloom.llm.components import components
from replyloom.session import cut_lineage, remove_written

ORDERS = 3
SKETCH_BITS = 21
PARITY = 4
FOLD = 1024
_SALTS = np.random.Generator(np.random.PCG64(77)).integers(1, 1 << 63, 8, dtype=np.uint64)


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, shingle) pairs in order."""
    w = W.words(texts, W.SPACE)
    g, at = W.grams(w, k, whole=True)
    d, v, _ = W.distinct_in_doc(w.doc[at], g)
    return d, v


def _cell(token: np.ndarray, bits: int) -> np.ndarray:
    return (token >> np.uint64(64 - bits)).astype(np.int64)


def sketch(texts: DataFrame, k: int, bits: int) -> np.ndarray:
    """Frequency band of each of ``1 << bits`` cells, one byte a cell. A task counts its
    shingles in one array and sends it in segments; segments are summed in two levels,
    so no group holds more than a fixed share of the tasks' arrays."""
    part_bits = max(0, bits - 12)
    width = 1 << (bits - part_bits)

    def count(batches):
        from pyspark import TaskContext

        total = np.zeros(1 << bits, np.uint32)  # sent as 16 bits: a task's count above them is frequent anyway
        for batch in batches:
            for _, part in W.pieces(batch.column("text")):
                np.add.at(total, _cell(shingles(part, k)[1], bits), 1)
        lane = TaskContext.get().partitionId() % 64
        rows = total.reshape(-1, width)
        some = np.flatnonzero(rows.any(axis=1))
        for i in range(0, len(some), 256):
            at = some[i : i + 256]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(np.full(len(at), lane, np.int32)), pa.array([np.minimum(rows[j], 0xFFFF).astype(np.uint16).tobytes() for j in at], pa.binary())], names=["segment", "lane", "counts"]
            )

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(width, np.uint64)
        for x in group.column("counts"):
            total += np.frombuffer(x.as_buffer(), np.uint16 if len(x.as_buffer()) == 2 * width else np.uint32)
        out = np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()
        return pa.table({"segment": group.column("segment")[:1], "lane": group.column("lane")[:1], "counts": pa.array([out], pa.binary())})

    schema = "segment int, lane int, counts binary"
    lanes = texts.select("text").mapInArrow(giving_back(count), schema).groupBy("segment", "lane").applyInArrow(add, schema)
    got = lanes.groupBy("segment").applyInArrow(add, schema).toArrow()
    total = np.zeros((1 << part_bits, width), np.uint32)
    for seg, x in zip(got.column("segment").to_pylist(), got.column("counts").to_pylist(), strict=True):
        total[seg] = np.frombuffer(x, np.uint32)
    count_ = total.ravel()
    usual = max(1.0, float(np.median(count_)))
    # half-octave bands above twice the usual count
    return np.clip(2 * np.log2(np.maximum(count_ / (2 * usual), 1)), 0, 120).astype(np.int8)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """|x| - ceil(t |x|) + 1 for t in per cent."""
    return n - (-(-n * percent // 100)) + 1


def _parity(d: np.ndarray, v: np.ndarray, n: np.ndarray) -> tuple[pa.Array, list[pa.Array]]:
    """Parity bits of each row's set, a power of two of them, and the same folded to ``FOLD`` bits."""
    bits = np.maximum(FOLD, 1 << np.ceil(np.log2(np.maximum(PARITY * n, 1))).astype(np.int64))
    first = np.concatenate(([0], np.cumsum(bits)))
    cell = first[d] + (W.mix(v ^ _SALTS[6]) & (bits[d] - 1).astype(np.uint64)).astype(np.int64)
    packed = np.packbits((np.bincount(cell, minlength=first[-1]) & 1).astype(bool), bitorder="little")
    whole = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((first // 8).astype(np.int32)), pa.py_buffer(packed)])
    folded = np.bitwise_xor.reduceat(packed.view(np.int64).reshape(-1, FOLD // 64), first[:-1] // FOLD, axis=0)
    return whole, [pa.array(np.ascontiguousarray(folded[:, i])) for i in range(FOLD // 64)]


_FOLDS = [f"fold{i}" for i in range(FOLD // 64)]
_MEASURED = "doc_id bigint, row_key bigint, n bigint, rep bigint, prefix array<bigint>, band array<tinyint>, parity binary, " + ", ".join(f"{c} bigint" for c in _FOLDS)


def _orders(d: np.ndarray, v: np.ndarray, n: np.ndarray, band: np.ndarray, percent: int, orders) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(offsets, tokens, bands) of the prefixes of each row's set under the named orders."""
    first = np.concatenate(([0], np.cumsum(n)))
    length = np.where(n > 0, prefix_length(n, percent), 0)
    keep = np.arange(len(v)) - first[d] < length[d]
    offsets = np.concatenate(([0], np.cumsum(length)))
    out = []
    for o in orders:
        order = np.lexsort((W.mix(v ^ _SALTS[o]), band, d))[keep]
        out.append((offsets, v[order], band[order]))
    return out


def _lists(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def _names(v: np.ndarray, n: np.ndarray) -> np.ndarray:
    """A hash of each row's whole set; 0 for the empty set."""
    rep = np.zeros(len(n), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        with np.errstate(over="ignore"):
            rep[some] = W.mix(np.add.reduceat(W.mix(v ^ _SALTS[7]), np.concatenate(([0], np.cumsum(n)))[some]) + n[some].astype(np.uint64))
    return rep.view(np.int64)


def _measure(texts: DataFrame, bands, k: int, percent: int) -> DataFrame:
    """Size, name, order-0 prefix and parity bits of each row's set."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        d, v = shingles(batch.column("text"), k)
        n = np.bincount(d, minlength=batch.num_rows)
        band = bands.value[_cell(v, int(len(bands.value)).bit_length() - 1)]
        ((offsets, tokens, levels),) = _orders(d, v, n, band, percent, [0])
        parity, folds = _parity(d, v, n)
        cols = [
            batch.column("doc_id"), batch.column("row_key"), pa.array(n.astype(np.int64)), pa.array(_names(v, n)), _lists(offsets, tokens.view(np.int64)), _lists(offsets, levels), parity, *folds,
        ]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "row_key", "n", "rep", "prefix", "band", "parity", *_FOLDS])

    return texts.mapInArrow(per_batch(run), _MEASURED)


def _key_bits(keys: DataFrame, bits: int = 24) -> np.ndarray:
    """A fixed-size bit table of ``keys`` (one bigint column); a key may also be found by chance."""
    cell = F.pmod(F.col(keys.columns[0]), F.lit(1 << bits))
    got = keys.select(F.shiftright(cell, 5).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (cell % 32).cast("int")).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[got.column("word").to_numpy()] = got.column("bit").to_numpy().astype(np.uint32)
    return out


def _sets(texts: DataFrame, reps: DataFrame, witnesses: DataFrame, bands, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """As written and as to be read: tokens and the prefixes of the other orders of the classes in ``reps``, each from its witness
    row. A bit table skips other rows where they are read. Rows it lets through by chance, and rows
    alike in id and text, may bring a class several times; then readers skip all but one."""
    wanted = reps.distinct().join(witnesses.select("rep", "row_key"), "rep")
    table = texts.sparkSession.sparkContext.broadcast(_key_bits(wanted.select("row_key")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        key = batch.column("row_key").to_numpy() & ((len(table.value) << 5) - 1)
        batch = batch.filter(pa.array((table.value[key >> 5] >> (key & 31).astype(np.uint32)) & 1 == 1))
        if not batch.num_rows:
            return None
        d, v = shingles(batch.column("text"), k)
        n = np.bincount(d, minlength=batch.num_rows)
        band = bands.value[_cell(v, int(len(bands.value)).bit_length() - 1)]
        at = np.concatenate(([0], np.cumsum(n)))
        others = [_lists(o, t.view(np.int64)) for o, t, _ in _orders(d, v, n, band, percent, range(1, ORDERS))]
        return pa.RecordBatch.from_arrays([pa.array(_names(v, n)), _lists(at, v.view(np.int64)), *others], names=["rep", "tokens", *_OTHERS])

    schema = "rep bigint, tokens array<bigint>, " + ", ".join(f"{o} array<bigint>" for o in _OTHERS)
    found = cut_lineage(texts.mapInArrow(per_batch(run), schema).withColumn("at", F.monotonically_increasing_id()), "sets")
    table.destroy()
    places = Window.partitionBy("rep").orderBy("at")
    doubles = cut_lineage(found.select("rep", "at").withColumn("nth", F.row_number().over(places)).filter("nth > 1").select("at"), "doubles")
    return found, found.join(doubles, "at", "left_anti").drop("at")


_OTHERS = [f"other{i}" for i in range(1, ORDERS)]


def _alike(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose parity bits differ in no more places than sets of that similarity can."""
    for side, mark in (("a", "_x"), ("b", "_y")):
        pairs = pairs.join(classes.select(F.col("rep").alias(side), F.col("n").alias(mark + "n"), F.col("parity").alias(mark)), side)

    def ends(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        offsets = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
        return np.frombuffer(col.buffers()[2], np.uint8), offsets[:-1], np.diff(offsets)

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 64):
                batch = whole.slice(i, 64)
                (x, at_x, nx), (y, at_y, ny) = ends(batch.column("_x")), ends(batch.column("_y"))
                differ = np.zeros(batch.num_rows, np.int64)
                for lx, ly in set(zip(nx.tolist(), ny.tolist(), strict=True)):
                    rows, short = np.flatnonzero((nx == lx) & (ny == ly)), min(lx, ly)
                    one, two = (np.bitwise_xor.reduce(v[at[rows][:, None] + np.arange(size)].reshape(len(rows), -1, short), axis=1) for v, at, size in ((x, at_x, lx), (y, at_y, ly)))
                    differ[rows] = np.bitwise_count(one ^ two).sum(axis=1)
                both = batch.column("_xn").to_numpy() + batch.column("_yn").to_numpy()
                ok = pa.array(np.flatnonzero((100 + percent) * (both - differ) >= 2 * percent * both))
                yield pa.RecordBatch.from_arrays([batch.column("a").take(ok), batch.column("b").take(ok)], names=["a", "b"])

    return cut_lineage(pairs.select("a", "b", "_xn", "_yn", "_x", "_y").mapInArrow(giving_back(run), "a bigint, b bigint"), "alike", arrow_rows=64)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those that meet in the prefixes of every other order and then reach the
    similarity."""
    near = pairs
    for side, mark in (("a", "_x"), ("b", "_y")):
        near = near.join(sets.select(F.col("rep").alias(side), *[F.col(o).alias(mark + o) for o in _OTHERS]), side)
    for o in _OTHERS:
        near = near.filter(F.arrays_overlap("_x" + o, "_y" + o))
    near = cut_lineage(near.select("a", "b"), "pairs")
    joined = near.join(sets.select(F.col("rep").alias("a"), F.col("tokens").alias("_x")), "a").join(sets.select(F.col("rep").alias("b"), F.col("tokens").alias("_y")), "b")

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, 64):
                batch = whole.slice(i, 64)
                x, y = batch.column("_x"), batch.column("_y")
                n = batch.num_rows
                nx, ny = x.value_lengths().to_numpy(), y.value_lengths().to_numpy()
                row = np.concatenate((np.repeat(np.arange(n), nx), np.repeat(np.arange(n), ny)))
                val = np.concatenate((x.flatten().to_numpy(), y.flatten().to_numpy()))
                order = np.lexsort((val, row))
                r, v = row[order], val[order]
                both = np.bincount(r[1:][(r[1:] == r[:-1]) & (v[1:] == v[:-1])], minlength=n)
                ok = pa.array(np.flatnonzero(100 * both >= percent * (nx + ny - both)))
                yield pa.RecordBatch.from_arrays([batch.column("a").take(ok), batch.column("b").take(ok)], names=["a", "b"])

    links = cut_lineage(joined.select("a", "b", "_x", "_y").mapInArrow(giving_back(run), "a bigint, b bigint"), "links", arrow_rows=64)
    remove_written(near)
    return links


def _sizes_fit(na: Column, nb: Column, percent: int) -> Column:
    return 100 * F.least(na, nb) >= percent * F.greatest(na, nb)


def _can_reach(na: Column, nb: Column, at_a: Column, at_b: Column, percent: int) -> Column:
    """Position filter: if this is the first common token, at most the rest of the shorter side is
    common; ceil(t / (1 + t) * (na + nb)) common tokens are needed."""
    return (100 + percent) * F.least(na - at_a, nb - at_b) >= percent * (na + nb)


def _row_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id.cast("bigint"), text.cast("string"))


def _classes(docs: DataFrame, k: int, percent: int, sketch_bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, row_key, n, rep), their classes (rep, least) and the component of each linked
    class (node, root)."""
    spark = docs.sparkSession
    texts = two_columns(docs).withColumn("row_key", _row_key(F.col("doc_id"), F.col("text"))).withColumn("text", F.coalesce("text", F.lit("")))
    bands = spark.sparkContext.broadcast(sketch(texts, k, sketch_bits))
    measured = cut_lineage(_measure(texts, bands, k, percent), "prefixes")
    full = measured.filter("n > 0")
    witnesses = full.groupBy("rep").agg(
        F.min("doc_id").alias("least"), F.min("row_key").alias("row_key"), F.first("n").alias("n"), *[F.first(c).alias(c) for c in _FOLDS], F.first("parity").alias("parity")
    )
    witnesses = cut_lineage(witnesses, "classes")
    classes = full.groupBy("rep").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("band").alias("band"))
    # postings; a token of a frequent cell is dealt out under a salt
    entry = F.posexplode(F.arrays_zip("prefix", "band")).alias("at", "e")
    salt = F.when(F.col("e.band") > 0, 1 + F.pmod("rep", F.pow(F.lit(2), F.least(F.col("e.band") / 2, F.lit(10))).cast("bigint"))).otherwise(0)
    # place and size in one number: a smaller place means fewer rare tokens before this one
    packed = F.call_function("shiftleft", F.col("at").cast("bigint"), F.lit(32)) + F.col("n")
    postings = classes.select("rep", "n", entry).select("rep", F.col("e.prefix").alias("token"), salt.cast("bigint").alias("salt"), packed.alias("place"))
    group = Window.partitionBy("token", "salt")
    pivot = F.first(F.struct("place", "rep")).over(group.orderBy("place", "rep"))
    buckets = cut_lineage(
        postings.withColumn("pivot", pivot).withColumn("size", F.count("*").over(group)).filter("size > 1 or salt > 0").select("token", "salt", "rep", "place", "pivot"), "buckets"
    )
    # prefixes are in the buckets now
    rows = cut_lineage(measured.select("doc_id", "row_key", "n", "rep"), "rows")
    remove_written(measured)
    size = lambda c: F.col(c).bitwiseAND(0xFFFFFFFF)
    at = lambda c: F.shiftright(c, 32)
    fits = lambda x, y: _sizes_fit(size(x), size(y), percent) & _can_reach(size(x), size(y), at(x), at(y), percent)
    # a pair with the bucket's pivot for each class, and the pivots of a hot token's salts with their least
    heads = buckets.filter("salt > 0").groupBy("token").agg(F.min("pivot").alias("head"))
    among = buckets.filter("salt > 0").select("token", "pivot").distinct().join(heads, "token").select(F.col("pivot.rep").alias("x"), F.col("pivot.place").alias("px"), F.col("head.rep").alias("y"), F.col("head.place").alias("py"))
    star = buckets.select(F.col("rep").alias("x"), F.col("place").alias("px"), F.col("pivot.rep").alias("y"), F.col("pivot.place").alias("py")).unionByName(among)
    star = star.filter((F.col("x") != F.col("y")) & fits("px", "py")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    star = cut_lineage(star, "pairs")
    near = _alike(star, witnesses, percent)
    ends = lambda pairs: pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep")))
    written, sets = _sets(texts, ends(near), witnesses, bands, k, percent)
    edges = _verify(near, sets, percent)
    remove_written(written, near)
    roots = cut_lineage(components(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), "roots")
    # whatever could still join two components
    slim = buckets.select("token", "rep", "place").join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    slim = cut_lineage(slim, "bucket-roots")
    remove_written(buckets)
    mixed = slim.groupBy("token").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).filter("_lo != _hi").select("token")
    open_ = slim.join(mixed, "token", "left_semi")
    # tokens met by the same classes make the same pairs; the first of them has the least place
    lists = open_.groupBy("token").agg(F.xxhash64(F.bit_xor(F.xxhash64("rep")), F.count("*")).alias("list"))
    merged = open_.join(lists, "token").groupBy("list", "rep", "root").agg(F.min("place").alias("place")).join(witnesses.select("rep", *_FOLDS), "rep")
    one, two = (merged.select("list", *[F.col(c).alias(f"{c}_{x}") for c in ("rep", "place", "root", *_FOLDS)]) for x in "ab")
    differ = functools.reduce(operator.add, [F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in _FOLDS])
    both = size("place_a") + size("place_b")
    alike = (100 + percent) * (both - differ) >= 2 * percent * both
    rest = one.join(two, (one["list"] == two["list"]) & (F.col("root_a") < F.col("root_b")) & fits("place_a", "place_b") & alike)
    rest = rest.select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")).distinct()
    rest = cut_lineage(rest.join(star, ["a", "b"], "left_anti"), "pairs")
    remove_written(slim, star)
    near = _alike(rest, witnesses, percent)
    remove_written(rest)
    if not near.isEmpty():
        # the components found so far are single nodes now
        written, sets = _sets(texts, ends(near), witnesses, bands, k, percent)
        more = _verify(near, sets, percent)
        remove_written(written, near)
        for side in ("a", "b"):
            more = more.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"r{side}")), side, "left")
        ends = cut_lineage(more.select(*[F.coalesce(f"r{x}", x).alias(y) for x, y in (("a", "u"), ("b", "v"))]), "links")
        if not ends.isEmpty():
            higher = components(ends)
            roots = (
                roots.join(higher.select(F.col("node").alias("root"), F.col("root").alias("_top")), "root", "left").select("node", F.coalesce("_top", "root").alias("root"))
                .unionByName(higher.join(roots.select("node"), "node", "left_anti"))
            )
    bands.destroy()  # all that reads it is written
    return rows, witnesses, roots


def link(docs: DataFrame, k: int = 5, percent: int = 80, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """doc_id, n_shingles, component_id for every row: the least doc_id reachable by links of
    similarity ``percent`` / 100 or more, itself included."""
    measured, witnesses, roots = _classes(docs, k, percent, sketch_bits)
    # least doc_id of each component, then of each class
    named = witnesses.select("rep", "least").join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
    linked = named.filter("root is not null")
    by_root = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = named.join(by_root, "root", "left").select("rep", F.coalesce("component_id", "least").alias("component_id"))
    rows = measured.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("rep")).alias("rep"))
    return rows.join(by_class, "rep", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, one for each component: that with the least doc_id, and of unlike rows under
    this id the first by its content. Texts that are not linked stay, also under one id; rows alike in id
    and text are one. Texts without words are linked with nothing; rows without an id cannot
    be named and stay."""
    measured, _, roots = _classes(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")), k, percent, SKETCH_BITS)
    known = measured.filter("doc_id is not null")
    firsts = known.filter("n > 0").groupBy("rep").agg(F.min(F.struct("doc_id", "row_key")).alias("_first"))
    firsts = firsts.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left").groupBy(F.coalesce("root", "rep").alias("root")).agg(F.min("_first").alias("_first"))
    kept = firsts.select(F.col("_first.row_key").alias("_kept")).unionByName(known.filter("n = 0").select(F.col("row_key").alias("_kept"))).distinct()
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    rows = docs.select(docs[id_col].isNull().alias("_nameless"), _row_key(docs[id_col], docs[text_col]).alias("_key"), row.alias("_row"))
    alike = Window.partitionBy("_key").orderBy(F.xxhash64(*[F.col(f"_row.`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, MapType)]))
    named = rows.filter(~F.col("_nameless")).join(kept, F.col("_key") == F.col("_kept"), "left_semi").withColumn("_nth", F.row_number().over(alike)).filter("_nth = 1")
    return named.select("_row").unionByName(rows.filter("_nameless").select("_row")).select("_row.*")
