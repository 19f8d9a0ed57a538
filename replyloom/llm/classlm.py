"""Scoring texts with Brown class-based bigrams.

Words are assigned to classes by exchange clustering, and a text's probability is the product
of class transitions and word emissions, mixed with the add-one unigram model.

1. Texts are written once as blocks of bounded size: each has its own list of distinct words
   and the texts as positions in it. A block is one row, so its texts and words stay together.
2. Blocks ask about words in a few rows, one for each part of the vocabulary (dealt by hash); what
   answers a part sums it over all blocks and returns a value for each word asked about. Word
   counts come this way, and the classes of every round below.
3. Start: the ``TOP`` most frequent words one by one, every other word with those of its
   shape (last characters, length, kind), as at most ``UNITS`` units. Each unit in turn moves to the class
   where the mutual information of adjacent classes is greatest, until a sweep moves few or ``SWEEPS`` are done.
4. Exchange of all words of the training texts, however rare: each word leaves its start class by itself. A round counts
   exactly the class bigrams and the classes before and after every word. The ``TOP`` words move one after the other,
   which needs no more than these counts and the bigrams among them; each other word moves to the class where the
   mutual information is greatest with all others as they are: in the first round all words, then every ``EVERY``-th by turns,
   ``ROUNDS`` in all. Words move at once, so a round after which the mutual information is no greater is
   taken back, and only every other word of a turn moves from then on, then every fourth.
5. Scores: the block gets its words' counts and classes and is scored by array look-ups.

P(w | previous) = MIX * P(c(w) | c(previous)) * P(w | c(w)) + (1 - MIX) * P1(w), where P1 is
(count + 1) / (N + V + 1), transitions are smoothed with the class frequencies, and a
class keeps one count for words never seen; theirs is the class with most words of their shape.

Edge cases: NULL and empty texts are their end token alone; a NULL id is training text; repeated
rows count each; a long text is one block of its own; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from replyloom.llm import words as W
from replyloom.llm.common import giving_back, two_columns
from replyloom.session import cut_lineage, remove_written

BLOCK_BYTES = 4 << 20
TOP, SHAPES = 500, 523
UNITS = TOP + SHAPES + 1
CLASSES = 48
SWEEPS = 6
EVERY = 3
ROUNDS = 1 + 2 * EVERY
MIX = 0.9
END = UNITS - 1
#: Kinds of characters as bits: others, lower-case letters, digits, beyond ASCII; white space has none.
_KIND = np.full(256, 1, np.uint8)
_KIND[97:123], _KIND[48:58], _KIND[128:], _KIND[W.SPACE] = 2, 4, 8, 0
_BLOCK = "block bigint, ids binary, first binary, docs array<bigint>, held array<boolean>, words binary, shapes binary, counts binary"
#: Blocks are rows of a few MB; readers and writers hold few of them.
_LARGE = {"size": 16 << 20, "row_count_limit": 4}


def shape(w: W.Words, at: np.ndarray) -> np.ndarray:
    """A unit number from a word's first and last bytes, length and kinds of characters."""
    s, e = w.start[at], w.end[at]
    code = np.minimum(e - s, 12).astype(np.uint64)
    kinds = np.bitwise_or.reduceat(_KIND[w.buf], w.start)[at] if len(w.start) else np.zeros(0, np.uint8)
    plain = (kinds & 6) == 2
    code = code * np.uint64(16) + kinds.astype(np.uint64)
    with np.errstate(over="ignore"):
        last = w.buf[np.maximum(e - 1, s)].astype(np.uint64) * np.uint64(256) + w.buf[np.maximum(e - 2, s)].astype(np.uint64)
        code = np.where(plain, last * np.uint64(31) + np.minimum(e - s, 4).astype(np.uint64), code * np.uint64(7919) + np.uint64(1 << 40))
        return (W.mix(code) % np.uint64(SHAPES)).astype(np.int32)


def _planes(ids: np.ndarray) -> bytes:
    """Four planes of bytes, lowest first: frequent words have small numbers, so the upper planes are
    nearly empty and compress away."""
    return np.concatenate([(ids >> s & 255).astype(np.uint8) for s in (0, 8, 16, 24)]).tobytes()


def _unplaned(data) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def blocks(docs: DataFrame, hold_mod: int, hold_rest: int) -> DataFrame:
    """One row for each block; see the module text."""

    def made(rows: list[tuple], number: int) -> pa.RecordBatch:
        texts = pa.array([t for _, t in rows], pa.string())
        w = W.words(texts, W.SPACE)
        held = np.array([i is not None and zlib.crc32(str(i).encode()) % hold_mod == hold_rest for i, _ in rows])
        distinct, at, ids, often = np.unique(w.hash, return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        distinct, at, ids = distinct[order], at[order], rank[ids]
        counts = np.bincount(ids[~held[w.doc]], minlength=len(distinct)) if len(ids) else np.zeros(0, np.int64)
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        raw = lambda values, kind: pa.array([values.astype(kind).tobytes()], pa.binary())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), pa.array([_planes(ids)], pa.binary()), raw(w.bounds(), "<i8"),
                one([i for i, _ in rows], pa.int64()), one(held.tolist(), pa.bool_()), raw(distinct, "<u8"), raw(shape(w, at), "<u2"), raw(counts, "<i8"),
            ],
            names=["block", "ids", "first", "docs", "held", "words", "shapes", "counts"],
        )

    def run(batches):
        from pyspark import TaskContext

        number, rows, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if rows and size + len(t or "") > BLOCK_BYTES:
                    yield made(rows, number)
                    number, rows, size = number + 1, [], 0
                rows.append((i, t))
                size += len(t or "")
        if rows:
            yield made(rows, number)

    return cut_lineage(two_columns(docs).mapInArrow(run, _BLOCK), "lm-blocks", **_LARGE)


@dataclass
class Model:
    unseen: np.ndarray
    log_next: np.ndarray
    emit: np.ndarray
    total: int
    vocabulary: int
    ends: int


def _ranks(top: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Place among the top words, or -1."""
    if not len(top):
        return np.full(len(words), -1)
    at = np.minimum(np.searchsorted(top, words), len(top) - 1)
    return np.where(top[at] == words, at, -1)


def _units(top: np.ndarray, words: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    rank = _ranks(top, words)
    return np.where(rank < 0, shapes.astype(np.int64) + TOP, rank)


def _raw(batch: pa.RecordBatch, i: int, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(batch.column(name)[i].as_buffer(), kind)


def _adjacent(batch: pa.RecordBatch, i: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Words before and after each other in a block's training texts, by position; every text begins and
    ends with the end, whose position is the number of words."""
    ids, first, held = _unplaned(batch.column("ids")[i].as_buffer()), _raw(batch, i, "first", "<i8"), np.array(batch.column("held")[i].as_py())
    seq = np.insert(ids, first[1:], words)
    doc = np.insert(np.repeat(np.arange(len(held)), np.diff(first)), first[1:], np.arange(len(held)))
    before, keep = np.concatenate(([words], seq[:-1])), ~held[doc]
    return before[keep], seq[keep]


def _summed(cells: DataFrame, size: int, purpose: str) -> np.ndarray:
    """Sums of ``n`` by ``cell``."""
    got = cut_lineage(cells.groupBy("cell").agg(F.sum("n").alias("n")), purpose, arrow_rows=4).toArrow()
    out = np.zeros(size, np.int64)
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out


def unit_bigrams(parts: DataFrame, top: np.ndarray) -> np.ndarray:
    """Adjacent units in training texts; every text begins and ends with the end unit."""

    def run(batches):
        total = np.zeros(UNITS * UNITS, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                words = _raw(batch, i, "words", "<u8")
                unit = np.append(_units(top, words, _raw(batch, i, "shapes", "<u2")), END)
                before, after = _adjacent(batch, i, len(words))
                np.add.at(total, unit[before] * UNITS + unit[after], 1)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["cell", "n"])

    cells = parts.select("ids", "first", "held", "words", "shapes").mapInArrow(run, "cell int, n bigint")
    return _summed(cells, UNITS * UNITS, "lm-bigrams").reshape(UNITS, UNITS)


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS, cls: np.ndarray | None = None, fixed: int = 0) -> np.ndarray:
    """Class of each unit; the end unit has class 0 alone. Units start by frequency rank, or where ``cls`` has
    them; then the first ``fixed`` stay there."""
    b = bigrams.astype(float)
    units = len(b)
    weight = b.sum(axis=1) + b.sum(axis=0)
    if cls is None:
        cls = np.zeros(units, np.int64)
        order = [int(u) for u in np.argsort(-weight, kind="stable") if u != units - 1]
        for rank, u in enumerate(order):
            cls[u] = 1 + rank % (classes - 1)
    else:
        cls = cls.copy()
        order = [int(u) for u in np.argsort(-weight, kind="stable") if u >= fixed]
    xlogx = lambda x: x * np.log(np.maximum(x, 1))
    member = np.zeros((units, classes))
    member[np.arange(units), cls] = 1
    n = member.T @ b @ member
    right, left = b @ member, b.T @ member  # by unit: counts to and from each class
    active = [u for u in order if weight[u] > 0]
    for _ in range(sweeps):
        moved = 0
        for u in active:
            old, self_ = cls[u], b[u, u]
            # take u out of its class
            r, l_ = right[u].copy(), left[u].copy()
            r[old] -= self_
            l_[old] -= self_
            n[old, :] -= r
            n[:, old] -= l_
            n[old, old] -= self_
            # totals of the classes when u is back, wherever it goes
            rows, cols = n.sum(axis=1) + l_, n.sum(axis=0) + r
            out_w, in_w = r.sum() + self_, l_.sum() + self_
            # gain of joining each class k: cells (k, d) += r[d], (c, k) += l[c], (k, k) += r[k] + l[k] + self
            gain = (xlogx(n + r[None, :]) - xlogx(n)).sum(axis=1) + (xlogx(n + l_[:, None]) - xlogx(n)).sum(axis=0)
            diag = np.diag(n)
            gain += xlogx(diag + r + l_ + self_) - xlogx(diag + r) - xlogx(diag + l_) + xlogx(diag)
            gain -= xlogx(rows + out_w) - xlogx(rows) + xlogx(cols + in_w) - xlogx(cols)
            gain[0] = -np.inf
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            n[new, :] += r
            n[:, new] += l_
            n[new, new] += self_
            if new != old:
                moved += 1
                cls[u] = new
                right[:, old] -= b[:, u]
                right[:, new] += b[:, u]
                left[:, old] -= b[u, :]
                left[:, new] += b[u, :]
        if moved <= len(active) // 200:
            break
    return cls


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _gains(n: np.ndarray, old: np.ndarray, to: np.ndarray, back: np.ndarray, own: np.ndarray) -> np.ndarray:
    """What cells (class, neighbour's class) gain when a word is in each of the classes. ``n``: class bigrams with all
    words where they are (``old``); ``to``: each word's neighbours by class, ``back``: those on the other side, both
    without the word itself, which follows itself ``own`` times."""
    words, classes = to.shape
    out = np.zeros((words, classes))
    word, c = np.nonzero(to)
    count = to[word, c]
    same = c == old[word]
    # other classes' cells are as counted, whatever the word: one look-up by neighbour's class and count
    w, d, m = word[~same], c[~same], count[~same]
    pairs, kind = np.unique(m.astype(np.int64) * classes + d, return_inverse=True)
    cells = n[:, pairs % classes].T
    value = _xlogx(cells + (pairs // classes)[:, None]) - _xlogx(cells)
    for i in range(0, len(w), 1 << 14):
        part = w[i : i + (1 << 14)]
        at = np.flatnonzero(np.diff(part, prepend=-1))
        out[part[at]] += np.add.reduceat(value[kind[i : i + (1 << 14)]], at, axis=0)
    # its own class has the cell without the word
    o = old[w]
    cell = n[o, d]
    out[np.arange(words), old] += np.bincount(w, _xlogx(cell) - _xlogx(cell - m) - value[kind, o], minlength=words)
    # neighbours of its own class: that class's column is without the word too
    for i in range(0, int(same.sum()), 1 << 14):
        w, m = word[same][i : i + (1 << 14)], count[same][i : i + (1 << 14)]
        o = old[w]
        cells = n[:, o].T - back[w]
        cells[np.arange(len(w)), o] = n[o, o] - to[w, o] - back[w, o] - own[w]
        out[w] += _xlogx(cells + m[:, None]) - _xlogx(cells)
    return out


def best(n: np.ndarray, old: np.ndarray, after: np.ndarray, before: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The class where each word makes the mutual information of adjacent classes greatest, all other words staying
    where they are; its own if none is better. ``n``: class bigrams; ``after`` and ``before``: each word's neighbours by class,
    the word itself included, which follows itself ``own`` times."""
    n, rows_of = n.astype(float), np.arange(len(old))
    right, left, own = after.astype(float), before.astype(float), own.astype(float)
    right[rows_of, old] -= own
    left[rows_of, old] -= own
    gain = _gains(n, old, right, left, own) + _gains(n.T, old, left, right, own)
    # the cell of the class with itself counts in both; its right sum has what follows inside it
    diag = np.tile(np.diag(n), (len(old), 1))
    diag[rows_of, old] -= right[rows_of, old] + left[rows_of, old] + own
    w, k = np.nonzero(((right > 0) & (left > 0)) | (own > 0)[:, None])
    x, r, l_, s = diag[w, k], right[w, k], left[w, k], own[w]
    gain[w, k] += _xlogx(x + r + l_ + s) - _xlogx(x + r) - _xlogx(x + l_) + _xlogx(x)
    for total, weight in ((n.sum(axis=1), right.sum(axis=1) + own), (n.sum(axis=0), left.sum(axis=1) + own)):
        weights, at = np.unique(weight, return_inverse=True)
        gain -= (_xlogx(total[None, :] + weights[:, None]) - _xlogx(np.tile(total, (len(weights), 1))))[at]
        without = total[old] - weight
        gain[rows_of, old] += _xlogx(total[old] + weight) - _xlogx(total[old]) - _xlogx(total[old]) + _xlogx(without)
    gain[:, 0] = -np.inf
    new = np.argmax(gain, axis=1)
    return np.where(gain[rows_of, new] <= gain[rows_of, old] + 1e-9, old, new)


def information(n: np.ndarray) -> float:
    """Mutual information of adjacent classes, times their number, but for what no move changes."""
    return float(_xlogx(n.astype(float)).sum() - _xlogx(n.sum(axis=0).astype(float)).sum() - _xlogx(n.sum(axis=1).astype(float)).sum())


def _cut(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """A binary value for each stretch of ``data`` between two of the places ``at``."""
    data = np.ascontiguousarray(data)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * data.itemsize).astype(np.int32)), pa.py_buffer(data)])


def _joined(table: pa.Table, name: str, kind: str) -> np.ndarray:
    """The values of all rows one after the other."""
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_buffer(), kind) for c in table.column(name).chunks for x in c)])


def _dealt(words: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For one block: its words ordered by part of the vocabulary, the parts it has words of, and where each begins, with one place more."""
    part = (words % np.uint64(parts)).astype(np.int64)
    sizes = np.bincount(part, minlength=parts)
    has = np.flatnonzero(sizes)
    return np.argsort(part, kind="stable"), has, np.concatenate(([0], np.cumsum(sizes[has])))


def _answers(table: pa.Table, values: np.ndarray) -> list[pa.Array]:
    """Block, part and the values of the words it asked about, for each row of ``table``."""
    sizes = np.array([len(x.as_buffer()) // 8 for c in table.column("words").chunks for x in c], np.int64)
    return [table.column("block").combine_chunks(), table.column("part").combine_chunks(), _cut(values, np.concatenate(([0], np.cumsum(sizes))))]


def _ordered(table: pa.Table, name: str, kind: str, order: np.ndarray) -> np.ndarray:
    """Answers that a block got, in the order of the words it asked about."""
    got = table.filter(pc.and_(table.column(name).is_valid(), table.column("part").is_valid())).sort_by("part")
    out = np.zeros(len(order), kind)
    out[order] = _joined(got, name, kind)
    return out


_COUNTED = "block bigint, part int, n binary, top array<bigint>, top_n array<bigint>"


def word_counts(parts: DataFrame, deal: int) -> DataFrame:
    """Training counts of each block's words over all blocks, doubled, and one more in the block that stands for the word;
    rows without a block have the most frequent words of a part."""

    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                words = _raw(batch, i, "words", "<u8")
                order, has, at = _dealt(words, deal)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(has.astype(np.int32)), pa.array(np.full(len(has), batch.column("block")[i].as_py())), _cut(words[order], at), _cut(_raw(batch, i, "counts", "<i8")[order], at)],
                    names=["part", "block", "words", "counts"],
                )

    def add(table: pa.Table) -> pa.Table:
        words, one, at = np.unique(_joined(table, "words", "<u8"), return_index=True, return_inverse=True)
        counts = _joined(table, "counts", "<i8")
        n = np.zeros(len(words), np.int64)
        np.add.at(n, at, counts)
        first = np.lexsort((words.view(np.int64), -n))[:TOP]
        first = first[n[first] > 0]
        rows, none = table.num_rows, pa.list_(pa.int64())
        doubled = 2 * n[at]
        doubled[one] += 1
        block, part, values = _answers(table, doubled)
        answers = pa.table([block, part, values, pa.nulls(rows, none), pa.nulls(rows, none)], names=["block", "part", "n", "top", "top_n"])
        top = [pa.array([None], pa.int64()), part.slice(0, 1), pa.array([None], pa.binary()), pa.array([words[first].view(np.int64)], none), pa.array([n[first]], none)]
        return pa.concat_tables([answers, pa.table(top, names=answers.column_names)])

    asked = parts.select("block", "words", "counts").mapInArrow(giving_back(ask), "part int, block bigint, words binary, counts binary")
    return cut_lineage(asked.groupBy("part").applyInArrow(add, _COUNTED), "lm-counts", arrow_rows=16, size=_LARGE["size"])


_ASKED = "part int, block bigint, words binary, own binary, after_size binary, after_class binary, after_n binary, before_size binary, before_class binary, before_n binary, cls binary, cells binary"
_TEXT = ["block", "ids", "first", "held", "words", "shapes"]
_MOVED = "block bigint, part int, cls binary, moved bigint, active bigint"


@dataclass
class Turn:
    """Words that a round asks about: every ``among``-th but the top ones, or none."""

    among: int
    number: int

    def words(self, words: np.ndarray, top: np.ndarray) -> np.ndarray:
        if not self.among:
            return np.zeros(0, np.int64)
        return np.flatnonzero(((words >> np.uint64(40)) % np.uint64(self.among) == np.uint64(self.number % self.among)) & (_ranks(top, words) < 0))


def _neighbours(batch: pa.RecordBatch, i: int, words: np.ndarray, cls: np.ndarray, top: np.ndarray, deal: int, turn: Turn) -> pa.RecordBatch:
    """What one block has to say of its words whose turn it is, by part of the vocabulary, and (a row without a part) all its words'
    classes, its class bigrams and the classes after and before the top words."""
    count, asked = len(words), turn.words(words, top)
    order, has, at = _dealt(words[asked], deal)
    asked, place = asked[order], np.full(count + 1, -1)
    place[asked] = np.arange(len(asked))
    before, after = _adjacent(batch, i, count)
    classes, rank = np.append(cls, 0).astype(np.int64), np.append(_ranks(top, words), -1)
    class_before, class_after = classes[before], classes[after]
    cells = [np.bincount(class_before * CLASSES + class_after, minlength=CLASSES * CLASSES)]
    twice = place[before[before == after]]
    kept = [_cut(x, at) for x in (words[asked], cls[asked].astype("u1"), np.bincount(twice[twice >= 0], minlength=len(asked)).astype("<u4"))]
    narrow = np.uint32 if len(asked) * CLASSES < 1 << 32 else np.int64
    for word, other in ((before, class_after), (after, class_before)):
        listed = np.flatnonzero(rank[word] >= 0)
        cells.append(np.bincount(rank[word[listed]] * CLASSES + other[listed], minlength=len(top) * CLASSES))
        where = place[word]
        inside = np.flatnonzero(where >= 0)
        key, n = np.unique((where[inside] * CLASSES + other[inside]).astype(narrow), return_counts=True)
        sizes = np.bincount(key // CLASSES, minlength=len(asked))
        entry = np.concatenate(([0], np.cumsum(sizes)))[at]
        kept += [_cut(sizes.astype("u1"), at), _cut((key % CLASSES).astype("u1"), entry), _cut(n.astype("<u4"), entry)]
    rows = len(has)
    columns = [pa.array([*has.tolist(), None], pa.int32()), pa.array([batch.column("block")[i].as_py()] * (rows + 1), pa.int64())]
    told = [pa.nulls(1, pa.binary())] * len(kept)
    told[1] = pa.array([cls.astype("u1").tobytes()], pa.binary())
    joined = [pa.concat_arrays([x, y]) for x, y in zip(kept, told, strict=True)]
    cells = pa.array([None] * rows + [np.concatenate(cells).astype("<u4").tobytes()], pa.binary())
    return pa.RecordBatch.from_arrays([*columns, joined[0], *joined[2:], joined[1], cells], names=[x.split()[0] for x in _ASKED.split(", ")])


def start(parts: DataFrame, top: np.ndarray, unit_class: np.ndarray, deal: int) -> DataFrame:
    """What blocks say of all words, with each in the class of its unit."""
    shared = parts.sparkSession.sparkContext.broadcast((top, unit_class))

    def run(batches):
        top, unit_class = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                words = _raw(batch, i, "words", "<u8")
                yield _neighbours(batch, i, words, unit_class[_units(top, words, _raw(batch, i, "shapes", "<u2"))], top, deal, Turn(1, 0))

    return cut_lineage(parts.select(_TEXT).mapInArrow(giving_back(run), _ASKED), "lm-neighbours", arrow_rows=4, size=_LARGE["size"])


def again(parts: DataFrame, asked: DataFrame, moved: DataFrame, top: np.ndarray, top_class: np.ndarray, deal: int, turn: Turn, next_: Turn) -> DataFrame:
    """What blocks say of the words of the next turn, after those of a turn and the top words have moved."""
    shared = parts.sparkSession.sparkContext.broadcast((top, top_class))

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        (top, top_class), batch = shared.value, block.combine_chunks().to_batches()[0]
        words = _raw(batch, 0, "words", "<u8")
        cls, some = _joined(answers.filter(pc.is_null(answers.column("part"))), "cls", "u1").copy(), turn.words(words, top)
        cls[some] = _ordered(answers, "cls", "u1", _dealt(words[some], deal)[0])
        rank = _ranks(top, words)
        cls[rank >= 0] = top_class[rank[rank >= 0]]
        return pa.Table.from_batches([_neighbours(batch, 0, words, cls, top, deal, next_)])

    answers = asked.filter("part is null").select("block", "part", "cls").unionByName(moved.filter("block is not null").select("block", "part", "cls"))
    both = parts.select(_TEXT).groupBy("block").cogroup(answers.groupBy("block"))
    return cut_lineage(both.applyInArrow(run, _ASKED), "lm-neighbours", arrow_rows=256, size=_LARGE["size"])


def moves(asked: DataFrame, n: np.ndarray, share: Turn) -> DataFrame:
    """Classes of the words asked about after they, or a share of them, have moved; a row without a block for each part has how
    many moved, of how many."""
    shared = asked.sparkSession.sparkContext.broadcast(n)

    def run(table: pa.Table) -> pa.Table:
        words, first, at = np.unique(_joined(table, "words", "<u8"), return_index=True, return_inverse=True)
        old = _joined(table, "cls", "u1")[first].astype(np.int64)
        own = np.bincount(at, _joined(table, "own", "<u4"), minlength=len(words))
        sides = []
        for side in ("after", "before"):
            word = np.repeat(at, _joined(table, f"{side}_size", "u1"))
            key = word * CLASSES + _joined(table, f"{side}_class", "u1")
            sides.append(np.bincount(key, _joined(table, f"{side}_n", "<u4"), minlength=len(words) * CLASSES).reshape(-1, CLASSES))
        may = np.flatnonzero((sides[0].sum(axis=1) > 0) & ((words >> np.uint64(50)) % np.uint64(share.among) == np.uint64(share.number % share.among)))
        new = old.copy()
        for i in range(0, len(may), 1 << 14):
            some = may[i : i + (1 << 14)]
            new[some] = best(shared.value, old[some], sides[0][some], sides[1][some], own[some])
        answers = pa.table([*_answers(table, new[at].astype("u1")), *(pa.nulls(table.num_rows, pa.int64()) for _ in range(2))], names=[x.split()[0] for x in _MOVED.split(", ")])
        told = [pa.array([None], pa.int64()), answers.column("part").combine_chunks().slice(0, 1), pa.array([None], pa.binary()), pa.array([int((new != old).sum())]), pa.array([len(may)])]
        return pa.concat_tables([answers, pa.table(told, names=answers.column_names)])

    return cut_lineage(asked.filter("part is not null").drop("cells").groupBy("part").applyInArrow(run, _MOVED), "lm-classes", arrow_rows=256, size=_LARGE["size"])


def _class_bigrams(asked: DataFrame, tops: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class bigrams, and the classes after and before each top word."""
    size = CLASSES * (CLASSES + 2 * tops)

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for x in batch.column("cells"):
                total += np.frombuffer(x.as_buffer(), "<u4")
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["cell", "n"])

    cells = _summed(asked.filter("part is null").select("cells").mapInArrow(giving_back(run), "cell int, n bigint"), size, "lm-class-bigrams")
    n, after, before = np.split(cells, [CLASSES * CLASSES, CLASSES * (CLASSES + tops)])
    return n.reshape(CLASSES, CLASSES), after.reshape(tops, CLASSES), before.reshape(tops, CLASSES)


def _move_top(n: np.ndarray, after: np.ndarray, before: np.ndarray, among: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the top words after each in turn has moved, and the class bigrams then. ``among``: bigrams of the top words."""
    member = np.eye(CLASSES, dtype=np.int64)[cls]
    to, from_ = after - among @ member, before - among.T @ member  # neighbours that are not top words
    rest = n - member.T @ to - from_.T @ member - member.T @ among @ member
    units = np.block([[rest, from_.T], [to, among]])
    new = exchange(units, sweeps=1, cls=np.concatenate((np.arange(CLASSES), cls)), fixed=CLASSES)
    member = np.eye(CLASSES, dtype=np.int64)[new]
    return new[CLASSES:], member.T @ units @ member


def _kinds(parts: DataFrame, counts: DataFrame, asked: DataFrame, deal: int) -> np.ndarray:
    """Distinct training words by shape and class; each is counted in one of its blocks."""

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        batch = block.combine_chunks().to_batches()[0]
        n = _ordered(answers, "n", "<i8", _dealt(_raw(batch, 0, "words", "<u8"), deal)[0])
        cell = _raw(batch, 0, "shapes", "<u2").astype(np.int64) * CLASSES + _joined(answers.filter(answers.column("cls").is_valid()), "cls", "u1")
        cell, many = np.unique(cell[(n > 1) & (n & 1 == 1)], return_counts=True)
        return pa.table([pa.array(cell.astype(np.int32)), pa.array(many)], names=["cell", "n"])

    both = parts.select("block", "words", "shapes").groupBy("block").cogroup(_known(counts, asked).groupBy("block"))
    return _summed(both.applyInArrow(run, "cell int, n bigint"), SHAPES * CLASSES, "lm-kinds").reshape(SHAPES, CLASSES)


def _known(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """Counts and classes of each block's words."""
    classes = asked.filter("part is null").select("block", "part", "cls")
    return counts.filter("block is not null").select("block", "part", "n").unionByName(classes, allowMissingColumns=True)


def train(parts: DataFrame) -> tuple[Model, DataFrame, DataFrame, int]:
    """The model, the training counts and the classes of each block's words, and the number of parts."""
    many = parts.count()
    deal = max(1, min(many // 4, 512), many // 24)
    counts = word_counts(parts, deal)
    frequent = counts.filter("block is null").select(F.explode(F.arrays_zip("top", "top_n")).alias("e")).select(F.col("e.top").alias("word"), F.col("e.top_n").alias("n"))
    top = np.sort(frequent.orderBy(F.desc("n"), "word").limit(TOP).select("word").toArrow().column("word").to_numpy().view(np.uint64))
    bigrams = unit_bigrams(parts, top)
    unit_class = exchange(bigrams)
    tops, top_class, bigrams = len(top), unit_class[: len(top)], bigrams[: len(top), : len(top)].copy()
    asked, turn, share = start(parts, top, unit_class, deal), Turn(1, 0), 1
    n, *sides = _class_bigrams(asked, tops)
    for i in range(ROUNDS):
        next_ = Turn(EVERY if i + 1 < ROUNDS else 0, i + 1)
        top_then, n_top = _move_top(n, *sides, bigrams, top_class)
        moved = moves(asked, n_top, Turn(share, i // EVERY))
        told = moved.filter("block is null").agg(F.sum("moved"), F.sum("active")).first()
        then = again(parts, asked, moved, top, top_then, deal, turn, next_)
        n_then, *sides_then = _class_bigrams(then, tops)
        if information(n_then) > information(n):
            remove_written(asked, moved)
            asked, turn, n, sides, top_class = then, next_, n_then, sides_then, top_then
            if i and told[0] <= told[1] // 200:
                break
        else:
            remove_written(then, moved)
            if not told[0]:
                break
            share *= 2
    kinds = _kinds(parts, counts, asked, deal)
    ends, known = int(n[:, 0].sum()), kinds.sum(axis=0)
    known[0] = 1 if ends else 0
    mass = n.sum(axis=0)
    freq = (mass + 1) / (mass + 1).sum()
    # transitions fall back on class frequencies in proportion to how few followers were seen
    rows = n.sum(axis=1, keepdims=True)
    kinds_after = (n > 0).sum(axis=1, keepdims=True) + 1
    log_next = np.log10((n + kinds_after * freq[None, :]) / (rows + kinds_after))
    # what a class emits: counts + 1 over its mass, its words and one unseen word; 0 for the end class
    emit = mass + known + 1.0
    unseen = np.where(kinds.any(axis=1), kinds.argmax(axis=1), unit_class[TOP : TOP + SHAPES])
    return Model(unseen, log_next, emit, int(mass.sum()), int(known.sum()), ends), counts, asked, deal


_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score_blocks(parts: DataFrame, counts: DataFrame, asked: DataFrame, model: Model, deal: int) -> DataFrame:
    shared = parts.sparkSession.sparkContext.broadcast(model)

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        m, batch = shared.value, block.combine_chunks().to_batches()[0]
        ids, first, words = _unplaned(batch.column("ids")[0].as_buffer()), _raw(batch, 0, "first", "<i8"), _raw(batch, 0, "words", "<u8")
        c, cls = _ordered(answers, "n", "<i8", _dealt(words, deal)[0]) >> 1, _joined(answers.filter(answers.column("cls").is_valid()), "cls", "u1").astype(np.int64)
        c, cls = np.append(c, m.ends), np.append(np.where(c > 0, cls, m.unseen[_raw(batch, 0, "shapes", "<u2")]), 0)
        seq = np.insert(ids, first[1:], len(words))
        docs = len(first) - 1
        doc = np.insert(np.repeat(np.arange(docs), np.diff(first)), first[1:], np.arange(docs))
        after = cls[seq]
        before = np.concatenate(([0], after[:-1]))
        base = (c + 1) / (m.total + m.vocabulary + 1)
        inside = np.append((c[:-1] + 1) / m.emit[cls[:-1]], 1.0)
        p = MIX * 10 ** m.log_next[before, after] * inside[seq] + (1 - MIX) * base[seq]
        return pa.Table.from_arrays(
            [
                batch.column("docs")[0].values, batch.column("held")[0].values, pa.array(np.bincount(doc, minlength=docs).astype(np.int64)),
                pa.array(np.bincount(doc, c[seq] > 0, minlength=docs).astype(np.int64)), pa.array(np.full(docs, m.total, np.int64)),
                pa.array(np.bincount(doc, np.log10(base)[seq], minlength=docs)), pa.array(np.bincount(doc, np.log10(p), minlength=docs)),
            ],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    both = parts.select("block", "ids", "first", "docs", "held", "words", "shapes").groupBy("block").cogroup(_known(counts, asked).groupBy("block"))
    return cut_lineage(both.applyInArrow(run, _SCORES), "lm-scores", arrow_rows=256)


def score(docs: DataFrame, hold_mod: int = 7, hold_rest: int = 2) -> DataFrame:
    """A row for each document: held_out, n_tokens, n_known, train_tokens, base_score and score (log10
    probabilities). Texts with crc32(doc_id) mod ``hold_mod`` = ``hold_rest`` are not learned from."""
    parts = blocks(docs, hold_mod, hold_rest)
    model, counts, asked, deal = train(parts)
    scores = score_blocks(parts, counts, asked, model, deal)
    remove_written(parts, counts, asked)
    return scores
