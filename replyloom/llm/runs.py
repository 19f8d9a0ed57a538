"""Periodic runs of a text's words, by suffix trees and longest common extensions.

A run is a stretch of consecutive words with smallest period q, at least ``MIN_WORDS`` words and
``MIN_EXPONENT`` periods long, that neither neighbouring word extends. Per text:

1. Ukkonen's algorithm builds a suffix tree of the words and one of their reversal.
2. An Euler tour of each tree answers lowest common ancestors in constant time (range minima over
   the tour), hence how far two places of the text agree to the right, and to the left.
3. Every run has, under one of two opposite orders of the words, a Lyndon root: the longest
   Lyndon word that begins at its place, which ends where the next smaller suffix begins. Each
   place gives one candidate per order, extended in both directions; what spans two
   periods or more is a run, and its root's length is its smallest period.

Trees need only cover places that can lie in a run: inside one, each sequence of three words
recurs at every period, at least three times, and so do its neighbours. Stretches of at least
four consecutive places whose three words are met three times within the stretch are found with
array operations over a whole batch, twice over; they hold every run whole. Plain prose leaves
nothing; a text of repetitions leaves all of itself. A text's stretches share its trees, with
separators that occur once between them.

Memory follows the longest text (about 1 KB for each word inside stretches); batches are cut at
256 KB otherwise. Documents stay where they are read; there is no shuffle.

Defined results: NULL, empty and blank texts have no words, no runs and an empty collapsed text;
rows with equal or NULL ids each give their own row; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from replyloom.llm.common import per_batch, two_columns
from replyloom.llm.words import SPACE, Words, grams, mix, words

MIN_WORDS, MIN_EXPONENT, ROUNDS = 6, 4, 3
_U = np.uint64


class SuffixTree:
    """Ukkonen's tree of a sequence of whole numbers whose last one occurs nowhere else, with
    range minima over its Euler tour. ``rank``: place of each suffix among all in order."""

    def __init__(self, seq: list[int]):
        leaf, length, keys, children = _ukkonen(seq)
        tour, first = _euler(length, keys, children)
        self.first = np.array(first, np.int64)[np.array(leaf, np.int64)]
        self._small, self._large = _minima(np.array(tour, np.int32))
        self.rank = np.empty(len(seq), np.int64)
        self.rank[np.argsort(self.first)] = np.arange(len(seq))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of suffixes ``a`` and ``b`` (unlike ones)."""
        lo, hi = np.minimum(self.first[a], self.first[b]), np.maximum(self.first[a], self.first[b])
        size = hi - lo + 1
        level = np.minimum(_floor_log2(size), len(self._small) - 1)
        out = np.minimum(self._small[level, lo], self._small[level, hi - (1 << level) + 1])
        step = 1 << (len(self._small) - 1)
        # whole blocks between the two ends
        from_, to = -(-lo // step), (hi + 1) // step
        far = np.flatnonzero(to > from_)
        if len(far):
            level = _floor_log2(to[far] - from_[far])
            inner = np.minimum(self._large[level, from_[far]], self._large[level, to[far] - (1 << level)])
            out[far] = np.minimum(out[far], inner)
        return out.astype(np.int64)


def _floor_log2(x: np.ndarray) -> np.ndarray:
    return np.frexp(x.astype(np.float64))[1].astype(np.int64) - 1


def _ukkonen(seq: list[int]) -> tuple[list[int], list[int], int, dict[int, int]]:
    """Leaf of each suffix, length of the edge into each node, key base, children by node and symbol."""
    n, base = len(seq), max(seq) + 1
    start, end, link, leaf = [0], [0], [0], []
    children: dict[int, int] = {}
    find = children.get
    node = edge = length = left = 0
    for i, c in enumerate(seq):
        fresh = 0
        left += 1
        while left:
            if not length:
                edge = i
            key = node * base + seq[edge]
            below = find(key)
            if below is None:
                children[key] = len(start)
                leaf.append(len(start))
                start.append(i)
                end.append(n)
                link.append(0)
                if fresh:
                    link[fresh] = node
                    fresh = 0
            else:
                at = start[below]
                span = (end[below] if end[below] <= i else i + 1) - at
                if length >= span:
                    edge += span
                    length -= span
                    node = below
                    continue
                if seq[at + length] == c:
                    length += 1
                    if fresh:
                        link[fresh] = node
                    break
                split = len(start)
                children[key] = split
                children[split * base + seq[at + length]] = below
                children[split * base + c] = split + 1
                leaf.append(split + 1)
                start += (at, i)
                end += (at + length, n)
                link += (0, 0)
                start[below] = at + length
                if fresh:
                    link[fresh] = split
                fresh = split
            left -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - left + 1
    return leaf, [e - s for s, e in zip(start, end, strict=True)], base, children


def _euler(length: list[int], base: int, children: dict[int, int]) -> tuple[list[int], list[int]]:
    """Depth in words at each step of the tour, children in order of symbols, and each node's first step."""
    keys, nodes = np.fromiter(children.keys(), np.int64, len(children)), np.fromiter(children.values(), np.int64, len(children))
    order = np.argsort(keys)
    parent = keys[order] // base
    following = np.searchsorted(parent, np.arange(len(length) + 1)).tolist()
    child, stop = nodes[order].tolist(), following[1:]
    depth, first, tour, above = [0] * len(length), [0] * len(length), [], []
    v = 0
    while True:
        tour.append(depth[v])
        at = following[v]
        if at < stop[v]:
            following[v] = at + 1
            above.append(v)
            c = child[at]
            depth[c] = depth[v] + length[c]
            first[c] = len(tour)
            v = c
        elif above:
            v = above.pop()
        else:
            return tour, first


def _minima(values: np.ndarray, levels: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Sparse tables of range minima: short ranges everywhere, long ones over whole blocks."""
    small = np.empty((levels, len(values)), values.dtype)
    small[0] = values
    for k in range(1, levels):
        small[k] = small[k - 1]
        half = 1 << (k - 1)
        if len(values) > half:
            np.minimum(small[k - 1, :-half], small[k - 1, half:], out=small[k, :-half])
    large = [small[-1, : len(values) - len(values) % (1 << (levels - 1)) : 1 << (levels - 1)]]
    while len(large[0]) >= 2 << (len(large) - 1):
        half, row = 1 << (len(large) - 1), large[-1].copy()
        np.minimum(large[-1][:-half], large[-1][half:], out=row[:-half])
        large.append(row)
    return small, np.array(large)


def _next_less(rank: list[int]) -> list[int]:
    """For each place the next one of less rank, or -1."""
    out, open_ = [-1] * len(rank), []
    for i, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = i
        open_.append(i)
    return out


def maximal_runs(seq: list[int]) -> np.ndarray:
    """start, length, period of every maximal repetition of at least two periods, in order."""
    last = max(seq, default=0)
    ahead, back = SuffixTree([*seq, last + 1]), SuffixTree([*seq[::-1], last + 1])
    rank = ahead.rank[: len(seq)]
    found = []
    for order in (rank, -rank):
        root_end = np.array(_next_less(order.tolist()), np.int64)
        i = np.flatnonzero(root_end >= 0)
        j = root_end[i]
        right = ahead.common(i, j)
        inner = np.flatnonzero(i > 0)
        left = np.zeros(len(i), np.int64)
        left[inner] = back.common(len(seq) - i[inner], len(seq) - j[inner])
        period = j - i
        twice = left + right >= period
        found.append(np.stack([(i - left)[twice], (left + period + right)[twice], period[twice]], axis=1))
    return np.unique(np.concatenate(found), axis=0)


def _stretches(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word of each stretch that could hold a run, and the word after its last."""
    value, at = grams(w, 3)
    group = w.doc[at] if len(at) else at
    first = stop = np.zeros(0, np.int64)
    for _ in range(ROUNDS):
        with np.errstate(over="ignore"):
            key = value + mix(group.astype(_U) + _U(1))
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        often = count[which] >= MIN_EXPONENT - 1
        kept = len(at)
        value, at, group = value[often], at[often], group[often]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(group) != 0)
        head = np.flatnonzero(new)
        size = np.diff(np.concatenate((head, [len(at)])))
        long = size >= MIN_WORDS - 2
        keep = np.repeat(long, size)
        value, at, group = value[keep], at[keep], np.repeat(np.arange(len(size)), size)[keep]
        head, size = np.concatenate(([0], np.cumsum(size[long])))[:-1], size[long]
        first, stop = at[head] if len(at) else at, (at[head] + size + 2) if len(at) else at
        if len(at) in (0, kept):
            break
    return first, stop


def find_runs(w: Words) -> list[np.ndarray]:
    """For each text its runs (start, length, period), ordered by start and period."""
    bounds, out = w.bounds(), [np.zeros((0, 3), np.int64)] * w.n_docs
    first, stop = _stretches(w)
    owner = w.doc[first] if len(first) else first
    for doc in np.unique(owner):
        mine = np.flatnonzero(owner == doc)
        _, ids = np.unique(np.concatenate([w.hash[first[k] : stop[k]] for k in mine]), return_inverse=True)
        ids, seq, place = ids + len(mine), [], []
        done = 0
        for n, k in enumerate(mine):
            size = int(stop[k] - first[k])
            seq += [*ids[done : done + size].tolist(), n]
            place.append(np.arange(first[k], stop[k] + 1))
            done += size
        runs = maximal_runs(seq)
        runs = runs[runs[:, 1] >= np.maximum(MIN_WORDS, MIN_EXPONENT * runs[:, 2])]
        runs[:, 0] = np.concatenate(place)[runs[:, 0]] - bounds[doc]
        out[doc] = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return out


def _collapsed(w: Words, runs: list[np.ndarray]) -> pa.Array:
    """Texts of the words outside runs' repetitions, one space between."""
    bounds, edge = w.bounds(), np.zeros(len(w.hash) + 1, np.int64)
    for doc, found in enumerate(runs):
        if len(found):
            np.add.at(edge, bounds[doc] + found[:, 0] + found[:, 2], 1)
            np.add.at(edge, bounds[doc] + found[:, 0] + found[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edge)[:-1] == 0)
    start, end, doc = w.start[kept], w.end[kept], w.doc[kept]
    # a word and, unless it is its text's last, one byte after it, which becomes a space
    spaced = np.zeros(len(kept), np.int64)
    spaced[:-1] = doc[1:] == doc[:-1]
    change = np.zeros(len(w.buf) + 2, np.int8)
    change[start] += 1
    change[end + spaced] -= 1
    inside = np.cumsum(change, dtype=np.int8)[: len(w.buf)] > 0
    data = w.buf.copy()
    data[end[spaced == 1]] = 0x20
    size = np.bincount(doc, weights=(end - start + spaced), minlength=w.n_docs).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.StringArray.from_buffers(w.n_docs, pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes()))


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _one_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    w = words(batch.column("text"), SPACE, lower=False)
    runs = find_runs(w)
    flat = np.concatenate([*runs, np.zeros((0, 3), np.int64)])
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(RUN)))
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(w.counts().astype(np.int64)), lists, _collapsed(w, runs)], ["doc_id", "n_words", "runs", "collapsed"])


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), collapsed (the text
    without the words of a run after its first period, one space between words)."""
    schema = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return two_columns(docs, id_col, text_col).mapInArrow(per_batch(_one_batch), schema)
