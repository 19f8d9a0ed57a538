"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all benchmark items go into one automaton. A document's words
are streamed through it; the state tells the longest item passage that ends at each word.
A word is hit if it lies inside an occurrence of a window: ``window`` consecutive words of
an item, or a whole shorter item. ``clean`` removes hit spans of at least ``min_span``
words and whole documents of which more than ``max_coverage`` is hit.

Long stretches that share nothing with any item never enter the automaton: only runs of
words whose every short run occurs in an item can hold a window, and these runs are
found by array lookups. This skips work, not cases.

The benchmark is split by item hash into blocks of about ``block_words`` words; each
block's automaton is built, broadcast and dropped in turn, and the hit spans of all blocks are
merged for each document, so nothing broadcast grows with the benchmark and results do not
depend on the blocks.

Edge cases: NULL and empty texts have no words and no hits; NULL or wordless items have
no windows; items with the same words are each reported; repeated documents are each
scanned; texts of any length are scanned whole; other columns are ignored by ``scan`` and
passed through by ``clean``; empty tables give no hits or no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from replyloom.llm import words as W
from replyloom.llm.common import per_batch, two_columns
from replyloom.session import cut_lineage

WINDOW = 10
BLOCK_WORDS = 400_000
MIN_SPAN = 10
MAX_COVERAGE = 0.5
_RUN = 4
_BITS = 20


class Automaton:
    """Generalised suffix automaton over word hashes of (item id, hashes) pairs."""

    def __init__(self, items: Iterable[tuple[int, list[int]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: items of a window that a state stands for, or of whole short items that end there
        self.marks: list[set] = [set()]
        items = [(i, w) for i, w in items if w]
        for _, word in items:
            last = 0
            for c in word:
                last = self._extend(last, c)
        self._mark(items)
        shortest = min((min(len(w), window) for _, w in items), default=window)
        self.run, self.least = min(shortest, _RUN), shortest
        grams = set()
        for _, word in items:
            for p in range(len(word) - self.run + 1):
                grams.add(tuple(word[p : p + self.run]))
        self.present = np.zeros(1 << _BITS, bool)
        self.grams = np.zeros(0, np.uint64)
        if grams:
            arr = np.array(sorted(grams), np.uint64)
            with np.errstate(over="ignore"):
                code = np.unique(W.mix((arr * W._GRAM[: self.run]).sum(axis=1, dtype=np.uint64)))
            self.grams = code
            self.present[(code >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = self._state(length[last] + 1, {})
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _state(self, length: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(-1)
        self.length.append(length)
        self.marks.append(set())
        return len(self.next) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        new = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[new] = self.link[q]
        self.link[q] = new
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def _mark(self, items) -> None:
        """Walk every item; at each window note the item at the state of exactly that window."""
        k = self.window
        self.window_items: dict[int, set] = {}
        self.short_items: dict[int, tuple[int, set]] = {}
        for ident, word in items:
            state = 0
            for pos, c in enumerate(word):
                state = self.next[state][c]
                if pos + 1 >= k:
                    self.window_items.setdefault(self._of(state, k), set()).add(ident)
            if len(word) < k:
                end = self._of(state, len(word))
                self.short_items.setdefault(end, (len(word), set()))[1].add(ident)
        # a state's nearest suffix state (itself included) that ends a short item
        order = sorted(range(len(self.next)), key=self.length.__getitem__)
        self.near_short = [-1] * len(self.next)
        for s in order:
            above = self.near_short[self.link[s]] if s else -1
            self.near_short[s] = s if s in self.short_items else above

    def _of(self, state: int, n: int) -> int:
        while self.length[self.link[state]] >= n and state:
            state = self.link[state]
        return state

    def stream(self, word: list[int]) -> Iterable[tuple[int, int, set]]:
        """(first, past, items) of every word where a window or short item ends."""
        nxt, link, length, k = self.next, self.link, self.length, self.window
        state = match = 0
        for pos, c in enumerate(word):
            while state and c not in nxt[state]:
                state = link[state]
                match = length[state]
            to = nxt[state].get(c)
            if to is None:
                state = match = 0
                continue
            state, match = to, match + 1
            if match >= k:
                at = state
                while length[link[at]] >= k:
                    at = link[at]
                yield pos + 1 - match, pos + 1, self.window_items.get(at, set())
            at = self.near_short[state]
            if at >= 0 and self.short_items[at][0] > match:
                at = self._short_within(at, match)
            while at > 0:
                n, ids = self.short_items[at]
                yield pos + 1 - n, pos + 1, ids
                at = self.near_short[link[at]]

    def _short_within(self, at: int, match: int) -> int:
        while at > 0 and self.short_items[at][0] > match:
            at = self.near_short[self.link[at]]
        return at

    def live_runs(self, w: W.Words) -> list[tuple[int, int]]:
        """Ranges of words that may hold a window."""
        g, at = W.grams(w, self.run)
        if not len(g) or not len(self.grams):
            return []
        ok = np.flatnonzero(self.present[(g >> np.uint64(64 - _BITS)).astype(np.int64)])
        where = np.minimum(np.searchsorted(self.grams, g[ok]), len(self.grams) - 1)
        at = at[ok[self.grams[where] == g[ok]]]
        if not len(at):
            return []
        cut = np.flatnonzero((np.diff(at) != 1) | (w.doc[at[1:]] != w.doc[at[:-1]]))
        first, last = at[np.concatenate(([0], cut + 1))], at[np.concatenate((cut, [len(at) - 1]))]
        keep = last - first + self.run >= self.least
        return list(zip(first[keep].tolist(), (last[keep] + self.run).tolist(), strict=True))


def hits(auto: Automaton, texts: pa.Array):
    """The words, a flag for each hit word, and the items met by each text."""
    w = W.words(texts, W.PLAIN)
    hit = np.zeros(len(w.hash) + 1, np.int64)
    items: dict[int, set] = {}
    for first, past in auto.live_runs(w):
        found = items.setdefault(int(w.doc[first]), set())
        for a, b, ids in auto.stream(w.hash[first:past].tolist()):
            hit[first + a] += 1
            hit[first + b] -= 1
            found |= ids
    return w, np.cumsum(hit)[:-1] > 0, items


def item_words(text: str | None) -> list[int]:
    return W.words(pa.array([text], pa.string()), W.PLAIN).hash.tolist()


def automata(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> Iterator[tuple[int, Automaton]]:
    """(blocks, automaton) for each block of items; one is made at a time, when it is asked for."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // (6 * block_words)))
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield blocks, Automaton([(r.item_id, item_words(r.text)) for r in rows], window)


_SCANNED = "doc_id bigint, n_words bigint, n_hit bigint, items array<bigint>, spans array<struct<first:bigint,past:bigint>>"


def _spans(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _written_block(docs: DataFrame, auto: Automaton) -> DataFrame:
    """One block's scan, written; its broadcast is dropped then."""
    shared = docs.sparkSession.sparkContext.broadcast(auto)
    part = cut_lineage(_scan_block(docs, auto, shared), "block")
    shared.destroy()
    return part


def _scan_block(docs: DataFrame, auto: Automaton, shared: Broadcast | None = None) -> DataFrame:
    shared = shared or docs.sparkSession.sparkContext.broadcast(auto)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w, flags, items = hits(shared.value, batch.column("text"))
        at = w.bounds()
        spans = [[] if d not in items else [{"first": a, "past": b} for a, b in _spans(flags[at[d] : at[d + 1]])] for d in range(batch.num_rows)]
        kind = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))
        cols = [
            batch.column("doc_id"), pa.array(w.counts().astype(np.int64)), pa.array(np.bincount(w.doc[flags], minlength=batch.num_rows).astype(np.int64)),
            pa.array([sorted(items.get(d, ()), key=lambda i: (i is None, i)) for d in range(batch.num_rows)], pa.list_(pa.int64())), pa.array(spans, kind),
        ]
        return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "n_hit", "items", "spans"])

    return two_columns(docs).mapInArrow(per_batch(run), _SCANNED)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, items (ids with an occurring window), spans (hit word ranges).
    With several blocks, spans of the blocks are merged for each document."""
    parts = numbered = None
    for blocks, auto in automata(benchmark, window, block_words):
        if blocks == 1:
            return _scan_block(docs, auto)
        if numbered is None:
            # rows get a number that is written down, so that repeated rows stay apart
            numbered = cut_lineage(two_columns(docs).withColumn("row", F.monotonically_increasing_id()), "scan")
        part = _written_block(numbered.select(F.col("row").alias("doc_id"), "text"), auto)
        parts = part if parts is None else parts.unionByName(part)
    marks = parts.groupBy(F.col("doc_id").alias("row")).agg(F.max("n_words").alias("n_words"), F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("spans")).alias("spans"))
    words_hit = F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["past"] - 1)))
    hit = F.array_sort(F.array_distinct(words_hit))
    starts = F.filter(hit, lambda p: ~F.array_contains(hit, p - 1))
    ends = F.filter(hit, lambda p: ~F.array_contains(hit, p + 1))
    return numbered.select("row", "doc_id").join(marks, "row").select(
        "doc_id", "n_words", F.size(hit).cast("bigint").alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items"),
        F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"), (b + 1).alias("past"))).alias("spans"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, min_span: int = MIN_SPAN, max_coverage: float = MAX_COVERAGE, text_col: str = "text", size_col: str = "n_chars", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents without their contaminated spans: all columns as they are, but for the
    cut text and its length in ``size_col``. A span is cut from its first word to its last; shorter
hit spans (whole short items) stay. Spans of all blocks are merged before coverage is
    judged and anything is cut."""
    parts = numbered = None
    names = docs.columns
    for blocks, auto in automata(benchmark, window, block_words):
        if blocks == 1:
            return _clean_block(docs, auto, min_span, max_coverage, text_col, size_col)
        if numbered is None:
            # the whole row travels in one struct, so no column of the input can clash
            numbered = cut_lineage(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*[docs[f"`{c}`"] for c in names]).alias("whole")), "clean")
        part = _written_block(numbered.select(F.col("row").alias("doc_id"), F.col("whole").getField(text_col).alias("text")), auto)
        part = part.filter(F.size("spans") > 0).select(F.col("doc_id").alias("row"), "spans")
        parts = part if parts is None else parts.unionByName(part)
    marks = parts.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = pa.RecordBatch.from_arrays(batch.column("whole").flatten(), names=names)
        w = W.words(rows.column(text_col), W.PLAIN)
        at, hit, touched = w.bounds(), np.zeros(len(w.hash) + 1, np.int64), []
        for d, spans in enumerate(batch.column("spans").to_pylist()):
            for s in spans or ():
                hit[at[d] + s["first"]] += 1
                hit[at[d] + s["past"]] -= 1
            if spans:
                touched.append(d)
        return _cut(rows, w, np.cumsum(hit)[:-1] > 0, touched, min_span, max_coverage, text_col, size_col)

    whole = numbered.join(marks, "row", "left").select("whole", "spans", F.col("whole").getField(text_col).alias("text"))
    return whole.mapInArrow(per_batch(run), docs.schema)


def _clean_block(docs: DataFrame, auto: Automaton, min_span: int, max_coverage: float, text_col: str, size_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(auto)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w, flags, items = hits(shared.value, batch.column(text_col))
        return _cut(batch, w, flags, items, min_span, max_coverage, text_col, size_col)

    return docs.mapInArrow(per_batch(run, col=text_col), docs.schema)


def _cut(batch: pa.RecordBatch, w: W.Words, flags: np.ndarray, rows: Iterable[int], min_span: int, max_coverage: float, text_col: str, size_col: str) -> pa.RecordBatch:
    """``batch`` without the flagged spans of ``rows``, and without those that are mostly flagged."""
    names, texts, at = batch.schema.names, batch.column(text_col), w.bounds()
    touched = [d for d in rows if flags[at[d] : at[d + 1]].any()]
    if not touched:
        return batch
    keep, changed = np.ones(batch.num_rows, bool), {}
    raw, base = W.text_bytes(texts)
    for d in touched:
        mine = flags[at[d] : at[d + 1]]
        if mine.sum() > max_coverage * len(mine):
            keep[d] = False
            continue
        out, pos = [], int(base[d])
        for a, b in _spans(mine):
            if b - a >= min_span:
                out.append(raw[pos : w.start[at[d] + a]].tobytes())
                pos = int(w.end[at[d] + b - 1])
        changed[d] = (b"".join(out) + raw[pos : base[d + 1]].tobytes()).decode()
    cols = list(batch.columns)
    new = [changed.get(i, t) for i, t in enumerate(texts.to_pylist())]
    cols[names.index(text_col)] = pa.array(new, texts.type)
    if size_col in names:
        k = names.index(size_col)
        cols[k] = pa.array([len(changed[i]) if i in changed else s for i, s in enumerate(cols[k].to_pylist())], cols[k].type)
    return pa.RecordBatch.from_arrays(cols, schema=batch.schema).filter(pa.array(keep))
