"""Vectorised words of Arrow string batches.

Texts stay UTF-8 bytes: every separator used here is ASCII, so words can be found
and hashed with array operations over the concatenated bytes, without one Python
object per word. Word hashes are 64-bit polynomial hashes over random byte codes;
equal words have equal hashes, and two different ones collide with a chance of
about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SEGMENT_BYTES = 1 << 18
_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_P = _U(0x9E3779B97F4A7C15 | 1)
_P_INV = _U(pow(int(_P), -1, 1 << 64))
_GRAM = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)


def separators(spec: str) -> np.ndarray:
    """True for bytes that end a word: ``space`` is U+0020 and U+0009-U+000D; ``plain``
    is every ASCII byte but digits and letters; ``line`` is the line feed."""
    table = np.zeros(256, bool)
    if spec == "space":
        table[[0x20, *range(0x09, 0x0E)]] = True
    elif spec == "plain":
        table[:128] = True
        for a, b in (("0", "9"), ("a", "z"), ("A", "Z")):
            table[ord(a) : ord(b) + 1] = False
    else:
        table[0x0A] = True
    return table


SPACE, PLAIN, LINE = separators("space"), separators("plain"), separators("line")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SAME = np.arange(256, dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers: list[np.ndarray] = []


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            up, down = np.full(size, _P, np.uint64), np.full(size, _P_INV, np.uint64)
            up[0] = down[0] = 1
            _powers[:] = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Words of a run of texts. ``doc`` is a word's text, ``start``/``end`` its bytes
    in ``buf``; ``base`` has each text's first byte and one more."""

    buf: np.ndarray
    base: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.base) - 1

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.n_docs)

    def bounds(self) -> np.ndarray:
        """First word of each text, and one more."""
        return np.concatenate(([0], np.cumsum(self.counts())))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array, NULL as empty, and where each text begins."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def pieces(texts: pa.Array, limit: int = SEGMENT_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of about ``limit`` bytes with the row each begins at; a longer text
    comes alone. Working arrays stay a small multiple of that."""
    sizes = np.diff(text_bytes(texts)[1])
    first = 0
    while first < len(sizes):
        cum = np.cumsum(sizes[first : first + 65536])
        n = max(1, int(np.searchsorted(cum, limit, side="right")))
        yield first, texts.slice(first, n)
        first += n


def find(buf: np.ndarray, base: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of the words; no word reaches over a text's end."""
    if len(buf) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~stop[buf]
    change = np.empty(len(buf), bool)
    change[0] = inside[0]
    np.logical_and(inside[1:], ~inside[:-1], out=change[1:])
    cuts = base[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(buf))]
    change[cuts] = inside[cuts]
    last = np.empty(len(buf), bool)
    last[-1] = inside[-1]
    np.logical_and(inside[:-1], ~inside[1:], out=last[:-1])
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(change), np.flatnonzero(last) + 1


def range_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, step: int = 1 << 20) -> np.ndarray:
    """Polynomial hash of each byte range; the ranges ascend and do not overlap."""
    out = np.empty(len(start), np.uint64)
    first = 0
    with np.errstate(over="ignore"):
        while first < len(start):
            lo = int(start[first])
            n = max(1, int(np.searchsorted(end[first:], lo + step, side="right")))
            s, e = start[first : first + n] - lo, end[first : first + n] - lo
            up, down = _pow(int(e[-1]) + 1)
            total = np.zeros(int(e[-1]) + 1, np.uint64)
            np.cumsum(_CODES[buf[lo : lo + int(e[-1])]] * up[: int(e[-1])], out=total[1:])
            out[first : first + n] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
            first += n
    return out


def words(texts: pa.Array, stop: np.ndarray = SPACE, lower: bool = True) -> Words:
    buf, base = text_bytes(texts)
    if lower:
        buf = LOWER[buf]
    start, end = find(buf, base, stop)
    doc = np.searchsorted(base, start, side="right") - 1
    return Words(buf, base, doc, start, end, range_hashes(buf, start, end))


def grams(w: Words, k: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside a text, and the word each begins at.
    ``whole``: a text of fewer words, but not none, is one run of all of them."""
    n = len(w.hash)
    with np.errstate(over="ignore"):
        if n >= k:
            total = np.zeros(n - k + 1, np.uint64)
            for i in range(k):
                total += w.hash[i : n - k + 1 + i] * _GRAM[i]
            at = np.flatnonzero(w.doc[: n - k + 1] == w.doc[k - 1 :])
            total = mix(total[at])
        else:
            total, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if whole:
            counts, first = w.counts(), w.bounds()
            short = np.flatnonzero((counts > 0) & (counts < k))
            if len(short):
                extra = np.array([mix(np.array([(w.hash[first[d] : first[d] + counts[d]] * _GRAM[: counts[d]]).sum() + _U(counts[d])], np.uint64))[0] for d in short], np.uint64)
                total, at = np.concatenate((total, extra)), np.concatenate((at, first[short]))
                order = np.argsort(at, kind="stable")
                total, at = total[order], at[order]
    return total, at


def distinct_in_doc(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, value) pairs in that order with how often each occurs."""
    order = np.lexsort((value, doc))
    d, v = doc[order], value[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    at = np.flatnonzero(new)
    return d[at], v[at], np.diff(np.concatenate((at, [len(d)])))


def chars(buf: np.ndarray) -> np.ndarray:
    """True for bytes that begin a code point."""
    return (buf & 0xC0) != 0x80
