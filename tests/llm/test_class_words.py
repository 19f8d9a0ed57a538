import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from corpus_cases import crowded, documents

from replyloom.llm import classlm
from replyloom.session import _written


def ids(held):
    return [i for i in range(4000) if (zlib.crc32(str(i).encode()) % 7 == 2) == held]


LETTERS = "bcdfghjklm"
FREQUENT = [f"f{a}{b}{c}x" for a in LETTERS for b in LETTERS for c in LETTERS[:5]]
RARE = [f"{a}{b}qz" for a in LETTERS for b in LETTERS]  # all of one shape


def around(i, word):
    return f"{FREQUENT[5 * i]} {word} {FREQUENT[5 * i + 3]}"


def corpus():
    """500 frequent words, and rare ones between two of them each."""
    rng = random.Random(5)
    frequent = FREQUENT * 12
    rng.shuffle(frequent)
    return [" ".join(frequent[i : i + 40]) for i in range(0, len(frequent), 40)] + [around(i, w) for i, w in enumerate(RARE) for _ in range(4)]


def test_rare_words_of_one_shape_have_classes_of_their_own(spark):
    free = ids(True)
    own, other = ([around(i, RARE[(i + by) % 100]) for i in range(100)] for by in (0, 37))
    docs = crowded(documents(spark, [(i, t, None, None) for i, t in [*zip(ids(False), corpus()), *zip(free, own + other)]]))
    score = {r.doc_id: r.score for r in classlm.score(docs).collect()}
    gain = [score[free[i]] - score[free[100 + i]] for i in range(100)]  # equal counts and neighbours: only classes differ
    assert sum(abs(x) > 1e-6 for x in gain) > 10 and sum(gain) > 0


def test_best_move_is_the_one_that_brute_force_finds():
    rng = np.random.default_rng(2)
    words, text = 300, rng.integers(0, 300, 6000) ** 2 // 300
    text[1::7] = text[::7][: len(text[1::7])]  # some words follow themselves
    cls = 1 + np.arange(words) % (classlm.CLASSES - 1)
    ends, k = words, classlm.CLASSES
    before, after = np.append(ends, text), np.append(text, ends)
    of = lambda c: np.append(c, 0)
    grams = lambda c: np.bincount(of(c)[before] * k + of(c)[after], minlength=k * k).reshape(k, k)
    right = np.bincount(before[1:] * k + of(cls)[after[1:]], minlength=words * k).reshape(words, k)
    left = np.bincount(after[:-1] * k + of(cls)[before[:-1]], minlength=words * k).reshape(words, k)
    own = np.bincount(before[before == after], minlength=words)
    new = classlm.best(grams(cls), cls, right, left, own)
    assert (new != cls).sum() > 50
    for w in [*range(6), *np.flatnonzero(own)[-4:], *np.flatnonzero(new != cls)[-10:]]:
        if right[w].any():
            tried = []
            for c in range(1, k):
                moved = cls.copy()
                moved[w] = c
                tried.append(classlm.information(grams(moved)))
            assert tried[new[w] - 1] == pytest.approx(max(tried), abs=1e-6)


def test_top_words_move_as_with_all_bigrams():
    rng = np.random.default_rng(4)
    k, tops = classlm.CLASSES, 20
    units = rng.poisson(0.6, (k + tops, k + tops))
    cls = rng.integers(1, k, tops)
    member = np.eye(k, dtype=np.int64)[np.concatenate((np.arange(k), cls))]
    to, from_ = units[k:] @ member, units[:, k:].T @ member
    got, n = classlm._move_top(member.T @ units @ member, to, from_, units[k:, k:], cls)
    want = classlm.exchange(units, sweeps=1, cls=np.concatenate((np.arange(k), cls)), fixed=k)
    assert (got == want[k:]).all() and (got != cls).any()
    member = np.eye(k, dtype=np.int64)[want]
    assert (n == member.T @ units @ member).all()


def test_small_blocks_change_nothing_and_are_held_few_at_a_time(spark, monkeypatch):
    data = [(i, t, None, None) for i, t in enumerate(corpus()[100:220])] + [(None, "red alone", None, None), (5, "", None, None), (6, None, None, None)]
    docs = crowded(documents(spark, data))
    key = lambda r: (r.doc_id is None, r.doc_id, r.n_tokens, round(r.base_score, 6), round(r.score, 6))
    want = sorted(map(key, classlm.score(docs).collect()), key=repr)
    monkeypatch.setattr(classlm, "BLOCK_BYTES", 300)
    parts = classlm.blocks(docs, 7, 2)
    assert parts.count() > 40
    files = [f.removeprefix("file:").replace("//", "/") for f in parts.inputFiles()]
    assert _written[parts] and max(g for f in files for m in [pq.ParquetFile(f).metadata] for g in (m.row_group(i).num_rows for i in range(m.num_row_groups))) <= 4
    assert sorted(map(key, classlm.score(docs).collect()), key=repr) == want
