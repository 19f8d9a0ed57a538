"""Periodic runs, mixing and whitening against brute force, and their edge cases."""

import itertools
import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_cases import crowded, documents, rows, texts
from replyloom.llm import mixing, runs, whitening
from replyloom.llm.queries import with_periodic_ends

SPACE_WORD = r"[^\x20\x09-\x0D]+"


def brute_runs(s):
    """Maximal repetitions by comparing the sequence with itself at every distance."""
    out, seen = [], set()
    for q in range(1, len(s) // 2 + 1):
        i = 0
        while i < len(s) - q:
            j = i
            while j < len(s) - q and s[j] == s[j + q]:
                j += 1
            if j - i >= q and (i, j) not in seen and (i, j - i + q) not in {(a, b) for a, b, _ in out}:
                seen.add((i, j))
                out.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(out)


def brute_text(text):
    w = re.findall(SPACE_WORD, text or "")
    found = sorted((r for r in brute_runs(w) if r[1] >= max(6, 4 * r[2])), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return len(w), found, " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_all_maximal_repetitions_are_found(letters):
    rng = random.Random(letters)
    for _ in range(150):
        s = [rng.randint(0, letters) for _ in range(rng.randint(1, 50))]
        assert [tuple(int(v) for v in r) for r in runs.maximal_runs(s)] == brute_runs(s)
    for s in itertools.product(range(2), repeat=9):
        assert [tuple(int(v) for v in r) for r in runs.maximal_runs(list(s))] == brute_runs(s)


def test_extensions_agree_with_comparing_word_by_word():
    rng = random.Random(4)
    s = [rng.randint(0, 1) for _ in range(400)] + [2] * 200 + [9]
    tree = runs.SuffixTree(s)
    a, b = np.array([rng.sample(range(len(s)), 2) for _ in range(2000)]).T
    want = [next((k for k in range(len(s)) if max(i, j) + k >= len(s) or s[i + k] != s[j + k])) for i, j in zip(a, b, strict=True)]
    assert tree.common(a, b).tolist() == want
    assert tree.rank.tolist() == np.argsort(sorted(range(len(s)), key=lambda i: s[i:])).tolist()


def repetitive(rng):
    out = []
    for _ in range(rng.randint(0, 6)):
        if rng.random() < 0.5:
            out += [rng.choice("abcdé") * rng.randint(1, 2) for _ in range(rng.randint(0, 40))]
        else:
            p = [rng.choice("abcdef") + str(rng.randint(0, 9)) for _ in range(rng.randint(1, 9))]
            out += [p[i % len(p)] for i in range(rng.randint(1, len(p) * 7))]
    return rng.choice(["", " "]) + "".join(x + rng.choice([" ", "\n", "  ", "\t"]) for x in out)


def test_runs_of_texts_equal_brute_force(spark):
    rng = random.Random(8)
    data = [(i, repetitive(rng), "en", "s") for i in range(150)] + [(None, "a b " * 9, None, None), (3, "a b " * 9, None, None), (3, "a b " * 9, None, None), (7, None, None, None)]
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.detect(crowded(documents(spark, data))).collect()]
    assert sorted(got, key=repr) == sorted([(d[0], *brute_text(d[1])) for d in data], key=repr)


def test_runs_of_odd_and_long_texts(spark):
    got = {(r.doc_id, r.n_words): r for r in runs.detect(documents(spark)).collect()}
    assert got[(3, 0)].runs == [] and got[(4, 0)].collapsed == "" and (2, 0) in got and (None, 0) in got
    assert [tuple(r) for r in got[(16, 5000)].runs] == [(0, 5000, 1)] and got[(16, 5000)].collapsed == "1"
    assert [tuple(r) for r in got[(17, 120)].runs] == [(0, 120, 3)] and got[(17, 120)].collapsed == "same line here"
    assert [tuple(r) for r in got[(5, 30000)].runs] == [(0, 30000, 9973)] if 30000 >= 4 * 9973 else got[(5, 30000)].runs == []
    assert len(got) == len({(d[0], len(re.findall(SPACE_WORD, d[1] or ""))) for d in texts()})
    assert runs.detect(documents(spark, []).limit(0)).collect() == []


def test_a_tenth_of_texts_is_made_periodic(spark):
    import zlib

    docs = [(i, " ".join(f"w{k}" for k in range(i)), None, None) for i in range(60)]
    got = {r.doc_id: r.text for r in with_periodic_ends(documents(spark, docs)).collect()}
    altered = 0
    for i, t, *_ in docs:
        w, h = t.split(), zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[a + (k - a) % p] if k >= a else x for k, x in enumerate(w)]
            altered += 1
        assert got[i] == " ".join(w)
    assert altered


# ---------------------------------------------------------------- mixing


def brute_targets(size, weight, total, epochs):
    """Clamp, share the excess again by weight, until none is above."""
    clamped = set()
    while True:
        free = [s for s in size if s not in clamped]
        left = total - sum(epochs * size[s] for s in clamped)
        over = sum(weight[s] for s in free)
        share = {s: Fraction(left * weight[s], over) if over else Fraction(0) for s in free}
        more = {s for s in free if share[s] > epochs * size[s]}
        if not more:
            return {s: Fraction(epochs * size[s]) if s in clamped else share[s] for s in size}
        clamped |= more


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_step_by_step_sharing(spark, seed):
    rng = random.Random(seed)
    data = [(i, "w " * rng.choice([0, 1, 3, 20, 400]), "en", rng.choice(["a", "b", "c", "d", "e", None])) for i in range(80)]
    data += [(1000 + i, "w " * 50, "en", "hot") for i in range(60)]
    docs = documents(spark, data)
    weight = {s: rng.randint(1, 40) for s in ["a", "b", "c", "d", "e", None, "hot"]}
    table = spark.createDataFrame(list(weight.items()), "source string, weight int")
    got = mixing.plan(crowded(docs), table, max_epochs=2).collect()
    size = {}
    for _, t, _, s in data:
        size[s] = size.get(s, 0) + len(t.split())
    want = brute_targets(size, weight, sum(size.values()), 2)
    taken = {s: 0 for s in size}
    for r in got:
        assert r.source_size == size[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-12)
        assert r.taken == r.whole * r.size + r.extra and 0 <= r.extra <= r.size and r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert len(got) == len(data) and all(taken[s] == int(want[s]) for s in size)
    # at most one document a source is cut
    assert all(sum(r.source == s and 0 < r.extra < r.size for r in got) <= 1 for s in size)
    assert rows(mixing.plan(docs.repartition(7), table, max_epochs=2)) == rows(mixing.plan(crowded(docs), table, max_epochs=2))


def test_mix_of_odd_rows(spark):
    docs = documents(spark)
    weights = spark.createDataFrame([("a", 5), ("b", 0), ("c", None), ("a", 2), ("zz", 9)], "source string, weight int")
    got = mixing.plan(docs, weights, total=10).collect()
    assert len(got) == len(texts())
    assert {r.target for r in got if r.source in ("b", "c", None)} == {0.0}
    assert sum(r.taken for r in got if r.source == "a") == 10 == max(r.target for r in got if r.source == "a")
    # more than all sources can give: each gives its maximum
    most = mixing.plan(docs, weights, total=10**9).collect()
    assert all(r.taken == (3 * r.size if r.source == "a" else 0) for r in most)
    # copies of one row share what falls on them
    same = documents(spark, [(1, "x y z", "en", "s")] * 4 + [(2, "p q", "en", "t")] * 3)
    both = mixing.plan(same, spark.createDataFrame([("s", 1), ("t", 1)], "source string, weight int")).collect()
    assert len({r.taken for r in both if r.source == "s"}) == 1 and abs(sum(r.taken for r in both if r.source == "s") - 9) < 4
    assert mixing.plan(documents(spark, []), weights).collect() == []
    assert {r.taken for r in mixing.plan(docs, weights.limit(0)).collect()} == {0}


def test_mixture_has_the_planned_words(spark):
    docs = crowded(documents(spark, [(i, f"{i}a  {i}b\n{i}c {i}d", "en", "s" if i % 3 else "t") for i in range(30)]))
    weights = spark.createDataFrame([("s", 1), ("t", 3)], "source string, weight int")
    planned = {r.doc_id: r for r in mixing.plan(docs, weights, total=175).collect()}
    copies = {}
    for r in mixing.mixture(docs, weights, total=175).collect():
        assert r.document.text.startswith(r.text) and r.document.row == "other"
        copies.setdefault(r.document.doc_id, []).append(len(r.text.split()))
    assert {i: sum(n) for i, n in copies.items()} == {i: r.taken for i, r in planned.items() if r.taken}
    assert any(r.whole == 3 for r in planned.values()) and any(0 < n[-1] < 4 for n in copies.values())


# ---------------------------------------------------------------- whitening


def brute_whiten(x, k):
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    return c @ u[:, ::-1][:, :k] / np.sqrt(e[::-1][:k]), e[::-1][:k] / np.trace(v), [sum(int(d) ** 2 for d in row) for row in n * x - s]


@pytest.mark.parametrize("block", [(7, 3, 2), (4096, 1024, 16)])
def test_whitening_equals_dense_algebra(spark, block, monkeypatch):
    for name, v in zip(("BLOCK_ROWS", "BLOCK_COLS", "SPLIT_BLOCKS"), block, strict=True):
        monkeypatch.setattr(whitening, name, v)
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(90, 10)) @ rng.normal(size=(10, 10)) * 1000).astype(np.int64) + 100_000
    odd = [(-1, None), (-2, []), (-3, [1, 2, 3])]
    table = spark.createDataFrame([(i % 80, row.tolist()) for i, row in enumerate(x)] + odd, "vec_id bigint, x array<bigint>").repartition(5)
    got = whitening.whiten(crowded(table), components=4).collect()
    white, share, deviation = brute_whiten(x, 4)
    assert len(got) == 90 and {r.n for r in got} == {90} and got[0].identity_error < 1e-9
    assert sorted((r.id, int(r.deviation)) for r in got) == sorted((i % 80, d) for i, d in enumerate(deviation))
    assert np.allclose(got[0].explained, share, rtol=1e-10)
    by_deviation = {d: w for d, w in zip(deviation, white, strict=True)}
    mine, want = np.array([r.whitened for r in got]), np.array([by_deviation[int(r.deviation)] for r in got])
    for c in range(4):
        assert min(abs(mine[:, c] - want[:, c]).max(), abs(mine[:, c] + want[:, c]).max()) < 1e-8


def test_whitening_of_odd_vectors(spark):
    def whiten(data, k=8):
        table = spark.createDataFrame(data, "vec_id bigint, embedding array<float>")
        return whitening.whiten(table.select("vec_id", whitening.grid(F.col("embedding")).alias("x")), components=k)

    nan, inf = float("nan"), float("inf")
    bad = [(1, None), (2, [0.5, None]), (3, [nan, 1.0]), (4, [1.0, inf]), (5, [-inf, 0.0]), (6, [])]
    assert whiten(bad).collect() == [] and whiten([]).collect() == []
    one = whiten([*bad, (None, [0.5, -0.25])]).collect()
    assert [(r.id, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [(None, 1, 0, [None, None], [None, None], None)]
    # the second dimension follows the first: one component has variance
    line = whiten([(7, [float(i), 2.0 * i]) for i in range(5)]).collect()
    assert all(r.whitened[1] is None for r in line) and math.isclose(line[0].explained[0], 1.0) and line[0].identity_error < 1e-9
    assert math.isclose(sum(r.whitened[0] ** 2 for r in line) / 5, 1.0) and len(line) == 5
    on_grid = spark.createDataFrame([([0.1, -0.1],)], "e array<double>").select(whitening.grid(F.col("e"))).first()[0]
    assert on_grid == [100102, 99897]
    with pytest.raises(ValueError, match="dimensions"):
        whitening.fit(None, 1, np.zeros(5000))
