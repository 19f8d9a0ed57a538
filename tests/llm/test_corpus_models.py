"""Similarity join, language model, classifiers, packing, archives and the pipeline on small inputs."""

import base64
import collections
import gzip
import hashlib
import itertools
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpus_cases import LOWER, crowded, documents, rows, texts, words
from replyloom.llm import classlm, jaccard, packing, quality, toxicity, warc
from replyloom.llm.components import components

SPACE_WORD = r"[^\x20\x09-\x0D]+"


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute_groups(data, k, percent):
    """(shingles, least id reachable) of each row by comparing all pairs of sets."""
    sets = []
    for i, t in data:
        w = re.findall(SPACE_WORD, (t or "").translate(LOWER))
        sets.append(frozenset(tuple(w[p : p + k]) for p in range(max(1, len(w) - k + 1))) if w else frozenset())
    parent = list(range(len(data)))
    for a in range(len(data)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                parent[find(parent, a)] = find(parent, b)
    least = collections.defaultdict(list)
    for i in range(len(data)):
        if data[i][0] is not None:
            least[find(parent, i)].append(data[i][0])
    return sorted(((d[0], len(s), min(least.get(find(parent, i), []), default=d[0])) for i, (d, s) in enumerate(zip(data, sets, strict=True))), key=repr)


def test_classes_let_through_by_chance_come_once(spark, monkeypatch):
    """A key table that lets every row through: copies must not multiply pairs."""
    base, near = words(60, 3), words(60, 3).replace(words(60, 3).split()[50], "other")
    data = [(i, base) for i in range(30)] + [(100 + i, near) for i in range(30)]
    seen = []
    verify = jaccard._verify
    monkeypatch.setattr(jaccard, "_key_bits", lambda keys, bits=24: np.full(1 << (bits - 5), 0xFFFFFFFF, np.uint32))
    monkeypatch.setattr(jaccard, "_verify", lambda *a: seen.append(verify(*a)) or seen[-1])
    got = jaccard.link(documents(spark, [(*d, "en", "s") for d in data]), 4, 80)
    assert rows(got) == brute_groups(data, 4, 80) and {r.component_id for r in got.collect()} == {0}
    assert max(e.count() for e in seen) == 1


def test_unlike_texts_under_one_id_both_stay(spark):
    data = [(1, words(30, 1)), (1, words(30, 2)), (1, words(30, 1)), (2, words(30, 2)), (3, ""), (3, ""), (3, None), (4, words(30, 9)), (None, words(30, 9)), (None, words(30, 9))]
    got = jaccard.one_of_each(crowded(documents(spark, [(*d, "en", "s") for d in data])))
    want = [(1, words(30, 1)), (1, words(30, 2)), (3, ""), (3, None), (4, words(30, 9)), (None, words(30, 9)), (None, words(30, 9))]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert got.columns == crowded(documents(spark, [])).columns


def test_parity_bits_bound_the_difference(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    sets = [base[:0], base[:1], base[:40], base[2:40], base[:300], base[10:310], base[:3000], base[900:4000], base]
    n = np.array([len(x) for x in sets])
    whole, folds = jaccard._parity(np.repeat(np.arange(len(sets)), n), np.concatenate(sets), n)
    # numpy counts the bits of a signed number's absolute value, Spark those of its two's complement
    folds = np.array([f.to_numpy().view(np.uint64) for f in folds]).T
    assert spark.sql("select bit_count(-1L)").first()[0] == 64
    bits = [np.frombuffer(x, np.uint8) for x in whole.to_pylist()]
    pairs = list(itertools.combinations_with_replacement(range(len(sets)), 2))
    for i, j in pairs:
        short = min(len(bits[i]), len(bits[j]))
        one, two = (np.bitwise_xor.reduce(bits[x].reshape(-1, short), axis=0) for x in (i, j))
        differ = len(np.setxor1d(sets[i], sets[j]))
        fine, coarse = int(np.bitwise_count(one ^ two).sum()), int(np.bitwise_count(folds[i] ^ folds[j]).sum())
        assert coarse <= fine <= differ and (differ - fine) % 2 == 0
    # the operator keeps every pair that reaches the similarity, and equal sets always
    classes = spark.createDataFrame([(i, int(n[i]), bytearray(whole[i].as_py())) for i in range(len(sets))], "rep bigint, n bigint, parity binary")
    kept = {tuple(r) for r in jaccard._alike(spark.createDataFrame(pairs, "a bigint, b bigint"), classes, 80).collect()}
    near = {(i, j) for i, j in pairs if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    assert near <= kept and (6, 7) not in kept and (1, 2) not in kept


@pytest.mark.parametrize("bits", [3, 14])
def test_jaccard_groups_equal_brute_force(spark, bits):
    rng = random.Random(5)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(rng.randint(20, 60))] for _ in range(12)]
    passage = [f"p{i}" for i in range(15)]
    data = []
    for n in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 6])):
            w[rng.randrange(len(w))] = f"z{rng.randint(0, 10**6)}"
        if rng.random() < 0.3:
            w = passage + w
        data.append((n, " ".join(w)))
    data += [(1000 + i, t) for i, (_, t, *_) in enumerate(texts()) if t is None or len(t) < 5000] + [(None, data[3][1]), (3, data[3][1]), (2000, "one"), (2001, "ONE")]
    docs = crowded(documents(spark, [(i, t, None, None) for i, t in data]))
    got = rows(jaccard.link(docs, 4, 85, sketch_bits=bits))
    assert got == brute_groups(data, 4, 85)


def test_one_of_each_group_stays(spark):
    docs = crowded(documents(spark))
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    assert sorted(x for x in kept if x is not None) == [1, 2, 3, 4, 5, 7, 12, 14, 15, 16, 17]
    assert kept.count(None) == 2  # rows without an id stay
    assert jaccard.link(docs.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(40)}, 200: 200, 201: 200}


def test_language_model_base_and_gain(spark):
    rng = random.Random(1)
    grammar = [["red", "blue", "green"], ["cat", "dog", "bird"], ["runs", "sleeps", "eats"]]
    data = [(i, " ".join(rng.choice(grammar[j % 3]) for j in range(60))) for i in range(80)] + [(500, None), (501, ""), (502, "RED cat"), (502, "RED cat"), (None, "blue dog unseen-words")]
    docs = crowded(documents(spark, [(i, t, None, None) for i, t in data]))
    got = classlm.score(docs).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = collections.Counter()
    for i, t in data:
        if not held(i):
            count.update(re.findall(SPACE_WORD, (t or "").translate(LOWER)) + ["\n"])
    n, v = sum(count.values()), len(count)
    want = []
    for i, t in data:
        w = re.findall(SPACE_WORD, (t or "").translate(LOWER)) + ["\n"]
        want.append((i, held(i), len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6)))
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == sorted(want, key=repr)
    unseen = [r for r in got if r.held_out and r.n_tokens > 3]
    assert unseen and sum(r.score for r in unseen) > 1.15 * sum(r.base_score for r in unseen)  # log probabilities are negative
    assert classlm.score(docs.limit(0)).count() == 0


def test_exchange_separates_alternating_units():
    n = classlm.UNITS
    b = np.zeros((n, n))
    for i in range(10):
        for j in range(10, 20):
            b[i, j] = b[j, i] = 5 + (i + j) % 3
    cls = classlm.exchange(b, classes=3)
    assert len({*cls[:10]}) == 1 and len({*cls[10:20]}) == 1 and cls[0] != cls[10]


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.default_tokenizer())
    data = [(i, t) for i, t, *_ in texts()] + [(50, "a  b \n c"), (51, " lead"), (52, "trail "), (53, "<|endoftext|> x"), (54, "zero\0 byte"), (55, "'s it's\n\n"), (56, "日本 語 é" * 50)]
    docs = crowded(documents(spark, [(i, t, None, None) for i, t in data]))
    got = packing.pack(docs).collect()
    whole = collections.defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) // 4 and r.length & (r.length - 1) == 0 and r.length <= packing.MAX_LEN and r.offset == 0
        whole[r.doc_id].append(r)
    assert len({r.sequence_id for r in got}) == len(got)
    for i, t in data:
        if sum(x == i for x, _ in data) > 1 or i is None:
            continue
        want = tok.encode(t or "", add_special_tokens=False).ids + [0]
        pieces = sorted(whole[i], key=lambda r: r.start)
        assert np.frombuffer(b"".join(bytes(r.ids) for r in pieces), "<u4").tolist() == want
        assert [r.length for r in pieces] == packing.decompose(len(want)) and {r.doc_tokens for r in pieces} == {len(want)}
    assert packing.pack(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, max_len=1000)


def test_packed_buckets_hold_one_length(spark, tmp_path):
    packing.write_buckets(packing.pack(documents(spark, [(1, words(700), None, None)])), str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.filter(F.octet_length("ids") != 4 * F.col("length")).count() == 0
    assert sorted(os.path.basename(x) for x in os.listdir(tmp_path / "p") if x.startswith("length=")) == sorted({f"length={r.length}" for r in back.select("length").collect()})


PAGES = [(1, "http://a/\r\nx", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "u", None), (4, "u", ""), (5, "u", "é" * 5000), (6, "u", "\r\n\r\nWARC/1.1\r\n\x1f\x8b"), (None, "u", "<p>one</p>"), (1, "again", "<p>one</p>"), (8, "u", "y" * (1 << 17))]


def test_archives_round_trip(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("size", F.lit(1)).withColumn("sha", F.lit(2)).withColumn("digest", F.lit(3))
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    warc.write_archives(df, raw)
    streams = [gzip.open(os.path.join(raw, f)).read() for f in os.listdir(raw) if f.endswith(".gz")]
    assert sum(s.count(b"WARC-Record-ID") for s in streams) == len(PAGES)
    warc.normalise(spark, raw, out)
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    first = {}
    for i, _, h in sorted(PAGES, key=lambda p: (p[0] is None, p[0] or 0)):
        first.setdefault(h or "", i)
    want = []
    for i, _, h in PAGES:
        f = first[h or ""]
        response = f == i
        want.append((i, len((h or "").encode()), digest(h), "response" if response else "revisit", None if response else f, (h or "").encode() if response else None))
    got = [tuple(None if v is None else bytes(v) if isinstance(v, bytearray) else v for v in r) for r in warc.read_back(spark, out).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    # one record alone, by its place in the index: the bytes there are a gzip member by themselves
    some = warc.fetch(spark, out, spark.createDataFrame([(5,)], "page_id bigint")).collect()
    assert [(r.page_id, bytes(r.payload).decode()) for r in some] == [(5, "é" * 5000)]
    place = spark.read.parquet(f"{out}/index").filter("record_id = '5'").first()
    folder = f"{out}/archive/file={place.file}"
    data = b"".join(open(os.path.join(folder, f), "rb").read() for f in os.listdir(folder) if f.startswith("part"))
    assert gzip.decompress(data[place.offset : place.offset + place.length]).startswith(b"WARC/1.1")
    assert warc.archive(df.limit(0)).count() == 0


def test_stream_parsing_in_small_steps():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 4\r\n\r\nab\r\n\r\n\r\n"
    both = gzip.compress(record * 3) + gzip.compress(record)
    assert [p for _, p, _ in warc.parse_stream(both, step=3)] == [b"ab\r\n"] * 4
    with pytest.raises(ValueError):
        list(warc.parse_stream(gzip.compress(record[:-9])))
    parts = warc.member(record) + warc.member(b"x" * 10)
    assert [d for _, _, d in warc.members(parts)] == [record, b"x" * 10] and parts[-1] == 0


def labelled(spark, n=400):
    rng = random.Random(8)
    plain = [f"{a}{b}" for a in "bcdfgklm" for b in ("ana", "elo", "iru", "omi")]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(plain) + rng.choice(plain) for _ in range(rng.randint(40, 120))]
        toxic, good = int(i % 4 == 0), int(i % 3 != 0)
        if toxic:
            for _ in range(4):
                w[rng.randrange(len(w))] = rng.choice(["hatefulword", "vilestinsult", "nastyslur"])
        if not good:
            w = [x.upper() + "!!" for x in w]
        docs.append((i, " ".join(w), "en", "s"))
        labels.append((i, good, toxic))
    return documents(spark, docs), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").withColumn("text", F.lit("clash"))


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_toxicity_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = toxicity.train(crowded(docs), labels)
    got = {r.doc_id: r.score for r in toxicity.score(crowded(docs), model).collect()}
    right = [(got[i] >= 0.5) == (i % 4 == 0) for i in range(400) if held(i)]
    assert sum(right) >= 0.95 * len(right)
    odd = [r.score for r in toxicity.score(documents(spark), model).collect()]
    assert len(odd) == len(texts()) and all(0 <= s <= 1 for s in odd)
    assert toxicity.train(docs, labels.filter("toxic = 0")) is None and toxicity.train(docs.limit(0), labels) is None
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_scores_do_not_depend_on_the_sample_bound(spark):
    rng = random.Random(11)
    plain = [f"{a}{b}" for a in "bcdfgklm" for b in ("ana", "elo", "iru", "omi")]
    data, labels = [], []
    for i in range(900):
        w = [rng.choice(plain) + rng.choice(plain) for _ in range(rng.randint(30, 60))]
        toxic = int(i % 9 == 0)
        if i % 18 == 0:  # the other toxic texts read like ordinary ones
            w[5:5] = ["hatefulword", "vilestinsult", "nastyslur"]
        data.append((i, " ".join(w), "en", "s"))
        labels.append((i, toxic))
    docs, marks = documents(spark, data), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = [[r.score for r in toxicity.score(docs.filter("doc_id % 9 != 0"), toxicity.train(docs, marks, rows=n)).collect()] for n in (4000, 50)]
    # both classes are cut to 50: unweighted, an ordinary text would score about a third
    assert abs(np.mean(found[0]) - np.mean(found[1])) < 0.05 and np.mean(found[1]) < 0.15


def test_toxicity_dictionaries_hold_bodies_of_both_classes(spark):
    docs, labels = labelled(spark)
    opened = docs.withColumn("text", F.concat(F.lit("this licence opens each text alike "), F.lower("text")))
    model = toxicity.train(opened, labels)
    for data in (model.ordinary, model.toxic):
        assert len(re.findall(rb"[bcdfgklm](?:ana|elo|iru|omi)[bcdfgklm](?:ana|elo|iru|omi)", data)) > 50


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = quality.fit(crowded(docs), quality.graded(labels))
    assert list(model.thresholds) == sorted(model.thresholds)
    got = {r.doc_id: r for r in quality.score(crowded(docs), model).collect()}
    right = [got[i].selected == (i % 3 != 0) for i in range(400) if held(i)]
    assert sum(right) >= 0.95 * len(right)
    assert all(r.p_fair >= r.p_top and abs(r.expected_grade - r.p_fair - r.p_top) < 1e-9 for r in got.values())
    kept = quality.select(crowded(docs), model)
    assert kept.columns == crowded(docs).columns and kept.count() == sum(r.selected for r in got.values())
    assert quality.score(documents(spark), model).count() == len(texts())
    assert quality.fit(docs, quality.graded(labels).limit(0)) is None and quality.select(docs, None).count() == 400
    assert quality.fit(docs, quality.graded(labels.withColumn("quality", F.lit(None).cast("int")))) is None


def test_ordinal_fit_orders_three_grades():
    rng = np.random.default_rng(0)
    z = rng.normal(size=600)
    grades = (z > -0.5).astype(int) + (z > 0.7)
    rows_ = np.repeat(np.arange(600), 2)
    dims = np.tile([0, 1], 600)
    vals = np.stack([np.ones(600), z], axis=1).ravel()
    m = quality.fit_arrays(rows_, dims, vals, grades, 3, steps=300)
    score = m.weights[0] + m.weights[1] * z
    tails = 1 / (1 + np.exp(m.thresholds[None, :] - score[:, None]))
    assert np.mean((tails >= 0.5).sum(axis=1) == grades) > 0.95 and m.thresholds[0] < m.thresholds[1]


def test_pipeline_stage_by_stage(spark, tmp_path):
    docs, labels = labelled(spark, 200)
    copies = docs.filter("doc_id in (4, 5)").withColumn("doc_id", F.col("doc_id") + 1000)
    bench_text = " ".join(f"bench{i}" for i in range(14))
    extra = documents(spark, [
        (2000, words(60, 3) + " " + bench_text + " " + words(30, 4), "en", "s"), (2001, bench_text, "en", "s"), (2002, words(80, 9) + " mail me@site.org now", "en", "s"), (2003, None, None, None),
    ])
    every = docs.unionByName(copies).unionByName(extra)
    every.write.parquet(str(tmp_path / "documents.parquet"))
    labels.drop("text").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, bench_text)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == every.columns
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r.doc_id: r.text for r in now.collect()}
    poor = {i for i in range(200) if i % 3 == 0}
    assert not poor & set(seen["quality"])
    assert 5 in seen["near_duplicates"] and 1005 not in seen["near_duplicates"] and set(seen["near_duplicates"]) <= set(seen["quality"])
    assert "bench5" not in seen["decontamination"][2000] and 2001 not in seen["decontamination"]
    assert "[EMAIL]" in seen["personal_data"][2002] and "me@site.org" not in seen["personal_data"][2002]
    clean = [i for i in seen["quality"] if i not in (2000, 2001, 2002) and i < 1000]
    assert all(seen["personal_data"][i] == seen["quality"][i] for i in clean)
    got = corpus_pipeline.run(spark, str(tmp_path)).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert {r.doc_id for r in got} == set(seen["personal_data"]) and all(r.n == r.t for r in got)
