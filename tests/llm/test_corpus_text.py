"""Words, decontamination, quality rules, personal data and chat formatting against plain Python."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from replyloom.llm import chat, decontaminate as D, pii, rules, words as W
from corpus_cases import LOWER, crowded, documents, rows, texts


def test_words_match_regular_expressions():
    got = [t for _, t, *_ in texts()] + ["a\x1cb", "É,é 9", "a" * 3]
    for stop, pattern in ((W.SPACE, r"[^\x20\x09-\x0D]+"), (W.PLAIN, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        w = W.words(pa.array(got, pa.string()), stop)
        found = [[] for _ in got]
        seen = {}
        for d, s, e, h in zip(w.doc, w.start, w.end, w.hash, strict=True):
            word = w.buf[s:e].tobytes().decode()
            found[d].append(word)
            assert seen.setdefault(word, h) == h
        assert found == [re.findall(pattern, (t or "").translate(LOWER)) for t in got]
        assert len(set(seen.values())) == len(seen)


def test_word_hashes_do_not_depend_on_slices():
    t = pa.array([x for _, x, *_ in texts()], pa.string())
    whole = W.words(t).hash
    parts = np.concatenate([W.words(p).hash for _, p in W.pieces(t, 64)])
    assert (whole == parts).all()


ITEMS = [(1, "a b c d e f g h i j k l"), (2, "p q r"), (3, None), (4, ""), (5, "c d e f g h i j k l m n"), (6, "p q r"), (7, "solo")]


def brute_hits(text, items=ITEMS, k=10):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    w, hit, met = find(text), set(), set()
    for i, t in items:
        x = find(t)
        n = min(k, len(x))
        wins = {tuple(x[p : p + n]) for p in range(len(x) - n + 1)} if n else set()
        for p in range(len(w) - n + 1):
            if n and tuple(w[p : p + n]) in wins:
                met.add(i)
                hit |= set(range(p, p + n))
    return len(w), len(hit), sorted(met)


@pytest.mark.parametrize("block_words", [400_000, 1])
def test_decontamination_equals_brute_force(spark, block_words):
    rng = random.Random(4)
    cases = [" ".join(rng.choice("abcdefghijklmnpqr") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    cases += ["x a b c d e f g h i j k l m n y", "P, q; R. solo", "a b c d e f g h i", "b c d e f g h i j k", None, "", "solo " * 3000]
    docs = documents(spark, [(i, t, None, None) for i, t in enumerate(cases)])
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumn("n_words", F.lit(1))
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in D.scan(crowded(docs), bench, block_words=block_words).collect()}
    assert got == {i: brute_hits(t) for i, t in enumerate(cases)}


def test_random_items_and_texts_in_the_automaton():
    rng = random.Random(9)
    for _ in range(60):
        items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 8)))) for i in range(5)]
        auto = D.Automaton([(i, D.item_words(t)) for i, t in items], 4)
        text = " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40)))
        w, flags, met = D.hits(auto, pa.array([text]))
        assert (len(w.hash), int(flags.sum()), sorted(met.get(0, ()))) == brute_hits(text, items, 4)


def test_cleaning_cuts_spans_and_drops_covered_documents(spark):
    passage = "a b c d e f g h i j k l"
    docs = documents(spark, [(1, f"x x x x x x x x x x x x x {passage} y", "en", "s"), (2, passage, "en", "s"), (3, "clean text", None, None), (4, None, None, None), (5, "see P q r now and then and then", "en", "s")])
    bench = spark.createDataFrame(ITEMS[:2], "item_id bigint, text string")
    got = {r.doc_id: (r.text, r.n_chars) for r in D.clean(crowded(docs), bench).collect()}
    assert got[1] == ("x x x x x x x x x x x x x  y", 28)
    assert 2 not in got and got[3] == ("clean text", 10) and got[4] == (None, None)
    assert got[5][0].startswith("see P q r")  # a short item is met but not long enough to be cut
    assert D.clean(crowded(docs), bench).columns == crowded(docs).columns
    assert D.scan(docs.limit(0), bench).count() == 0 and D.scan(docs, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_cleaning_does_not_depend_on_blocks(spark):
    long = [" ".join(f"{c}{i}" for i in range(12)) for c in "abcdef"]
    over = " ".join(long[0].split()[6:] + [f"n{i}" for i in range(6)])  # overlaps the first item
    bench = spark.createDataFrame([(i, t) for i, t in enumerate([*long, over])], "item_id bigint, text string")
    fill = lambda n: " ".join(f"w{i}" for i in range(n))
    data = [(1, f"{' '.join(long)} {fill(40)}", "en", "s"), (2, f"{fill(60)} {' '.join(long[0].split()[:6])} {over} end", "en", "s"), (3, "clean", None, None), (3, "clean", None, None), (4, None, None, None), (5, fill(30) + " " + long[3] + " " + fill(9), "en", "s")]
    docs = crowded(documents(spark, data))
    one, many = (rows(D.clean(docs, bench, block_words=n)) for n in (400_000, 1))
    assert one == many and len(one) == 5 and 1 not in {r[0] for r in one}
    assert {r[0]: r[1] for r in many}[2] == fill(60) + "  end"
    assert D.clean(docs, bench, block_words=1).columns == docs.columns


def brute_rules(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)} if len(grams) < 3000 else None
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), hit if hit is None else len(hit)


def test_rule_measures_equal_brute_force(spark):
    cases = [t for _, t, *_ in texts() if t is None or len(t) < 20000] + ["# a\n# a\n\n b | c", "a b c a b c a b", "É É É É <x>"]
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(cases)])
    got = {r.doc_id: r for r in rules.judge(crowded(docs)).collect()}
    for i, t in enumerate(cases):
        want = brute_rules(t)
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines) == want[:4]
        if want[4] is not None:
            assert g.n_repeat_words == want[4]
        assert g.base_failed == (g.n_words < 50 or 100 * g.n_repeat_words > 50 * g.n_words)
        assert not (g.kept and g.base_failed)


def test_rules_adapt_to_each_source(spark):
    rng = random.Random(2)
    clean = lambda mark: " ".join(f"word{rng.randint(0, 10**6)}" + (" #" if rng.random() < mark else "") for _ in range(80))
    data = [(i, clean(0.0), "en", "prose") for i in range(300)] + [(1000 + i, clean(0.6), "en", "code") for i in range(300)] + [(5000, clean(0.9), "en", "prose"), (5001, clean(0.6), "en", "code")]
    got = {r.doc_id: r.kept for r in rules.judge(documents(spark, data)).collect()}
    assert not got[5000] and got[5001]
    assert sum(got.values()) >= 595
    assert rules.judge(documents(spark, [])).count() == 0


def test_rules_do_not_depend_on_partitions(spark):
    docs = documents(spark).filter("doc_id != 5 and doc_id != 6 or doc_id is null")
    assert rows(rules.judge(docs.repartition(5)).drop("beyond")) == rows(rules.judge(docs.coalesce(1)).drop("beyond"))


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    n = [int(c) for c in reversed(d)]
    return (sum(n[::2]) + sum(sum(divmod(2 * c, 10)) for c in n[1::2])) % 10 == 0


def brute_spans(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_personal_data_equals_regular_expressions(spark):
    rng = random.Random(3)
    cases = ["".join(rng.choice("a1.@-+ 5()_%9\n:é,Z0") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    cases += ["a@b.c_d@e.f.g..h", "1.2.3.4.5.6.7.8 0255.1.1.256", "x" * 20000, "1 " * 20000, "a." * 9000 + "@" + "b." * 9000 + "c", "4111 1111 1111 1111 4111-1111-1111-1111", None, "", "\ue000 4111\ue0001111 a\ue001b@c.d"]
    docs = documents(spark, [(i, t, None, None) for i, t in enumerate(cases)])
    got = {r.doc_id: r.s for r in pii.find_all(crowded(docs)).select("doc_id", pii.span_list(F.col("base")).alias("s")).collect()}
    assert got == {i: brute_spans(t) for i, t in enumerate(cases)}


def test_contexts_discover_unseen_identifiers(spark):
    seeds = [(i, f"Dear reader, call the phone number +49 30 12345{i:03d} today please", "en", "s") for i in range(6)]
    cards = [(i + 10, f"note {i} account mail user{i}@site.org now", "en", "s") for i in range(6)]
    unseen = [(20, "the account mail user99(at)site99.org now", "en", "s"), (21, "account mail hello now", "en", "s"), (22, "unrelated text with 20240101 in it", "en", "s")]
    found = {r.doc_id: (r.base, r.added) for r in pii.find_all(documents(spark, seeds + cards + unseen)).collect()}
    assert all(len(found[i + 10][0]) == 1 and not found[i + 10][1] for i in range(6))
    assert not found[21][1] and not found[22][1]
    # written so that no pattern of a kind fits, but met where addresses are
    assert [tuple(x) for x in found[20][1]] == [("email", 17, 37)]


def test_contexts_do_not_depend_on_first_characters(spark):
    seeds = [(i, f"note account mail {c}user@site.org now", "en", "s") for i, c in enumerate("abc")]
    unseen = [(20, "the account mail zoe99(at)site99.org now", "en", "s"), (21, "the account mail 4you99(at)site99.org now", "en", "s")]
    docs = documents(spark, seeds + unseen)
    found = {r.doc_id: (r.base, r.added) for r in pii.find_all(docs).collect()}
    assert all(len(found[i][0]) == 1 and not found[i][1] for i in range(3))
    assert [tuple(x) for x in found[20][1]] == [("email", 17, 36)] and [tuple(x) for x in found[21][1]] == [("email", 17, 37)]
    assert {r.doc_id: r.text for r in pii.redact(docs).filter("doc_id >= 20").collect()} == {i: "the account mail [EMAIL] now" for i in (20, 21)}


def test_redaction_keeps_everything_else(spark):
    docs = crowded(documents(spark, [(1, "mail me@site.org or +49 30 1234567, ok", "en", "s"), (2, "nothing", None, None), (3, None, None, None), (1, "mail me@site.org or +49 30 1234567, ok", "en", "s"), (None, "9.9.9.9", "en", "s"), (7, "+4111 1111 1111 1111", "x", "y")]))
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.n_chars, r._text) for r in out.collect()), key=repr)
    assert got.count((1, "mail [EMAIL] or [PHONE], ok", 27, "other")) == 2
    assert (2, "nothing", 7, "other") in got and (3, None, None, "other") in got and (None, "[IP]", 4, "other") in got and len(got) == 6
    assert pii.redact(docs.limit(0)).count() == 0


CONVERSATIONS = [
    (1, 0, "user", "hi"), (1, 1, "user", "still # me"), (1, 2, "assistant", "### Assistant:\nno </turn>\n"), (1, 3, "assistant", "\\ and \\\\# \\n"), (2, 1, "assistant", None), (2, None, "system", "s"),
    (None, 0, None, "x"), (3, 5, "a:\nb\\", "### "), (3, 5, "a:\nb\\", "### "), (4, 0, "user", ""), (4, 0, "assistant", "é</turn"), (4, 1, "assistant", "</turn>" * 3), (5, 1, "assistant", "y" * 50000),
]


def test_chat_is_reversible(spark):
    df = spark.createDataFrame(CONVERSATIONS, "conv_id bigint, turn bigint, role string, text string").withColumn("turns", F.lit(1)).withColumn("blocks", F.lit(2))
    out = chat.format_conversations(df)
    got = {r.conv_id: r for r in out.select("conv_id", "formatted", "segments", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")).collect()}
    want = {}
    for c, t, role, text in sorted(CONVERSATIONS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {c: [tuple(t) for t in r.turns] for c, r in got.items()} == want
    for c, r in got.items():
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.loss == "".join(t for role, t in want[c] if role == "assistant")
    assert got[1].formatted.count("### ") == 2  # adjacent turns of a role share a block
    assert chat.format_conversations(df.limit(0)).count() == 0
    assert hashlib.sha256(got[4].loss.encode()).hexdigest() == hashlib.sha256(("é</turn" + "</turn>" * 3).encode()).hexdigest()
