"""Jaccard join, decontamination, fingerprints, licenses against brute force."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from quantloom.llm import decontaminate as D
from quantloom.llm.jaccard_join import keep_one_per_component, ngram_jaccard_join
from quantloom.llm.license_scan import TEMPLATES, scan_licenses
from quantloom.llm.merkle import fingerprint_edits, with_next

SCHEMA = "doc_id long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def shingles(text):
    w = words(text)
    return set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def corpus(seed=0, n=120):
    """Families of edited copies around the threshold, loose documents, and every odd case."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(12):
        base = rng.choices(vocab, k=rng.randint(30, 140))
        for _ in range(7):
            own = list(base)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            docs.append(" ".join(own))
    docs += [" ".join(rng.choices(vocab, k=rng.randint(1, 60))) for _ in range(n - len(docs) - 10)]
    docs += [docs[0], docs[0].upper(), "", None, "  \t\n", "One", "one", "one two three", "x " * 4000, "x " * 4001]
    return list(enumerate(docs))


def brute_components(docs):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("seed", [0, 1])
def test_jaccard_join(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame([(i, t, 1, "n") for i, t in docs], SCHEMA + ", n long, node string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard_join(df).collect()}
    assert got == brute_components(docs)


def test_jaccard_join_of_nothing_and_of_repeated_rows(spark):
    assert ngram_jaccard_join(spark.createDataFrame([], SCHEMA)).count() == 0
    same = spark.createDataFrame([(3, "a b c"), (3, "a b c"), (None, "a b c"), (2, "A B C"), (9, None)], SCHEMA)
    got = sorted(ngram_jaccard_join(same).collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted([(3, 1, 2), (3, 1, 2), (None, 1, 2), (2, 1, 2), (9, 0, 9)], key=str)
    assert sorted(r.doc_id for r in keep_one_per_component(same.where("doc_id is not null")).collect()) == [2, 9]


def test_decontamination(spark):
    rng = random.Random(4)
    vocab = [f"v{i}" for i in range(300)]
    items = [(j, " ".join(rng.choices(vocab, k=k))) for j, k in enumerate([14, 20, 36, 59, 15])] + [(7, ""), (8, None)]
    docs = []
    for i in range(40):
        text = rng.choices(vocab, k=rng.randint(0, 60))
        if i % 2:
            own = items[i % 5][1].split()
            for _ in range(i % 4):
                own[rng.randrange(len(own))] = "other"
            cut = rng.randrange(len(text) + 1)
            text = text[:cut] + own[: len(own) - (i % 3)] + text[cut:]
        docs.append((i, " ".join(text).upper() if i % 5 == 0 else " ".join(text)))
    docs += [(100, None), (101, ""), (102, items[2][1])]
    df, bench = spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(items, "item_id long, text string")
    expected = all_leaks(docs, [x for x in items if x[1]])
    assert expected and {(r.doc_id, r.item_id) for r in D.find_leaks(df, bench).collect()} == expected
    # the same in slices of the benchmark
    assert {(r.doc_id, r.item_id) for r in D.find_leaks(df, bench, slice_words=30).collect()} == expected
    assert {r.doc_id for r in D.drop_leaks(df, bench, slice_words=30).collect()} == {i for i, _ in docs} - {i for i, _ in expected}
    assert D.find_leaks(df, bench.limit(0)).count() == 0 and D.find_leaks(df.limit(0), bench).count() == 0


def test_masks_meet_every_placement():
    """Leaks of 26 words or more have a half that is a leak; all of 13 to 25 words are enumerated."""
    assert (D.MIN_WORDS, D.MIN_SHARE) == (13, 0.8)
    seeds = [(sum(1 << i for i, c in enumerate(m) if c == "1"), len(m)) for m in D.MASKS]
    for n in range(13, 26):
        laid = np.array([m << p for m, size in seeds for p in range(n - size + 1)], np.int64)
        for places in itertools.combinations(range(n), n // 5):
            same = (1 << n) - 1 - sum(1 << p for p in places)
            assert ((laid & same) == laid).any(), (n, places)


def all_leaks(docs, items):
    """All alignments of all pairs, whether a mask hits or not."""
    out = set()
    for i, t in docs:
        a = words(t)
        for j, u in items:
            b = words(u)
            need = min(D.MIN_WORDS, len(b))
            for d in range(-len(b) + 1, len(a)):
                gain = np.cumsum([0] + [1 if a[k] == b[k - d] else -4 for k in range(max(0, d), min(len(a), d + len(b)))])
                if len(gain) > need and (gain[need:] >= np.minimum.accumulate(gain)[: len(gain) - need]).any():
                    out.add((i, j))
    return out


def test_every_leak_is_found(spark):
    rng = random.Random(13)
    vocab = [f"v{i}" for i in range(60)]
    items = [(j, " ".join(rng.choices(vocab, k=k))) for j, k in enumerate([13, 15, 20, 25, 40, 90, 14, 5, 8, 9, 10, 12, 3, 1])]
    docs = []
    for i in range(150):
        own = items[i % len(items)][1].split()
        if i % 3:
            places = rng.sample(range(len(own)), min(len(own), len(own) // 5 + (i % 7 == 0)))
        else:
            places = range(rng.randrange(6), len(own), 5 + i % 2)
        for p in places:
            own[p] = "other"
        docs.append((i, " ".join(rng.choices(vocab, k=rng.randint(0, 20)) + own + rng.choices(vocab, k=rng.randint(0, 20)))))
    expected = all_leaks(docs, items)
    df, bench = spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.find_leaks(df, bench).collect()} == expected
    assert {r.doc_id for r in D.drop_leaks(df, bench, slice_words=30).collect()} == {i for i, _ in docs} - {i for i, _ in expected}


def test_repeating_texts(spark):
    rng = random.Random(21)
    texts = ["one " * 300, "a b " * 150, "a b c " * 90 + "tail words here", "x " * 40 + "a b " * 30 + "x " * 40, "a a b " * 60]
    items = list(enumerate(["one " * 30, "a b " * 20, "b a " * 8 + "c", "a b c " * 10, "x " * 13, "a " * 20, "one one", " ".join(rng.choices("ab", k=40))]))
    docs = [(i, t) for i, t in enumerate(texts + [" ".join(rng.choices("abx", k=200)) for _ in range(6)])]
    df, bench = spark.createDataFrame(docs, SCHEMA).repartition(2), spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in D.find_leaks(df, bench).collect()} == all_leaks(docs, items)


def test_very_long_repeating_text_takes_linear_time():
    seeds = D._Seeds([(i, D.words_of(np.frombuffer(b"word " * 200, np.uint8), np.array([0, 1000])).codes) for i in range(5)])
    began = time.time()
    got = list(D._leaking(pa.array(["word " * 20_000]), seeds))
    assert got == [(0, {i: (200, 200) for i in range(5)})] and time.time() - began < 5


def test_decontamination_of_odd_ids_and_columns(spark):
    docs = spark.createDataFrame([(1, "x alpha beta gamma y", "keep", 3), (1, "x alpha beta gamma y", "keep", 3), (None, "alpha beta gamma", "keep", None), (2, "clean", None, 4)], "doc_id long, text string, item_id string, n_words int")
    bench = spark.createDataFrame([(None, "Alpha beta GAMMA"), ("7", "alpha beta gamma"), ("seven", "beta gamma")], "item_id string, text string")
    got = sorted(((r.doc_id, r.item_id) for r in D.find_leaks(docs, bench).collect()), key=str)
    assert got == sorted([(i, j) for i in (1, 1, None) for j in (None, 7, None)], key=str)
    kept = D.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [2]


def test_decontamination_of_short_items(spark):
    bench = spark.createDataFrame([(1, "Alpha beta GAMMA")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x alpha beta gamma y"), (2, "alpha beta"), (3, "beta alpha gamma")], SCHEMA)
    assert {r.doc_id for r in D.find_leaks(docs, bench).collect()} == {1}


def test_fingerprints(spark):
    docs = [(i, f"Für {i}. Second, sentence; here\n\n" * (i % 5) + "tail " * i + "é\U0001f600") for i in range(30)] + [(2000, "far away."), (40, ""), (41, None), (-5, "a\nb")]
    got = {r.doc_id: r for r in fingerprint_edits(spark.createDataFrame(docs, SCHEMA).repartition(4)).collect()}
    order = sorted(docs, key=lambda x: -x[0])
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        t, n = t or "", n or ""
        k = len(t) // 3
        edited = t[: len(t) - k] + n[:k]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (r.fingerprint == r.edited_fingerprint) == (t == edited) and (r.edit_paragraph is None) == (t == edited)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 and (t != edited or r.near_edited == 1.0)
    assert got[40].fingerprint == got[41].fingerprint
    one = fingerprint_edits(spark.createDataFrame([(None, "abc"), (None, "abc")], SCHEMA)).collect()
    assert len(one) == 2 and one[0].near_next == 1.0
    assert fingerprint_edits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_fingerprints_of_sparse_ids(spark):
    rng = random.Random(7)
    ids = [rng.randrange(-(2**63), 2**63) for _ in range(3000)] + [5] * 20 + [None] * 20
    docs = [(i, f"text {k % 50}", "x", k) for k, i in enumerate(ids)]
    df = spark.createDataFrame(docs, "doc_id long, text string, fingerprint string, bucket int").repartition(5)
    got = sorted(((r.doc_id, r.text, r.next_text) for r in with_next(df.select("doc_id", "text")).collect()), key=str)
    order = sorted(((-(2**63) if i is None else i, t, i) for i, t, _, _ in docs), key=lambda x: (x[0], x[1]), reverse=True)
    assert got == sorted(((i, t, n) for (_, t, i), (_, n, _) in zip(order, order[1:] + order[:1])), key=str)
    assert fingerprint_edits(df).count() == len(docs)


def test_edits_are_located(spark):
    text = "\n".join(f"Paragraph {i} says something of its own." for i in range(30))
    rows = spark.createDataFrame([(2, text), (1, "entirely different words stand here\n" * 40)], SCHEMA)
    r = {x.doc_id: x for x in fingerprint_edits(rows).collect()}[2]
    place = text[: len(text) - len(text) // 3].count("\n")
    assert r.edit_paragraph == place and r.edit_section == place // 8 and r.near_edited > 0.5 > r.near_next


def test_licenses(spark):
    filler = " ".join(f"filler{i}" for i in range(200))
    mit = TEMPLATES["mit"].split()
    changed = " ".join(w if i % 30 else "changed" for i, w in enumerate(mit, 1))
    docs = [(1, f"{filler} released under the mit license. {filler}"), (2, f"{filler}\n{TEMPLATES['apache-2.0']}"), (3, filler), (4, None), (5, ""), (6, f"{filler} {changed} {filler}"), (7, "Released under"), (8, "All rights reserved.")]
    got = {(r.doc_id, r.license): r.containment for r in scan_licenses(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got[(1, "mit-notice")] == 1.0 and got[(2, "apache-2.0")] == 1.0 and got[(8, "all-rights-reserved")] == 1.0 and got[(6, "mit")] >= 0.75
    assert {i for i, _ in got} == {1, 2, 6, 8}


def test_license_windows_miss_nothing_against_all_places(spark):
    rng = random.Random(5)
    norm = lambda t: re.findall(r"[^\W_]+", t.lower())
    sets = {n: {tuple(w[i : i + min(5, len(w))]) for i in range(len(w) - min(5, len(w)) + 1)} for n, t in TEMPLATES.items() for w in [norm(t)]}
    docs = []
    for i in range(60):
        name = rng.choice(sorted(TEMPLATES))
        own = TEMPLATES[name].split()
        for _ in range(rng.randint(0, max(1, len(own) // 30))):
            own[rng.randrange(len(own))] = "edit"
        docs.append((i, " ".join([f"f{rng.randrange(500)}" for _ in range(rng.randint(0, 90))] + own + [f"g{rng.randrange(500)}" for _ in range(rng.randint(0, 90))])))
    expected = set()
    for i, t in docs:
        w = norm(t)
        for n, s in sets.items():
            k = min(5, len(norm(TEMPLATES[n])))
            if len(s & {tuple(w[j : j + k]) for j in range(len(w) - k + 1)}) / len(s) >= 0.8:
                expected.add((i, n))
    got = {(r.doc_id, r.license) for r in scan_licenses(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert len(expected - got) <= 0.1 * len(expected)
