"""Manifest, spelling variants and source mixing against brute force, and in every odd case."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.llm import manifest as M
from quantloom.llm import mixing as X
from quantloom.llm import spelling as S
from quantloom.llm.places import Places

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, g_ string, row_ long, leaf string, place_ long, word string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, rows):
    """Documents with columns whose names clash with those that the operators make."""
    return spark.createDataFrame([(*r, "g", 1, "x", 2, "w") for r in rows], SCHEMA)


def odd_rows():
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["Alpha", "beta", "Größe", "x"], k=rng.randint(0, 40))), "en", rng.choice(["b", "b", "b", "a", "Z", "é", ""]), i) for i in range(430)]
    rows += [(1000, None, None, None, None), (1001, "", "", None, 0), (1002, "one\ttwo", "en", "lone", 7), (None, "No Id", "en", "a", 5), (None, None, None, "a", None)]
    rows += [rows[3], rows[3], (7, "other text", "en", "b", 1), (2000, "Word " * 60_000, "en", "b", 300_000)]
    return rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows):
    def leaf(doc_id, text, lang, source, n_chars):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    def climb(digests):
        """The top digest, and for each the (left, right) siblings on the way."""
        paths, at = [[] for _ in digests], list(range(len(digests)))
        while len(digests) > 1:
            for i, p in enumerate(at):
                run = digests[p // 16 * 16 : p // 16 * 16 + 16]
                paths[i].append(("".join(run[: p % 16]), "".join(run[p % 16 + 1 :])))
            digests, at = [sha("".join(digests[i : i + 16])) for i in range(0, len(digests), 16)], [p // 16 for p in at]
        return digests[0], paths

    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        leaves = sorted(((r[0] is not None, r[0] or 0, leaf(*r), r) for r in by_source[s]), key=lambda x: x[:3])
        trees.append((leaves, *climb([x[2] for x in leaves])))
    root, tops = climb([t[1] for t in trees])
    out = []
    for (leaves, subroot, paths), top in zip(trees, tops):
        for (_, _, digest, r), path in zip(leaves, paths):
            text = r[1]
            if text is not None and zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0:
                text = text.translate(LOWER)
            x = leaf(r[0], text, *r[2:])
            for left, right in path + top:
                x = sha(left + x + right)
            out.append((str(r[0]), digest, subroot, root, sha("".join(a + b for a, b in path + top)), x, x == root))
    return sorted(out)


def test_manifest_against_brute_force(spark):
    rows = odd_rows()
    got = M.manifest_digests(table(spark, rows))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == brute_manifest(rows)


def test_manifest_of_many_sources_and_of_few_rows(spark):
    rows = [(i, f"T{i}", "en", f"s{i % 300:03}", i) for i in range(330)]
    assert sorted((str(r[0]), *r[1:]) for r in M.manifest_digests(table(spark, rows)).collect()) == brute_manifest(rows)
    for n in (1, 2, 17):
        few = [(i, "A", None, None, i) for i in range(n)]
        assert sorted((str(r[0]), *r[1:]) for r in M.manifest_digests(table(spark, few)).collect()) == brute_manifest(few)
    assert M.manifest_digests(table(spark, rows).limit(0)).count() == 0


def test_places_of_a_hot_group_and_of_equal_rows(spark):
    rows = [("hot", 5, 2)] * 300 + [("hot", i, 1) for i in range(200)] + [("b", i, i) for i in range(9)] + [("a", 1, 3)]
    got = Places(spark.createDataFrame(rows, "k string, o int, v int"), "k", ["o"], "v")
    seen = defaultdict(list)
    for r in got.rows().collect():
        seen[r.k].append(r)
    assert {k: (v[0].rank_, v[0].group_rows_, v[0].group_sum_) for k, v in seen.items()} == {"a": (0, 1, 3), "b": (1, 9, 36), "hot": (2, 500, 800)}
    for v in seen.values():
        v.sort(key=lambda r: r.pos_)
        assert [r.pos_ for r in v] == list(range(len(v))) and [r.o for r in v] == sorted(r.o for r in v)
        assert [r.before_ for r in v] == [0, *np.cumsum([r.v for r in v])[:-1].tolist()]


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("most", [10_000, 20])
def test_near_words_against_all_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(S, "MOST_MET", most)
    rng = random.Random(11)
    words = {"".join(rng.choices("abé", k=rng.randint(6, 9))) for _ in range(500)} | {"a" * n for n in range(6, 12)} | {"abcdefgh" + c for c in "ijklmnop"}
    got = [tuple(sorted(r)) for r in S.near_pairs(spark.createDataFrame([(w,) for w in sorted(words)], "word string")).collect()]
    assert len(got) == len(set(got))
    ordered = sorted(words)
    assert set(got) == {(a, b) for i, a in enumerate(ordered) for b in ordered[i + 1 :] if near(a, b)}


def brute_variants(rows):
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    form, out = {}, []
    for w in n:
        close = [v for v in n if near(v, w)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form[w] = (best if best and n[best] >= 5 * n[w] else None, len(close))
    for w, (f, k) in form.items():
        root = w
        while form[root][0]:
            root = form[root][0]
        out.append((w, f, root, n[w], k, n[f] if f else None))
    return sorted(out)


def test_spelling_variants_against_brute_force(spark):
    rng = random.Random(3)
    base = ["strasse", "Straße", "receive", "separate", "Ératosthène", "ératosthène", "colour", "color", "colours", "definitely", "abcabcabc"]
    texts = [" ".join(rng.choices(base, [9, 2, 40, 12, 5, 5, 30, 9, 3, 20, 4], k=60)) for _ in range(120)]
    texts += ["recieve receve receive " * 3, "aaaaaa aaaaaaa " * 6 + "aaaaaaaa " * 40, "seperate separat separat separat separat separat", None, "", "12 - ×÷×÷×÷", "q" * 50_000]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(None, texts[0], None, None, None)] * 2 + [(3, texts[3], None, None, None)]
    got = S.spelling_variants(table(spark, rows))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = brute_variants(rows)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str) and any(r[1] for r in expected)
    assert S.spelling_variants(table(spark, rows).limit(0)).count() == 0


def test_roots_follow_long_chains(spark):
    forms = [(f"w{i}", f"w{i + 1}" if i < 9 else None) for i in range(10)] + [("alone", None)]
    assert {r.word: r.root for r in S.roots(spark.createDataFrame(forms, "word string, form string")).collect()} == {f"w{i}": "w9" for i in range(10)} | {"alone": "alone"}


def brute_mix(rows):
    """Sizes, targets and taken words, block by block."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    order = sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(z for z, r in zip(size, rows) if r[3] == s) for s in order}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    full, spare = set(), 1.5 * sum(size)
    while spare > 1e-9 and len(full) < len(order):
        rest = [s for s in order if s not in full]
        share = spare / sum(weight[s] for s in rest)
        spare = 0.0
        for s in rest:
            target[s] += share * weight[s]
            if target[s] > 2 * total[s]:
                spare += target[s] - 2 * total[s]
                target[s] = 2.0 * total[s]
                full.add(s)
    return size, total, target


def test_mix_meets_targets_and_reruns_agree(spark):
    rows = odd_rows()
    size, total, target = brute_mix(rows)
    got = X.mix_report(table(spark, rows)).collect()
    assert Counter((r.doc_id, r["size"], r.source_size) for r in got) == Counter((r[0], z, total[r[3]]) for r, z in zip(rows, size))
    assert all(r.taken <= 2 * r["size"] for r in got)
    taken, told = Counter(), {}
    for r in got:  # the sizes of the sources differ
        taken[r.source_size] += r.taken
        told[r.source_size] = r.target
    assert len(set(total.values())) == len(total)
    for s, n in total.items():
        assert told[n] == pytest.approx(target[s])
        assert abs(taken[n] - target[s]) <= max(1, n / X.LEAST_BLOCKS + 1)
    spread = table(spark, rows).repartition(7, F.rand(1))
    key = lambda r: str((r.doc_id, r["size"], r.taken))
    assert sorted(map(key, X.mix_report(spread).collect())) == sorted(map(key, got))
    assert X.mix_report(table(spark, rows).limit(0)).count() == 0
    nothing = X.mix_report(table(spark, [(1, None, None, "a", 0), (2, " ", None, None, 1)])).collect()
    assert {(r.doc_id, r["size"], r.target, r.taken) for r in nothing} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}


def test_shards_hold_exact_quotas_of_disjoint_stretches():
    quotas, shards = [900, 0, 77, 5, 3000], 13
    all_of = [X.shard_stretches(quotas, k, shards) for k in range(shards)]
    for s, q in enumerate(quotas):
        assert [x[s][0] for x in all_of] == [0, *[x[s][1] for x in all_of][:-1]] and all_of[-1][s][1] == q
    sizes = [sum(b - a for a, b in x) for x in all_of]
    assert sum(sizes) == sum(quotas) and max(sizes) - min(sizes) <= 1
    means = np.mean([X.split_quotas([60, 30, 10], 20, np.random.default_rng(i)) for i in range(2000)], axis=0)
    assert means == pytest.approx([12, 6, 2], abs=0.15)
    big = X.split_quotas([3 * 10**12, 10**12, 7], 10**12, np.random.default_rng(1))
    assert sum(big) == 10**12 and big[0] / 10**12 == pytest.approx(0.75, abs=1e-4) and 0 <= big[2] <= 7


def test_permutations():
    for n in (1, 2, 3, 64, 1000, 4097):
        a, b = (X.permuted(np.arange(n), np.full(n, n), np.full(n, key)) for key in (12345, 999_999_999))
        assert sorted(a.tolist()) == sorted(b.tolist()) == list(range(n))
        if n >= 1000:  # a random order of so many is correlated by 0.03 at most in two cases of three
            assert (a != b).mean() > 0.9 and abs(np.corrcoef(np.arange(n), a)[0, 1]) < 0.12


def test_mixed_texts_are_the_words_of_the_draws(spark):
    rows = [(i, f"d{i} " + " ".join(f"w{i}_{j}" for j in range(i % 40)), None, f"s{i % 3}", 0) for i in range(200)]
    docs = table(spark, rows)
    draws = X.draw_mix(docs, 5)
    out = X.mixed_texts(docs, draws).collect()
    words = {r[0]: re.findall(r"\S+", r[1]) for r in rows}
    assert all(r.text.split(" ") == words[r.doc_id][r.from_word : r.from_word + r.n_words] for r in out)
    taken = {r.doc_id: r.taken for r in X.mix_report(docs, 5).collect()}
    by_doc, by_shard = Counter(), Counter()
    for r in out:
        by_doc[r.doc_id] += r.n_words
        by_shard[r.shard] += r.n_words
    assert by_doc == Counter({k: v for k, v in taken.items() if v}) and set(by_shard) == set(range(5))
    assert max(by_shard.values()) < 1.2 * min(by_shard.values())
