from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import documents, odd_texts
from pyspark.sql import functions as F

from panelcast.llm import jaccard_join as j
from panelcast.llm.components import components
from panelcast.llm.words import shingle_hashes, word_hashes


def shingles(text):
    w = (text or "").encode().lower().split()
    if len(w) >= 5:
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    return frozenset([tuple(w)]) if w else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for t in s:
            holders[t].append(i)
    for i, s in enumerate(sets):
        common = Counter(o for t in s for o in holders[t] if o > i)
        for o, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[o]) - n):
                parent[find(i)] = find(o)
    groups = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        groups[find(i)].append(doc)
    return sorted((doc, len(sets[i]), min(groups[find(i)])) for i, (doc, _) in enumerate(rows))


def found(spark, rows, **options):
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    got = j.near_duplicates(docs, **options).select("doc_id", "n_shingles", "component_id").collect()
    return sorted(tuple(r) for r in got)


def copies(n, size, seed):
    """Near copies of one text with a few words changed, and chains of copies of copies."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in rng.integers(0, 5000, size)]
    texts, last = [" ".join(base)], base
    for k in range(n):
        words = list(base if k % 3 else last)
        for at in rng.integers(0, size, rng.integers(0, 5)):
            words[at] = f"new{seed}-{k}-{at}"
        last = words
        texts.append(" ".join(words))
    return texts


def test_odd_texts(spark):
    rows = list(enumerate(odd_texts()))
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("unit", [1 << 20, 2000, 300])
def test_groups_of_near_copies(spark, unit):
    texts = [t for seed in range(6) for t in copies(25, 60 + 20 * seed, seed)]
    texts += ["common line of words that many share " * 3 + f"own {i} text {i * i} of {i}" for i in range(60)]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    assert found(spark, rows, unit_shingles=unit) == brute(rows)


def test_repeated_rows_ids_and_nulls(spark):
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (3, "A B C D E F G"), (9, "x"), (8, "x"), (7, None), (7, None)]
    assert found(spark, rows) == brute(rows)
    docs = documents(spark, ["a b c d e f", "a b c d e f", "z"], ids=[None, 4, None])
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in j.near_duplicates(docs).collect()}
    assert got == {(None, 2): 4, (4, 2): 4, (None, 1): None}


def test_ids_with_two_texts(spark):
    a, b, c, d = (copies(0, 80, seed)[0] for seed in range(50, 54))
    rows = [(1, a), (1, b), (2, a + " end"), (3, b + " end"), (4, c), (4, d), (4, d), (5, d + " end"), (6, c + " end")]
    want = sorted((i, len(shingles(t)), {2: 1, 3: 1, 5: 4, 6: 4}.get(i, i)) for i, t in rows)
    assert found(spark, rows) == found(spark, rows[::-1]) == brute(rows) == want


def test_linked_texts_without_id(spark):
    bases = [copies(0, 80, seed)[0] for seed in range(60, 66)]
    rows = [(None, b + end) for b in bases for end in ("", " end", " end of it")] + [(None, bases[0])] * 5
    rows += [(20 + i, b + " its end") for i, b in enumerate(bases[:4])]
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    got = Counter(r["component_id"] for r in j.near_duplicates(docs).collect())
    assert got == {20: 9, 21: 4, 22: 4, 23: 4, None: 6}


def test_empty(spark):
    assert j.near_duplicates(documents(spark, [])).count() == 0


def test_keep_one(spark):
    docs = documents(spark, ["a b c d e f g", "a b c d e f g", "a b c d e f g", "other text", None, None, ""], ids=[2, 2, 1, 3, 4, 5, 6])
    kept = j.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5, 6]
    twice = documents(spark, ["a b c", "a b c", None, None], ids=[1, 1, 2, 2])
    assert sorted(r["doc_id"] for r in j.keep_one(twice).collect()) == [1, 2, 2]


def test_keep_one_decides_by_row(spark):
    a, b, c, d, e = (copies(0, 80, seed)[0] for seed in range(80, 85))
    rows = [(5, a), (5, b), (3, a + " end"), (None, a + " end of it")]  # of a: row 3; b stays
    rows += [(7, c), (7, "some words")]  # alone, under one id
    rows += [(None, d), (None, d), (None, d + " end"), (None, "other words"), (None, None), (None, "")]  # of d: one
    rows += [(8, e), (8, e), (8, e + " end"), (9, e)]  # of e: one
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows])
    got = Counter((r["doc_id"], r["text"]) for r in j.keep_one(docs).collect())
    fixed = [(5, b), (3, a + " end"), (7, c), (7, "some words"), (None, "other words"), (None, None), (None, "")]
    assert all(got[row] == 1 for row in fixed)
    assert got[None, d] + got[None, d + " end"] == got[8, e] + got[8, e + " end"] == 1
    assert sum(got.values()) == len(fixed) + 2


def test_keep_one_leaves_other_columns(spark):
    """Names that the operator uses itself stay as they are, and a table without copies comes back whole."""
    docs = documents(spark, ["a b c d e f", "a b c d e f", "other text"], ids=[1, 2, 3])
    for name in ("key", "once", "id", "decided", "row", "a.b"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    kept = j.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["row"], r["a.b"], r["key"]) for r in kept.collect()) == [(1, "row1", "a.b1", "key1"), (3, "row3", "a.b3", "key3")]
    assert j.keep_one(docs.where("doc_id = 3")).count() == 1 and j.keep_one(docs.where("doc_id < 0")).count() == 0


def test_threshold_is_exact(spark):
    words = [f"t{i}" for i in range(14)]  # ten shingles
    rows = [(1, " ".join(words)), (2, " ".join(words[1:])), (3, " ".join(words[:12])), (4, " ".join(words[3:]))]
    # 9/10, 8/10 and 7/10 of the first set
    assert found(spark, rows) == brute(rows) == [(1, 10, 1), (2, 9, 1), (3, 8, 1), (4, 7, 4)]
    assert found(spark, rows[:1] + rows[3:]) == [(1, 10, 1), (4, 7, 4)]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(200)] + [(500, 500 + i) for i in range(1, 50)] + [(901, 900), (900, 901), (7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    want = {**{i: 0 for i in range(201)}, **{500 + i: 500 for i in range(50)}, 900: 900, 901: 900}
    assert got == want


def test_word_hashes_tell_words_apart():
    texts = odd_texts() + ["The the THE", "a\x0bb\x0cc\x1cd", "\x85x", "q" * 600_000 + " z"]
    hashes, owner = word_hashes(texts)
    words = [(w, i) for i, t in enumerate(texts) for w in (t or "").encode().lower().split()]
    assert owner.tolist() == [i for _, i in words]
    by_word = defaultdict(set)
    for (w, _), h in zip(words, hashes.tolist()):
        by_word[w].add(h)
    assert all(len(h) == 1 for h in by_word.values())
    assert len({h for hs in by_word.values() for h in hs}) == len(by_word)


@pytest.mark.parametrize("size", [1, 2, 5])
def test_shingles_agree_with_tuples(size):
    texts = odd_texts()
    hashes, owner = word_hashes(texts)
    got, of = shingle_hashes(hashes, owner, len(texts), size)
    want = []
    for i, t in enumerate(texts):
        w = (t or "").encode().lower().split()
        want += [(i, tuple(w[k : k + size])) for k in range(len(w) - size + 1)] if len(w) >= size else [(i, tuple(w))] * bool(w)
    assert Counter(of.tolist()) == Counter(i for i, _ in want)
    assert len(set(zip(of.tolist(), got.tolist()))) == len(set(want))
    assert len(set(got.tolist())) == len({t for _, t in want})
