import random
import re
import zlib
from collections import Counter

import pytest
from helpers import documents, odd_texts, write_tables

from panelcast.llm import spelling_variants as s


def distance_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_force(ids, texts):
    counts = Counter()
    for i, text in zip(ids, texts):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{i}:{word}".encode())
            if i is not None and h % 199 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [o for o in words if distance_one(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(tuple(r) for r in df.collect())


def test_a_minimal_acceptor():
    words = ["ab", "abc", "bb", "bbc", "cb"]
    one = s.Acceptor(words)
    assert len(one.arcs) == 6 - 1  # start, after a or b, its end, after c, the plain end

    def place(word):
        q, at = one.start, 0
        for c in word:
            q, before = one.arcs[q][c]
            at += before
        return at if one.final[q] else None

    assert [place(w) for w in words] == [0, 1, 2, 3, 4] and place("a") is None


@pytest.mark.parametrize("seed", range(6))
def test_pairs_one_edit_apart(seed):
    pick = random.Random(seed)
    words = sorted({"".join(pick.choice("abé") for _ in range(pick.randint(1, 9))) for _ in range(400)})
    pairs = [tuple(sorted(p)) for p in s.one_edit_pairs(words)]
    expected = {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if distance_one(a, b)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected


def corpus():
    pick = random.Random(5)
    base = ["spelling", "variant", "grouping", "accept", "accepts", "acceptor", "transducer", "überall", "naïveté", "×÷×÷×÷"]
    texts = odd_texts() + ["aaaaaa aaaaaaa aaaaaaaa " * 9, "CAFÉTERIA cafétéria cafÉteria " * 5]
    for i in range(60):
        words = []
        for _ in range(80):
            w = pick.choice(base)
            if pick.random() < 0.15:
                at = pick.randrange(len(w))
                w = pick.choice([w[:at] + w[at + 1 :], w[:at] + pick.choice("xyz") + w[at:], w[:at] + pick.choice("xyz") + w[at + 1 :]])
            words.append(w.title() if pick.random() < 0.1 else w)
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("small", [False, True])
def test_variants_are_those_of_brute_force(spark, tmp_path, monkeypatch, small):
    if small:
        monkeypatch.setattr(s, "HELD", 3)
        monkeypatch.setattr(s, "SHARD_WORDS", 2)
    texts = corpus()
    ids = [None if i % 11 == 3 else i // 2 for i in range(len(texts))]
    folder = write_tables(spark, tmp_path / "in", documents(spark, texts, ids).repartition(3))
    expected = brute_force(ids, texts)
    assert rows(s.query(spark, folder)) == expected
    assert any(r[1] for r in expected) and any(r[1] != r[2] and r[1] for r in expected) is not None


def test_chains_ties_and_deleted_letters(spark):
    steps = {"stepping": 5, "steppinh": 25, "steppimh": 125, "stoppimh": 625}
    ties = {"tiedword": 5, "tiedworb": 30, "tiedwora": 30}
    docs = documents(spark, [" ".join(w for w, n in {**steps, **ties}.items() for _ in range(n))] + ["lonely words " * 3000], [None, None])
    got = {r["word"]: r for r in s.spelling_variants(docs).collect()}
    assert got["stepping"]["root"] == "stoppimh" and got["stepping"]["form"] == "steppinh" and got["steppimh"]["n_near"] == 2
    assert got["tiedword"]["form"] == "tiedwora" and got["tiedwora"]["form"] is None and got["tiedwora"]["root"] == "tiedwora"
    i = next(i for i in range(10_000) if zlib.crc32(f"{i}:lonely".encode()) % 199 == 0)
    kept = s.corpus_words(documents(spark, ["lonely " * 9, "lonely " * 9], [i, i + 1])).collect()
    assert [tuple(r) for r in kept] == [("lonely", 9)]


def test_long_words_and_empty_tables(spark):
    long = "y" * 40_000
    docs = documents(spark, [None, "", f"{long} {long}y {long[:-1]}z " * 5])
    got = {len(r["word"]): r["n_near"] for r in s.spelling_variants(docs).collect() if not r["word"].endswith("z")}
    assert got == {40_000: 2, 40_001: 1}
    assert s.spelling_variants(documents(spark, [])).count() == 0
