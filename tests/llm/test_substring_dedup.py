import hashlib
import random
import re

import numpy as np
import pytest
from helpers import PASSAGE, documents, odd_texts, write_tables

from panelcast.llm import substring_dedup as s


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def brute_force(ids, texts):
    least = {}
    for i, text in zip(ids, texts):
        words = split(text)
        for p in range(len(words) - s.WINDOW + 1) if i is not None else ():
            w = tuple(words[p : p + s.WINDOW])
            least[w] = min(least.get(w, i), i)
    rows = []
    for i, text in zip(ids, texts):
        words, gone = split(text), set()
        for p in range(len(words) - s.WINDOW + 1) if i is not None else ():
            if least[tuple(words[p : p + s.WINDOW])] < i:
                gone.update(range(p, p + s.WINDOW))
        kept = " ".join(w for p, w in enumerate(words) if p not in gone)
        rows.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return order(rows)


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, str(r)))


def corpus(seed=3):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choice("abcdé") for _ in range(pick.randint(1, 3)))
    passages = [[word() for _ in range(n)] for n in (50, 51, 49, 120, 400)] + [["x"] * 70, ["x", "y"] * 40, ["p", "q", "r"] * 30]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(pick.randint(0, 3)):
            parts += [word() for _ in range(pick.randint(0, 40))]
            p = pick.choice(passages)
            a = pick.randint(0, 8)
            parts += p[a : len(p) - pick.randint(0, 8)]
        texts.append(pick.choice([" ", "\n", "\t  "]).join(parts))
    return texts


@pytest.mark.parametrize("small", [False, True])
def test_results_are_those_of_brute_force(spark, tmp_path, monkeypatch, small):
    if small:
        for name in ("BLOCK_WORDS", "BLOCK_WINDOWS", "SEGMENT"):
            monkeypatch.setattr(s, name, 40)
    texts = [x for x in odd_texts() if not x or len(x) < 60_000] + corpus() + [PASSAGE, PASSAGE.replace("w30x", "W30x"), "\x1c\x85\xa0".join(PASSAGE.split())]
    ids = [None if i % 13 == 5 else (i * 7) % 40 - 5 for i in range(len(texts))]
    folder = write_tables(spark, tmp_path / "in", documents(spark, texts, ids).repartition(3))
    got = s.query(spark, folder)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    expected = brute_force(ids, texts)
    assert order(got.collect()) == expected and sum(r[2] > 0 for r in expected) > 20


def test_equal_windows_have_equal_anchors():
    """Wherever a window stands, its anchor has the same name and the same place inside."""
    pick = random.Random(1)
    inner = [["a", "b", "a", "a", "c"][pick.randrange(5)] for _ in range(30)] + [str(pick.randrange(9)) for _ in range(90)]
    seen = {}
    for _ in range(40):
        before, after = ([pick.choice("abc123") for _ in range(pick.randint(0, 30))] for _ in range(2))
        words = s.Words([" ".join([*before, *inner, *after]).encode()])
        starts = words.windows()
        names, places = s.recompress(words.hashes, words.owner, starts)
        for at, name, place in zip(starts - len(before), names, places - starts):
            if 0 <= at <= len(inner) - s.WINDOW:
                seen.setdefault(int(at), set()).add((int(name), int(place)))
    assert len(seen) == len(inner) - s.WINDOW + 1 and all(len(v) == 1 for v in seen.values())


def test_anchors_are_few():
    words = s.Words([" ".join(str(random.Random(2).random()) + str(i) for i in range(20_000)).encode()])
    starts = words.windows()
    names, places = s.recompress(words.hashes, words.owner, starts)
    assert len(set(zip(names.tolist(), places.tolist()))) < len(starts) / 6


def test_word_hashes():
    texts = [b"One two  one", None, b"", b"\ttwo\n", b"x" * 1000 + b" two"]
    words = s.Words(texts)
    h = words.hashes
    assert words.n.tolist() == [3, 0, 0, 1, 2] and len(set(h.tolist())) == 4
    assert h[1] == h[3] == h[5] and h[0] != h[2]
    assert np.array_equal(s.Words([b"x" * (s.SEGMENT + 9) + b" two"]).hashes[1:], h[1:2])


def test_spans_long_texts_and_empty_tables(spark):
    long = " ".join(f"word{i % 977} tail{i % 13} {i}" for i in range(100_000))
    docs = documents(spark, [long, "start " + long + " end"])
    spans = {r["doc_id"]: (r["begins"], r["lengths"]) for r in s.repeated_spans(docs).collect()}
    assert spans == {1: ([1], [300_000])}
    kept = {r["doc_id"]: (r["n_removed"], r["kept"]) for r in s.remove_repeats(docs).collect()}
    assert kept[1] == (300_000, "start end") and kept[0] == (0, long)
    assert s.remove_repeats(documents(spark, [])).count() == 0
