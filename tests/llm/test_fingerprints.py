import hashlib
import random

import numpy as np
from helpers import documents, odd_texts

from panelcast.llm import fingerprints as f


def encode(text):
    return f.Fingerprints.of([text]).encode()[0]


def test_sums_follow_paragraphs():
    lines = [f"paragraph {i} with words {i * i}" for i in range(30)] + ["twice", "twice"]
    shuffled = lines[:]
    random.Random(1).shuffle(shuffled)
    whole = f.Fingerprints.of(["\n".join(lines)])
    assert whole.encode() == f.Fingerprints.of(["\n\n".join(shuffled)]).encode()
    assert encode("twice") != encode("twice\ntwice")
    part, rest = f.Fingerprints.of(["\n".join(lines[:10])]), f.Fingerprints.of(["\n".join(lines[10:])])
    assert (part + rest).encode() == whole.encode()
    assert (whole - rest).encode() == part.encode()
    assert f.Fingerprints.decode(whole.encode()).encode() == whole.encode()


def test_likeness_follows_the_shared_share():
    rng = np.random.default_rng(5)
    text = lambda n: "\n".join(" ".join(f"w{x}" for x in rng.integers(0, 10**6, 20)) for _ in range(n))
    own, other = text(100), text(100)
    for share in (0, 25, 50, 75, 100):
        mixed = "\n".join(own.split("\n")[:share] + other.split("\n")[share:])
        a, b = f.Fingerprints.of([own]), f.Fingerprints.of([mixed])
        assert abs(a.likeness(b)[0] - share / 100) < 0.2


def test_many_equal_lines_do_not_wrap():
    line = "the same words in every line"
    a, b = (f.Fingerprints.of(["\n".join([line] * n)]) for n in (40_000, 20_000))
    assert a.likeness(b)[0] > 0.999
    assert ((a - b).encode() == b.encode()) and a.likeness(a)[0] == 1


def test_empty_texts():
    none = f.Fingerprints.of([None, "", " \n ", "x"])
    assert none.likeness(none[[1, 2, 0, 0]]).tolist() == [1, 1, 1, 0]


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        a, b, c = (f.Fingerprints.of([t]) for t in (text, changed, following))
        out.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), a.encode()[0], b.encode()[0], a.likeness(b)[0], a.likeness(c)[0]))
    return out


def check(spark, rows):
    docs = documents(spark, [t for _, t in rows], ids=[i for i, _ in rows]).repartition(4)
    got = [tuple(r) for r in f.compare_with_next(docs).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_against_brute_force(spark):
    check(spark, [(7 * i % 31, t) for i, t in enumerate(odd_texts())])


def test_many_documents(spark):
    check(spark, [(i * 37 % 1009, f"text {i}\nof many {i % 10}\n" * (i % 7)) for i in range(700)])


def test_repeated_ids_nulls_and_single_rows(spark):
    check(spark, [(1, "a b"), (1, "a b"), (1, "c d"), (None, "e f"), (2, None)])
    check(spark, [(5, "only one text here")])
    assert f.compare_with_next(documents(spark, [])).count() == 0
