import math
from collections import Counter

import numpy as np
import pytest
from helpers import documents, odd_texts

from panelcast.llm import ngram_model as m


def tokens(text):
    return [*(text or "").encode().lower().split(), b"\0end"]


def grams(text, order):
    t = [*[b"\0begin"] * (order - 1), *tokens(text)]
    return [tuple(t[i : i + order]) for i in range(len(t) - order + 1)]


class Brute:
    """All n-grams counted at the highest order, distinct continuations below, nothing hashed."""

    def __init__(self, texts, order=2):
        self.order = order
        self.c = Counter(w for t in texts for w in tokens(t))
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.counts = {order: Counter(g for t in texts for g in grams(t, order))}
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.d = {k: m.discounts(*[sum(v == i for v in c.values()) for i in (1, 2, 3, 4)]) for k, c in self.counts.items()}
        self.sums, self.left = Counter(), Counter()
        for k, counts in self.counts.items():
            for g, n in counts.items():
                self.sums[k, g[:-1]] += n
                self.left[k, g[:-1]] += self.d[k][min(n, 3) - 1]

    def p(self, *gram):
        k, context = len(gram), gram[:-1]
        lower = self.p(*gram[1:]) if k > 1 else 1 / (self.v + 1)
        total, n = self.sums[k, context], self.counts[k][gram]
        if not total:
            return lower
        return (n - (self.d[k][min(n, 3) - 1] if n else 0)) / total + self.left[k, context] / total * lower

    def score(self, text):
        t = tokens(text)
        base = sum(math.log10((self.c[w] + 1) / (self.n + self.v + 1)) for w in t)
        return len(t), sum(self.c[w] > 0 for w in t), base, sum(math.log10(self.p(*g)) for g in grams(text, self.order))


def corpus():
    rng = np.random.default_rng(3)
    return odd_texts() + [" ".join(f"v{x}" for x in rng.zipf(1.4, 80) % 60) for _ in range(200)]


@pytest.mark.parametrize("order,shard_tokens,block", [(2, 1 << 21, 1 << 22), (2, 500, 700), (3, 1 << 21, 1 << 22), (3, 500, 700), (4, 500, 700)])
def test_against_brute_force(spark, monkeypatch, order, shard_tokens, block):
    """The second case salts frequent words and has many blocks; the closures carry the module's settings."""
    monkeypatch.setattr(m, "SHARD_TOKENS", shard_tokens)
    monkeypatch.setattr(m, "BLOCK_TOKENS", block)
    texts = [t if not t or len(t) < 100_000 else t[:20_000] for t in corpus()]
    learned, scored = texts[::2], texts + ["never seen words at all"]
    model = m.train(documents(spark, learned), order)
    if shard_tokens < 1000:
        assert len(model.salts.words) > 1
    brute = Brute(learned, order)
    assert (model.tokens, model.types) == (brute.n, brute.v)
    got = {r["doc_id"]: r for r in m.score(documents(spark, scored), model).collect()}
    assert len(got) == len(scored)
    for i, text in enumerate(scored):
        n, known, base, score = brute.score(text)
        r = got[i]
        assert (r["n_tokens"], r["n_known"]) == (n, known)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(score, rel=1e-9)


def test_probabilities_sum_to_one():
    for order in (2, 3):
        brute = Brute(corpus()[15:60], order)
        for before in (b"v1", b"\0begin", b"unseen"):
            first = [before] * (order - 1)
            assert sum(brute.p(*first, w) for w in brute.c) + brute.p(*first, b"unknown") == pytest.approx(1)


def test_without_training_rows(spark):
    model = m.train(documents(spark, []), 3)
    got = m.score(documents(spark, ["a b", None]), model).collect()
    assert [(r["n_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got] == [(3, 0, 0, 0), (1, 0, 0, 0)]
    assert m.score(documents(spark, []), m.train(documents(spark, ["a"]))).count() == 0


def test_packed_arrays_round_trip():
    arrays = [np.arange(5, dtype=np.uint8), np.arange(3, dtype=np.uint64), np.zeros(0, np.uint32), np.arange(7, dtype=np.int64)]
    for a, b in zip(arrays, m.unpack(m.pack(*arrays))):
        assert a.dtype == b.dtype and a.tolist() == b.tolist() and b.flags.aligned


def test_counts_of_any_width_are_kept():
    for most, kind in ((255, np.uint8), (256, np.uint16), (0xFFFFFFFF, np.uint32), (1 << 32, np.int64)):
        counts = np.array([2, most])
        assert m.narrowed(counts).dtype == kind
        assert m.unpack(m.pack(m.narrowed(counts)))[0].tolist() == counts.tolist()
    assert m.narrowed(np.zeros(0, np.int64)).tolist() == []
