from collections import defaultdict
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from helpers import documents, odd_texts
from pyspark.sql import functions as F

from panelcast.llm import mixing


def highest_quotients(weights, seats):
    won = [0] * len(weights)
    for _ in range(seats):
        best = max(range(len(weights)), key=lambda i: (Fraction(weights[i], 2 * won[i] + 1), -i))
        won[best] += 1
    return won


@pytest.mark.parametrize("weights,seats", [([5, 3, 1], 9), ([1], 7), ([0, 4, 4], 5), ([100, 1, 1, 1, 1], 10), ([7, 7, 7], 2), ([3, 2], 0)])
def test_sainte_lague(spark, weights, seats):
    df = spark.createDataFrame([(1, i, w, seats) for i, w in enumerate(weights)], "g int, i int, w long, seats long")
    got = mixing.sainte_lague(df, ["g"], "w", "seats", ["i"], "won").orderBy("i").collect()
    assert [r["won"] for r in got] == highest_quotients(weights, seats)


def test_many_groups_agree_with_highest_quotients(spark):
    groups = [[(g * 37 + i * i * 11) % 101 + 1 for i in range(g % 9 + 1)] for g in range(40)]
    rows = [(g, i, w, g * 3) for g, ws in enumerate(groups) for i, w in enumerate(ws)]
    df = spark.createDataFrame(rows, "g int, i int, w long, seats long")
    got = defaultdict(list)
    for r in mixing.sainte_lague(df, ["g"], "w", "seats", ["i"], "won").orderBy("g", "i").collect():
        got[r["g"]].append(r["won"])
    assert [got[g] for g in range(40)] == [highest_quotients(ws, g * 3) for g, ws in enumerate(groups)]


def reshared(sizes, weights, cap=3):
    """Targets by repeated resharing of the excess."""
    target, full = [0.0] * len(sizes), set()
    while True:
        left = sum(sizes) - sum(target[i] for i in full)
        open_ = [i for i in range(len(sizes)) if i not in full]
        total = sum(weights[i] for i in open_)
        for i in open_:
            target[i] = left * weights[i] / total
        over = [i for i in open_ if target[i] > cap * sizes[i]]
        if not over:
            return target
        for i in over:
            target[i] = cap * sizes[i]
            full.add(i)


def test_targets_stop_at_three_sizes(spark):
    sizes = [1000, 5, 0, 400, 70, 3, 900]
    df = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "source string, source_size long")
    got = mixing.targets(mixing.cycle_weights(df)).orderBy("source").collect()
    want = reshared(sizes, [1, 2, 3, 1, 2, 3, 1])
    assert [r["target"] for r in got] == pytest.approx(want)


def test_odd_rows_and_spans(spark):
    docs = documents(spark, odd_texts() + ["a b c"], sources=[None, "b", "b", "a", "a", "a", "a", "c", "c", None, "b", "b", "é", "Z", "Z", "b"])
    rows = mixing.mix(docs, block_words=4, shard_words=5000).collect()
    assert len(rows) == 16
    for r in rows:
        assert r["taken"] == r["passes"] * r["size"] + sum(s["words"] for s in r["spans"])
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert all(0 <= s["first"] and s["first"] + s["words"] <= r["size"] for s in r["spans"])
    by = defaultdict(int)
    for r in rows:
        by[r["source"], r["target"], r["source_size"]] += r["taken"]
    assert sum(t for _, t, _ in by) == pytest.approx(sum(r["size"] for r in rows))
    # A block per source at most, and one per shard of a source that is taken three times.
    assert all(abs(got - target) <= 4 * (2 + size / 5000) for (_, target, size), got in by.items())
    again = mixing.mix(docs.repartition(5), block_words=4, shard_words=5000).collect()
    assert sorted(r["taken"] for r in rows) == sorted(r["taken"] for r in again)


def test_own_weights(spark):
    docs = documents(spark, ["a b c d e f g h"] * 40, sources=["x"] * 20 + ["y"] * 20)
    weights = spark.createDataFrame([("x", 3.0), ("y", 1.0)], "source string, weight double")
    got = {r["source"]: r["t"] for r in mixing.mix(docs, weights, block_words=2).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    assert got == {"x": 240, "y": 80}


def test_empty(spark):
    assert mixing.mix(documents(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 200), st.integers(0, 200), st.integers(0, 10**6))
def test_spread_picks_the_quota(blocks, picks, offset):
    picks, offset = min(picks, blocks), offset % blocks
    chosen = [((b + 1) * picks + offset) // blocks - (b * picks + offset) // blocks for b in range(blocks)]
    assert sum(chosen) == picks and set(chosen) <= {0, 1}
