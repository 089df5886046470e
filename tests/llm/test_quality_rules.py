import math
import random

import pytest
from helpers import documents, odd_texts
from pyspark.sql import functions as F

from panelcast.llm import quality_rules as q


def corpus(n=400):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    texts, marks = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 90))]
        bad = i % 4 == 0
        texts.append(" ".join(w.upper() + "!!" for w in words) if bad else " ".join(words) + ".")
        marks.append(0 if bad else 1)
    return texts, marks


@pytest.fixture(scope="module")
def trained(spark):
    texts, marks = corpus()
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, m) for i, m in enumerate(marks)] + [(10_000, 1), (3, None)], "doc_id long, quality int")
    return docs, labels, marks, q.fit_contract(docs, labels)


def test_held_out_accuracy(trained):
    docs, _, marks, model = trained
    rows = q.score(docs.withColumn("out", q.held_out(F.col("doc_id"))), model).where("out").collect()
    assert len(rows) > 40
    assert all((r["score"] >= q.THRESHOLD) == bool(marks[r["doc_id"]]) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_the_rules_are_few_and_reproducible(trained):
    docs, labels, _, model = trained
    assert 0 < len(model.weighted) < 60
    assert q.fit_contract(docs.repartition(7), labels.repartition(3)) == model


def test_expression_agrees_with_plain_python(spark, trained):
    docs, _, _, model = trained
    texts = [t for t in odd_texts()]
    got = {r["doc_id"]: r["score"] for r in q.score(documents(spark, texts), model).collect()}
    for i, text in enumerate(texts):
        s = dict(zip(q.STATISTICS, q.statistics(text)))
        total = model.intercept + sum(w for r, w in model.weighted if all(lo < s[n] <= hi for n, lo, hi in r.bounds))
        assert got[i] == pytest.approx(1 / (1 + math.exp(-total)))


def test_keep_good_and_columns(trained):
    docs, labels, marks, _ = trained
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, m in enumerate(marks) if m}


def test_one_class_or_none(spark):
    docs = documents(spark, ["a b", "c d", None])
    labels = spark.createDataFrame([(0, 1), (1, 1)], "doc_id long, quality int")
    assert {r["score"] for r in q.score(docs, q.fit(docs, labels)).collect()} == {0.75}
    assert {r["score"] for r in q.score(docs, q.fit(docs, labels.where("false"))).collect()} == {0.5}
    assert q.score(documents(spark, []), q.fit(docs, labels)).count() == 0


def test_sample_is_bounded(spark):
    docs = documents(spark, [f"text {i}" for i in range(300)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    n = q.labelled_statistics(docs, labels, "quality", 50).count()
    assert 20 < n < 90
    assert q.labelled_statistics(docs, labels, "quality", 5000).count() == 300
