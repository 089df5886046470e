"""Quality classifier: a sparse ensemble of rules over text statistics (Friedman and Popescu 2008).

A small forest is grown on statistics of labelled documents. Every path from a root becomes a rule, the conjunction
of its comparisons; a lasso logistic regression over the rule indicators keeps few of them; the ones it keeps are
compiled into one Spark column expression, so scoring is a projection over the statistics.

The fit reads a hash sample of about ``max_labels`` labelled rows; scoring covers all rows. Only the text enters the
score.

Defined cases: a null text counts as empty, all its statistics are 0; labels that are null are skipped, several labels
of one document all count; with labels of one class only (or none) every score is the smoothed share of ones;
documents may repeat and carry further columns.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.llm.store import settle

#: Labelled rows that the fit reads, about: a hash of the document id draws them.
MAX_LABELS = 20_000
TREES, DEPTH, LASSO = 30, 3, 0.001
THRESHOLD = 0.3

STATISTICS = (
    "words", "word_length", "upper_share", "digit_share", "symbol_share", "stop_share", "shout_share", "bar_share",
    "marked_share", "distinct_share", "top_share", "repeat_share", "line_repeat_share", "words_per_line", "short_share",
    "non_ascii_share",
)


def _of_bytes(*codes) -> np.ndarray:
    table = np.zeros(256)
    table[list(codes)] = 1.0
    return table


_CLASSES = np.stack(
    [
        _of_bytes(*range(65, 91)),
        _of_bytes(*range(97, 123)),
        _of_bytes(*range(48, 58)),
        _of_bytes(*b"#$%&*+<=>@\\^_`{}~"),
        _of_bytes(*b".,;:?"),
        _of_bytes(*b"!"),
        _of_bytes(*b"|"),
        _of_bytes(*range(128, 256)),
        _of_bytes(9, 10, 11, 12, 13, 32),
    ],
    axis=1,
)
_MARKS = tuple(bytes([c]) for c in b"#$%&*!|")


def statistics(text: str | None) -> tuple[float, ...]:
    """The values of STATISTICS for one whole text."""
    raw = (text or "").encode("utf-8", "replace")
    upper, lower, digit, symbol, stop, shout, bar, wide, blank = (
        np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES if raw else np.zeros(9)
    )
    words = raw.split()
    n = len(words) or 1
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    inked = (len(raw) - blank) or 1
    return (
        math.log1p(len(words)),
        (len(raw) - blank) / n,
        upper / ((upper + lower) or 1),
        digit / inked,
        symbol / inked,
        stop / n,
        shout / n,
        bar / n,
        sum(w.endswith(_MARKS) for w in words) / n,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        math.log1p(len(words) / (len(lines) or 1)),
        sum(len(w) <= 2 for w in words) / n,
        wide / inked,
    )


def statistics_of(text: str) -> Column:
    """A struct of the STATISTICS of a text column."""

    @F.pandas_udf(", ".join(f"{s} double" for s in STATISTICS))
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([statistics(t) for t in texts], columns=list(STATISTICS), dtype="float64")

    return run(F.col(text))


@dataclass(frozen=True)
class Rule:
    """A conjunction: ``low < statistic <= high`` for each of ``bounds`` (statistic, low, high)."""

    bounds: tuple[tuple[str, float, float], ...]

    def column(self, at) -> Column:
        tests = []
        for name, low, high in self.bounds:
            if low > -math.inf:
                tests.append(at(name) > F.lit(low))
            if high < math.inf:
                tests.append(at(name) <= F.lit(high))
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


@dataclass(frozen=True)
class RuleEnsemble:
    intercept: float
    weighted: tuple[tuple[Rule, float], ...]

    def score(self, at) -> Column:
        """Probability of label 1; ``at(name)`` gives the column of a statistic."""
        total = F.lit(self.intercept)
        for rule, weight in self.weighted:
            total = total + F.when(rule.column(at), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def rules_of(forest) -> list[Rule]:
    """Every distinct path from a root to a node, as a rule."""
    found: dict[Rule, None] = {}

    def walk(node, bounds: dict[str, tuple[float, float]]) -> None:
        if bounds:
            found[Rule(tuple((s, *bounds[s]) for s in sorted(bounds)))] = None
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, at = STATISTICS[split.featureIndex()], split.threshold()
        low, high = bounds.get(name, (-math.inf, math.inf))
        walk(node.leftChild(), {**bounds, name: (low, min(high, at))})
        walk(node.rightChild(), {**bounds, name: (max(low, at), high)})

    for tree in forest.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found)


def labelled_statistics(docs: DataFrame, labels: DataFrame, label: str, max_labels: int) -> DataFrame:
    """``doc_id, label`` and the statistics of a hash sample of the labelled documents, settled."""
    known = labels.where(F.col(label).isNotNull()).select(F.col("doc_id").alias("__d"), F.col(label).cast("double").alias("label"))
    n = max(known.count(), 1)
    drawn = known.where(F.pmod(F.xxhash64("__d", F.lit(11)), F.lit(n)) < max_labels) if n > max_labels else known
    # About max_labels rows of two numbers: small by construction, so broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("__d"))
    return settle(rows.select("doc_id", "label", statistics_of("text").alias("s")).select("doc_id", "label", "s.*"), "rule-sample")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labels: int = MAX_LABELS, seed: int = 7) -> RuleEnsemble:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id and a 0/1 column)."""
    sample = labelled_statistics(docs, labels, label, max_labels)
    sums = sample.agg(F.count("label").alias("n"), F.sum("label").alias("ones")).first()
    n, ones = sums["n"], sums["ones"] or 0.0
    if ones in (0.0, float(n)):
        share = (ones + 1) / (n + 2)
        return RuleEnsemble(math.log(share / (1 - share)), ())
    rows = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(sample)
    rows = settle(rows.select("doc_id", "label", "features", *STATISTICS).repartition(1).sortWithinPartitions("doc_id", "label"), "rule-rows")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=seed, minInstancesPerNode=5, featureSubsetStrategy="onethird").fit(rows)
    rules = rules_of(forest)
    if not rules:
        share = (ones + 1) / (n + 2)
        return RuleEnsemble(math.log(share / (1 - share)), ())
    marked = rows.select("label", *[r.column(F.col).cast("double").alias(f"r{i}") for i, r in enumerate(rules)])
    marked = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(marked)
    lasso = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, maxIter=100).fit(settle(marked.select("label", "features"), "rule-marks"))
    weighted = tuple((r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w)
    return RuleEnsemble(float(lasso.intercept), weighted)


def score(docs: DataFrame, model: RuleEnsemble, out: str = "score") -> DataFrame:
    """``docs`` (with ``text``) and the score of every row, between 0 and 1."""
    scored = docs.drop(out).withColumn("__statistics", statistics_of("text"))
    return scored.withColumn(out, model.score(lambda s: F.col("__statistics")[s])).drop("__statistics")


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: one fifth by checksum."""
    return F.crc32(doc_id.cast("string")) % 5 == 0


def fit_contract(docs: DataFrame, labels: DataFrame) -> RuleEnsemble:
    return fit(docs, labels.where(~held_out(F.col("doc_id"))))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with their columns."""
    scored = score(docs, fit_contract(docs, labels), "__score")
    return scored.where(F.col("__score") >= threshold).select(*docs.columns)


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_contract(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
