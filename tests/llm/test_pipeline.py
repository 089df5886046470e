import random

import corpus_pipeline
import pytest
from helpers import PASSAGE, documents, write_tables
from pyspark.sql import functions as F

from panelcast.llm import catalogue, pii


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    good = [" ".join(word() for _ in range(rng.randint(60, 120))) + "." for _ in range(300)]
    bad = [" ".join(word().upper() + "!!" for _ in range(50)) for _ in range(80)]
    copy = good[5].replace(" ", "  ", 3)
    near = good[6] + " tail"
    personal = good[7][:200] + " call +1 (743) 555-3824 or 4845168114407329"
    return good + bad + [copy, near, PASSAGE, personal, None, ""]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    texts = corpus()
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 300), 0) for i in range(380)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, PASSAGE), (2, "never in any text of this corpus")], "item_id long, text string")
    return write_tables(spark, tmp_path_factory.mktemp("corpus"), docs, labels=labels, benchmark=benchmark), texts


def test_stages(spark, tables):
    folder, texts = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, ids, step = docs.columns, {}, docs
    for name, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, folder)
        if name != "source_mix":
            assert step.columns == columns
        step = step.cache()
        ids[name] = {r["doc_id"] for r in step.select("doc_id").collect()}
        if name == "personal_data":
            row = step.where("doc_id = 383").first()
            assert "4845168114407329" not in row["text"] and "555-3824" not in row["text"]
            clean = step.where("doc_id = 10").first()
            assert clean["text"] == texts[10]
    assert set(range(300)) <= ids["quality"] and not ids["quality"] & set(range(300, 380))
    assert ids["quality"] - ids["near_duplicates"] == {380, 381}
    assert ids["near_duplicates"] - ids["decontamination"] == {382}
    assert ids["personal_data"] == ids["decontamination"]
    assert ids["source_mix"] <= ids["personal_data"]


def test_run_is_the_stages_in_order(spark, tables):
    folder, texts = tables
    out = corpus_pipeline.run(spark, folder)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "source_mix"]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert rows and all(0 < r["taken"] <= 3 * r["size"] for r in rows.values())
    for i, r in rows.items():
        assert r["text"] == pii.pseudonymise(texts[i], pii.Pseudonyms(pii.DEMO_KEY))[0]
    sums = out.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target")).collect()
    assert all(abs(r["t"] - r["target"]) < 100 for r in sums)


def test_empty_tables(spark, tables, tmp_path):
    folder, _ = tables
    read = lambda t: spark.read.parquet(f"{folder}/{t}.parquet").where("false")
    empty = write_tables(spark, tmp_path / "none", read("documents"), labels=read("labels"), benchmark=read("benchmark"))
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_every_operator_is_registered_once():
    numbers = [int(name[2:].split("_")[0]) for name in catalogue.queries() if name.startswith("op")]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in catalogue.queries()
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())
