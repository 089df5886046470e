"""Queries of the corpus operators over whole tables, with the SQL that states their results."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid
import zipfile

import corpus_pipeline
from panelcast.llm import (
    decontaminate,
    fingerprints,
    jaccard_join,
    language_id,
    mixing,
    ngram_model,
    pii,
    quality_rules,
    spelling_variants,
    substring_dedup,
    token_alignment,
    token_counts,
    web_archives,
)

QUERIES = {
    "op1_mix_sources": (mixing.query, mixing.SQL),
    "op2_ngram_score": (ngram_model.query, None),
    "op3_pseudonyms": (pii.query, None),
    "op4_fingerprints": (fingerprints.query, None),
    "op5_web_archives": (web_archives.query, web_archives.SQL),
    "op6_token_counts": (token_counts.query, None),
    "op7_quality_rules": (quality_rules.query, None),
    "op8_language_id": (language_id.query, None),
    "op9_decontaminate": (decontaminate.query, decontaminate.SQL),
    "op10_jaccard_join": (jaccard_join.query, None),
    "op11_token_alignment": (token_alignment.query, None),
    "op12_spelling_variants": (spelling_variants.query, spelling_variants.SQL),
    "op13_substring_dedup": (substring_dedup.query, substring_dedup.SQL),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}


_shipped: set[str] = set()


def ship(spark) -> None:
    """Give the Python workers of a session this package, wherever they run."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    folder = tempfile.mkdtemp(prefix="panelcast-ship-")  # read by Spark's file server until the driver ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, f"panelcast-{uuid.uuid4().hex}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for at, _, names in os.walk(os.path.join(root, "panelcast")):
            for name in names:
                if name.endswith(".py"):
                    out.write(os.path.join(at, name), os.path.relpath(os.path.join(at, name), root))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def _shipping(run):
    @functools.wraps(run)
    def query(spark, sf_dir):
        ship(spark)
        return run(spark, sf_dir)

    return query


def queries():
    return {name: _shipping(run) for name, (run, _) in QUERIES.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in QUERIES.items() if sql}
