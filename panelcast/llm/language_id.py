"""Language identification of web pages by Bayesian fusion of evidence.

Four sources speak about a page: the likelihood of its text under byte-trigram models learned from labelled documents,
the language its markup declares, the suffix of its address, and a prior of its host. The text's own posterior says how
much each page counts for each language; from these shares, grouped sums give the chance of a declaration and of a
suffix under each language, and hierarchically smoothed priors: all pages, then the domain, then the host, each
shrunk towards the level above with ``strength`` pages. A page never counts towards its own prior.

Sums are taken per group with partial sums first, so a host with a third of all pages is one row per task. The driver
learns the text model, TRIGRAMS numbers per language.

Defined cases: null markup is empty text, which says nothing; a page without declaration or address counts as declaring
nothing, as having no host; equal posteriors go to the first language by name; without labelled documents the language
is ``und`` with probability 1; repeated rows and further columns do not matter; empty tables give an empty result.
"""

from __future__ import annotations

import html
import re
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.store import settle

TRIGRAMS, LANES = 1 << 14, 256
#: Trigrams overlap, so each counts this much only; pages that a prior level weighs; pseudo-counts of a likelihood.
TEMPER, STRENGTH, SMOOTHING = 0.2, 5.0, 1.0

# No pattern runs past the next "<", and attribute names are tried where they begin: one pass, whatever the page.
_OPEN = re.compile(r"(?i)<!--|<(script|style)\b")
_CLOSE = {"": re.compile("-->"), "script": re.compile(r"(?i)</script(?=[\s>])\s*>?"), "style": re.compile(r"(?i)</style(?=[\s>])\s*>?")}
_TAG = re.compile(r"<[^<>]*>")
_ROOT_OR_META = re.compile(r"(?i)<(html|meta)\b([^<>]*)")
_ATTRIBUTE = re.compile(r"""(?<![\w:-])([\w:-]+)\s*=\s*(?:"([^"]*)|'([^']*)|([^\s"'>]+))""")
_PRIMARY = re.compile(r"\s*([A-Za-z]{2,3})(?![A-Za-z0-9_])")


def without_hidden(markup: str) -> str:
    """The page without comments, scripts and styles; one that is never closed hides nothing."""
    out, at, endless = [], 0, set()
    for opened in _OPEN.finditer(markup):
        kind = (opened[1] or "").lower()
        if opened.start() < at or kind in endless:
            continue
        closed = _CLOSE[kind].search(markup, opened.end())
        if closed is None:
            endless.add(kind)
            continue
        out += [markup[at : opened.start()], " "]
        at = closed.end()
    return "".join(out) + markup[at:]


def visible_text(markup: str | None) -> str:
    return html.unescape(_TAG.sub(" ", without_hidden(markup or "")))


def declared_language(markup: str | None) -> str:
    """Primary language tag of the root element, or else of the first meta element that has one; empty without."""
    meta, rooted = "", False
    for tag in _ROOT_OR_META.finditer(markup or ""):
        is_root = tag[1].lower() == "html"
        if is_root and rooted or not is_root and meta:
            continue
        values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(tag[2])}
        if is_root:
            rooted = True
            found = _PRIMARY.match(values.get("xml:lang", "")) or _PRIMARY.match(values.get("lang", ""))
            if found:
                return found[1].lower()
        elif {values.get("name", "").lower(), values.get("http-equiv", "").lower()} & {"language", "content-language"}:
            found = _PRIMARY.match(values.get("content", ""))
            meta = found[1].lower() if found else ""
    return meta


def address_parts(url: str | None) -> tuple[str, str, str]:
    """(host, domain, suffix)."""
    try:
        host = (urlsplit(url or "").hostname or "").rstrip(".").lower()
    except ValueError:
        host = ""
    labels = host.split(".")
    return host, ".".join(labels[-2:]), labels[-1]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(slot, text index) of the byte trigrams of lower-cased texts; runs of blanks are one."""
    raw = [" ".join(t.lower().split()).encode("utf-8", "replace") for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    joined = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    if len(joined) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (joined[:-2] << 16 | joined[1:-1] << 8 | joined[2:]) * np.uint32(0x9E3779B1)
    owner = np.repeat(np.arange(len(raw)), sizes)
    inside = owner[:-2] == owner[2:]
    return (code >> np.uint32(18)).astype(np.int64)[inside], owner[:-2][inside]


def _pieces(texts: list, size: int = 1 << 20):
    """Index ranges of at most ``size`` characters (or one text)."""
    begin = total = 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= size or i + 1 == len(texts):
            yield begin, i + 1
            begin, total = i + 1, 0


def learn_text_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages by name, log probability by slot and language) from all rows of ``docs`` (text, lang)."""

    def count(batches):
        from pyspark import TaskContext

        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for begin, end in _pieces(texts):
                slot, owner = trigrams([t or "" for t in texts[begin:end]])
                names = sorted(set(langs[begin:end]))
                number = np.array([names.index(x) for x in langs[begin:end]])[owner]
                counts = np.bincount(number * TRIGRAMS + slot, minlength=len(names) * TRIGRAMS).reshape(-1, TRIGRAMS)
                for name, row in zip(names, counts):
                    totals[name] = totals.get(name, 0) + row
        lane = TaskContext.get().partitionId() % LANES
        for name, row in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([lane]), pa.array([row.astype(np.int64).tobytes()])], ["lang", "lane", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b.as_py(), np.int64) for b in table.column("counts"))
        return pa.table({"lang": table.column("lang")[:1], "lane": table.column("lane")[:1], "counts": pa.array([total.tobytes()])})

    schema = "lang string, lane long, counts binary"
    parts = docs.where("lang IS NOT NULL").select("lang", "text").mapInArrow(count, schema)
    parts = parts.groupBy("lang", "lane").applyInArrow(add, schema).groupBy("lang").applyInArrow(add, schema)
    rows = sorted(parts.collect(), key=lambda r: r["lang"])  # one row of fixed size per language
    counts = np.array([np.frombuffer(r["counts"], np.int64) for r in rows], np.float64).reshape(-1, TRIGRAMS)
    return [r["lang"] for r in rows], np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * TRIGRAMS)).T


def evidence(pages: DataFrame, languages: list[str], table: np.ndarray, temper: float = TEMPER) -> DataFrame:
    """Per page: id, host, domain, suffix, declared language, tempered log likelihoods and the text's own shares."""
    given = pages.sparkSession.sparkContext.broadcast(table)
    schema = "page_id long, host string, domain string, suffix string, declared string, loglik array<double>, share array<double>"

    def run(batches):
        table = given.value
        for batch in batches:
            ids, urls, marks = (batch.column(c).to_pylist() for c in ("page_id", "url", "html"))
            for begin, end in _pieces(marks):
                texts = [visible_text(m) for m in marks[begin:end]]
                slot, owner = trigrams(texts)
                loglik = np.zeros((len(texts), len(languages)))
                for k in range(len(languages)):
                    loglik[:, k] = temper * np.bincount(owner, table[slot, k], len(texts))
                loglik -= loglik.max(1, keepdims=True)
                share = np.exp(loglik)
                share /= share.sum(1, keepdims=True)
                host, domain, suffix = zip(*(address_parts(u) for u in urls[begin:end]))
                declared = [declared_language(m) for m in marks[begin:end]]
                columns = [pa.array(ids[begin:end], pa.int64()), *map(pa.array, (host, domain, suffix, declared)), pa.array(loglik.tolist()), pa.array(share.tolist())]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(run, schema)


def _sums(rows: DataFrame, key: str, n: int) -> DataFrame:
    """``_key, pages, sums``: how much the pages of each group count for each language."""
    each = [F.sum(F.col("share")[k]).alias(f"_{k}") for k in range(n)]
    return rows.groupBy(F.col(key).alias(f"_{key}")).agg(F.count(F.lit(1)).alias(f"{key}_pages"), *each).select(
        f"_{key}", f"{key}_pages", F.array(*[f"_{k}" for k in range(n)]).alias(f"{key}_sums")
    )


def identify(pages: DataFrame, docs: DataFrame, strength: float = STRENGTH, smoothing: float = SMOOTHING) -> DataFrame:
    """Per row of ``pages`` (page_id, url, html): ``page_id, lang, probability, text_lang, declared, host, posterior``."""
    languages, table = learn_text_model(docs)
    if not languages:
        languages, table = ["und"], np.zeros((TRIGRAMS, 1))
    n = len(languages)
    rows = settle(evidence(pages, languages, table), "language-evidence")
    total = rows.agg(F.count(F.lit(1)).alias("pages"), *[F.sum(F.col("share")[k]).alias(f"s{k}") for k in range(n)]).first()
    pages_all = max(total["pages"], 1)
    mass = [float(total[f"s{k}"] or 0.0) for k in range(n)]
    overall = F.array(*[F.lit((m + 1.0 / n) / (pages_all + 1.0)) for m in mass])
    for key in ("host", "domain", "suffix", "declared"):
        sums = settle(_sums(rows, key, n), f"language-{key}")
        rows = rows.join(sums, F.col(key) == F.col(f"_{key}")).drop(f"_{key}")

    def prior(key, above):
        """Shares of the other pages of the group, shrunk towards the level above."""
        others = F.zip_with(f"{key}_sums", "share", lambda s, own: F.greatest(s - own, F.lit(0.0)))
        return F.zip_with(others, above, lambda s, a: (s + strength * a) / (F.col(f"{key}_pages") - 1 + strength))

    def likelihood(key):
        """Chance of the page's declaration or suffix under each language, from the other pages."""
        others = F.zip_with(f"{key}_sums", "share", lambda s, own: F.greatest(s - own, F.lit(0.0)))
        rate = F.col(f"{key}_pages") / F.lit(float(pages_all))
        return F.zip_with(others, F.array(*map(F.lit, mass)), lambda s, m: (s + smoothing * rate) / (m + smoothing))

    rows = rows.withColumn("_domain_prior", prior("domain", overall)).withColumn("_prior", prior("host", F.col("_domain_prior")))
    rows = rows.withColumn("_declared", likelihood("declared")).withColumn("_suffix", likelihood("suffix"))
    log = lambda c: F.transform(c, lambda x: F.log(x))
    fused = F.col("loglik")
    for part in ("_prior", "_declared", "_suffix"):
        fused = F.zip_with(fused, log(F.col(part)), lambda a, b: a + b)
    rows = rows.withColumn("_log", fused).withColumn("_most", F.array_max("_log"))
    weights = F.transform("_log", lambda x: F.exp(x - F.col("_most")))
    rows = rows.withColumn("_weights", weights)
    rows = rows.withColumn("_sum", F.aggregate("_weights", F.lit(0.0), lambda a, x: a + x))
    names = F.array(*map(F.lit, languages))
    best = lambda c: F.element_at(names, F.array_position(c, F.array_max(c)).cast("int"))
    return rows.select(
        "page_id",
        best(F.col("_weights")).alias("lang"),
        (F.lit(1.0) / F.col("_sum")).alias("probability"),
        F.when(F.size(F.array_distinct("share")) > 1, best(F.col("share"))).alias("text_lang"),
        F.when(F.col("declared") != "", F.col("declared")).alias("declared"),
        F.when(F.col("host") != "", F.col("host")).alias("host"),
        F.map_from_arrays(names, F.transform("_weights", lambda w: w / F.col("_sum"))).alias("posterior"),
    )


def query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(pages, docs).select("page_id", "lang", "probability", "text_lang", "declared", "host")
