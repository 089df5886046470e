import re

from helpers import PASSAGE, documents, odd_texts
from pyspark.sql import functions as F

from panelcast.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(d.UPPER, d.LOWER)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(texts, items):
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for item, body in items:
            v = words(body)
            size = min(13, len(v))
            for s in range(max(len(v) - 13, 0) + 1 if v else 0):
                for p in range(len(w) - size + 1):
                    if w[p : p + size] == v[s : s + size]:
                        hit |= set(range(p, p + size))
                        found.add("" if item is None else str(item))
        out.append((len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def benchmark(spark, items):
    df = spark.createDataFrame(items, "item_id long, text string")
    return df.withColumn("words", F.lit(1)).withColumn("file", F.lit("x"))


HEAD, MIDDLE = " ".join(PASSAGE.split()[:20]), " ".join(PASSAGE.split()[15:40])
ITEMS = [
    (1, HEAD), (2, "Two  WORDS"), (3, None), (4, "..."), (5, "É é ß"), (1, HEAD), (None, "one"), (12, MIDDLE.upper()),
    (7, "the the the"), (8, "a-b, c! d e"),
]


def test_against_brute_force(spark):
    texts = [t if not t or len(t) < 5000 else t[:3000] for t in odd_texts()]
    texts += ["prefix " + HEAD + " suffix " * 300, "prefix " + HEAD + " suffix " * 420, "the the the the", "É É ß é é SS", "x two, words; y", "A b C d E", None]
    docs = documents(spark, texts)
    got = {r["doc_id"]: r for r in d.contamination(docs, benchmark(spark, ITEMS)).collect()}
    want = brute(texts, ITEMS)
    assert len(got) == len(texts)
    for i, (n, hit, items, bad) in enumerate(want):
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) == (n, hit, items, bad), i
        assert sum(s["end"] - s["first"] for s in r["spans"]) == hit
    kept = {r["doc_id"] for r in d.drop_contaminated(docs, benchmark(spark, ITEMS)).collect()}
    assert kept == {i for i, w in enumerate(want) if not w[3]}


def test_shuffled_windows_agree(spark):
    docs = documents(spark, [PASSAGE, "no", PASSAGE + " one two three"])
    index, _ = d.windows(benchmark(spark, ITEMS))
    rows = lambda most: sorted((r["doc_id"], r["n_words"], len(r["found"])) for r in d.hits(docs, index, most).collect())
    assert rows(0) == rows(10**6)


def test_repeated_rows_and_spans(spark):
    docs = documents(spark, [PASSAGE, PASSAGE, f"a, {HEAD}! b\n{HEAD}"], ids=[1, 1, 2])
    got = d.contamination(docs, benchmark(spark, ITEMS)).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in got} == {1: 2, 2: 1}
    cut = {r["doc_id"]: r["text"] for r in d.remove_spans(docs, benchmark(spark, ITEMS[:1])).collect()}
    assert cut[2] == "a, ! b\n"
    assert words(cut[1]) == PASSAGE.split()[20:]


def test_empty(spark):
    none = benchmark(spark, [(1, "x")]).where("false")
    got = d.contamination(documents(spark, ["a b", None]), none).collect()
    assert [(r["n_hit"], r["items"], r["contaminated"]) for r in got] == [(0, [], False)] * 2
    assert d.contamination(documents(spark, []), benchmark(spark, ITEMS)).count() == 0
