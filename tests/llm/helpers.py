"""Small document tables with the cases every operator must take."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use themselves
        T.StructField("size", T.StringType()),
        T.StructField("class", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("words", T.StringType()),
        T.StructField("found", T.StringType()),
    ]
)
PASSAGE = " ".join(f"w{i}x" for i in range(60))


def documents(spark, texts, ids=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    sources = [f"s{i % 3}" for i in range(len(texts))] if sources is None else sources
    rows = [(i, t, "en", s, len(t or ""), "a", "b", "c", "d", "e") for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, DOCS)


def odd_texts():
    """Null, empty, blank, one word, short, long, repeated and multilingual texts."""
    long = " ".join(f"word{i % 977} tail{i % 13}" for i in range(60_000))
    return [
        None, "", " \t\n ", "one", "two words", PASSAGE, PASSAGE, PASSAGE + " more words here", long, "É é ß 日本語 text",
        "x" * 50_000, "line\nline\nline\n\nlast", PASSAGE.upper(), "a b c d e", "a b c d",
    ]


def write_tables(spark, folder, docs, **others):
    docs.write.parquet(f"{folder}/documents.parquet")
    for name, df in others.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
