import public_tokenizers
import pytest
from helpers import documents, odd_texts
from tokenizers import Tokenizer

from panelcast.llm import token_counts as t

PATH = public_tokenizers.path(t.VOCABULARY)
EXTRA = [
    "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext|>", "  \n\n  x \t y's 'll IT'S 'LL", "日本語 テキスト 123 ①②", " a　b \x85 \x1c c", "é՘ 1 ࢏x",
    "tab\tnew\r\nline  ", "don't we'll I'd", "1234567 12,345.67", "👍🏽 emoji 👨‍👩‍👧", "՘֋꟎ mixed", "ﬁ ﬀ ǅ ʰ", "<|endoftext", "|endoftext|>",
]


@pytest.fixture(scope="module")
def counter():
    kind, content = t.read_vocabulary(PATH)
    return t.TokenCounter(kind, content, t.whole_tokens(content))


def library(path=PATH):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_every_proven_code_point_splits_like_the_library(counter):
    assert all(counter.agrees(chr(c)) for c in range(t.AGREED))
    assert not counter.agrees("՘")


def test_whole_tokens_are_single():
    kind, content = t.read_vocabulary(PATH)
    whole = t.whole_tokens(content)
    one = library()
    assert len(whole) > 45_000 and all(one(s) == 1 for s in whole[::97])


@pytest.mark.parametrize("text", odd_texts() + EXTRA)
def test_counts(counter, text):
    assert (counter.count(text) if text else 0) == library()(text)


def test_forgetting_changes_nothing(counter, monkeypatch):
    monkeypatch.setattr(t, "REMEMBERED", 3)
    text = " ".join(f"zq{i}x{i}" for i in range(500))
    fresh = t.TokenCounter(*t.read_vocabulary(PATH), t.whole_tokens(t.read_vocabulary(PATH)[1]))
    assert fresh.count(text) == library()(text) and len(fresh._costs) <= fresh._costs.whole + 3


def test_documents(spark):
    texts = odd_texts() + EXTRA
    docs = documents(spark, texts)
    got = {r["doc_id"]: r["n_tokens"] for r in t.count_tokens(docs, PATH).collect()}
    assert got == {i: library()(x) for i, x in enumerate(texts)}
    assert t.count_tokens(documents(spark, []), PATH).count() == 0


def test_other_vocabularies(spark):
    docs = documents(spark, EXTRA + odd_texts()[:6])
    words = public_tokenizers.path("word_bpe_49k.json")
    one = library(words)
    got = {r["doc_id"]: r["n_tokens"] for r in t.count_tokens(docs, words).collect()}
    assert got == {i: one(x) for i, x in enumerate(EXTRA + odd_texts()[:6])}
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    pieces = sentencepiece.SentencePieceProcessor(model_file=model)
    got = {r["doc_id"]: r["n_tokens"] for r in t.count_tokens(docs, model).collect()}
    assert got == {i: len(pieces.encode(x)) if x else 0 for i, x in enumerate(EXTRA + odd_texts()[:6])}
