"""Token counts of a byte-level BPE vocabulary without merging most words.

Offline, on the driver, every vocabulary string is encoded alone; the strings that come back as their own single token
form the whole-token set (bounded by the vocabulary file) and are broadcast. A worker splits texts into pre-tokens,
counts one for each pre-token of the set and merges only the others, each distinct one once.

The split must be the library's. Code points below AGREED are tested as a block by the tests; any other one is tried
in the library when it first occurs, and a text with one that the two split differently is counted by the library
whole. Vocabularies with normalisers, prefix blanks or unknown pre-tokenizers, and sentencepiece models, are always
counted by the library.

Defined cases: null texts count as empty, with 0 tokens; special strings inside texts are single tokens, as the
library has it by default; nothing is added, truncated or padded; repeated rows and further columns do not matter.
"""

from __future__ import annotations

import json
import re

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Below this code point the pre-token pattern and the library agree on every character (see the tests).
AGREED = 0x558
#: Distinct merged pre-tokens a worker remembers (about 100 MB); when full it forgets them and goes on.
REMEMBERED = 500_000
VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024


def read_vocabulary(path: str) -> tuple[str, bytes]:
    with open(path, "rb") as f:
        return ("sentencepiece" if path.endswith(".model") else "tokenizers"), f.read()


def is_plain_byte_level(spec: dict) -> bool:
    split = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and split.get("type") == "ByteLevel"
        and not split.get("add_prefix_space")
        and split.get("use_regex", True)
        and spec["model"]["type"] == "BPE"
        and spec["model"].get("dropout") is None
        and all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec.get("added_tokens", []))
    )


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(printable)]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def whole_tokens(content: bytes) -> list[str]:
    """The strings of the vocabulary that the library encodes, alone, as the one token they name."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content.decode())
    signs, strings = byte_of_sign(), []
    special = {t["content"] for t in json.loads(content).get("added_tokens", [])}
    for token, number in tokenizer.get_vocab(with_added_tokens=False).items():
        if token in special or not all(c in signs for c in token):
            continue
        try:
            strings.append((bytes(signs[c] for c in token).decode("utf-8"), number))
        except UnicodeDecodeError:  # part of a character: never a pre-token
            continue
    encoded = tokenizer.encode_batch([s for s, _ in strings], add_special_tokens=False)
    return [s for (s, number), e in zip(strings, encoded) if e.ids == [number]]


class _Costs(dict):
    """Tokens per pre-token; merges a new one when it is asked for."""

    def __init__(self, whole: list[str], encode):
        super().__init__(dict.fromkeys(whole, 1))
        self.whole, self.encode = len(whole), encode

    def __missing__(self, piece: str) -> int:
        cost = len(self.encode(piece, add_special_tokens=False).ids)
        if len(self) >= self.whole + REMEMBERED:
            kept = list(self.items())[: self.whole]
            self.clear()
            self.update(kept)
        self[piece] = cost
        return cost


class TokenCounter:
    def __init__(self, kind: str, content: bytes, whole: list[str] | None):
        if kind == "sentencepiece":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=content)
            self.count = lambda text: len(model.encode(text, num_threads=1))
            return
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(content.decode())
        self._library = lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)
        if whole is None:
            self.count = self._library
            return
        import public_tokenizers

        self._pieces = regex.compile(public_tokenizers.PATTERN).findall
        self._unproven = re.compile(f"[^\\x00-{chr(AGREED - 1)}]").findall
        specials = [t["content"] for t in json.loads(content).get("added_tokens", []) if t["content"]]
        self._special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True)))) if specials else None
        self._split = tokenizer.pre_tokenizer.pre_tokenize_str
        self._agrees: dict[str, bool] = {}
        self._costs = _Costs(whole, tokenizer.encode)
        self.count = self._count

    def agrees(self, sign: str) -> bool:
        """Whether the library and the pattern split text around a character alike."""
        known = self._agrees.get(sign)
        if known is None:
            probe = f"a{sign}1{sign}! {sign}{sign} a{sign}"
            known = self._agrees[sign] = [probe[a:b] for _, (a, b) in self._split(probe)] == self._pieces(probe)
        return known

    def _count(self, text: str) -> int:
        if not all(map(self.agrees, set(self._unproven(text)))):
            return self._library(text)
        parts, n = [text], 0
        if self._special and self._special.search(text):
            parts = self._special.split(text)
            n = len(parts) - 1
        costs = self._costs
        for part in parts:
            n += sum([costs[p] for p in self._pieces(part)])
        return n


_made: dict[bytes, TokenCounter] = {}


def token_count(spark: SparkSession, path: str):
    """A function from a text column to its number of tokens, by the vocabulary at ``path`` (read on the driver)."""
    kind, content = read_vocabulary(path)
    plain = kind == "tokenizers" and is_plain_byte_level(json.loads(content))
    given = spark.sparkContext.broadcast((kind, content, whole_tokens(content) if plain else None))

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        counter = _made.get(given.value[1])
        if counter is None:
            counter = _made[given.value[1]] = TokenCounter(*given.value)
        return texts.map(lambda t: counter.count(t) if t else 0)

    return count


def count_tokens(docs: DataFrame, path: str, out: str = "n_tokens") -> DataFrame:
    """``docs`` (with ``text``) and the number of tokens of every whole text."""
    return docs.withColumn(out, token_count(docs.sparkSession, path)("text"))


def query(spark, sf_dir):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path(VOCABULARY))
    return counted.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > LIMIT).alias("over_limit"),
    )
