"""Alignment of the tokens of two vocabularies, and how often ids of one go with ids of the other.

Both tokenizers cut the same bytes. All tokens of A and B are sorted by start (``lexsort``), their ends are run through
``maximum.accumulate``, and a group ends where the next start reaches the running maximum: there both have a token end.
Within a group every A token is linked with every B token.

How many documents hold an id pair linked is known only over the whole corpus. Tasks gather documents into blocks, align
them once, and keep each document's distinct pairs as places in the block's list of pairs (written to the shared folder).
A block sends each of its pairs once to the shard of the pair, with the number of its documents that hold it; the shard
adds these up and answers the block. The highest count of every A id is a vector of the vocabulary's length, the only
thing that is broadcast.

Defined cases: texts that are null, empty, or whose joined token bytes differ from a blank and the text in one of the two
vocabularies have no tokens and no groups; special strings inside texts are plain text; repeated rows are documents of
their own; ids may be null or repeated, they are only carried; an empty table gives an empty result. A large group is
expanded by its distinct ids with their counts, never by its tokens.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.blocks import batch_of, chunks, masked, pack, scramble, shard_count, shard_of, slices, unpack
from panelcast.llm.store import settle
from panelcast.llm.token_counts import AGREED, byte_of_sign, is_plain_byte_level, read_vocabulary

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Pair places of a block, bytes of text per shard, links that are expanded at once, and products beyond which a group
#: is expanded by distinct ids.
BLOCK_PAIRS, SHARD_BYTES, EXPANDED, LARGE_GROUP = 1 << 20, 16 << 20, 1 << 22, 256
#: The longest text that is given to the faster library.
FAST_CHARS = 100_000
DOCS, PAIRS, COUNTS, BEST = 0, 1, 2, 3
PACKED = "kind int, block long, shard long, blob binary"
COLUMNS = ["kind", "block", "shard", "blob"]


class Vocabulary:
    """Encodes texts without special tokens; ``token[i]`` are the bytes of id i and ``width[i]`` their number."""

    def __init__(self, kind: str, content: bytes):
        if kind == "sentencepiece":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=content)
            self.encode = lambda texts: model.encode(texts, num_threads=1)
            pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
            self.token = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_str(content.decode())
            tokenizer.encode_special_tokens = True
            library = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ranks = merge_ranks(json.loads(content))
            self.encode = by_ranks(ranks, library) if ranks else lambda texts: library([" " + t for t in texts])
            signs = byte_of_sign()
            special = {t["id"] for t in json.loads(content).get("added_tokens", [])}
            of = {i: t for t, i in tokenizer.get_vocab(with_added_tokens=True).items()}
            # special tokens are never the outcome of plain text
            self.token = [b"" if i in special or i not in of else bytes(signs[c] for c in of[i]) for i in range(max(of) + 1)]
        self.width = np.array([len(t) for t in self.token], np.int64)

    def __len__(self) -> int:
        return len(self.token)


def merge_ranks(spec: dict) -> dict[bytes, int] | None:
    """The ids of the tokens' bytes, if merging the neighbours with the least id first is what the vocabulary does."""
    if not is_plain_byte_level(spec):
        return None
    signs, vocab = byte_of_sign(), spec["model"]["vocab"]
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])):
        return None
    special = {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(signs[c] for c in t): i for t, i in vocab.items() if t not in special}


def by_ranks(ranks: dict[bytes, int], library):
    """Encodes like ``library``, with a faster one where both are known to agree (see the tests).

    They merge alike, as every token of the vocabulary is what its own bytes merge to; they split alike around the code
    points below AGREED. Long texts, which the faster one may refuse, and all others go to the library.
    """
    import public_tokenizers
    import tiktoken

    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    unproven = re.compile(f"[^\\x00-{chr(AGREED - 1)}]").search

    def encode(texts: list[str]) -> list[list[int]]:
        out = [fast(" " + t) if len(t) <= FAST_CHARS and not unproven(t) else None for t in texts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, library([" " + texts[i] for i in rest])):
            out[i] = ids
        return out

    return encode


def decimals(n: int) -> np.ndarray:
    """The decimal digits of 0 .. n-1, a row each, zero bytes in front."""
    return np.array([list(str(i).rjust(len(str(n - 1)), "\0").encode()) for i in range(n)], np.uint8)


class Alignment:
    """The groups of some texts, one after the other.

    ``doc_a`` and ``doc_b`` are the text of every token, ``group_a`` and ``group_b`` its group, ``group_doc`` the text of
    every group, ``starts`` and ``ends`` the bytes of every group in its blank and text.
    """

    def __init__(self, texts: list[str | None], a: Vocabulary, b: Vocabulary):
        ids_a, ids_b, n_a, n_b, kept = [], [], [], [], []
        some = [i for i, t in enumerate(texts) if t]
        given = [texts[i] for i in some]
        for i, text, left, right in zip(some, given, a.encode(given), b.encode(given)):
            whole = b" " + text.encode()
            if b"".join(map(a.token.__getitem__, left)) == whole == b"".join(map(b.token.__getitem__, right)):
                ids_a += left
                ids_b += right
                n_a.append(len(left))
                n_b.append(len(right))
                kept.append(i)
        self.n, self.a, self.b = len(texts), np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        kept = np.array(kept, np.int64)
        self.doc_a, self.doc_b = np.repeat(kept, n_a), np.repeat(kept, n_b)
        # Kept texts have the same length in both, so one running sum places all of them behind each other.
        end_a, end_b = np.cumsum(a.width[self.a]), np.cumsum(b.width[self.b])
        ends = np.concatenate([end_a, end_b])
        starts = np.concatenate([end_a - a.width[self.a], end_b - b.width[self.b]])
        order = np.lexsort((starts,))  # two runs that are in order already
        reached = np.maximum.accumulate(ends[order]) if len(order) else ends
        new = np.ones(len(order), bool)
        new[1:] = starts[order][1:] >= reached[:-1]
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        self.group_a, self.group_b = group[: len(self.a)], group[len(self.a) :]
        groups = int(new.sum())
        self.size_a, self.size_b = np.bincount(self.group_a, minlength=groups), np.bincount(self.group_b, minlength=groups)
        firsts = order[new]
        self.group_doc = np.concatenate([self.doc_a, self.doc_b])[firsts] if groups else np.zeros(0, np.int64)
        self.starts, self.ends = starts[firsts], np.append(starts[firsts][1:], reached[-1:])
        base = np.full(self.n, -1)
        base[self.group_doc[::-1]] = self.starts[::-1]
        self.starts, self.ends = self.starts - base[self.group_doc], self.ends - base[self.group_doc]

    def per_text(self) -> tuple[np.ndarray, ...]:
        """(n_a, n_b, n_groups, n_links) of every text."""
        links = np.bincount(self.group_doc, self.size_a * self.size_b, self.n).astype(np.int64)
        return tuple(np.bincount(x, minlength=self.n) for x in (self.doc_a, self.doc_b, self.group_doc)) + (links,)

    def digests(self, digits_a: np.ndarray, digits_b: np.ndarray) -> list[str]:
        """The hash of every text's groups, written as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        width = max(digits_a.shape[1], digits_b.shape[1]) + 1
        out = np.zeros((len(self.a) + len(self.b), width), np.uint8)
        before_a, before_b = np.cumsum(self.size_a), np.cumsum(self.size_b)
        at_a = np.arange(len(self.a)) + before_b[self.group_a] - self.size_b[self.group_a]
        at_b = np.arange(len(self.b)) + before_a[self.group_b]
        for at, ids, digits, group, doc, mark in (
            (at_a, self.a, digits_a, self.group_a, self.doc_a, b"|"),
            (at_b, self.b, digits_b, self.group_b, self.doc_b, b";"),
        ):
            out[at, width - 1 - digits.shape[1] : width - 1] = digits[ids]
            last = np.append(group[1:] != group[:-1], True)[: len(group)]
            closing = np.where(last, mark[0], ord(",")).astype(np.uint8)
            if mark == b";":
                closing[np.append(doc[1:] != doc[:-1], True)[: len(doc)]] = 0
            out[at, width - 1] = closing
        doc = np.empty(len(out), np.int64)
        doc[at_a], doc[at_b] = self.doc_a, self.doc_b
        used = out != 0
        ends = np.cumsum(np.bincount(doc, used.sum(1), self.n).astype(np.int64))
        flat = memoryview(out[used].tobytes())
        return [hashlib.sha256(flat[i:j]).hexdigest() if j > i else "" for i, j in zip([0, *ends[:-1]], ends)]

    def pairs(self, n_ids_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, a * n_ids_b + b, links) of the distinct linked pairs of every text, in this order."""

        def side(ids, group, large):
            """(group, id, occurrences), with the ids of large groups once."""
            big = large[group]
            if not big.any():
                return group, ids, np.ones(len(ids), np.int64)
            both, many = np.unique(group[big] * (1 << 32) + ids[big], return_counts=True)
            groups, all_ids = np.append(group[~big], both >> 32), np.append(ids[~big], both & 0xFFFFFFFF)
            order = np.argsort(groups, kind="stable")
            return groups[order], all_ids[order], np.append(np.ones((~big).sum(), np.int64), many)[order]

        large = self.size_a * self.size_b > LARGE_GROUP
        group_a, a, times_a = side(self.a, self.group_a, large)
        group_b, b, times_b = side(self.b, self.group_b, large)
        many_b = np.bincount(group_b, minlength=len(large))
        first_b = np.cumsum(many_b) - many_b
        repeat = many_b[group_a]
        ends = np.cumsum(repeat)
        keys, times, at = [], [], 0
        while at < len(a):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + EXPANDED, "right")))
            part = slice(at, to)
            r = repeat[part]
            left = np.repeat(np.arange(at, to), r)
            right = np.arange(r.sum()) - np.repeat(np.cumsum(r) - r, r) + np.repeat(first_b[group_a[part]], r)
            key, place = np.unique(self.group_doc[group_a[left]] * (1 << 40) + a[left] * n_ids_b + b[right], return_inverse=True)
            keys.append(key)
            times.append(np.bincount(place, times_a[left] * times_b[right], len(key)).astype(np.int64))
            at = to
        if not keys:
            return (np.zeros(0, np.int64),) * 3
        key, place = np.unique(np.concatenate(keys), return_inverse=True) if len(keys) > 1 else (keys[0], slice(None))
        times = np.bincount(place, np.concatenate(times), len(key)).astype(np.int64) if len(keys) > 1 else times[0]
        return key >> 40, key & ((1 << 40) - 1), times


_made: dict[bytes, Vocabulary] = {}


def vocabulary(given: tuple[str, bytes]) -> Vocabulary:
    """The vocabulary of a worker, made once."""
    if given[1] not in _made:
        _made[given[1]] = Vocabulary(*given)
    return _made[given[1]]


def _read(spark, a_path: str, b_path: str):
    return spark.sparkContext.broadcast((read_vocabulary(a_path), read_vocabulary(b_path)))  # fixed files


def align_tokens(docs: DataFrame, a_path: str, b_path: str, out: str = "groups") -> DataFrame:
    """``docs`` (with ``text``) and the groups of every text: start and end in the bytes of a blank and the text, a ids, b ids."""
    given = _read(docs.sparkSession, a_path, b_path)
    group = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))])
    kind = "array<struct<start: long, end: long, a: array<int>, b: array<int>>>"
    if out in docs.columns:
        raise ValueError(f"there is a column {out} already")

    def run(batches):
        a, b = map(vocabulary, given.value)
        for batch in batches:
            parts = []
            for (texts,) in chunks([batch], ["text"]):
                one = Alignment(texts, a, b)
                lists = [
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(ids, pa.int32()))
                    for size, ids in ((one.size_a, one.a), (one.size_b, one.b))
                ]
                rows = pa.StructArray.from_arrays([pa.array(one.starts), pa.array(one.ends), *lists], fields=list(group))
                ends = np.append(0, np.cumsum(np.bincount(one.group_doc, minlength=one.n)))
                parts.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows))
            yield batch.append_column(out, pa.concat_arrays(parts) if parts else pa.array([], pa.list_(group)))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, `{out}` {kind}")


def _blocks(docs: DataFrame, given, shards: int) -> DataFrame:
    """Packed rows: DOCS of a block, and the block's distinct PAIRS for each shard."""

    def flush(block, docs, pairs, n_ids_b):
        ids, missing, numbers, hashes = (np.concatenate(x) for x in zip(*docs))
        many, codes, times = (np.concatenate(x) for x in zip(*pairs))
        distinct, place, holders = np.unique(codes, return_inverse=True, return_counts=True)
        hashed = scramble(distinct)
        order = np.argsort(hashed)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        distinct, holders, hashed = distinct[order], holders[order], hashed[order]
        blob = pack(ids, missing, numbers.reshape(-1), hashes.reshape(-1), many, rank[place].astype(np.uint32), times, distinct // n_ids_b)
        yield batch_of(COLUMNS, pa.array([DOCS], pa.int32()), [block], [-1], [blob])
        for shard, part in slices(shard_of(hashed, shards)):
            yield batch_of(COLUMNS, pa.array([PAIRS], pa.int32()), [block], [shard], [pack(distinct[part], holders[part])])

    def run(batches):
        from pyspark import TaskContext

        a, b = map(vocabulary, given.value)
        digits = decimals(len(a)), decimals(len(b))
        block, docs, pairs, size = TaskContext.get().partitionId() << 32, [], [], 0
        for ids, texts in chunks(batches, ["doc_id", "text"]):
            one = Alignment(texts, a, b)
            doc, code, times = one.pairs(len(b))
            digest = b"".join(bytes.fromhex(h) if h else bytes(32) for h in one.digests(*digits))
            digest = np.frombuffer(digest, np.uint8).reshape(-1, 32)
            docs.append((*masked(ids), np.stack(one.per_text(), 1), digest))
            pairs.append((np.bincount(doc, minlength=one.n), code, times))
            size += len(code)
            if size >= BLOCK_PAIRS:
                yield from flush(block, docs, pairs, len(b))
                block, docs, pairs, size = block + 1, [], [], 0
        if docs:
            yield from flush(block, docs, pairs, len(b))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PACKED)


def _totals(packed: DataFrame, n_ids_b: int) -> DataFrame:
    """COUNTS of a block's pairs for each shard, in the order sent, and per shard the BEST count of its A ids."""

    def run(table: pa.Table) -> pa.Table:
        blocks, shard = table.column("block").to_pylist(), table.column("shard")[0].as_py()
        sent = [unpack(x.as_py()) for x in table.column("blob")]
        codes, holders = (np.concatenate(x) for x in zip(*sent))
        distinct, place = np.unique(codes, return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, place, holders)
        a, first = np.unique(distinct // n_ids_b, return_index=True)
        answers, at = [pack(a, np.maximum.reduceat(total, first))], 0
        for codes, _ in sent:
            answers.append(pack(total[place[at : at + len(codes)]]))
            at += len(codes)
        kinds = pa.array([BEST] + [COUNTS] * len(blocks), pa.int32())
        return pa.table([kinds, pa.array([-1, *blocks], pa.int64()), pa.array([shard] * len(answers), pa.int64()), pa.array(answers)], COLUMNS)

    return packed.where(F.col("kind") == PAIRS).groupBy("shard").applyInArrow(run, PACKED)


def _rows_of(kind: int, names: list[str], types: str):
    """Unpack the arrays of packed rows into columns."""

    def run(batches):
        for batch in batches:
            for blob in batch.column("blob"):
                yield batch_of(names, *[pa.array(x, pa.int64()) for x in unpack(blob.as_py())])

    return lambda packed: packed.where(F.col("kind") == kind).select("blob").mapInArrow(run, types)


def linked_ids(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(a, b, documents): how many documents hold each pair of ids linked."""
    given = _read(docs.sparkSession, a_path, b_path)
    n_ids_b = len(Vocabulary(*given.value[1]))
    packed = _blocks(docs, given, shard_count(docs, SHARD_BYTES))
    pairs = _rows_of(PAIRS, ["code", "n"], "code long, n long")(packed)
    pairs = pairs.groupBy("code").agg(F.sum("n").alias("documents"))
    return pairs.select(F.floor(F.col("code") / n_ids_b).cast("int").alias("a"), (F.col("code") % n_ids_b).cast("int").alias("b"), "documents")


def alignment_statistics(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document the numbers of its tokens, groups and links, and how common its links are in the corpus.

    ``n_best`` are the links whose pair is (also) the most frequent one of its A id, ``count_sum`` adds up the pair
    counts of all links, ``groups_sha256`` is the hash of the written groups.
    """
    given = _read(docs.sparkSession, a_path, b_path)
    n_ids_a, n_ids_b = (len(Vocabulary(*g)) for g in given.value)
    packed = settle(_blocks(docs, given, shard_count(docs, SHARD_BYTES)), "alignment-blocks")
    totals = settle(_totals(packed, n_ids_b), "alignment-totals")
    highest = _rows_of(BEST, ["a", "n"], "a long, n long")(totals).groupBy("a").agg(F.max("n").alias("n"))
    best = np.zeros(n_ids_a, np.int64)
    for row in highest.collect():  # as many rows as the vocabulary has ids, at most
        best[row["a"]] = row["n"]
    best = docs.sparkSession.sparkContext.broadcast(best)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def finish(table: pa.Table) -> pa.Table:
        kinds, blobs = table.column("kind").to_pylist(), table.column("blob")
        own = unpack(blobs[kinds.index(DOCS)].as_py())
        ids, missing, numbers, hashes, many, place, times, a = own
        answers = sorted((s, i) for i, (k, s) in enumerate(zip(kinds, table.column("shard").to_pylist())) if k == COUNTS)
        count = np.concatenate([np.zeros(0, np.int64), *[unpack(blobs[i].as_py())[0] for _, i in answers]])
        owner = np.repeat(np.arange(len(many)), many)
        numbers, n = numbers.reshape(-1, 4), len(ids)
        is_best = count == best.value[a]
        n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(n_best, owner, times * is_best[place])
        np.add.at(count_sum, owner, times * count[place])
        digests = [bytes(h).hex() if t else "" for h, t in zip(hashes.reshape(-1, 32), numbers[:, 0] + numbers[:, 1])]
        return pa.table([pa.array(ids, pa.int64(), mask=missing), *numbers.T, n_best, count_sum, pa.array(digests, pa.string())], names)

    rows = packed.where(F.col("kind") == DOCS).unionByName(totals.where(F.col("kind") == COUNTS))
    schema = ", ".join(f"{c} {'string' if c == 'groups_sha256' else 'long'}" for c in names)
    return rows.groupBy("block").applyInArrow(finish, schema)


def query(spark, sf_dir):
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return alignment_statistics(docs, public_tokenizers.path(FIRST), public_tokenizers.path(SECOND))
