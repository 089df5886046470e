import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from helpers import documents, odd_texts, write_tables
from tokenizers import Tokenizer

from panelcast.llm import token_alignment as t
from panelcast.llm.token_counts import byte_of_sign, read_vocabulary

A, B = public_tokenizers.path(t.FIRST), public_tokenizers.path(t.SECOND)
EXTRA = [
    "a<|endoftext|> b </s><s><unk>", "  two  blanks   three", "ends with blanks   ", "\ttab\nline\r\n", "日本語 テキスト 👍🏽 ①②", "a▁b keeps no bytes",
    " " * 3000 + "x" + " " * 3001, "ab" * 2000, "x" + "ab" * 2000 + "👍" * 300, "É" * 700, "\x00 null \x7f", "same text", "same text",
]


def plain_groups(text, first, second, pieces):
    """The groups of one text, token by token."""
    signs, names = byte_of_sign(), {i: s for s, i in first.get_vocab().items()}
    if not text:
        return []
    whole = b" " + text.encode()
    left = [(i, bytes(signs[c] for c in names[i])) for i in first.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, bytes([int(pieces[i][3:5], 16)]) if second.is_byte(i) else pieces[i].replace("▁", " ").encode()) for i in second.encode(text)]
    if b"".join(x for _, x in left) != whole or b"".join(x for _, x in right) != whole:
        return []

    def cut(tokens):
        at, out = 0, []
        for i, x in tokens:
            at += len(x)
            out.append((at, i))
        return out

    left, right = cut(left), cut(right)
    ends = sorted({e for e, _ in left} & {e for e, _ in right})
    groups, start = [], 0
    for end in ends:
        groups.append(([i for e, i in left if start < e <= end], [i for e, i in right if start < e <= end]))
        start = end
    return groups


def brute_force(ids, texts):
    first, second = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    first.encode_special_tokens = True
    pieces = [second.id_to_piece(i) for i in range(second.get_piece_size())]
    groups = [plain_groups(x, first, second, pieces) for x in texts]
    links = []
    for one in groups:
        found = Counter()
        for a, b in one:
            for i, n in Counter(a).items():
                for j, m in Counter(b).items():
                    found[i, j] += n * m
        links.append(found)
    held = Counter(pair for found in links for pair in found)
    best = {}
    for (i, _), n in held.items():
        best[i] = max(best.get(i, 0), n)
    rows = []
    for doc, one, found in zip(ids, groups, links):
        written = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in one)
        rows.append((
            doc, sum(len(a) for a, _ in one), sum(len(b) for _, b in one), len(one), sum(found.values()),
            sum(n for p, n in found.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in found.items()),
            hashlib.sha256(written.encode()).hexdigest() if one else "",
        ))
    return rows, held, groups


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, *[str(x) for x in r]))


@pytest.mark.parametrize("small", [False, True])
def test_statistics_are_those_of_brute_force(spark, tmp_path, monkeypatch, small):
    if small:  # several blocks, slices of links, and large groups
        monkeypatch.setattr(t, "BLOCK_PAIRS", 50)
        monkeypatch.setattr(t, "EXPANDED", 7)
        monkeypatch.setattr(t, "LARGE_GROUP", 3)
    texts = [x for x in odd_texts() if not x or len(x) < 60_000] + EXTRA
    ids = [None if i % 7 == 3 else i // 2 for i in range(len(texts))]
    expected, held, _ = brute_force(ids, texts)
    folder = write_tables(spark, tmp_path / "in", documents(spark, texts, ids).repartition(3))
    got = t.query(spark, folder)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert order(got.collect()) == order(expected)
    pairs = {(r["a"], r["b"]): r["documents"] for r in t.linked_ids(documents(spark, texts, ids), A, B).collect()}
    assert pairs == dict(held)


def test_groups_and_bytes(spark):
    texts = [x for x in odd_texts() if not x or len(x) < 60_000] + EXTRA
    rows = t.align_tokens(documents(spark, texts), A, B).collect()
    _, _, expected = brute_force(range(len(texts)), texts)
    for row in rows:
        groups = row["groups"]
        assert [(g["a"], g["b"]) for g in groups] == expected[row["doc_id"]]
        if groups:
            assert groups[0]["start"] == 0 and groups[-1]["end"] == 1 + len((row["text"] or "").encode())
            assert all(a["end"] == b["start"] for a, b in zip(groups, groups[1:]))


def test_a_very_long_text_and_empty_tables(spark):
    long = " ".join(f"word{i % 977} tail{i % 13}" for i in range(150_000))
    docs = documents(spark, [long, "short"])
    rows = t.alignment_statistics(docs, A, B).collect()
    one = next(r for r in rows if r["doc_id"] == 0)
    first = Tokenizer.from_file(A)
    assert one["n_a"] == len(first.encode(" " + long).ids) and one["n_groups"] > 150_000
    none = documents(spark, [])
    assert t.alignment_statistics(none, A, B).count() == 0 and t.align_tokens(none, A, B).count() == 0


def test_digits():
    assert [bytes(r).strip(b"\0") for r in t.decimals(12)] == [str(i).encode() for i in range(12)]


def test_token_bytes():
    vocabulary = t.Vocabulary(*read_vocabulary(A))
    assert vocabulary.token[vocabulary.encode(["hello"])[0][0]] == b" hello" and vocabulary.token[50256] == b""
    other = t.Vocabulary(*read_vocabulary(B))
    assert b"".join(other.token[i] for i in other.encode(["é 👍🏽"])[0]) == " é 👍🏽".encode()


def test_the_faster_library_merges_alike():
    """Merging the least rank first, every token is what its bytes merge to: no other merges can occur."""
    import json

    spec = json.loads(read_vocabulary(A)[1])
    ranks = t.merge_ranks(spec)
    signs = byte_of_sign()
    listed = {(bytes(signs[c] for c in a), bytes(signs[c] for c in b)): i for i, (a, b) in enumerate(spec["model"]["merges"])}
    assert len(ranks) == 256 + len(listed)
    for token in ranks:
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            rank, at = min((listed.get(p, len(listed)), i) for i, p in enumerate(zip(parts, parts[1:])))
            assert rank < len(listed), token
            parts[at : at + 2] = [parts[at] + parts[at + 1]]


def test_the_faster_library_splits_alike():
    """Below AGREED, in an encoding that has every part of the probe as a token and so shows where it splits."""
    import tiktoken

    split = Tokenizer.from_file(A).pre_tokenizer.pre_tokenize_str
    for code in range(t.AGREED):
        sign = chr(code)
        probe = f"a{sign}1{sign}! {sign}{sign} a{sign}"
        raw = probe.encode()
        parts = {raw[i:j] for i in range(len(raw)) for j in range(i + 1, len(raw) + 1)} | {bytes([i]) for i in range(256)}
        ranks = {p: i for i, p in enumerate(sorted(parts, key=lambda p: (len(p), p)))}
        shown = tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        back = {i: p for p, i in ranks.items()}
        assert [back[i].decode() for i in shown.encode_ordinary(probe)] == [probe[a:b] for _, (a, b) in split(probe)], code


def test_texts_go_to_the_library_that_can_take_them():
    vocabulary, library = t.Vocabulary(*read_vocabulary(A)), Tokenizer.from_file(A)
    library.encode_special_tokens = True
    texts = EXTRA + [" " * 400_000 + "x", "plain", "࢏ ՘ ՙ", "x" * 300_000]
    assert vocabulary.encode(texts) == [library.encode(" " + x, add_special_tokens=False).ids for x in texts]
