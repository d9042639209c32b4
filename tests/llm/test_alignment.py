"""Alignment of two tokenizers against brute force over whole texts, occurrence by occurrence."""

import collections
import hashlib

import numpy as np
import pytest

import __spark_entry__ as entry
from recallspark.llm import alignment
from recallspark.llm.alignment import Memory, align_documents, byte_level, count_links, score_links, token_arrays, tokenizers
from recallspark.llm.storage import stored
from tests.llm.conftest import ODD, SMALL

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TEXTS = ["hello world", " a", "a ", "  ", " ", "\t\nx y", "a▁ b", "▁", "日本 語です", "a\xa0b c", "é é 𝄞", "<s> hi </s> <|endoftext|> <unk> <0x41>",
         "x  y   z", "don't  stop 12345 1 2", "a\x1c b \x85 c", "word " * 3000, "nospace" * 2000, "\x00 \x01", "end\n", "\n\n a\n b", "ab cd ab cd", "​ ﻿ x"]


def token_bytes():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    table = byte_level()

    def of_a(i):
        return bytes(table[c] for c in a.id_to_token(i))

    def of_b(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    return a, b, of_a, of_b


def brute(rows):
    """Per (id, text): n_a, n_b, n_groups, n_links, n_best, count_sum, groups; every token of whole texts by itself."""
    a, b, of_a, of_b = token_bytes()
    docs, counts = [], collections.Counter()
    for doc, text in rows:
        data = (" " + (text or "")).encode()
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        if b"".join(map(of_a, ids_a)) != data or b"".join(map(of_b, ids_b)) != data:
            ids_a, ids_b = [], []
        ends_a = np.cumsum([len(of_a(i)) for i in ids_a]).tolist()
        ends_b = np.cumsum([len(of_b(i)) for i in ids_b]).tolist()
        places_b = {e: j for j, e in enumerate(ends_b)}
        links, groups, at_a, at_b = [], [], 0, 0
        for i, end in enumerate(ends_a):
            if end in places_b:
                j = places_b[end]
                links.append((ids_a[i], ids_b[j]))
                groups.append((ids_a[at_a:i + 1], ids_b[at_b:j + 1]))
                at_a, at_b = i + 1, j + 1
        counts.update(links)
        docs.append((doc, len(ids_a), len(ids_b), links, groups))
    top = collections.Counter()
    for (_, j), n in counts.items():
        top[j] = max(top[j], n)
    out = []
    for doc, n_a, n_b, links, groups in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc, n_a, n_b, len(groups), len(links), sum(counts[p] == top[p[1]] for p in links), sum(counts[p] for p in links),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=repr), counts


def test_runs_give_what_whole_texts_give():
    memory = Memory(tokenizers(A, B))
    a, b, of_a, of_b = token_bytes()
    for _ in range(2):  # learned and remembered
        (ids_a, ends_a), (ids_b, ends_b) = memory.align(TEXTS)
        ids_a, ids_b = ids_a >> 1, ids_b >> 1
        for i, text in enumerate(TEXTS):
            whole = a.encode(" " + text, add_special_tokens=False).ids
            like = b"".join(of_b(j) for j in b.encode(text)) == (" " + text).encode()
            assert ids_a[ends_a[i]:ends_a[i + 1]].tolist() == (whole if like else [])
            assert ids_b[ends_b[i]:ends_b[i + 1]].tolist() == (b.encode(text) if like else [])


def test_query_equals_brute_force(spark, small_texts):
    got = sorted((tuple(r) for r in entry.queries()["op13_alignment"](spark, SMALL).collect()), key=repr)
    assert got == brute(small_texts.items())[0]


def test_odd_rows(spark, odd, none, monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    rows = [(r[0], r[1]) for r in ODD] + [(100 + i, t) for i, t in enumerate(TEXTS)]
    docs = odd.select("doc_id", "text").unionByName(spark.createDataFrame(rows[len(ODD):], "doc_id long, text string"))
    aligned = stored(align_documents(docs, A, B))
    counts = count_links(aligned, A, B)
    expected, pairs = brute(rows)
    assert {(r.a, r.b): r.n for r in counts.collect()} == dict(pairs) and counts.count() == len(pairs)
    assert sorted((tuple(r) for r in score_links(aligned, counts, A, B, digest=True).collect()), key=repr) == expected
    assert align_documents(odd, A, B).count() == len(ODD)
    arrays = {r.doc_id: r for r in token_arrays(aligned).collect()}
    assert arrays[100].a_ids and all(sum(r.a_sizes) == len(r.a_ids) and sum(r.b_sizes) == len(r.b_ids) and len(r.a_sizes) == len(r.b_sizes) for r in arrays.values())
    assert (arrays[106].a_ids, arrays[106].b_sizes) == ([], [])


def test_tokenizer_without_ranked_merges(monkeypatch):
    coder = alignment.Tokenizers(A, B)
    assert coder.ranked is not None
    fast = Memory(coder).align(TEXTS)
    coder.ranked = None
    for (x, x_ends), (y, y_ends) in zip(fast, Memory(coder).align(TEXTS)):
        assert x.tolist() == y.tolist() and x_ends.tolist() == y_ends.tolist()


def test_no_documents(spark, none):
    empty = stored(align_documents(none, A, B))
    assert score_links(empty, count_links(empty, A, B), A, B).count() == 0
