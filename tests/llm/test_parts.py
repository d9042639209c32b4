"""The parts that need no Spark: codes, trees, transducers, rules, models."""

import base64
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recallspark.llm import katz, language_mixture, licences, personal_data, simple8b, toxicity
from recallspark.llm.byte_bpe import BytePairs, byte_pairs
from recallspark.llm.jaccard_join import bitmap, folded, links, overlap_bound
from recallspark.llm.storage import pack, unpack
from recallspark.llm.token_files import _gathered, word_encoder
from recallspark.llm.word_sets import shingle_sets, word_hashes

P = pytest.importorskip("public_tokenizers")
LETTERS = " \t\n\x1c\x85\xa0 abcXÉé'strve123,.!?日本語😀́-"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 70_000) | st.integers(0, 1), max_size=300), st.integers(0, 3))
def test_simple8b_round_trip(ids, repeat):
    ids = np.array(ids * (1 + 20 * repeat), dtype=np.uint64)
    words, escaped, offsets = simple8b.encode(ids)
    assert (simple8b.decode(words, escaped) == ids).all()
    blocks = [simple8b.decode_block(words, escaped, offsets, b) for b in range(len(offsets))]
    assert (np.concatenate([*blocks, ids[:0]]) == ids).all()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(-2**40, 2**40), max_size=50))
def test_pack(values):
    values = np.array(values, dtype=np.int64)
    assert (unpack(pack(values), np.int64) == values).all() and (unpack(pack(values, True), np.int64, True) == values).all()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=LETTERS, max_size=60))
def test_byte_bpe_equals_tiktoken(text):
    import tiktoken
    path = P.path("byte_bpe_50k.tiktoken")
    coder = byte_pairs(path, P.PATTERN)
    known = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={}, mergeable_ranks=coder.ranks)
    ids = coder.encode([text])[0].tolist()
    assert ids == known.encode_ordinary(text) and coder.decode(ids) == text.encode()


def test_byte_bpe_long_pieces_and_full_memory(monkeypatch):
    import tiktoken

    from recallspark.llm import byte_bpe
    coder = BytePairs(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    known = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={}, mergeable_ranks=coder.ranks)
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    texts = ["x" * 3000, "é" * 500, "abcabd" * 200, " " * 100, "a b c d e f g", "a b c, d. e f g nt, nt", ""]
    for _ in range(3):
        assert [e.tolist() for e in coder.encode(texts)] == [known.encode_ordinary(t) for t in texts]
    for size in (2, 7, 40):
        piece = bytes(random.Random(size).choices(b"aeinst", k=size))
        assert np.frombuffer(coder.merge_short([piece], 64)[0], "<i4").tolist() == coder.merge_long(piece)


def test_word_tokens_equal_the_library(monkeypatch):
    from recallspark.llm import token_files
    encoder = word_encoder(P.path("word_bpe_49k.json"))
    monkeypatch.setattr(token_files, "REMEMBERED", 5)
    texts = ["", "The the. THE, İSTANBUL ΟΔΟΣ á x\x1cy", "<|endoftext|>foo <|ENDOFTEXT|> it's 12,34. don't",
             "the. the, x y. é. 3. ß ẞ", *[f"newword{chr(97 + i)} Again{chr(97 + i)}." for i in range(20)]]
    for _ in range(2):
        for t in texts:
            assert encoder.encode(pa.array([t]))[0].tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids
    expected = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in [None, *texts]]
    ids, ends = encoder.encode(pa.array([None, *texts]))
    assert [part.tolist() for part in np.split(ids, ends[:-1])] == expected and ends[-1] == len(ids)


def test_ids_are_gathered_in_blocks():
    pool, sizes = np.arange(6, dtype="<u4"), np.array([0, 1, 2, 3])
    index = np.array([3, 0, 1, 2, 2, 0, 3])
    for block in (1, 3, 100):
        assert _gathered(pool, np.cumsum(sizes) - sizes, sizes, index, block).tolist() == [3, 4, 5, 0, 1, 2, 1, 2, 3, 4, 5]


def brute_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \t\nabAÉ\x0b\xa0", max_size=40), min_size=1, max_size=5))
def test_words_and_shingles(texts):
    hashes, offsets = word_hashes(texts)
    assert np.diff(offsets).tolist() == [len(brute_words(t)) for t in texts]
    flat = [w for t in texts for w in brute_words(t)]
    assert len(set(flat)) == len(set(hashes.tolist())) and all((flat[i] == flat[0]) == (hashes[i] == hashes[0]) for i in range(len(flat)))
    for t, s in zip(texts, shingle_sets(texts)):
        w = brute_words(t)
        expected = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
        assert len(s) == len(expected) and (np.diff(s.astype(object)) > 0).all()


def test_bitmaps_bound_the_overlap_from_above():
    rng = np.random.default_rng(3)
    for _ in range(200):
        shared = rng.integers(0, 2**63, rng.integers(0, 400)).astype(np.uint64)
        a = np.unique(np.concatenate((shared, rng.integers(0, 2**63, rng.integers(1, 300)).astype(np.uint64))))
        b = np.unique(np.concatenate((shared, rng.integers(0, 2**63, rng.integers(1, 3000)).astype(np.uint64))))
        rows = folded([bitmap(a), bitmap(b)])
        assert overlap_bound(rows[0], rows[1], len(a), len(b)) >= len(np.intersect1d(a, b))
    assert links(3, 4, 3) and not links(2, 4, 3) and links(1, 1, 1)


PII = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def brute_pii(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(*m.span(), "email") for m in PII.finditer(text)]
    out += [(*m.span(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(*m.span(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 14 <= len(digits(m[0])) <= 19 and personal_data.luhn(digits(m[0]))]
    out += [(*m.span(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], personal_data.KINDS.index(s[2])))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["1", "23", "256", "007", ".", "@", "a", "-", "+", " ", "(", "x.com", "4111111111111111", "@@", "é"]), max_size=40))
def test_plain_identifiers_equal_the_patterns(parts):
    text = "".join(parts)
    assert personal_data.find_plain(text) == brute_pii(text)
    assert [s[:3] for s in personal_data.find(text) if s[3]] == brute_pii(text)


@pytest.mark.parametrize("text, found, kind", [
    ("write to doe (at) example dot com now", "doe (at) example dot com", "email"),
    ("jane at mail dot example dot org.", "jane at mail dot example dot org", "email"),
    ("bob [at] site.co.uk", "bob [at] site.co.uk", "email"),
    ("ｂｏｂ＠ｅｘａｍｐｌｅ．ｃｏｍ", "ｂｏｂ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email"),
    ("é аdmin@ехample.com x", "аdmin@ехample.com", "email"),
    ("call +one two three four five five five one two three four", "+one two three four five five five one two three four", "phone"),
    ("card 4111 1111 1111 one one one one", "4111 1111 1111 one one one one", "card"),
    ("at 10 dot 0 dot 0 dot 1", "10 dot 0 dot 0 dot 1", "ip")])
def test_disguises_map_back(text, found, kind):
    assert [(text[a:b], k) for a, b, k, plain in personal_data.find(text) if not plain] == [(found, kind)]


@pytest.mark.parametrize("text", ["look at foo.bar", "the cat at the dot", "one two buckle", "", "meet at noon. dot com", "l'été à côté"])
def test_clean_text_has_no_identifiers(text):
    assert personal_data.find(text) == []


def test_licences():
    mit = "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software"
    assert [m[0] for m in licences.scan("Foo bar. Released under the MIT License. More.\nLicensed under CC BY-NC 4.0.")] == ["MIT", "CC-BY-NC-4.0"]
    assert [m[0] for m in licences.scan(mit)] == ["MIT"]
    bsd = ["Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:",
           "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."]
    assert licences.scan("\n".join(bsd)) == []  # part of a rule is no licence
    assert licences.scan("") == [] and licences.scan("The licence of poets.") == []
    text = "x y.\n# Licensed under the Apache License, Version 2.0."
    (name, a, b, ids), = licences.scan(text)
    assert name == "Apache-2.0" and text[a:b].strip("# .") == "Licensed under the Apache License, Version 2.0" and ids == ["Apache2ref"]
    assert all(any(s in k for s in licences.SIGNS) and licences.normalise(k) == k for k in licences.SENTENCES)
    assert {i for _, s in licences.RULES for i in s} >= set(licences.SENTENCES.values()) - {"GPLhope", "GPLdetails"}


def test_discounts():
    d = katz.discounts([0, 1000, 300, 150, 90, 60, 40])
    assert (d[1:] > 0).all() and (d[1:] <= 1).all() and d[1] < d[5]
    assert (katz.discounts([0] * 7) == 1).all() and (katz.discounts([0, 5, 0, 0, 0, 0, 0]) == 1).all()


def test_mixture_shares():
    rng = random.Random(5)
    words = {"a": ["kato", "mika", "tako"], "b": ["brum", "grum", "strub"]}
    make = lambda lang, n: " ".join(rng.choices(words[lang], k=n))
    table = np.full((language_mixture.BUCKETS, 2), 0.1)
    for i, lang in enumerate("ab"):
        np.add.at(table[:, i], language_mixture.word_grams([make(lang, 500)])[0], 1)
    table = np.log(table / table.sum(axis=0)).astype(np.float32)
    got = language_mixture.infer([make("a", 40), make("a", 30) + " " + make("b", 10), "", "12 !?", make("b", 1)], table)
    assert got[0].tolist() == [1, 0] and abs(got[1, 0] - 0.75) < 0.03 and got[2].sum() == got[3].sum() == 0 and got[4, 1] > 0.99


def test_ftrl_is_sparse_and_learns():
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for i in range(600):
        label = int(i % 5 == 0)
        rows.append(np.append(np.unique(rng.integers(10, 2000, 60)), 2000) if not label else np.append(np.unique([3, *rng.integers(10, 2000, 60)]), 2000))
        labels.append(label)
    z, n = np.zeros(2001), np.zeros(2001)
    for _ in range(3):
        toxicity.ftrl(rows, labels, z, n)
    w = toxicity.weights(z, n)
    assert w[3] == w.max() > 1 and np.count_nonzero(w[10:2000]) < 400


def test_rank_file_without_bytes_is_refused(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(bytes([b])) + b" %d" % b for b in range(255)))
    with pytest.raises(ValueError):
        BytePairs(str(path), P.PATTERN)
