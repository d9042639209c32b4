"""The operators on Spark: odd rows, empty tables, and the registered queries against brute force or SQL."""

import base64
import collections
import hashlib
import math
import os
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import compare, connect
from recallspark.llm import katz, language_mixture, toxicity
from recallspark.llm.byte_bpe import decode_documents, encode_documents
from recallspark.llm.components import components
from recallspark.llm.decontaminate import find_leaks
from recallspark.llm.exact_dedup import exact_dedup
from recallspark.llm.jaccard_join import jaccard_components
from recallspark.llm.licences import scan, scan_licences
from recallspark.llm.personal_data import find_personal_data, span_digest
from recallspark.llm.token_files import read_segments, segment_ids, token_files, word_encoder, write_token_files
from tests.llm.conftest import LONG, ODD, SMALL
from tests.llm.test_parts import brute_pii, brute_words

P = pytest.importorskip("public_tokenizers")
RANKS, WORDS = P.path("byte_bpe_50k.tiktoken"), P.path("word_bpe_49k.json")
TEXTS = [(r[0], r[1] or "") for r in ODD]


def test_every_query_is_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(names, key=lambda n: (n == "pipeline", int(n[2:].split("_")[0]) if n != "pipeline" else 0)) == [
        "op1_language_mixture", "op2_token_files", "op3_decontaminate", "op4_exact_dedup", "op5_byte_bpe", "op6_toxicity", "op7_katz",
        "op8_licences", "op9_jaccard_join", "op10_personal_data", "op11_fill_in_middle", "op12_warc", "op13_alignment", "pipeline"]


@pytest.mark.parametrize("name", ["op3_decontaminate", "op4_exact_dedup", "op9_jaccard_join"])
def test_query_equals_sql(spark, name):
    problem, rows = compare(spark, connect(SMALL), entry.queries()[name], entry.oracle_sql()[name], SMALL)
    assert problem is None and rows > 0


# 1 language ---------------------------------------------------------------------------------------
def test_language_held_out_accuracy(spark, small):
    got = entry.queries()["op1_language_mixture"](spark, SMALL).join(small, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == small.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert len(held) > 20 and sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held) and all(0 <= r.score <= 1 for r in got)


def test_language_odd_rows(odd, none):
    languages, table = language_mixture.train(odd)
    assert languages == ["de", "en", "fr"]  # the texts of two of them have no letters
    got = odd.withColumn("found", language_mixture.language_of(odd, F.col("text"), languages, table)).select("text", "found.*").collect()
    assert len(got) == language_mixture.identify(odd, languages, table).count() == len(ODD)
    assert {r.lang_pred for r in got if not any(c.isalpha() for c in r.text or "")} == {"und"}
    assert all(r.lang_pred == "en" and r.score > 0.9 for r in got if len(r.text or "") > 1000)
    assert language_mixture.train(none)[0] == []
    assert language_mixture.identify(none, languages, table).count() == 0
    assert {r.lang_pred for r in language_mixture.identify(odd, *language_mixture.train(none)).collect()} == {"und"}


def test_language_of_a_text_does_not_hang_on_its_neighbours(small):
    languages, table = language_mixture.train(small)
    some = [r.text for r in small.limit(150).collect()]
    mixed = [a + " " + b for a, b in zip(some, some[1:])] + ["", "12 34"]
    together = language_mixture.infer(mixed, table)
    assert all((language_mixture.infer([t], table)[0] == row).all() for t, row in zip(mixed, together))


# 2 token files ------------------------------------------------------------------------------------
def token_brute(rows):
    tokenizer, start, out = word_encoder(WORDS).tokenizer, 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], dtype="<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files_query(spark, small_texts):
    got = sorted(tuple(r) for r in entry.queries()["op2_token_files"](spark, SMALL).collect())
    assert got == token_brute(small_texts.items())


def test_token_files_odd_rows(spark, odd, none, tmp_path):
    got = token_files(odd, WORDS, 1, str(tmp_path / "a")).collect()
    assert sorted((r.start, r.n_tokens) for r in got) == [b[1:3] for b in token_brute(TEXTS)]
    assert collections.Counter(r.ids_crc32 for r in got) == collections.Counter(b[3] for b in token_brute(TEXTS))
    first = read_segments(spark, str(tmp_path / "a")).orderBy("shard", "segment").first()
    assert len(segment_ids(first.words, first.escaped)) == first.n_ids == sum(first.doc_tokens)
    assert token_files(none, WORDS, 1, str(tmp_path / "b")).count() == 0
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        write_token_files(odd, str(tmp_path / "a"), WORDS, 1)


# 3 decontamination --------------------------------------------------------------------------------
def test_leaks(spark, none, odd):
    item = "a b c d e f g h i j k l m n o p q r s t".split()
    docs = spark.createDataFrame([
        (1, "x " + " ".join(item) + " y"), (2, " ".join(item[:16])), (3, " ".join(item[:15])), (4, None), (5, ""), (None, " ".join(item)),
        (6, " ".join(item[:10]).upper()), (6, " ".join(item[6:])), (7, "two words"), (8, "w " * 20_000 + " ".join(item) + " v" * 20_000)],
        "doc_id long, text string").withColumn("item", F.lit(1)).withColumn("words", F.lit(2))
    items = spark.createDataFrame([(1, " ".join(item)), (1, " ".join(item)), (2, None), (3, ""), (4, "Two  words"), (None, "a")], "item_id long, text string")
    expected = {(1, 1, 16, 16), (2, 1, 12, 16), (6, 1, 16, 16), (7, 4, 1, 1), (8, 1, 16, 16)}
    assert {tuple(r) for r in find_leaks(docs, items).collect()} == expected
    # in blocks of the sketch, with shuffled joins
    assert {tuple(r) for r in find_leaks(docs, items, broadcast_rows=2).collect()} == expected
    assert find_leaks(none, items).count() == find_leaks(odd, items.filter("1 = 0")).count() == 0


def test_short_items_inside_long_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, "x y short famous benchmark item z " + "w " * 9000), (2, "Item"), (3, "short famous  item benchmark"),
                                  (4, "famous benchmark"), (5, "q " * 3000 + "items ITEM"), (6, None), (7, "a b c d e f")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, "Short famous benchmark item"), (2, "item"), (3, "famous benchmark"), (4, "d e f"), (5, "a b c d e"),
                                   (6, "item"), (6, "famous benchmark"), (7, "")], "item_id long, text string")
    expected = {(1, 1, 1, 1), (1, 2, 1, 1), (1, 3, 1, 1), (2, 2, 1, 1), (3, 2, 1, 1), (4, 3, 1, 1), (5, 2, 1, 1), (7, 4, 1, 1),
                (7, 5, 1, 1), (1, 6, 2, 2)}
    assert {tuple(r) for r in find_leaks(docs, items).collect()} == expected
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    query, sql = (table["op3_decontaminate"] for table in (entry.queries(), entry.oracle_sql()))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert {tuple(r) for r in query(spark, str(tmp_path)).collect()} == set(con.execute(sql).fetchall()) == expected


def test_a_passage_that_all_items_share(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = spark.createDataFrame([(i, f"{passage} own{i} " * 3) for i in range(30)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"{passage} item{i}") for i in range(30)], "item_id long, text string")
    assert {tuple(r) for r in find_leaks(docs, items).collect()} == {(d, i, 36, 37) for d in range(30) for i in range(30)}


def test_leaks_plan_is_native(spark):
    plan = entry.queries()["op3_decontaminate"](spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


# 4 exact copies -----------------------------------------------------------------------------------
@pytest.mark.parametrize("runs, fan_in", [(64, 4), (2, 2), (8, 8)])
def test_exact_dedup_odd_rows(odd, none, runs, fan_in):
    groups = collections.defaultdict(list)
    for i, t in TEXTS:
        groups[t].append(i)
    expected = collections.Counter()
    for i, t in TEXTS:
        keep = max((x for x in groups[t] if x is not None), default=None)
        expected[(i, keep, len(groups[t]), i is not None and i == keep, hashlib.sha256(t.encode()).hexdigest())] += 1
    assert collections.Counter(tuple(r) for r in exact_dedup(odd, n_runs=runs, fan_in=fan_in).collect()) == expected
    assert exact_dedup(none).count() == 0


# 5 byte-level BPE ---------------------------------------------------------------------------------
def tiktoken_coder():
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_query(spark, small_texts):
    coder, got = tiktoken_coder(), {r.doc_id: r for r in entry.queries()["op5_byte_bpe"](spark, SMALL).collect()}
    assert len(got) == len(small_texts)
    for i, t in small_texts.items():
        ids = coder.encode_ordinary(t)
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_byte_bpe_odd_rows(odd, none):
    coder = tiktoken_coder()
    encoded = encode_documents(odd, RANKS, P.PATTERN)
    assert collections.Counter((r[0], tuple(r[1])) for r in encoded.collect()) == collections.Counter(
        (i, tuple(coder.encode_ordinary(t))) for i, t in TEXTS)
    back = decode_documents(encoded, RANKS, P.PATTERN)
    assert collections.Counter((r[0], bytes(r[1])) for r in back.collect()) == collections.Counter((i, t.encode()) for i, t in TEXTS)
    assert encode_documents(none, RANKS, P.PATTERN, decoded=True).count() == 0


# 6 toxicity ---------------------------------------------------------------------------------------
def test_toxicity_separates_held_out_texts(spark):
    rng = np.random.default_rng(1)
    vocabulary = [f"{a}{b}" for a in "bcdfghklmn" for b in ("aro", "eli", "ino", "uta", "ome")]
    rows = []
    for i in range(600):
        words = rng.choice(vocabulary, 40).tolist()
        toxic = int(i % 5 == 0)
        if toxic:
            words[10:10] = [["vile", "foul", "nasty"][i // 5 % 3]]
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(docs.drop("toxic"), docs.filter("doc_id % 4 <> 2").select("doc_id", "toxic"))
    held = toxicity.score(docs, model).join(docs, "doc_id").filter("doc_id % 4 = 2").collect()
    right = sum((r.score >= 0.3) == bool(r.toxic) for r in held)
    assert right >= 0.97 * len(held) and len(model[0]) < 500 and all(0 <= r.score <= 1 for r in held)


@pytest.mark.parametrize("shard_rows", [5_000, 1_200])
def test_toxicity_equals_ftrl_over_all_features(spark, monkeypatch, shard_rows):
    """A marker in a handful of rows is learned; no feature is left out but by L1."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", shard_rows)
    rng, rows = np.random.default_rng(2), []
    for i in range(3_500):
        words = rng.choice([f"w{k}" for k in range(300)], 6).tolist()
        toxic = int(i % 9 == 0)
        rare = i in (9, 909, 1809) if shard_rows == 5_000 else i % 360 == 9
        rows.append((i, " ".join(words + ["vile"] * (i % 90 == 0) + ["rare"] * rare), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    shards = -(-len(rows) // shard_rows)
    of = {r.doc_id: r.s for r in docs.selectExpr("doc_id", f"cast(pmod(xxhash64(doc_id), {shards}) as int) AS s").collect()}
    number, examples = {}, collections.defaultdict(list)
    for i, text, toxic in rows:
        buckets = [*np.unique(toxicity.features([text])[1]).tolist(), "bias"]
        examples[of[i]].append((np.array([number.setdefault(b, len(number)) for b in buckets]), toxic))
    z, n = np.zeros(len(number)), np.zeros(len(number))
    for _ in range(toxicity.ROUNDS):
        moved = []
        for part in examples.values():
            own = z.copy(), n.copy()
            toxicity.ftrl([e for e, _ in part], [t for _, t in part], *own)
            moved.append((own[0] - z, own[1] - n))
        z, n = z + sum(m[0] for m in moved) / shards, n + sum(m[1] for m in moved) / shards
    value = toxicity.weights(z, n)
    known, got, bias = toxicity.train(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    expected = {b: value[i] for b, i in number.items() if value[i]}
    assert bias == pytest.approx(expected.pop("bias"), abs=1e-9)
    assert dict(zip(known.tolist(), got.tolist())) == pytest.approx(expected, abs=1e-9)
    assert toxicity.features(["rare"])[1][0] in known and np.all(np.diff(known) > 0)


def test_toxicity_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 1), (9, None)], "doc_id long, toxic int")
    got = toxicity.score(odd, toxicity.train(odd, labels)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    unlabelled = toxicity.train(odd, labels.filter("1 = 0"))
    assert {r.score for r in toxicity.score(odd, unlabelled).collect()} == {0.0}
    assert toxicity.score(none, unlabelled).count() == 0


# 7 language model ---------------------------------------------------------------------------------
def brute_katz(texts, training):
    sent = {i: brute_words(t) + [None] for i, t in texts.items()}
    one, two = collections.Counter(), collections.Counter()
    for i in training:
        one.update(sent[i])
        two.update(zip([None, *sent[i]], sent[i]))
    types = lambda c: [0] + [sum(v == r for v in c.values()) for r in range(1, katz.CUT + 2)]
    d1, d2, n = katz.discounts(types(one)), katz.discounts(types(two)), sum(one.values())
    cut = lambda d, c: d[c] if c <= katz.CUT else 1.0
    freed = n - sum(cut(d1, c) * c for c in one.values())
    base, unseen = (n, freed / n) if freed > 1e-9 else (n + 1, 1 / (n + 1))
    word = lambda w: cut(d1, one[w]) * one[w] / base if one[w] else unseen
    after = collections.defaultdict(dict)
    for (a, b), c in two.items():
        after[a][b] = c

    def probability(a, b):
        seen = after.get(a)
        if not seen:
            return word(b)
        total = sum(seen.values())
        free = total - sum(cut(d2, c) * c for c in seen.values())
        if free < 1e-9:
            free, total = 1.0, total + 1
        return cut(d2, seen[b]) * seen[b] / total if b in seen else free / total / (1 - sum(map(word, seen))) * word(b)

    plain = lambda w: math.log10((one[w] + 0.5) / (n + 0.5 * (len(one) + 1)))
    rows = {i: (len(s), sum(one[w] > 0 for w in s), n, sum(map(plain, s)), sum(math.log10(probability(a, b)) for a, b in zip([None, *s], s)))
            for i, s in sent.items()}
    return rows, probability, one


def test_katz_query(spark, small_texts):
    expected, probability, one = brute_katz(small_texts, [i for i in small_texts if zlib.crc32(str(i).encode()) % 5 != 1])
    got = {r.doc_id: r for r in entry.queries()["op7_katz"](spark, SMALL).collect()}
    for i, (n, known, total, base, score) in expected.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, zlib.crc32(str(i).encode()) % 5 == 1)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-9)
    for context in [None, "the", "never seen before"]:
        assert math.isclose(sum(probability(context, w) for w in one) + probability(context, "never seen before"), 1, rel_tol=1e-9)


def test_katz_splits_hot_contexts(spark, monkeypatch):
    rng = np.random.default_rng(2)
    texts = {i: " ".join(f"the w{int(x)}" for x in rng.zipf(1.6, 1500) % 400) for i in range(30)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    expected, _, _ = brute_katz(texts, [i for i in texts if i % 3])
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 20_000)
    got = {r.doc_id: r for r in katz.katz_scores(docs, F.col("doc_id") % 3 == 0).collect()}
    assert all(math.isclose(got[i].score, e[4], rel_tol=1e-9) and got[i].n_known == e[1] for i, e in expected.items())


def test_katz_odd_rows(odd, none):
    got = katz.katz_scores(odd, F.col("doc_id") == 9).collect()
    assert sorted(r.n_tokens for r in got) == sorted(len(brute_words(t)) + 1 for _, t in TEXTS)
    assert sum(r.held_out for r in got) == 1 and all(r.score < 0 for r in got)
    assert katz.katz_scores(none, F.lit(False)).count() == 0
    assert {(r.score, r.train_tokens) for r in katz.katz_scores(odd.filter("length(text) < 100"), F.lit(True)).collect()} == {(0.0, 0)}


# 8 licences, 10 personal data ---------------------------------------------------------------------
def test_licences_query(spark, small_texts):
    got = {r.doc_id: r for r in entry.queries()["op8_licences"](spark, SMALL).collect()}
    assert len(got) == len(small_texts) and sum(r.n_matches for r in got.values()) > 0
    lines = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only", "All rights reserved.": "Proprietary"}
    for i, t in small_texts.items():
        assert [(m.licence, m.start, m.end) for m in got[i].matches] == [m[:3] for m in scan(t)]
        assert set(got[i].licences) >= {name for line in t.split("\n") for text, name in lines.items() if line.strip() == text}
        assert not got[i].licences or "icense" in t or "rights" in t


def test_licences_odd_rows(odd, none):
    assert scan_licences(odd).filter("n_matches = 0 AND size(licences) = 0").count() == len(ODD) and scan_licences(none).count() == 0


def test_personal_data_query(spark, small_texts):
    for r in entry.queries()["op10_personal_data"](spark, SMALL).collect():
        spans = brute_pii(small_texts[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and set(text.split(",")) <= set(r.spans.split(",")) | {""}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[2] == k for s in spans) for k in ("email", "ip", "card", "phone")]


def test_personal_data_odd_rows(spark, odd, none):
    digest = span_digest(find_personal_data(odd)).collect()
    assert len(digest) == len(ODD) and {r.spans for r in digest} == {""} and {r.base_sha256 for r in digest} == {hashlib.sha256(b"").hexdigest()}
    assert find_personal_data(none).count() == 0
    rows = spark.createDataFrame([(1, "é a@b.c, 1.2.3.4 bob (at) b dot c")], "doc_id long, text string")
    assert span_digest(find_personal_data(rows)).first().spans == "email:2:7,ip:9:16,email:17:33"


# 9 near copies ------------------------------------------------------------------------------------
def brute_components(texts):
    sets = {i: {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set() for i, t in texts for w in [brute_words(t)]}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = list(sets)
    for x in range(len(ids)):
        for y in range(x):
            a, b = sets[ids[x]], sets[ids[y]]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                p, q = find(ids[x]), find(ids[y])
                root[max(p, q)] = min(p, q)
    return {(i, len(s), find(i)) for i, s in sets.items()}


def test_jaccard_chains_and_long_lists(spark, monkeypatch):
    from recallspark.llm import jaccard_join
    rng = np.random.default_rng(4)
    base, texts = [f"w{i}" for i in range(60)], []
    for i in range(70):  # a chain: neighbours are near, ends far apart
        base[i % 60] = f"c{i}"
        texts.append(" ".join(base))
    passage = " ".join(f"p{i}" for i in range(30))
    for i in range(60):  # a passage that many share, with as many words of their own or few
        texts.append(passage + " " + " ".join(f"q{i}x{j}" for j in range(rng.integers(1, 40))))
    texts += ["same text of just five", "SAME text of just five", "four words are here", "four words are  here", "", " ", LONG, LONG + " tail"]
    docs = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("band", F.lit(1))
    expected = brute_components(list(enumerate(texts, 1)))
    for short, block, rows in ((8, 512, 10**6), (2, 4, 1)):
        monkeypatch.setattr(jaccard_join, "SHORT_LIST", short)
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        got = jaccard_components(docs, broadcast_rows=rows).collect()
        assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == expected and len(got) == len(texts)


def test_jaccard_odd_rows(odd, none):
    got = jaccard_components(odd).collect()
    assert len(got) == len(ODD) and {(r.doc_id, r.component_id) for r in got if r.doc_id is not None} == {
        (1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 6), (7, 6), (8, 8), (9, 9), (10, 9)}
    assert jaccard_components(none).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 200), (300, 200), (400, 400)] + [(1000, i) for i in range(1001, 1040)]
    got = {r.id: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 61)) and got[200] == got[300] == 100 and 400 not in got and set(got[i] for i in range(1000, 1040)) == {1000}


# pipeline -----------------------------------------------------------------------------------------
def test_pipeline_equals_brute_force(spark, small, small_texts):
    coder, kept = tiktoken_coder(), {i: t for i, t in small_texts.items() if any(c.isalpha() for c in t)}
    last = {}
    for i, t in sorted(kept.items()):
        last[t] = i
    kept = {i: t for i, t in kept.items() if last[t] == i}
    kept = {i: kept[i] for i, _, c in brute_components(list(kept.items())) if i == c}
    items = [brute_words(r.text.lower()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    shingles = lambda w: {tuple(w[j:j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    sets = [shingles(w) for w in items]
    for i in list(kept):
        mine = shingles(brute_words(kept[i].lower()))
        if any(s and 100 * len(s & mine) >= 75 * len(s) for s in sets):
            del kept[i]
    got = {r.doc_id: (r.ids, r.n_tokens) for r in entry.queries()["pipeline"](spark, SMALL).collect()}
    assert got == {i: (ids, len(ids)) for i, t in kept.items() for ids in [coder.encode_ordinary(t)]}
    assert 0 < len(got) < len(small_texts)


def test_pipeline_odd_rows(spark, odd, none, tmp_path):
    spark.read.parquet(f"{SMALL}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    counts = []
    docs, empty = odd, none
    for name, stage in corpus_pipeline.STAGES:
        docs, empty = stage(spark, docs, str(tmp_path)), stage(spark, empty, str(tmp_path))
        assert empty.count() == 0
        if name != "tokens":
            assert docs.columns == odd.columns and docs.schema.simpleString() == odd.schema.simpleString()
        docs = docs.checkpoint()
        counts.append(sorted((r.doc_id for r in docs.collect()), key=lambda i: (i is not None, i)))
    assert counts == [[None, None, 1, 2, 2, 6, 7, 9, 10], [None, 2, 6, 7, 9, 10], [None, 2, 6, 9], [None, 2, 6, 9], [None, 2, 6, 9]]
    assert corpus_pipeline.language(spark, odd.withColumn("lang", F.lit(None).cast("string")), "").count() == len(ODD)


def test_nothing_else_imports_this_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder in ("recallspark", "checks"):
        for at, _, files in os.walk(os.path.join(root, folder)):
            if os.path.basename(at) != "llm":
                for f in files:
                    if f.endswith(".py"):
                        assert "recallspark.llm" not in open(os.path.join(at, f)).read(), f


def test_jaccard_links_through_rows_without_id(spark):
    words = [f"w{i}" for i in range(60)]
    left, middle, right = words[:50], words[4:54], words[8:58]  # neighbours link, the ends don't
    docs = spark.createDataFrame([(1, " ".join(left)), (None, " ".join(middle)), (2, " ".join(right)), (3, "none of these words at all"),
                                  (None, "nobody else says this at all")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.n_links_found) for r in jaccard_components(docs).collect())
    assert got == [(0, 0, 0), (0, 1, 2), (1, 1, 1), (2, 1, 1), (3, 3, 0)]
