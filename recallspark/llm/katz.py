"""Katz backoff: a bigram model with Good-Turing discounts and exactly normalised backoff weights.

Counts live in tables partitioned by hash, and documents in chunks of some million tokens. A chunk sends
each partition its distinct words, later its distinct bigrams, in packed form, and gets their counts over
all training texts back, with what the contexts need for their backoff weights; it then scores its texts
token by token. So what travels are the distinct n-grams of chunks, not tokens; every table and message
is spread by hash, and contexts with a large share of all tokens are split over several partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recallspark.llm.batches import pieces, texts
from recallspark.llm.hashing import chain
from recallspark.llm.storage import pack, stored, unpack
from recallspark.llm.word_sets import word_hashes

#: Counts above CUT are not discounted. Tokens of a chunk, about.
CUT, CHUNK_TOKENS = 5, 2_500_000
#: The token that ends a text, and the context of its first word. No word hashes to it but by chance (1 in 2^64).
END = np.uint64(0x656E64)
_CHUNK = ("chunk long, doc_ids array<bigint>, held array<boolean>, sizes binary, tokens binary, words binary, counts binary")
_ANSWER = "chunk long, kind int, bucket int, first binary, second binary, stats array<bigint>"
_QUESTION = "bucket int, chunk long, contexts binary, sizes binary, words binary, counts binary, word_counts binary"


def discounts(types: list[int]) -> np.ndarray:
    """Katz's discount factors of the counts 1..CUT (at 1..CUT; index 0 unused) from the number of types of each count.

    ``types[r]`` are the types seen r times, up to CUT + 1. Where Good-Turing gives no factor in
    (0, 1] (gaps in the counts, small corpora), the count is not discounted.
    """
    d = np.ones(CUT + 1)
    if types[1]:
        common = (CUT + 1) * types[CUT + 1] / types[1]
        for r in range(1, CUT + 1):
            if types[r] and types[r + 1] and common < 1:
                factor = ((r + 1) * types[r + 1] / (r * types[r]) - common) / (1 - common)
                d[r] = factor if 0 < factor <= 1 else 1.0
    return d


@dataclass
class Totals:
    """What scoring needs of the whole training text: tokens, types, discounts of words and bigrams."""
    tokens: int
    types: int
    words: np.ndarray
    bigrams: np.ndarray
    word_types: list[int]

    def __post_init__(self) -> None:
        freed = sum(self.word_types[r] * r * (1 - self.words[r]) for r in range(1, CUT + 1))
        self.base = self.tokens if freed > 0 else self.tokens + 1  # one token for unseen words if nothing was freed
        self.unseen = (freed if freed > 0 else 1.0) / self.base

    def word(self, counts: np.ndarray) -> np.ndarray:
        """Probability of words by their counts; unseen words share one entry."""
        low = self.words[np.minimum(counts, CUT)]
        return np.where(counts == 0, self.unseen, np.where(counts > CUT, 1.0, low) * counts / self.base)


def _chunks(docs: DataFrame, held: Column, n_buckets: int) -> DataFrame:
    """The texts in chunks: word numbers of every token, the distinct words in order of bucket and hash, training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        waiting: list[tuple] = []

        def chunk() -> pa.RecordBatch:
            nonlocal made
            hashes = np.concatenate([w[0] for w in waiting])
            sizes = np.concatenate([w[1] for w in waiting])
            ids, out = sum((w[2] for w in waiting), []), sum((w[3] for w in waiting), [])
            words, tokens = np.unique(hashes, return_inverse=True)
            order = np.argsort(words % np.uint64(n_buckets), kind="stable")
            place = np.empty(len(words), dtype=np.uint32)
            place[order] = np.arange(len(words), dtype=np.uint32)
            tokens = place[tokens]
            training = np.repeat(~np.array(out, dtype=bool), sizes)
            counts = np.bincount(tokens[training], minlength=len(words)).astype(np.uint32)
            made += 1
            values = [[part << 32 | made], [ids], [out], [pack(sizes.astype(np.int64))], [pack(tokens)], [pack(words[order], True)], [pack(counts)]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_())] + [pa.binary()] * 4
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=[f.split()[0] for f in _CHUNK.split(", ")])

        for batch in pieces(batches):
            words, offsets = word_hashes(texts(batch))
            hashes = np.insert(words, offsets[1:], END)  # one end behind each text
            waiting.append((hashes, np.diff(offsets) + 1, batch.column(0).to_pylist(), batch.column(2).to_pylist()))
            if sum(len(w[0]) for w in waiting) >= CHUNK_TOKENS:
                yield chunk()
        if waiting:
            yield chunk()

    rows = docs.select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held"))
    return rows.mapInArrow(run, _CHUNK)


def _word_questions(chunks: DataFrame, n_buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, counts = unpack(batch.column(1)[i].as_py(), np.uint64, True), unpack(batch.column(2)[i].as_py(), np.uint32)
                edges = np.searchsorted((words % np.uint64(n_buckets)).astype(np.int64), np.arange(n_buckets + 1)).tolist()
                rows = [(b, pack(words[x:y], True), pack(counts[x:y])) for b, (x, y) in enumerate(zip(edges, edges[1:])) if y > x]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([batch.column(0)[i].as_py()] * len(rows), pa.int64()),
                     pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                    names=["bucket", "chunk", "words", "counts"])

    return chunks.select("chunk", "words", "counts").mapInArrow(run, "bucket int, chunk long, words binary, counts binary")


def _types(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts[counts > 0], CUT + 2).astype(np.int64), minlength=CUT + 3)[:CUT + 2].tolist()


def _word_answers(questions: DataFrame, n_buckets: int) -> DataFrame:
    """Kind 1: number (dense, by falling count) and training count of each word asked for; kind 0: totals of the bucket."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iloc[0])
        rows = rows.sort_values("chunk")
        asked = [unpack(w, np.uint64, True) for w in rows["words"]]
        words, at = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([unpack(c, np.uint32) for c in rows["counts"]])).astype(np.int64)
        number = np.empty(len(words), dtype=np.int64)
        number[np.lexsort((words, -counts))] = np.arange(len(words)) * n_buckets + bucket
        ends = np.cumsum([len(a) for a in asked])
        out = [(chunk, 1, bucket, pack(number[i]), pack(counts[i]), None)
               for chunk, i in zip(rows["chunk"].tolist(), np.split(at, ends[:-1]))]
        out.append((None, 0, bucket, None, None, [int(counts.sum()), int((counts > 0).sum()), *_types(counts)]))
        return _frame(out)

    return questions.groupBy("bucket").applyInPandas(run, _ANSWER)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[f.split()[0] for f in _ANSWER.split(", ")])
    return frame.astype({"chunk": "Int64"})


class Chunk:
    """A chunk with the numbers and counts of its words: its distinct bigrams, in the order in which they are asked for."""

    def __init__(self, row: pd.Series, answers: pd.DataFrame, tokens_in_all: int, n_buckets: int):
        answers = answers[answers["kind"] == 1].sort_values("bucket")
        self.number = np.concatenate([unpack(x, np.int64) for x in answers["first"]])
        self.count = np.concatenate([unpack(x, np.int64) for x in answers["second"]])
        self.tokens = unpack(row["tokens"], np.uint32).astype(np.int64)
        self.sizes = unpack(row["sizes"], np.int64)
        ends = np.cumsum(self.sizes)
        self.starts = ends - self.sizes
        context = np.empty_like(self.tokens)
        context[1:] = self.tokens[:-1]
        context[self.starts] = self.tokens[ends[0] - 1]  # the end token stands before a text, too
        self.context = context
        training = np.repeat(~np.asarray(row["held"], dtype=bool), self.sizes)
        n_words = len(self.number)
        known = (self.count[context] > 0) & (self.count[self.tokens] > 0)
        pairs, at = np.unique((context * n_words + self.tokens)[known], return_inverse=True)
        seen = np.bincount(at[training[known]], minlength=len(pairs)).astype(np.uint32)
        left, right = pairs // n_words, pairs % n_words
        # a context with more than half of a partition's share of all tokens is split by its second words
        share = max(1000, tokens_in_all // (2 * n_buckets))
        bucket_of = lambda number, part: (chain(number.astype(np.uint64), part.astype(np.uint64)) % np.uint64(n_buckets)).astype(np.int64)
        bucket = bucket_of(self.number[left], self.number[right] // n_buckets % (1 + self.count[left] // share))
        order = np.lexsort((self.number[right], self.number[left], bucket))
        place = np.empty(len(pairs), dtype=np.int64)
        place[order] = np.arange(len(pairs))
        self.pair_of = np.full(len(self.tokens), -1)
        self.pair_of[known] = place[at]  # -1: no bigram, as one of the words is unseen
        self.left, self.right, self.seen, self.bucket = left[order], right[order], seen[order], bucket[order]
        # every context asks all its partitions for what they know of it
        heads = np.unique(context)
        heads = heads[self.count[heads] > 0]
        splits = 1 + self.count[heads] // share
        head = np.repeat(heads, splits)
        split = np.arange(len(head)) - np.repeat(np.cumsum(splits) - splits, splits)
        asked = np.stack((bucket_of(self.number[head], split), self.number[head], head))
        asked = np.unique(asked, axis=1)
        self.ask_bucket, _, self.ask_context = asked

    def questions(self, n_buckets: int) -> list[tuple]:
        edges = np.searchsorted(self.bucket, np.arange(n_buckets + 1))
        heads = np.searchsorted(self.ask_bucket, np.arange(n_buckets + 1))
        out = []
        for b in range(n_buckets):
            x, y, p, q = edges[b], edges[b + 1], heads[b], heads[b + 1]
            if q > p:
                contexts = self.number[self.ask_context[p:q]]
                sizes = np.bincount(np.searchsorted(contexts, self.number[self.left[x:y]]), minlength=q - p).astype(np.uint32)
                right = self.right[x:y]
                out.append((b, pack(contexts, True), pack(sizes), pack(self.number[right]), pack(self.seen[x:y]), pack(self.count[right])))
        return out


def _bigram_questions(chunks: DataFrame, answers: DataFrame, tokens_in_all: int, n_buckets: int) -> DataFrame:
    def run(chunk: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        names = [f.split()[0] for f in _QUESTION.split(", ")]
        if not len(chunk):
            return pd.DataFrame([], columns=names)
        rows = Chunk(chunk.iloc[0], known, tokens_in_all, n_buckets).questions(n_buckets)
        number = int(chunk["chunk"].iloc[0])
        return pd.DataFrame([(b, number, *rest) for b, *rest in rows], columns=names)

    texts_ = chunks.select("chunk", "held", "sizes", "tokens")
    return texts_.groupBy("chunk").cogroup(answers.filter("kind = 1").groupBy("chunk")).applyInPandas(run, _QUESTION)


def _bigram_answers(questions: DataFrame) -> DataFrame:
    """Kind 2: counts of the bigrams asked for, and of each context the types by bigram count and by word count."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        contexts = [unpack(x, np.int64, True) for x in rows["contexts"]]
        heads, head_at = np.unique(np.concatenate(contexts), return_inverse=True)
        sizes = np.concatenate([unpack(x, np.uint32) for x in rows["sizes"]])
        words, word_at = np.unique(np.concatenate([unpack(x, np.int64) for x in rows["words"]]), return_inverse=True)
        context_at = np.repeat(head_at, sizes)
        pairs, first, at = np.unique(context_at * max(1, len(words)) + word_at, return_index=True, return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([unpack(x, np.uint32) for x in rows["counts"]]), minlength=len(pairs)).astype(np.int64)
        lower = np.concatenate([unpack(x, np.int64) for x in rows["word_counts"]])[first] if len(pairs) else counts
        seen = np.flatnonzero(counts)
        owner, own, low = context_at[first][seen] if len(pairs) else seen, counts[seen], lower[seen]
        stats = np.zeros((2 * CUT + 2, len(heads)), dtype=np.int64)
        for r in range(1, CUT + 1):
            stats[r - 1] = np.bincount(owner[own == r], minlength=len(heads))
            stats[CUT + r] = np.bincount(owner[low == r], minlength=len(heads))
        stats[CUT] = np.bincount(owner[own > CUT], weights=own[own > CUT], minlength=len(heads))
        stats[2 * CUT + 1] = np.bincount(owner[low > CUT], weights=low[low > CUT], minlength=len(heads))
        bucket, out, x, p = int(rows["bucket"].iloc[0]), [], 0, 0
        lengths = [int.from_bytes(w[:8], "little") for w in rows["words"]]
        for chunk, asked, n in zip(rows["chunk"].tolist(), contexts, lengths):
            out.append((chunk, 2, bucket, pack(counts[at[x:x + n]]), pack(stats[:, head_at[p:p + len(asked)]].ravel()), None))
            x, p = x + n, p + len(asked)
        out.append((None, 0, bucket, None, None, _types(counts)))
        return _frame(out)

    return questions.groupBy("bucket").applyInPandas(run, _ANSWER)


def _scores(chunks: DataFrame, answers: DataFrame, totals: Totals, n_buckets: int) -> DataFrame:
    def run(chunk: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if not len(chunk):
            return pd.DataFrame([], columns=names)
        row = chunk.iloc[0]
        c = Chunk(row, known, totals.tokens, n_buckets)
        known = known[known["kind"] == 2].sort_values("bucket")
        pair_count = np.concatenate([unpack(x, np.int64) for x in known["first"]] or [np.zeros(0, np.int64)])
        parts = [unpack(x, np.int64).reshape(2 * CUT + 2, -1) for x in known["second"]]
        stats = np.zeros((2 * CUT + 2, len(c.number)))
        if parts:
            np.add.at(stats.T, c.ask_context, np.concatenate(parts, axis=1).T)
        # of every context: its tokens, the mass its discounts free, and the mass its seen words have as words
        r = np.arange(1, CUT + 1)[:, None]
        tokens = (r * stats[:CUT]).sum(axis=0) + stats[CUT]
        freed = ((1 - totals.bigrams[1:, None]) * r * stats[:CUT]).sum(axis=0)
        base = np.where(freed > 0, tokens, tokens + 1)
        freed = np.where(freed > 0, freed, 1.0)
        covered = ((totals.words[1:, None] * r * stats[CUT + 1:2 * CUT + 1]).sum(axis=0) + stats[2 * CUT + 1]) / totals.base
        backoff = np.where(tokens > 0, freed / base / np.maximum(1 - covered, 1e-300), 1.0)
        # P(w | context) = discounted share of the bigram if it was seen, else backoff(context) * P(w)
        word = totals.word(c.count)
        score = np.log10(backoff[c.context] * word[c.tokens])
        factor = np.where(pair_count > CUT, 1.0, totals.bigrams[np.minimum(pair_count, CUT)])
        share = factor * pair_count / np.maximum(base[c.left], 1)
        hit = np.flatnonzero(c.pair_of >= 0)
        hit = hit[pair_count[c.pair_of[hit]] > 0]
        score[hit] = np.log10(share[c.pair_of[hit]])
        count = c.count[c.tokens]
        plain = np.log10((count + 0.5) / (totals.tokens + 0.5 * (totals.types + 1)))
        add = lambda x: np.add.reduceat(x, c.starts)
        return pd.DataFrame({
            "doc_id": pd.array(row["doc_ids"], "Int64"), "held_out": np.asarray(row["held"], dtype=bool), "n_tokens": c.sizes,
            "n_known": add((count > 0).astype(np.int64)), "train_tokens": totals.tokens, "base_score": add(plain), "score": add(score)})[names]

    kind = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    texts_ = chunks.select("chunk", "doc_ids", "held", "sizes", "tokens")
    return texts_.groupBy("chunk").cogroup(answers.filter("kind > 0").groupBy("chunk")).applyInPandas(run, kind)


def katz_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score every whole text by a model of the texts where ``held_out`` (over id and text) is false or null.

    Tokens are words (A-Z in lower case, separated by ASCII white space) and one end per text, so
    null and empty texts are one token. Returns ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score`` (add-half unigram) and ``score`` (log10 of the Katz probability).
    Over the seen words and one unseen word the probabilities sum to 1 in every context. One row
    per input row, ids repeated or null or not; without training text every text scores 0.
    """
    spark = docs.sparkSession
    n_buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    chunks = stored(_chunks(rows, held_out, n_buckets))
    words = stored(_word_answers(_word_questions(chunks, n_buckets), n_buckets))
    sums = lambda answers, n: answers.filter("kind = 0").select(*[F.coalesce(F.sum(F.get("stats", i)), F.lit(0)) for i in range(n)]).first()
    tokens, types, *word_types = sums(words, CUT + 4)
    bigrams = stored(_bigram_answers(_bigram_questions(chunks, words, tokens, n_buckets)))
    bigram_types = list(sums(bigrams, CUT + 2))
    totals = Totals(tokens, types, discounts(word_types), discounts(bigram_types), word_types)
    return _scores(chunks, words.unionByName(bigrams), totals, n_buckets)
