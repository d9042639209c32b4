"""Alignment of two tokenizers: where the tokens of both end, and how often which ids meet there.

Tokenizer A is byte-level BPE (of the tokenizers library), B is a sentence-piece model that puts a space in
front. Both are looked at as bytes. An array gives for each id of A the id of B with the same bytes. A group
of one A token and one B token that the array names is regular: such groups are counted in a vector as
long as A's vocabulary, and only the others go through the shuffle of id pairs.

Neither tokenizer has a token that reaches over a single space between two other characters, so a text is
cut there and a task remembers the alignment of each run. Of two tokens that end together one is an end
of the other; so there are at most as many id pairs as the vocabularies have bytes, and their counts can be
broadcast whatever the size of the corpus.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recallspark.llm.batches import lists, pieces, texts
from recallspark.llm.storage import stored

#: The tokens of both sides: 32-bit little-endian numbers, twice the id, plus one where the token ends a group.
ALIGNED = "doc_id long, a_tokens binary, b_tokens binary"
#: Runs, and tokens of runs, that a task remembers before it starts anew.
REMEMBERED, REMEMBERED_TOKENS = 400_000, 3_000_000
#: Tokens of both sides that are worked on at once (one longer document is a piece by itself).
PIECE_TOKENS = 1_000_000
_GAP = re.compile(r"[\s\x1c-\x1f\x85]{2}")
_SPACE = re.compile(r"[\s\x1c-\x1f\x85]")
_CUT = re.compile(r"(?<=[^\s\x1c-\x1f\x85]) (?=[^\s\x1c-\x1f\x85])")


def byte_level() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself if printable Latin-1, else the next from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """The two tokenizers, the bytes of their ids, and the array from A ids to B ids of the same bytes (-1: none)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        to_byte, vocabulary = byte_level(), self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        named = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(named)]
        if any(" " in piece.lstrip(b" ").decode("latin-1") for piece in self.b_bytes):
            raise ValueError(f"{b_path} has pieces that reach over a space, so texts can't be cut there")
        self.a_lengths = np.array([len(t) for t in self.a_bytes], dtype=np.int64)
        self.b_lengths = np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        self.ranked = ranked_pairs(a_path, vocabulary, self.a_bytes)
        same = {piece: i for i, piece in enumerate(self.b_bytes)}  # the last: a piece rather than the byte it stands for
        self.identity = np.array([same.get(t, -1) for t in self.a_bytes], dtype=np.int32)

    def encode(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(A ids, their ends by run, B ids, their ends by run, whether each run is given back)``.

        Runs begin with a space (B puts that space itself) and don't depend on their neighbours, so as
        many as give back their own bytes go through together.
        """
        sizes = np.array([len(r.encode()) for r in runs], dtype=np.int64)
        joined = "".join(runs)
        sides, data = [], joined.encode()
        a_ids = self.ranked.encode_ordinary(joined) if self.ranked else self.a.encode(joined, add_special_tokens=False).ids
        for ids, table, lengths in ((a_ids, self.a_bytes, self.a_lengths), (self.b.encode(joined[1:], num_threads=1), self.b_bytes, self.b_lengths)):
            ids = np.array(ids, dtype=np.int32)
            if b"".join(map(table.__getitem__, ids.tolist())) != data:
                break
            sides += [ids, np.searchsorted(np.cumsum(lengths[ids]), np.cumsum(sizes), side="right")]
        if len(sides) == 4:
            return *sides, np.ones(len(runs), bool)
        if len(runs) > 1:  # one of them is not given back: find it by halves
            half = len(runs) // 2
            (a, ends_a, b, ends_b, fine), (a2, ends_a2, b2, ends_b2, fine2) = self.encode(runs[:half]), self.encode(runs[half:])
            joint = np.concatenate
            return joint((a, a2)), joint((ends_a, ends_a2 + len(a))), joint((b, b2)), joint((ends_b, ends_b2 + len(b))), joint((fine, fine2))
        nothing, end = np.zeros(0, np.int32), np.zeros(1, np.int64)
        return nothing, end, nothing, end, np.zeros(1, bool)


def ranked_pairs(path: str, vocabulary: dict[str, int], id_bytes: list[bytes]):
    """The same byte-level BPE as a tiktoken encoding, which is several times as fast, or None: merges must have
    their ids in the order of their ranks, and the text be split by the byte-level pattern alone."""
    import public_tokenizers
    import tiktoken
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    split, model = told["pre_tokenizer"], told["model"]
    merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    plain = told["normalizer"] is None and split["type"] == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"]
    if not plain or model["type"] != "BPE" or model.get("ignore_merges") or merged != sorted(merged):
        return None
    added = {t["id"] for t in told["added_tokens"]}
    ranks = {token: i for i, token in enumerate(id_bytes) if token and i not in added}
    if len(ranks) != 256 + len(merged):
        return None
    return tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.held, self.used = np.zeros(1 << 12, kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.used + len(values) > len(self.held):
            self.held = np.concatenate((self.held[:self.used], np.zeros(self.used + 2 * len(values), self.held.dtype)))
        self.held[self.used:self.used + len(values)] = values
        self.used += len(values)


class Column:
    """Values of all remembered runs behind each other."""

    def __init__(self):
        self.values, self.ends = Grown(np.int32), Grown(np.int64)
        self.ends.add(np.zeros(1, np.int64))

    def add(self, values: np.ndarray, ends: np.ndarray) -> None:
        self.ends.add(ends + self.values.used)
        self.values.add(values)

    def take(self, runs: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values of ``runs`` in order, and where each row's end (a row ends behind ``rows`` of the runs)."""
        begins = self.ends.held[runs]
        counts = self.ends.held[runs + 1] - begins
        sums = np.concatenate(([0], np.cumsum(counts)))
        places = np.arange(sums[-1]) + np.repeat(begins - sums[:-1], counts)
        return self.values.held[places], sums[rows]


class Memory:
    """The alignment of runs, by run. It lives as long as a task."""

    def __init__(self, coder: Tokenizers):
        self.coder = coder
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}  # without the space that a run begins with
        self.fine, self.columns = Grown(bool), [Column(), Column()]

    def learn(self, runs: list[str], gaps: bool) -> None:
        """Runs with white space at their ends go through alone, others together."""
        alone = [r for r in runs if not r or _SPACE.match(r[0]) or _SPACE.match(r[-1])] if gaps else []
        others = list(set(runs).difference(alone)) if alone else runs
        for some in [*[[r] for r in alone], *[others[i:i + 1000] for i in range(0, len(others), 1000)]]:
            a_ids, ends_a, b_ids, ends_b, fine = self.coder.encode([" " + r for r in some])
            self.index.update(zip(some, range(len(self.index), len(self.index) + len(some))))
            self.fine.add(fine)
            at_a, at_b = np.cumsum(self.coder.a_lengths[a_ids]), np.cumsum(self.coder.b_lengths[b_ids])
            self.columns[0].add(a_ids << 1 | np.isin(at_a, at_b), ends_a)  # the end of a run ends a group, too
            self.columns[1].add(b_ids << 1 | np.isin(at_b, at_a), ends_b)

    def align(self, batch: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(tokens, row offsets) by A and by B, as in ``ALIGNED``; a text that is not given back has none."""
        gaps = [_GAP.search(f" {t} ") is not None for t in batch]
        cut = [[] if not t else _CUT.split(t) if gap else t.split(" ") for t, gap in zip(batch, gaps)]
        if len(self.index) > REMEMBERED or max(c.values.used for c in self.columns) > REMEMBERED_TOKENS:
            self.forget()
        new = list(set().union(*cut).difference(self.index))
        if new:
            self.learn(new, any(gaps))
        rows = np.concatenate(([0], np.cumsum([len(r) for r in cut])))
        runs = np.array([i for r in cut for i in map(self.index.__getitem__, r)], dtype=np.int64)
        broken = np.concatenate(([0], np.cumsum(~self.fine.held[runs])))[rows]
        if broken[-1]:
            kept = np.diff(broken) == 0
            counts = np.diff(rows)
            runs, rows = runs[np.repeat(kept, counts)], np.concatenate(([0], np.cumsum(counts * kept)))
        return [c.take(runs, rows) for c in self.columns]


def align_documents(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, a_tokens, b_tokens`` (see ``ALIGNED``; ``token_arrays`` unpacks them): the ids of space and text by A and
    of text by B, and which of them end a group, that is, end where a token of the other side ends.

    Strings of special tokens are plain text. Texts that are null, empty, or that the bytes of A or B ids
    don't give back have no tokens. One row per row, ids repeated or null or not (whole numbers);
    very long texts are worked on whole; other columns are ignored. No shuffle.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("a_tokens", pa.binary()), ("b_tokens", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(tokenizers(a_path, b_path))
        for batch in pieces(batches):
            columns = [pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((4 * ends).astype("<i4")), pa.py_buffer(tokens.astype("<i4"))])
                       for tokens, ends in memory.align(texts(batch))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=schema)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, ALIGNED)


def token_arrays(aligned: DataFrame) -> DataFrame:
    """``doc_id, a_ids, b_ids, a_sizes, b_sizes``: ids in order, and how many of each side are in every group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in _groups(batches):
            parts = [(groups.a, groups.n_a), (groups.b, groups.n_b), (groups.a_sizes, groups.n_groups), (groups.b_sizes, groups.n_groups)]
            columns = [lists(values.astype(np.int32), np.concatenate(([0], np.cumsum(counts)))) for values, counts in parts]
            yield pa.RecordBatch.from_arrays([groups.ids, *columns], names=["doc_id", "a_ids", "b_ids", "a_sizes", "b_sizes"])

    return aligned.mapInArrow(run, "doc_id long, a_ids array<int>, b_ids array<int>, a_sizes array<int>, b_sizes array<int>")


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in a binary column, and how many are in each row."""
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1] // 4
    return np.frombuffer(column.buffers()[2] or b"", "<i4")[ends[0]:ends[-1]], np.diff(ends).astype(np.int64)


class Groups:
    """The groups of some aligned documents, behind each other."""

    def __init__(self, batch: pa.RecordBatch):
        self.ids = batch.column(0)
        (a, self.n_a), (b, self.n_b) = _tokens(batch.column(1)), _tokens(batch.column(2))
        self.a, self.b = a >> 1, b >> 1
        self.a_ends, self.b_ends = np.flatnonzero(a & 1) + 1, np.flatnonzero(b & 1) + 1  # of each group, in tokens
        self.a_sizes, self.b_sizes = np.diff(self.a_ends, prepend=0), np.diff(self.b_ends, prepend=0)
        self.n_groups = np.diff(np.concatenate(([0], np.cumsum(a & 1)))[np.concatenate(([0], np.cumsum(self.n_a)))])
        self.last_a, self.last_b = self.a[self.a_ends - 1], self.b[self.b_ends - 1]  # the pair of ids that ends with each group

    def pairs(self) -> np.ndarray:
        return self.last_a.astype(np.int64) << 32 | self.last_b

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums over the groups of each document."""
        total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
        ends = np.cumsum(self.n_groups)
        return total[ends] - total[ends - self.n_groups]

    def written(self, a_size: int, words: list[str]) -> list[str]:
        """Each document's groups as ``a1,a2|b1;a3|b2``; ``words`` has every id with what follows it (``id_words``)."""
        codes = np.empty(len(self.a) + len(self.b), dtype=np.int64)
        a_code, b_code = 2 * self.a.astype(np.int64), 2 * (self.b.astype(np.int64) + a_size)
        a_code[self.a_ends - 1] += 1
        b_code[self.b_ends - 1] += 1
        codes[np.arange(len(self.a)) + np.repeat(self.b_ends - self.b_sizes, self.a_sizes)] = a_code
        codes[np.arange(len(self.b)) + np.repeat(self.a_ends, self.b_sizes)] = b_code
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(map(words.__getitem__, codes[x:y].tolist()))[:-1] for x, y in zip([0, *ends], ends)]


def id_words(a_size: int, b_size: int) -> list[str]:
    return [f"{i}{s}" for i in range(a_size) for s in ",|"] + [f"{i}{s}" for i in range(b_size) for s in ",;"]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[Groups]:
    for batch in batches:
        sizes = pc.add(pc.binary_length(batch.column(1)), pc.binary_length(batch.column(2))).to_numpy()
        piece = np.cumsum(sizes, dtype=np.int64) // (4 * PIECE_TOKENS)
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for x, y in zip(cuts, cuts[1:]):
            if y > x:
                yield Groups(batch.slice(x, y - x))


def count_links(aligned: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``a, b, n``: how often A id ``a`` and B id ``b`` end together, over all aligned documents.

    Each task counts its regular groups in a vector by A id and its other pairs once per pair; the
    vectors are summed up by A id, only the other pairs are shuffled as pairs. The two never hold
    the same pair: tokens of the same bytes that end together begin together, too.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identity = tokenizers(a_path, b_path).identity
        regular, keys, counts = np.zeros(len(identity), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for groups in _groups(batches):
            is_regular = (groups.a_sizes == 1) & (groups.b_sizes == 1) & (identity[groups.last_a] == groups.last_b)
            regular += np.bincount(groups.last_a[is_regular], minlength=len(identity))
            found, times = np.unique(groups.pairs()[~is_regular], return_counts=True)
            both = np.concatenate((keys, found))
            keys, place = np.unique(both, return_inverse=True)
            counts = np.bincount(place, np.concatenate((counts, times)), len(keys)).astype(np.int64)
        seen = np.flatnonzero(regular)
        a = np.concatenate((seen, keys >> 32)).astype(np.int32)
        b = pa.array(np.concatenate((np.zeros(len(seen)), keys & 0xFFFFFFFF)).astype(np.int32), mask=np.arange(len(a)) < len(seen))
        yield pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(np.concatenate((regular[seen], counts)))], names=["a", "b", "n"])

    counted = stored(aligned.mapInArrow(run, "a int, b int, n long"))
    spark = aligned.sparkSession
    identity = tokenizers(a_path, b_path).identity
    same = spark.createDataFrame([(a, int(b)) for a, b in enumerate(identity) if b >= 0], "a int, b int")
    regular = counted.filter("b IS NULL").groupBy("a").agg(F.sum("n").alias("n")).join(F.broadcast(same), "a")
    return regular.select("a", "b", "n").unionByName(counted.filter("b IS NOT NULL").groupBy("a", "b").agg(F.sum("n").alias("n")))


def score_links(aligned: DataFrame, counts: DataFrame, a_path: str, b_path: str, digest: bool = False) -> DataFrame:
    """Per aligned document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum`` and, with ``digest``, the SHA-256
    of its written groups ('' without tokens).

    A link is an A token and a B token that end together, one for each group. ``n_best`` counts those whose
    pair is the most frequent of their B id in ``counts`` (or as frequent), ``count_sum`` adds the counts up.
    """
    table = counts.toPandas().sort_values(["a", "b"])  # at most as many rows as the vocabularies have bytes
    a, b, n = (table[c].to_numpy(np.int64) for c in ("a", "b", "n"))
    top = np.zeros(int(b.max()) + 1 if len(b) else 0, np.int64)
    np.maximum.at(top, b, n)
    keys, best = a << 32 | b, n == top[b]
    kinds = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long" + ", groups_sha256 string" * digest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizers(a_path, b_path)
        words = id_words(len(coder.a_bytes), len(coder.b_bytes)) if digest else []
        for groups in _groups(batches):
            place = np.searchsorted(keys, groups.pairs())
            columns = [groups.ids, *[pa.array(c) for c in (groups.n_a, groups.n_b, groups.n_groups, groups.n_groups,
                                                           groups.sums(best[place]), groups.sums(n[place]))]]
            if digest:
                columns.append(pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in groups.written(len(coder.a_bytes), words)]))
            yield pa.RecordBatch.from_arrays(columns, names=[k.split()[0] for k in kinds.split(", ")])

    return aligned.mapInArrow(run, kinds)


def alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``score_links`` of all documents, with digests; the alignment is stored once for both passes over it."""
    aligned = stored(align_documents(docs, a_path, b_path))
    return score_links(aligned, count_links(aligned, a_path, b_path), a_path, b_path, digest=True)
