"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

The leaf of a live position holds the rank of the pair that starts there (with the position, so that
the root is the leftmost minimum); a merge takes the root, and updates three leaves and the nodes
above them: the merged position, the one it swallowed, and its live neighbour on the left. Pieces up
to SHORT bytes go through their trees side by side, one numpy step for all; longer ones one by one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from recallspark.llm.batches import lists, pieces, texts

SHORT = 64
#: Text runs in each of the two generations of runs whose ids a worker remembers.
REMEMBERED = 200_000
_NONE = np.int64(1) << 60
#: Two white-space characters in a row: then a text is cut by the pattern alone.
_GAP = regex.compile(r"[\s\x1c-\x1f\x85]{2}")


class BytePairs:
    """Encoder and decoder for a rank file (one line per token: base64 of its bytes, rank)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.pattern = regex.compile(pattern)
        pairs = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.merged = np.array([pairs[k] for k in self.keys.tolist()], dtype=np.int64)
        self.of_byte = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        if (self.of_byte < 0).any():
            raise ValueError(f"{path} lacks single bytes, so not every text can be encoded")
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens; _NONE where they don't merge."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merged[at], _NONE)

    def merge_long(self, piece: bytes) -> list[int]:
        """Ids of one piece of any length: a segment tree in a list."""
        n, size = len(piece), 1 << max(1, (len(piece) - 1).bit_length())
        tokens = [int(self.of_byte[b]) for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        none, pairs = (int(_NONE), 0), self.pairs
        tree = [none] * (2 * size)

        def put(i: int, rank: int | None) -> None:
            at = size + i
            tree[at] = none if rank is None else (rank, i)
            while at > 1:
                at >>= 1
                best = min(tree[2 * at], tree[2 * at + 1])
                if tree[at] == best:
                    break
                tree[at] = best

        for i in range(n - 1):
            rank = pairs.get(tokens[i] << 32 | tokens[i + 1])
            tree[size + i] = none if rank is None else (rank, i)
        for at in range(size - 1, 0, -1):
            tree[at] = min(tree[2 * at], tree[2 * at + 1])
        while tree[1] is not none and tree[1][0] < none[0]:
            rank, i = tree[1]
            gone = after[i]
            tokens[i], after[i] = rank, after[gone]
            if after[i] < n:
                before[after[i]] = i
            put(gone, None)
            put(i, pairs.get(rank << 32 | tokens[after[i]]) if after[i] < n else None)
            if before[i] >= 0:
                put(before[i], pairs.get(tokens[before[i]] << 32 | rank))
        ids, i = [], 0
        while i < n:
            ids.append(tokens[i])
            i = after[i]
        return ids

    def merge_short(self, batch: list[bytes], size: int) -> list[bytes]:
        """Ids of many pieces of at most ``size`` bytes: one tree each, moved on together."""
        m, bits = len(batch), size.bit_length() - 1
        lengths = np.array([len(p) for p in batch])
        inside = np.arange(size) < lengths[:, None]
        tokens = np.full((m, size), -1, dtype=np.int64)
        tokens[inside] = self.of_byte[np.frombuffer(b"".join(batch), dtype=np.uint8)]
        after = np.minimum(np.arange(1, size + 1), size) + np.zeros((m, 1), dtype=np.int64)
        after[after >= lengths[:, None]] = size
        before = np.arange(-1, size - 1) + np.zeros((m, 1), dtype=np.int64)
        tree = np.full((m, 2 * size), _NONE, dtype=np.int64)
        row, col = np.nonzero(inside[:, 1:])
        rank = self._rank_of(tokens[row, col], tokens[row, col + 1])
        tree[row, size + col] = np.where(rank < _NONE, rank << bits | col, _NONE)
        for level in range(bits - 1, -1, -1):
            width = 1 << level
            tree[:, width:2 * width] = np.minimum(tree[:, 2 * width:4 * width:2], tree[:, 2 * width + 1:4 * width:2])

        def put(rows: np.ndarray, at: np.ndarray, rank: np.ndarray) -> None:
            node = at + size
            tree[rows, node] = np.where(rank < _NONE, rank << bits | at, _NONE)
            for _ in range(bits):
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        rows = np.flatnonzero(tree[:, 1] < _NONE)
        while len(rows):
            best = tree[rows, 1]
            at, rank = best & (size - 1), best >> bits
            gone = after[rows, at]
            right, left = after[rows, gone], before[rows, at]
            tokens[rows, at], tokens[rows, gone], after[rows, at] = rank, -1, right
            put(rows, gone, np.full(len(rows), _NONE))
            has = right < size
            before[rows[has], right[has]] = at[has]
            joined = np.full(len(rows), _NONE)
            joined[has] = self._rank_of(rank[has], tokens[rows[has], right[has]])
            put(rows, at, joined)
            has = left >= 0
            put(rows[has], left[has], self._rank_of(tokens[rows[has], left[has]], rank[has]))
            rows = rows[tree[rows, 1] < _NONE]
        alive = tokens >= 0
        ids, ends = tokens[alive].astype("<i4").tobytes(), (4 * np.cumsum(alive.sum(axis=1))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def encode_pieces(self, batch: list[bytes]) -> list[bytes]:
        """Ids (as 32-bit integers) of pieces, each encoded separately; a piece that is a token is that token."""
        out: list = [None] * len(batch)
        by_size: dict[int, list[int]] = {}
        for i, piece in enumerate(batch):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(piece) > SHORT:
                out[i] = np.array(self.merge_long(piece), dtype="<i4").tobytes()
            else:
                by_size.setdefault(1 << max(1, (len(piece) - 1).bit_length()), []).append(i)
        for size, members in by_size.items():
            for start in range(0, len(members), 20_000):
                some = members[start:start + 20_000]
                for i, ids in zip(some, self.merge_short([batch[i] for i in some], size)):
                    out[i] = ids
        return out

    def _learn(self, runs: set[str]) -> None:
        """Remember the ids of text runs that the pattern cuts independently of their surroundings."""
        again = runs.intersection(self.older)
        self.known.update((r, self.older[r]) for r in again)
        new = list(runs.difference(again))
        matches = [self.pattern.findall(r) for r in new]
        pieces_ = list(set().union(*matches).difference(self.known))
        self.known.update(zip(pieces_, self.encode_pieces([p.encode() for p in pieces_])))
        known = self.known
        known.update((r, b"".join([known[m] for m in found])) for r, found in zip(new, matches) if len(found) != 1)

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        """Ids of whole texts.

        The pattern always starts a new match at a single space between two other characters, so a
        text without two white-space characters in a row is a sequence of runs, each but the first
        with the space before it, that can be encoded and remembered apart.
        """
        runs = []
        for text in batch:
            if _GAP.search(text):
                runs.append(self.pattern.findall(text))
            else:
                first, *rest = text.split(" ")
                runs.append([first, *[" " + r for r in rest]])
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        self._learn(set().union(*runs).difference(self.known))
        known = self.known.__getitem__
        return [np.frombuffer(b"".join(map(known, r)), dtype="<i4") for r in runs]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ids; raises IndexError for an id that the vocabulary lacks."""
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def byte_pairs(path: str, pattern: str) -> BytePairs:
    return BytePairs(path, pattern)


def _plain(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     decoded: bool = False) -> DataFrame:
    """``doc_id, ids`` of every whole text, and with ``decoded`` the bytes its ids decode to.

    Null and empty texts have no ids. One row per input row, ids repeated or null or not; other
    columns are ignored. No shuffle: each task works through its own rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))] + [("decoded", pa.binary())] * decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_pairs(path, pattern)
        coder.forget()  # what the worker learned in another task goes, so that memory does not add up over stages
        for batch in pieces(batches):
            encoded = coder.encode(texts(batch))
            offsets = np.cumsum([0] + [len(e) for e in encoded])
            columns = [batch.column(0).cast(pa.int64()), lists(np.concatenate(encoded), offsets)]
            if decoded:
                columns.append(pa.array([coder.decode(e.tolist()) for e in encoded], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        coder.forget()

    kinds = "doc_id long, ids array<int>" + ", decoded binary" * decoded
    return _plain(docs, id_col, text_col).mapInArrow(run, kinds)


def decode_documents(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, decoded`` (bytes) of every row of ids; null ids decode to no bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_pairs(path, pattern)
        for batch in batches:
            texts_ = pa.array([coder.decode(x or []) for x in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), texts_], names=["doc_id", "decoded"])

    return encoded.select(encoded[id_col].alias("doc_id"), encoded[ids_col].alias("ids")).mapInArrow(
        run, "doc_id long, decoded binary")
