"""Token-id output: documents encoded with a public tokenizer, written as simple-8b files.

A file set is a Parquet folder, so that Spark's commit makes a rewrite after a lost executor safe and
any store Spark can reach will do. A row is a segment: whole documents in order, their token counts,
and the simple-8b words, escapes and block offsets of all their ids.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from string import punctuation
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recallspark.llm import simple8b
from recallspark.llm.batches import pieces
from recallspark.session import scratch_dir

SEGMENT = ("shard int, segment int, first_id long, n_ids long, doc_ids array<bigint>, doc_tokens array<bigint>, "
           "offsets binary, words binary, escaped binary")
#: Bytes of text that make up a segment (one longer text is a segment by itself).
SEGMENT_BYTES = 4_000_000
#: Words in each of the two generations of words whose ids a worker remembers.
REMEMBERED = 700_000
#: Characters of those words (a word may be as long as a text).
REMEMBERED_CHARS = 16_000_000


class WordEncoder:
    """Ids of texts, for tokenizers that drop white space and let no token cross it.

    Texts are cut into words by Arrow, each distinct word of a batch is looked up once, and the ids are
    gathered by index. Each distinct word goes through the tokenizers library once; a closing full stop
    or comma after letters is a token run of its own there, so such a word is put together from its parts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of new words: letters with punctuation behind them as two parts, ASCII letters in lower case."""
        known, older = self.known, self.older
        parts, single, other = [], set(), set()
        for w in words:
            ids = older.get(w)
            if ids is not None:
                known[w] = ids
                continue
            body = w.rstrip(punctuation)
            if not body.isalpha():
                other.add(w)
                continue
            plain = body.lower() if body.isascii() else body
            if plain not in known:
                # a word of letters alone is one token run, whose last token is a word end: many go through together
                (single if plain.isascii() or plain.lower().isalpha() and is_normalized("NFC", plain) else other).add(plain)
            if plain != w:
                tail = w[len(body):]
                if tail and tail not in known:
                    other.add(tail)
                parts.append((w, plain, tail))
        alone = list(single)
        for start in range(0, len(alone), 4000):
            some = alone[start:start + 4000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(some):
                other.update(some)
                continue
            data, cuts = ids.tobytes(), (4 * ends).tolist()
            known.update(zip(some, [data[x:y] for x, y in zip([0, *cuts], cuts)]))
        alone = list(other)
        for word, found in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            known[word] = np.array(found.ids, dtype="<u4").tobytes()
        for w, body, tail in parts:
            known[w] = known[body] + known[tail] if tail else known[body]
        self.held += sum(map(len, words))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: none) one behind the other, and the end of each text's ids among them."""
        column = pc.fill_null(column, "")
        # the tokenizer folds case; special tokens are matched before that
        plain = pc.and_(pc.string_is_ascii(column), pc.invert(pc.match_substring(column, "<|")))
        words = pc.ascii_split_whitespace(pc.if_else(plain, pc.ascii_lower(column), column))
        coded = words.flatten().dictionary_encode()
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_CHARS:
            self.known, self.older, self.held = {"": b""}, self.known, 0
        distinct, known = coded.dictionary.to_numpy(zero_copy_only=False), self.known
        found = list(map(known.get, distinct))
        fresh = [i for i, ids in enumerate(found) if ids is None]
        self._learn([distinct[i] for i in fresh])
        for i in fresh:
            found[i] = known[distinct[i]]
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        pool, starts = np.frombuffer(b"".join(found), dtype="<u4"), np.cumsum(sizes) - sizes
        index = coded.indices.to_numpy()
        ends = np.cumsum(sizes[index])
        cuts = words.offsets.to_numpy()[1:]
        return _gathered(pool, starts, sizes, index), np.concatenate(([0], ends))[cuts]


def _gathered(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray, index: np.ndarray, block: int = 500_000) -> np.ndarray:
    """``pool[starts[i]:starts[i] + sizes[i]]`` of all ``i`` in ``index``, a block of them at a time."""
    out = [pool[:0]]
    for at in range(0, len(index), block):
        some = index[at:at + block]
        lengths = sizes[some]
        shift = starts[some] - (np.cumsum(lengths) - lengths)
        places = np.repeat(shift, lengths)
        places += np.arange(len(places))
        out.append(pool[places])
    return np.concatenate(out)


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path)


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts, add ``end_id`` to each, and write segments in ascending id order.

    Null texts are empty. Rows with a null id come first; rows with equal ids follow each other by
    text. Documents are dealt to shards by ranges of ids; shard numbers ascend with the ids.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, segment, first = word_encoder(tokenizer_path), TaskContext.get().partitionId(), 0, 0
        for batch in pieces(batches, limit=SEGMENT_BYTES):
            found, ends = encoder.encode(batch.column(1))
            counts = (np.diff(ends, prepend=0) + 1).tolist()
            ids = np.insert(found, ends, end_id)
            words, escaped, offsets = simple8b.encode(ids)
            columns = [[shard], [segment], [first], [len(ids)], [batch.column(0).to_pylist()], [counts],
                       [offsets.tobytes()], [words.tobytes()], [escaped.tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.binary(), pa.binary(), pa.binary()]
            names = [field.split()[0] for field in SEGMENT.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            segment, first = segment + 1, first + len(ids)

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(write, SEGMENT).write.option("compression", "zstd").mode("errorifexists").parquet(folder)


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SEGMENT).parquet(folder)


def segment_ids(words: bytes, escaped: bytes) -> np.ndarray:
    return simple8b.decode(np.frombuffer(words, np.uint64), np.frombuffer(escaped, np.uint64))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files alone.

    ``start`` counts the ids of all documents before it: the totals of the shards (one row per
    shard) are summed up in order, and added to the place inside the shard.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, first, docs, counts, words, escaped = (batch.column(i)[row].as_py() for i in range(6))
                ids = segment_ids(words, escaped).astype("<u4")
                ends = np.cumsum(np.array(counts, dtype=np.int64))
                starts = ends - counts
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array([shard] * len(docs), pa.int32()), pa.array(starts + first),
                     pa.array(counts, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "shard", "place", "n_tokens", "ids_crc32"])

    segments = read_segments(spark, folder)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (segments.groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
             .select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")))
    found = segments.select("shard", "first_id", "doc_ids", "doc_tokens", "words", "escaped").mapInArrow(
        read, "doc_id long, shard int, place long, n_tokens long, ids_crc32 long")
    return found.join(bases, "shard").select("doc_id", (F.col("place") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Write the files of ``docs`` into a new folder (in the shared one, if none is given) and read them back."""
    spark = docs.sparkSession
    folder = folder or f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"
    write_token_files(docs, folder, tokenizer_path, end_id)
    return read_token_files(spark, folder)
