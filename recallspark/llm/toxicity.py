"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recallspark.llm.batches import pieces, texts
from recallspark.llm.hashing import chain, span_hashes
from recallspark.llm.language_mixture import _folded
from recallspark.llm.storage import pack, unpack
from recallspark.session import checkpoint

#: Feature buckets; the coordinate behind the last one is the bias.
BITS, BIAS = 26, 1 << 26
#: FTRL-proximal: rate, its offset, L1 and L2.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 10.0, 0.1
#: The documented bound of the training sample (labelled rows), the rows of a shard, and how often
#: the shards, each trained from the mean of all, go through their rows.
SAMPLE, SHARD_ROWS, ROUNDS = 20_000, 5_000, 5
#: Hash ranges of the buckets; the shards' states of a range are averaged together.
PARTS = 64
STATE = "part int, shard int, bucket binary, z binary, n binary, dz binary, dn binary"


def features(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(text numbers, buckets)`` of all words, word pairs, and pairs that skip one word."""
    limits = np.cumsum([len(t) + 1 for t in batch])
    codes = _folded()[np.frombuffer("".join(t + " " for t in batch).encode("utf-32-le"), dtype=np.uint32)]
    letter = np.concatenate(([False], codes != 32))
    begins = np.flatnonzero(letter[1:] & ~letter[:-1])
    ends = np.flatnonzero(letter[:-1] & ~letter[1:])
    of = np.searchsorted(limits, begins, side="right")
    word = span_hashes(codes, begins, ends)
    rows, hashes = [of], [chain(word)]
    for gap in (1, 2):
        same = np.flatnonzero(of[:-gap] == of[gap:])
        rows.append(of[same])
        hashes.append(chain(word[same], word[same + gap], np.full(len(same), gap, dtype=np.uint64)))
    return np.concatenate(rows), (np.concatenate(hashes) >> np.uint64(64 - BITS)).astype(np.int32)


def ftrl(examples: list[np.ndarray], labels: list[int], z: np.ndarray, n: np.ndarray) -> None:
    """One pass over examples (their distinct buckets), in place on the state of the coordinates."""
    for at, label in zip(examples, labels):
        zi, ni = z[at], n[at]
        root = np.sqrt(ni)
        w = np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + root) / ALPHA + L2))
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        more = ni + g * g
        z[at] = zi + g - (np.sqrt(more) - root) / ALPHA * w
        n[at] = more


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """``(buckets, weights, bias)``: the sorted buckets whose weight is not 0.

    Learns from at most ``sample`` labelled rows, those with the smallest hashed ids; rows without
    text, id or label are left out. Shards of SHARD_ROWS rows each run FTRL from the mean state of
    the round before, and the states are averaged by feature. A shard holds the coordinates of its
    own rows, a range of buckets those of all shards, and the driver the weights that are not 0.
    L1 alone leaves out features; those that it is bound to are not carried (``_start``). Without a labelled row there are no weights.
    """
    marked = labels.select(labels[id_col].alias("doc_id"), labels[label_col].cast("int").alias("label")).dropna()
    plain = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).dropna()
    chosen = checkpoint(marked.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample))
    rows = chosen.count()
    shards = max(1, -(-rows // SHARD_ROWS))

    def open_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            of, buckets = features(texts(batch))
            found = [np.unique(buckets[of == i]) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32())), batch.column(2)],
                                             names=["doc_id", "buckets", "label"])

    # the chosen ids are bounded by ``sample``, so they may be broadcast
    examples = checkpoint(plain.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
                          .mapInArrow(open_up, "doc_id long, buckets array<int>, label int")
                          .withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int")))
    by_shard = examples.groupBy("shard")
    state = by_shard.applyInPandas(_counts, STATE).groupBy("part").applyInPandas(
        lambda found: _start(found, shards), STATE)
    for _ in range(ROUNDS if rows else 0):
        moved = by_shard.cogroup(state.groupBy("shard")).applyInPandas(_one_pass, STATE)
        state = moved.groupBy("part").applyInPandas(lambda found: _mean(found, shards), STATE)

    def not_zero(found: pd.DataFrame) -> pd.DataFrame:
        bucket, z, n = _joined(found, "z", "n")
        bucket, first = np.unique(bucket, return_index=True)
        value = weights(z[first], n[first])
        return pd.DataFrame({"bucket": bucket, "weight": value})[value != 0]

    final = state.groupBy("part").applyInPandas(not_zero, "bucket int, weight double").toPandas().sort_values("bucket")
    known, value = final["bucket"].to_numpy(dtype=np.int32), final["weight"].to_numpy(dtype=float)
    is_bias = known == BIAS
    return known[~is_bias], value[~is_bias], float(value[is_bias].sum())


def _joined(found: pd.DataFrame, *names: str) -> list[np.ndarray]:
    """The buckets of packed state rows, and the named numbers, one behind the other."""
    buckets = [unpack(b, np.int32, rising=True) for b in found["bucket"]]
    return [np.concatenate([np.zeros(0, np.int32), *buckets]),
            *[np.concatenate([np.zeros(0), *[unpack(b, float) for b in found[name]]]) for name in names]]


def _packed(rows: list[tuple]) -> pd.DataFrame:
    """State rows of (part, shard, rising buckets, z, n, dz, dn)."""
    return pd.DataFrame([(part, shard, pack(bucket, rising=True), *[pack(v) for v in values])
                         for part, shard, bucket, *values in rows if len(bucket)],
                        columns=["part", "shard", "bucket", "z", "n", "dz", "dn"])


def _dealt(shard: int, bucket: np.ndarray, *values: np.ndarray) -> pd.DataFrame:
    """The state of a shard by range; the buckets are hashes and rise."""
    cuts = np.searchsorted(bucket, np.arange(PARTS + 1, dtype=np.int64) * (BIAS // PARTS))
    cuts[-1] = len(bucket)  # the bias belongs to the last range
    return _packed([(part, shard, bucket[i:j], *[v[i:j] for v in values]) for part, (i, j) in enumerate(zip(cuts, cuts[1:]))])


def _counts(rows: pd.DataFrame) -> pd.DataFrame:
    """The distinct coordinates of a shard, with their number of rows as ``dn``."""
    bucket, count = np.unique(np.concatenate([*rows["buckets"], np.full(len(rows), BIAS, dtype=np.int32)]), return_counts=True)
    none = np.zeros(len(bucket))
    return _dealt(int(rows["shard"].iloc[0]), bucket.astype(np.int32), none, none, none, count.astype(float))


def _start(found: pd.DataFrame, shards: int) -> pd.DataFrame:
    """The coordinates at 0, without those whose weight is 0 in every round whatever the labels.

    While a weight is 0 each row moves z by less than 1, and a shard starts from the mean, so with
    c rows z stays within c + (ROUNDS - 1) * c / shards. Up to L1 the weight is 0.
    """
    bucket, count = _joined(found, "dn")
    distinct, at = np.unique(bucket, return_inverse=True)
    kept = np.bincount(at, weights=count, minlength=len(distinct)) * (1 + (ROUNDS - 1) / shards) > L1
    out = []
    for part, shard, packed in zip(found["part"], found["shard"], found["bucket"]):
        own = unpack(packed, np.int32, rising=True)
        own = own[kept[np.searchsorted(distinct, own)]]
        out.append((part, shard, own, *[np.zeros(len(own))] * 4))
    return _packed(out)


def _one_pass(rows: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
    """How one pass over a shard moves the state of its coordinates."""
    if not len(rows) or not len(found):
        return _packed([])
    rows = rows.sort_values("doc_id")
    known, z, n = _joined(found.sort_values("part"), "z", "n")
    own_z, own_n, examples = z.copy(), n.copy(), []
    for buckets in rows["buckets"]:
        buckets = np.append(buckets, np.int32(BIAS))
        at = np.minimum(np.searchsorted(known, buckets), len(known) - 1)
        examples.append(at[known[at] == buckets])
    ftrl(examples, rows["label"].tolist(), own_z, own_n)
    return _dealt(int(rows["shard"].iloc[0]), known, z, n, own_z - z, own_n - n)


def _mean(found: pd.DataFrame, shards: int) -> pd.DataFrame:
    """The state of a range averaged over all shards, for each shard that has the coordinate."""
    found = found.sort_values("shard")
    bucket, z, n, dz, dn = _joined(found, "z", "n", "dz", "dn")
    distinct, first, at = np.unique(bucket, return_index=True, return_inverse=True)
    z = z[first] + np.bincount(at, weights=dz, minlength=len(distinct)) / shards
    n = n[first] + np.bincount(at, weights=dn, minlength=len(distinct)) / shards
    out = []
    for part, shard, packed in zip(found["part"], found["shard"], found["bucket"]):
        own = unpack(packed, np.int32, rising=True)
        place = np.searchsorted(distinct, own)
        out.append((part, shard, own, z[place], n[place], *[np.zeros(len(own))] * 2))
    return _packed(out)


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` (0 to 1) of every whole text; null texts are empty and get the bias alone.

    A feature counts once per text. A model without weights scores 0. Only the non-zero weights
    are sent out, which the training sample bounds; no shuffle.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, value, bias = sent.value
        likely = np.zeros(1 << 16, dtype=bool)
        likely[known & 0xFFFF] = True
        for batch in pieces(batches, limit=1_000_000):
            of, buckets = features(texts(batch))
            some = np.flatnonzero(likely[buckets & 0xFFFF])
            at = np.minimum(np.searchsorted(known, buckets[some]), max(0, len(known) - 1))
            hit = known[at] == buckets[some] if len(known) else np.zeros(0, dtype=bool)
            once = np.unique(of[some[hit]].astype(np.int64) * len(known) + at[hit])
            total = np.full(batch.num_rows, bias)
            if len(once):
                total += np.bincount(once // len(known), weights=value[once % len(known)], minlength=batch.num_rows)
            scores = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))) if len(known) else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(scores)], names=["doc_id", "score"])

    plain = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return plain.mapInArrow(run, "doc_id long, score double")
