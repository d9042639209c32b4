"""Language ID as mixture inference: EM over a document's words, languages chosen by penalised likelihood."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recallspark.llm.batches import pieces, texts

#: Buckets of the n-gram table, additive smoothing, characters of an n-gram.
BUCKETS, SMOOTH, ORDER = 1 << 16, 0.1, 3
#: Languages that a model may have: its table has BUCKETS x languages numbers of four bytes.
MAX_LANGUAGES = 200
#: EM stops at this change of a share, or after so many rounds.
TOLERANCE, ROUNDS = 1e-3, 25
UNDETERMINED = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Code point -> its lower case if it is a letter, else the space."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def word_grams(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(buckets, word_starts, words_per_text)`` of the n-grams of runs of letters.

    A word of k letters has k + 1 n-grams: those that end at its letters and at the space behind
    it; what lies before the word is one space (repeated). So a word means the same everywhere.
    """
    joined = _folded()[np.frombuffer("".join(" " + t + " " for t in batch).encode("utf-32-le"), dtype=np.uint32)]
    letter = joined != 32
    begins = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    ends = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    sizes = ends - begins + 1
    word = np.repeat(np.arange(len(begins)), sizes)
    firsts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64) if len(begins) else np.zeros(0, np.int64)
    at = np.arange(len(word)) - firsts[word] + begins[word] if len(begins) else np.zeros(0, np.int64)
    key = joined[at].astype(np.uint64)
    for back in range(1, ORDER):
        inside = at - back >= begins[word] if len(begins) else at
        key = key * np.uint64(0x1FFFFF) + np.where(inside, joined[np.maximum(at - back, 0)], 32).astype(np.uint64)
    buckets = ((key * _MIX) >> np.uint64(64 - 16)).astype(np.int32)
    limits = np.cumsum([len(t) + 2 for t in batch])
    of_text = np.bincount(np.searchsorted(limits, begins, side="right"), minlength=len(batch))
    return buckets, firsts, of_text


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """``(languages, log likelihoods)`` from all labelled rows; rows without text or language are left out.

    Every partition counts its hashed n-grams per language, Spark sums the counts. The table has
    BUCKETS rows whatever the input; a table with over MAX_LANGUAGES languages is refused.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in pieces(batches):
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            whole = texts(batch)
            for lang in set(langs):
                buckets, _, _ = word_grams([whole[i] for i in np.flatnonzero(langs == lang)])
                sums[lang] = sums.get(lang, 0) + np.bincount(buckets, minlength=BUCKETS)
        for lang, seen in sums.items():
            some = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)),
                                              pa.array(seen[some].astype(np.int64))], names=["lang", "bucket", "n"])

    labelled = docs.select(docs[text_col].alias("text"), docs[lang_col].cast("string").alias("lang"))
    labelled = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    names = [r.lang for r in labelled.select("lang").distinct().orderBy("lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    counts = labelled.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = np.full((BUCKETS, len(names)), SMOOTH)
    for lang, buckets, seen in counts.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n")).toLocalIterator():
        table[buckets, names.index(lang)] += seen
    return names, np.log(table / table.sum(axis=0)).astype(np.float32)


def _runs(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of rows of ``values`` over runs, 0 for empty runs."""
    out = np.zeros((len(sizes),) + values.shape[1:], dtype=np.float64)
    full = sizes > 0
    if full.any():
        out[full] = np.add.reduceat(values, starts[full], axis=0, dtype=np.float64)
    return out


def infer(batch: list[str], table: np.ndarray) -> np.ndarray:
    """Shares of the languages in each text (rows sum to 1; all 0 without letters).

    A word's likelihood in a language is the product over its n-grams; EM fits the shares to all
    words of a text. Languages are kept by the Bayesian criterion: the first k of them by share,
    for the k with the largest log likelihood - k / 2 * log(words), going up while that grows.
    """
    n_lang = table.shape[1]
    shares = np.zeros((len(batch), n_lang))
    buckets, firsts, n_words = word_grams(batch)
    if not len(firsts) or not n_lang:
        return shares
    grams = np.diff(np.append(firsts, len(buckets)))
    logs = np.empty((len(firsts), n_lang), dtype=np.float64)
    step = 1 << 18
    for start in range(0, len(firsts), step):  # the n-gram rows of a part of the words at a time
        stop = min(start + step, len(firsts))
        a, b = firsts[start], firsts[stop - 1] + grams[stop - 1]
        logs[start:stop] = np.add.reduceat(table[buckets[a:b]], firsts[start:stop] - a, axis=0)
    top = logs.max(axis=1, keepdims=True)
    like = np.exp(logs - top)

    def fit(which: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares and log likelihoods (less the words' own tops) of some texts with their allowed languages."""
        starts_all = np.concatenate(([0], np.cumsum(n_words)[:-1]))
        mask = np.repeat(np.isin(np.arange(len(batch)), which), n_words)
        own, sizes = like[mask], n_words[which]
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        of = np.repeat(np.arange(len(which)), sizes)
        pi = allowed / allowed.sum(axis=1, keepdims=True)
        going, rows, at, count, row_of = np.arange(len(which)), own, starts, sizes, of
        for _ in range(ROUNDS):  # a text stops when its own shares do, whatever the others of the batch
            weight = rows * pi[going][row_of]
            weight /= np.maximum(weight.sum(axis=1, keepdims=True), 1e-300)
            new = _runs(weight, at, count) / count[:, None]
            moving = np.abs(new - pi[going]).max(axis=1, initial=0) >= TOLERANCE
            pi[going] = new
            if not moving.any():
                break
            if not moving.all():
                rows, going, count = rows[np.repeat(moving, count)], going[moving], count[moving]
                at, row_of = np.concatenate(([0], np.cumsum(count)[:-1])), np.repeat(np.arange(len(going)), count)
        fitted = _runs(np.log(np.maximum((own * pi[of]).sum(axis=1), 1e-300)), starts, sizes)
        return pi, fitted

    live = np.flatnonzero(n_words)
    full, _ = fit(live, np.ones((len(live), n_lang)))
    order = np.argsort(-full, axis=1, kind="stable")
    penalty = 0.5 * np.log(np.maximum(n_words[live], 2))
    best, best_shares, going = np.full(len(live), -np.inf), np.zeros((len(live), n_lang)), np.arange(len(live))
    for k in range(1, n_lang + 1):
        allowed = np.zeros((len(going), n_lang))
        np.put_along_axis(allowed, order[going, :k], 1.0, axis=1)
        pi, fitted = fit(live[going], allowed)
        value = fitted - k * penalty[going]
        better = value > best[going]
        best[going[better]], best_shares[going[better]] = value[better], pi[better]
        going = going[better]
        if not len(going):
            break
    shares[live] = best_shares
    return shares


FOUND = "lang_pred string, score double, languages map<string,double>"


def language_of(docs: DataFrame, text: Column, languages: list[str], table: np.ndarray) -> Column:
    """A struct ``lang_pred, score, languages`` for a column of texts of ``docs``; only the texts go through Python.

    ``lang_pred`` has the largest share (the first by name of equal ones), ``score`` is that share
    and ``languages`` maps the chosen languages to theirs. A text that is null, empty or without
    letters (or any, if the model knows no language) is ``und`` with score 0. Very long texts are
    worked on one at a time. The model is BUCKETS x languages numbers, sent to every task.
    """
    model = docs.sparkSession.sparkContext.broadcast((languages, table))
    kind = pa.map_(pa.string(), pa.float64())

    @F.arrow_udf(FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, likelihoods = model.value
        for column in batches:
            parts = []
            for batch in pieces(iter([pa.RecordBatch.from_arrays([column], names=["text"])]), limit=1_000_000):
                shares = infer(texts(batch), likelihoods)
                top = shares.argmax(axis=1) if names else np.zeros(len(shares), dtype=int)
                score = shares.max(axis=1) if names else np.zeros(len(shares))
                parts.append((pa.array([names[i] if s > 0 else UNDETERMINED for i, s in zip(top, score)], pa.string()), pa.array(np.minimum(score, 1.0)),
                              pa.array([[(names[i], float(row[i])) for i in np.flatnonzero(row)] for row in shares], kind)))
            columns = [pa.concat_arrays(c) for c in zip(*parts)] if parts else [pa.array([], k) for k in (pa.string(), pa.float64(), kind)]
            yield pa.StructArray.from_arrays(columns, names=["lang_pred", "score", "languages"])

    return found(text)


def identify(docs: DataFrame, languages: list[str], table: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, languages`` (see ``language_of``) of every whole text, one row per row; no shuffle.

    Nothing but the text is used. Ids may be null or repeated; other columns, whatever their names, are ignored.
    """
    plain = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return plain.withColumn("found", language_of(plain, F.col("text"), languages, table)).select("doc_id", "found.*")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the decimal id, modulo ``modulus`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus
