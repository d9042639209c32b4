"""From the table of documents to token ids: language, exact copies, near copies, leaks, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each one's rows to the
shared folder and gives what it reads back to the next. All stages but the last return rows of their input,
unchanged. What a stage decides holds for the rows that the stage before it kept, and uses nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recallspark.llm.byte_bpe import encode_documents
from recallspark.llm.decontaminate import find_leaks
from recallspark.llm.exact_dedup import exact_dedup
from recallspark.llm.jaccard_join import jaccard_components
from recallspark.llm.language_mixture import UNDETERMINED, language_of, train
from recallspark.llm.storage import stored

#: Keys that may be broadcast (some ten bytes each) to drop their rows; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000


def _without(docs: DataFrame, dropped: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``docs`` whose keys are not in ``dropped``; a row with a null key stays."""
    dropped = stored(dropped.select(*keys).distinct())
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, keys, "left_anti")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: null, empty and without letters.

    The model learns from the labelled rows of its input; without any of them it rejects nothing.
    """
    languages, likelihoods = train(docs)
    if not languages:
        return docs
    found = docs.withColumn("_found", language_of(docs, F.col("text"), languages, likelihoods))
    return found.filter(F.col("_found.lang_pred") != UNDETERMINED).select(docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays; of rows that repeat id and text, one.

    Rows without id stay only where no row with an id has their text, one for each text.
    """
    marks = exact_dedup(docs)
    keys = ["doc_id", "text_sha256"]
    rows = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), F.struct("*").alias("row"))
    kept = _without(rows.filter("doc_id IS NOT NULL"), marks.filter("doc_id IS NOT NULL AND NOT kept"), keys)
    again = stored(marks.filter("kept").groupBy(keys).count().filter("count > 1").select(keys))
    if again.limit(1).count():
        kept = _without(kept, again, keys).unionByName(kept.join(again, keys, "left_semi").dropDuplicates(keys))
    alone = marks.filter("doc_id IS NULL AND keep_id IS NULL").select("text_sha256").distinct()
    nameless = rows.filter("doc_id IS NULL").join(alone, "text_sha256", "left_semi").dropDuplicates(["text_sha256"])
    return kept.unionByName(nameless, allowMissingColumns=False).select("row.*")


def _drop(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` without those whose id and text ``dropped`` holds."""
    keys = ["doc_id", "text_sha256"]
    rows = docs.select("doc_id", _digest().alias("text_sha256"), F.struct("*").alias("row"))
    return _without(rows, dropped, keys).select("row.*")


def _digest() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles (0.75 or more), the one with the smallest id stays.

    Where an id has several texts, those not linked with a smaller id stay: the rows of such ids are
    told apart by numbers of their own. Rows without an id stay.
    """
    several = stored(docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id"))
    if not several.limit(1).count():
        found = jaccard_components(docs)
        return _without(docs, found.filter("doc_id <> component_id"), ["doc_id"])
    named = docs.select("doc_id", "text", _digest().alias("text_sha256")).dropDuplicates(["doc_id", "text_sha256"])
    # numbers in order of id, then text; rows without id come last, but still link others
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_sha256")]
    ranked = stored(named.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("rank", F.monotonically_increasing_id()))
    found = jaccard_components(ranked, id_col="rank")
    gone = found.filter("rank <> component_id").select("rank")
    return _drop(docs, ranked.join(gone, "rank", "left_semi"))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold 0.75 or more of the five-word shingles of a benchmark item.

    Where an id has several texts, only those that hold the item go. Rows without an id stay.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = stored(find_leaks(docs, benchmark).select("doc_id").distinct())
    suspects = docs.join(F.broadcast(found) if found.count() <= BROADCAST_ROWS else found, "doc_id", "left_semi")
    several = suspects.groupBy("doc_id").agg(F.countDistinct(_digest()).alias("n")).filter("n > 1")
    if not several.limit(1).count():
        return _without(docs, found, ["doc_id"])
    alone = stored(suspects.select("doc_id", "text", _digest().alias("text_sha256")).dropDuplicates(["doc_id", "text_sha256"])
                   .withColumn("number", F.monotonically_increasing_id()))
    gone = find_leaks(alone.select(F.col("number").alias("doc_id"), "text"), benchmark).select(F.col("doc_id").alias("number")).distinct()
    return _drop(docs, alone.join(gone, "number", "left_semi"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_tokens``: the byte-level BPE ids of each whole text that is left."""
    import public_tokenizers
    encoded = encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies), ("leaks", leaks), ("tokens", tokens)]

#: SQL has no byte-level BPE (nor the language model): tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs


ENTRIES = {"pipeline": (run, ORACLE_SQL)}
