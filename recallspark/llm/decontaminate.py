"""Benchmark decontamination: size-partitioned MinHash containment search, then exact containment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recallspark.llm.shingles import WIDTH, shingle_texts, with_shingle_hashes, words
from recallspark.session import checkpoint

#: Percent of an item's shingles that a document must hold.
MIN_PERCENT = 75
#: Rows of 16 bytes that one broadcast may hold at most; beyond it the search goes in blocks of the
#: sketch and the check by a shuffled join.
BROADCAST_ROWS = 1_000_000
# Arrays are opened with explode_outer: for explode, Spark adds a filter size(array) > 0 and pushes it
# down to the scan, where it computes all shingles of a text once more for every place they are named.


def sketch_size(n: Column, min_percent: int = MIN_PERCENT) -> Column:
    """Minimum hashes kept for an item of ``n`` shingles: that of the largest item of its size part.

    Parts are [2^k, 2^(k+1)). A document with ``min_percent`` of the item's shingles lacks fewer
    than this many of them, so it holds at least one of the kept ones: the search misses nothing.
    """
    largest = F.pow(F.lit(2), F.floor(F.log2(n)) + 1) - 1
    return (largest - F.ceil(largest * min_percent / 100) + 1).cast("int")


def item_sketches(items: DataFrame, min_percent: int = MIN_PERCENT, width: int = WIDTH) -> DataFrame:
    """``hash, item``: the smallest hashes (bottom-k MinHash) of each item's shingle set."""
    hashed = with_shingle_hashes(items, "words", "hashes", width).select("item", F.array_distinct("hashes").alias("hashes"))
    n = F.size("hashes")
    # the second hash makes the order independent of the shingle hash itself
    ordered = F.array_sort(F.transform("hashes", lambda h: F.struct(F.xxhash64(h, F.lit(1)).alias("rank"), h.alias("hash"))))
    kept = hashed.filter(n > 0).select("item", F.explode_outer(F.slice(ordered, F.lit(1), sketch_size(n, min_percent))).alias("m"))
    return kept.select(F.col("m.hash").alias("hash"), "item")


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
               item_id: str = "item_id", item_text: str = "text", min_percent: int = MIN_PERCENT,
               width: int = WIDTH, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Pairs ``doc_id, item_id, n_shared, n_item`` with 100 * n_shared >= min_percent * n_item.

    Sets of distinct ``width``-word shingles of lower-cased words; a text with fewer words is one
    shingle. An item of fewer words is found where they stand in a row inside a document: runs of
    such widths as the items have (at most ``width`` - 1 of them) are looked up, too. Null, blank and
    wordless texts, and rows without id, are in no pair. Rows that share an id count as one
    document or item with the shingles of all. Empty tables give no pairs; other columns are
    ignored. Every shingle of every whole document, however long, is looked up in the items' sketches.
    """
    items = items.select(items[item_id].alias("item"), words(items[item_text]).alias("words")).filter("item IS NOT NULL")
    docs = docs.select(docs[doc_id].alias("doc"), docs[doc_text].alias("text")).filter("doc IS NOT NULL")
    short = tuple(sorted(r[0] for r in items.select(F.size("words")).distinct().filter(F.size("words").between(1, width - 1)).collect()))
    sketch = checkpoint(item_sketches(items, min_percent, width))
    n_sketch = sketch.count()
    blocks = max(1, -(-n_sketch // broadcast_rows))
    probes = with_shingle_hashes(docs.select("doc", words(F.col("text")).alias("words")), "words", "hashes", width, short)
    probes = probes.select("doc", F.explode_outer("hashes").alias("hash"))
    found = None
    for block in range(blocks):
        part = sketch.filter(F.pmod("hash", F.lit(blocks)) == block)
        hits = probes.join(F.broadcast(part), "hash").select("doc", "item")
        found = hits if found is None else found.unionByName(hits)
    candidates = checkpoint(found.distinct())
    ids = candidates.select("doc").distinct()
    if ids.count() <= broadcast_rows:
        ids = F.broadcast(ids)
    item_sets = (items.select("item", F.explode_outer(shingle_texts(F.col("words"), width)).alias("shingle")).distinct())
    sizes = item_sets.groupBy("item").agg(F.count(F.lit(1)).alias("n_item"))
    # a document's shingles meet the distinct ones of all items, then those of its own candidates only, so that a
    # passage which many items share is not multiplied by them
    held = (docs.join(ids, "doc", "left_semi").select("doc", words(F.col("text")).alias("words"))
            .select("doc", F.explode_outer(shingle_texts(F.col("words"), width, short)).alias("shingle"))
            .join(item_sets.select("shingle").distinct(), "shingle", "left_semi").distinct())
    wanted = candidates.join(item_sets, "item")
    shared = held.join(wanted, ["doc", "shingle"]).groupBy("doc", "item").agg(F.count(F.lit(1)).alias("n_shared"))
    return (shared.join(sizes, "item").filter(F.col("n_shared") * 100 >= F.col("n_item") * min_percent)
            .select(F.col("doc").alias(doc_id), F.col("item").alias(item_id), "n_shared", "n_item"))
