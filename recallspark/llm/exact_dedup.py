"""Exact de-duplication by a tree merge of sorted digest runs, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recallspark.llm.storage import stored

#: First-level runs and how many runs meet in one merge. Both are fixed, whatever the input.
RUNS, FAN_IN = 64, 4
#: Hexadecimal digits of the digest that name its range; ranges are merged independently.
RANGE_DIGITS = 3
WHOLE = (Window.unboundedPreceding, Window.unboundedFollowing)


def tree_merge(runs: DataFrame, n_runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """Merge runs ``(run, digest, check, length, id, copies)`` into one row per distinct text.

    Each round sends ``fan_in`` neighbouring runs of a digest range to one partition and sorts them by
    digest there. A pass in that order merges them: running sums over a text's rows are complete at
    its last one, which alone goes on to the next round. A text is the same only if its second hash and length
    agree too. A group of copies reaches a round as at most one row per run, so the pass holds no more than
    ``fan_in`` rows, however large the group is.
    """
    verified = ["digest", "check", "length"]
    level = runs.withColumn("range", F.substring("digest", 1, RANGE_DIGITS))
    for _ in range(max(1, math.ceil(math.log(n_runs, fan_in)))):
        level = level.withColumn("run", F.shiftright("run", int(math.log2(fan_in)))).repartition("range", "run")
        text = Window.partitionBy("range", "run", *verified).orderBy(F.col("id").asc_nulls_first())
        merged = level.select("*", F.row_number().over(text).alias("nth"), F.count(F.lit(1)).over(text.rowsBetween(*WHOLE)).alias("rows"),
                              F.sum("copies").over(text.rowsBetween(*WHOLE)).alias("all"))
        # rows of a text are in order of their ids: the last one has the largest
        level = merged.filter("nth = rows").select("range", "run", *verified, "id", F.col("all").alias("copies"))
    return level.select(*verified, "id", "copies")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                n_runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Equal texts (byte for byte; null is empty) form a group and its largest id stays. A null id
    never stays beside a real one; a group with null ids only has a null ``keep_id`` and keeps
    none. Rows that repeat both id and text are all marked alike and all counted. An empty table
    gives an empty result; other columns are ignored, whatever their names.

    Copies meet only after each of the ``n_runs`` runs has boiled them down to one row, and the
    answer travels back by (run, digest), so a text that fills a third of the table is never the
    key of one task. Only digests are shuffled, no texts.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    rows = docs.select(
        docs[id_col].alias("id"), F.sha2(text, 256).alias("digest"), F.xxhash64(text).alias("check"),
        F.length(text).alias("length"), F.pmod(F.xxhash64(docs[id_col]), F.lit(n_runs)).cast("int").alias("run"))
    verified = ["digest", "check", "length"]
    first = stored(rows.groupBy("run", *verified).agg(F.max("id").alias("id"), F.count(F.lit(1)).alias("copies")))
    merged = tree_merge(first, n_runs, fan_in).withColumnsRenamed({"id": "keep_id", "copies": "group_size"})
    answers = first.select("run", *verified).join(merged, verified)
    out = rows.join(answers, ["run", *verified])
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size",
                      F.coalesce(F.col("id") == F.col("keep_id"), F.lit(False)).alias("kept"),
                      F.col("digest").alias("text_sha256"))
