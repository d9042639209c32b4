"""Incremental ingest: new files in a folder -> the stored recall table.

State lives in the stored table and in the stream's checkpoint folder; each micro-batch is
normalised, validated, de-duplicated and upserted. An upsert of the same batch gives the same
table, so a batch repeated after a failure does no harm. What fails goes to a quarantine folder of
the batch beside the checkpoint, which a repeat overwrites.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from recallspark.operators.dedupe import dedupe, dedupe_one_source
from recallspark.operators.marks import ROW, mark_rows, numbered, with_marks
from recallspark.operators.merge import api_only, firm_deltas
from recallspark.operators.normalize import normalize
from recallspark.operators.validate import quarantine, valid_rows, validate
from recallspark.schemas import RECALLS
from recallspark.session import short_methods
from recallspark.sources.landing import PAGE_TEXT, corrupt_pages, explode_records, page_columns
from recallspark.sources.store import add_firm_deltas, drop_folder, upsert_recalls, write_table


def page_stream(spark: SparkSession, landing: str, files_per_batch: int = 1000) -> DataFrame:
    """Page files as they arrive, broken ones too."""
    text = (spark.readStream.schema(PAGE_TEXT).format("text").option("wholetext", True)
            .option("maxFilesPerTrigger", files_per_batch).load(f"{landing}/*"))
    return page_columns(text)


def landing_stream(spark: SparkSession, landing: str, files_per_batch: int = 1000) -> DataFrame:
    """Raw records of page files as they arrive."""
    return explode_records(page_stream(spark, landing, files_per_batch))


def quarantine_folder(checkpoint: str) -> str:
    """(file, recall_number, errors, raw_json, batch_id) of what failed, by batch; batch ids count per
    checkpoint, so each has a folder of its own. Not there before something failed."""
    return f"{checkpoint.rstrip('/')}-quarantine"


def upsert_stream(records: DataFrame, table_path: str, checkpoint: str,
                  prepare: Callable[[DataFrame], DataFrame], as_of: date, now: datetime | None = None,
                  on_batch: Callable[[int, int, int], None] | None = None,
                  broken: Callable[[DataFrame], DataFrame] | None = None,
                  on_failed: Callable[[int, int], None] | None = None,
                  firms_path: str | None = None, one_source: bool = False) -> StreamingQuery:
    """Run until the files present at the start are in the table, then stop. ``prepare`` turns a
    micro-batch into record columns with ``ingest_ord``, ``broken`` into quarantine rows of what
    gives no record; ``on_batch`` receives (batch id, inserted, updated), ``on_failed`` (batch id,
    failed rows and broken pages). With ``firms_path`` the API rows of a batch are added to the firm deltas there,
    under the checkpoint and batch id, so that a repeated batch counts once. ``one_source`` says that records come
    from one source only, whose winners need no full order."""
    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = f"{checkpoint.rstrip('/')}-staged/{batch_id}"
        checked = validate(prepare(batch), as_of)
        # only what the table, the firms and the quarantine need is staged
        checked = checked.select(*[c for c in checked.columns if c in RECALLS.names or c in ("errors", "ingest_ord")])
        with short_methods(spark):
            write_table(numbered(checked), f"{staged}/validated", "overwrite")
        validated = spark.read.parquet(f"{staged}/validated")
        failed = quarantine(validated).select(F.lit(None).cast("string").alias("file"), "recall_number", "errors", "raw_json")
        if broken is not None:
            write_table(broken(batch), f"{staged}/broken", "overwrite")
            failed = failed.unionByName(spark.read.parquet(f"{staged}/broken"))
        n_failed, kept = failed.count(), f"{quarantine_folder(checkpoint)}/batch_id={batch_id}"
        if n_failed:
            write_table(failed, kept, "overwrite")
        else:
            drop_folder(spark, kept)
        # narrow rows travel; the records stay where they are, with a mark on those that won
        narrow = valid_rows(validated).select("recall_number", "source", "report_date", "ingest_ord", ROW)
        won = (dedupe_one_source if one_source else dedupe)(narrow)
        write_table(mark_rows(won, won=F.lit(True)), f"{staged}/marks", "overwrite")
        marks = spark.read.parquet(f"{staged}/marks")
        winners = with_marks(valid_rows(validated), marks, validated.count()).where("won").drop("won", ROW)
        counts = upsert_recalls(spark, table_path, winners, now or datetime.now(timezone.utc).replace(tzinfo=None))
        if firms_path is not None:
            add_firm_deltas(spark, firms_path, firm_deltas(api_only(winners), "ingest_ord"), f"{checkpoint.rstrip('/')}:{batch_id}")
        drop_folder(spark, staged)
        if on_batch:
            on_batch(batch_id, *counts)
        if on_failed:
            on_failed(batch_id, n_failed)

    return (records.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def ingest_landing(spark: SparkSession, landing: str, table_path: str, checkpoint: str, as_of: date,
                   now: datetime | None = None, on_batch: Callable[[int, int, int], None] | None = None,
                   on_failed: Callable[[int, int], None] | None = None, firms_path: str | None = None) -> None:
    """One pass over what has arrived since the last one."""
    upsert_stream(page_stream(spark, landing), table_path, checkpoint, lambda pages: normalize(explode_records(pages)), as_of, now,
                  on_batch, corrupt_pages, on_failed, firms_path, one_source=True).awaitTermination()
