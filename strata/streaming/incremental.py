"""Incremental history maintenance as a Structured Streaming job.

The landing's ledger (see :mod:`strata.sources.ledger`) gets one small file per
run, and a file stream over it sees each exactly once (the stream's checkpoint
records them).  ``foreachBatch`` reads the files of the new runs and applies
them to the Type-2 history in one epoch of :class:`HistoryStore`, whatever
their dates: a batch is a date and its run, here as in a rebuild from
:func:`strata.sources.files.read_partitions`.

* Only the buckets of keys that the runs touch are rewritten.
* A late batch is known by the order kept beside the history; its buckets are
  built anew from the rows kept there.  The landing is not read again.
* A run that had been applied and was landed again is the one case that the
  history is built anew from the landing.
* Each epoch is published by one rename, and one replayed after a crash is
  applied once.

Run it with ``trigger(availableNow=True)`` after each landing: it processes
what has arrived and stops, the streaming equivalent of "copy the watermark
range, then merge".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strata.operators import history as H
from strata.sources import ledger as L
from strata.streaming.store import HistoryStore

EPOCH = "epoch"


def landing_stream(spark: SparkSession, root: str, max_runs: int | None = None) -> DataFrame:
    """A stream of the landing's runs: the rows of its ledger, in order of landing."""
    L.Ledger(spark, root).adopt()
    reader = spark.readStream.schema(L.SCHEMA)
    if max_runs:
        reader = reader.option("maxFilesPerTrigger", max_runs)
    return reader.json(f"{root.rstrip('/')}/{L.FOLDER}")


def latest_history(spark: SparkSession, history_root: str, **kw) -> DataFrame | None:
    """The history as last published (``None`` if there is none)."""
    return HistoryStore(spark, history_root, **kw).history()


def history_writer(
    spark: SparkSession,
    history_root: str,
    landing_root: str,
    key: str = "customer_id",
    ts_col: str = "updated_at",
    tracked: list[str] = H.CUSTOMER_TRACKED,
    sk_col: str = "customer_sk",
    quarantine_root: str | None = None,
    buckets: int = 64,
):
    """The ``foreachBatch`` function: read the runs, quarantine, apply them as one epoch.

    Rejected rows go to ``quarantine_root`` (default: beside the history), one
    folder per epoch.
    """
    rejected = quarantine_root or f"{history_root.rstrip('/')}-quarantine"

    def apply(micro: DataFrame, epoch_id: int) -> None:
        store = HistoryStore(spark, history_root, key, ts_col, tracked, sk_col, buckets)
        landed = L.Ledger(spark, landing_root)
        entries = L.parts_of(micro.collect())  # one small row per run
        newest = max((p.number for p in entries), default=0)
        standing = landed.parts([p for p in landed.entries() if p.number <= newest])
        fresh = bool(entries) and store.has_batches([p.batch for p in entries])
        named = {(p.number, p.load_date, p.run_id) for p in entries}
        parts = standing if fresh else [p for p in standing if (p.number, p.load_date, p.run_id) in named]
        if not parts and not fresh:
            return
        rows = L.read_parts(spark, landed.root, parts, L.united(standing or entries)).withColumn("batch_id", L.batch_column())
        feed, bad = H.prepare_feed(rows.drop(L.LOAD_DATE, L.RUN_ID, "source_file"), key, ts_col, "batch_id", tracked)
        bad.write.mode("overwrite").parquet(f"{rejected}/{EPOCH}={epoch_id}")
        store.apply(feed, epoch_id, fresh)

    return apply


def start_history_stream(
    spark: SparkSession,
    landing_root: str,
    history_root: str,
    checkpoint: str,
    available_now: bool = True,
    max_runs: int | None = None,
    **kw,
) -> StreamingQuery:
    """Start the incremental history job (each landed run exactly once)."""
    writer = (
        landing_stream(spark, landing_root, max_runs)
        .writeStream.foreachBatch(history_writer(spark, history_root, landing_root, **kw))
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
