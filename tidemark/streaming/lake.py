"""The store kept by a stream of runs: each micro-batch is one upsert; and event-time windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedupe import keep_first
from tidemark.operators.lake import LIFE, upsert
from tidemark.sources.stores import VersionedTable


def merge_stream(spark: SparkSession, source: DataFrame, table: VersionedTable, keys: list[str], board: list[str], at: str, order: str, checkpoint: str) -> None:
    """Run the stream to its present end, merging each micro-batch into ``table``.

    A batch holds whole reads: every board in it was read completely. Only the buckets of the table that
    hold the batch's boards are read and written again (the table's ``by`` must be ``board``; with one bucket
    that is all of it). Batches already merged (after a restart) are known by the number that the table's
    pointer carries and are skipped.
    """

    def merge(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        at_hand = table.pointer()
        if at_hand is not None and at_hand["note"] is not None and at_hand["note"] >= number:
            return
        now = F.lit(batch.agg(F.max(at)).first()[0])
        run = keep_first(batch, keys, [F.col(order)])
        touched = sorted(r[0] for r in batch.select(table.bucket().alias("b")).distinct().collect())  # no more than there are buckets
        old = table.read(touched)
        old = old if old is not None else spark.createDataFrame([], _schema(run))
        table.replace(upsert(old, run, keys, batch.select(*board), board, now), touched, number)

    def _schema(run: DataFrame) -> str:
        kinds = dict(run.dtypes)
        life = {"first_seen": kinds[at], "last_seen": kinds[at], "is_live": "boolean", "went_dead_at": kinds[at]}
        return ", ".join(f"`{c}` {k}" for c, k in [*run.dtypes, *[(c, life[c]) for c in LIFE]])

    query = source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def tumbling(events: DataFrame, at: str, by: list[str], width: str, late: str | None = None) -> DataFrame:
    """Rows per window of ``width`` and ``by``; on a stream, rows later than ``late`` are left out."""
    source = events.withWatermark(at, late) if late and events.isStreaming else events
    got = source.groupBy(F.window(at, width), *by).agg(F.count(F.lit(1)).alias("n"))
    return got.select(F.col("window.start").alias("start"), *by, "n")


def sessions(events: DataFrame, at: str, by: list[str], gap: str) -> DataFrame:
    """Rows per session of ``by``: a new one begins after ``gap`` without rows."""
    got = events.groupBy(F.session_window(at, gap), *by).agg(F.count(F.lit(1)).alias("n"))
    return got.select(*by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")
