"""One sweep: captured answers to postings, into the store, and a report of the run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.urls import identity
from tidemark.operators.dedupe import keep_first
from tidemark.operators.lake import upsert
from tidemark.operators.reads import totals, with_outcome
from tidemark.scale import cut
from tidemark.sources.payloads import headers, parse

VALUES = ["job_id", "title", "location", "url", "posted_on", "description"]
BOARD = ["platform", "token"]


@dataclass
class Sweep:
    store: DataFrame  # after the run
    reads: DataFrame  # one row per board with its outcome
    report: DataFrame  # counts of the run


def board_reads(answers: DataFrame) -> DataFrame:
    """One row per board from its answers: the first error, rows in all, the total reported (null if answers differ)."""
    each = headers(answers)
    got = each.groupBy(*BOARD).agg(
        F.min_by("error", F.when(F.col("error").isNotNull(), F.col("page"))).alias("error"), F.sum("n_postings").cast("int").alias("n_postings"),
        F.when(F.count_distinct("reported_total") == 1, F.max("reported_total")).alias("reported_total"),
    )
    return with_outcome(got)


def sweep(answers: DataFrame, store: DataFrame | None, now: Column) -> Sweep:
    """Merge a run's captured answers into the store.

    Postings with one identity count once, the first by platform, token, page and position. Boards whose
    every answer could be read, and whose rows reach the reported total, may close what they no longer list.
    The store's key is the identity; platform and token never change once stored, a description stays
    where the new one is missing. Without a store one begins.
    """
    reads = cut(board_reads(answers))
    rows = parse(answers).withColumn("key", identity(F.col("url"), F.col("platform"), F.col("token"), F.col("title")))
    order = [F.col(c) for c in (*BOARD, "page", "position")]
    run = cut(keep_first(rows, ["key"], order).select("key", *BOARD, *VALUES))
    if store is None:
        kind = run.select(now.alias("t")).schema["t"].dataType
        store = run.limit(0).select("*", F.lit(None).cast(kind).alias("first_seen"), F.lit(None).cast(kind).alias("last_seen"), F.lit(None).cast("boolean").alias("is_live"), F.lit(None).cast(kind).alias("went_dead_at"))
    merged = upsert(store, run, ["key"], reads.where("complete"), BOARD, now, kept=BOARD, filled=["description"])
    report = totals(reads.withColumn("at", now), ["at"])
    return Sweep(merged, reads, report)
