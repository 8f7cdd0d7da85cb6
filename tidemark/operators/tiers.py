"""How often a board is read, from what it has brought so far."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOURS = {"hot": 6, "warm": 24, "cold": 168}
RECENT_DAYS = 30


def history(finds: DataFrame, by: list[str], found: str, at: str, now: Column, days: int = RECENT_DAYS) -> DataFrame:
    """``total_ever``, ``recent``, ``sweeps`` and ``last_swept`` of each board. ``found`` rows came of the sweep at ``at``."""
    recent = F.col(at) > now - F.make_dt_interval(F.lit(days))
    return finds.groupBy(*by).agg(
        F.sum(F.coalesce(F.col(found), F.lit(0))).cast("bigint").alias("total_ever"), F.sum(F.when(recent, F.coalesce(F.col(found), F.lit(0))).otherwise(0)).cast("bigint").alias("recent"), F.count(F.lit(1)).alias("sweeps"), F.max(at).alias("last_swept")
    )


def board_yield(total: Column, sweeps: Column) -> Column:
    """Finds per sweep; null without any sweep, which isn't the same as 0."""
    return F.when(sweeps > 0, total / sweeps)


def tier(total: Column, recent: Column, sweeps: Column) -> Column:
    """'hot', 'warm' or 'cold'; a board never swept is 'cold'."""
    return F.when(F.coalesce(sweeps, F.lit(0)) == 0, "cold").when(recent > 0, "hot").when(total > 0, "warm").otherwise("cold")


def due(tier_name: Column, last: Column, now: Column) -> Column:
    """Whether the tier's hours have passed since the last sweep; a board never swept is due."""
    hours = F.lit(None).cast("int")
    for name, h in HOURS.items():
        hours = F.when(tier_name == name, h).otherwise(hours)
    return F.coalesce(last.isNull() | (now >= last + F.make_dt_interval(F.lit(0), hours)), F.lit(False))


def report(boards: DataFrame) -> DataFrame:
    """Per tier: boards, finds, and the mean of the boards' yields (a missing one counts as 0)."""
    mean = F.avg(F.coalesce(board_yield(F.col("total_ever"), F.col("sweeps")), F.lit(0.0)))
    return boards.groupBy("tier").agg(F.count(F.lit(1)).alias("boards"), F.sum("total_ever").alias("total_ever"), F.round(mean, 4).alias("mean_yield"))


def due_boards(registry: DataFrame, state: DataFrame, board: list[str], now: Column) -> DataFrame:
    """Registered boards with their history, tier and whether they are due; one without history has swept nothing and is due.

    ``state`` is unique in ``board`` and as of history().
    """
    known = state.select(*board, *[F.col(c) for c in ("total_ever", "recent", "sweeps", "last_swept")])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    met = registry.select(*board).distinct().join(known, board, "left").select(*board, zero("total_ever"), zero("recent"), zero("sweeps"), "last_swept")
    met = met.withColumn("tier", tier(F.col("total_ever"), F.col("recent"), F.col("sweeps")))
    return met.withColumn("due", due(F.col("tier"), F.col("last_swept"), now))
