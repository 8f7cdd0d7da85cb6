"""A store that keeps the history of all postings: upsert, closing of what is gone, reconciliation.

Rows are annotated, never deleted. A row closes only if its board was read completely and it wasn't there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LIFE = ["first_seen", "last_seen", "is_live", "went_dead_at"]


def upsert(store: DataFrame, run: DataFrame, keys: list[str], boards: DataFrame, board: list[str], now: Column, kept: list[str] = (), filled: list[str] = ()) -> DataFrame:
    """The store after a run: matched rows take the run's values, new rows enter, rows gone from complete boards close.

    ``store`` has the run's columns and LIFE. ``run`` has one row per ``keys`` (dedupe first). ``boards``
    has the ``board`` columns of the complete reads. Columns in ``kept`` never change once stored; those in
    ``filled`` keep the old value where the new one is null or ''. A row seen again lives again and keeps its
    went_dead_at. Null keys match null keys. Values for ``now`` should be a literal: the same for all rows.
    """
    values = [c for c in run.columns if c not in keys]
    new = run.select(*keys, F.struct(*[F.col(f"`{c}`") for c in values]).alias("__tm_n"))
    old = store.select(*keys, F.struct(*[F.col(f"`{c}`") for c in [*values, *LIFE]]).alias("__tm_o"))
    both = new.withColumn("__tm_o", F.lit(None).cast(old.schema["__tm_o"].dataType)).unionByName(old.withColumn("__tm_n", F.lit(None).cast(new.schema["__tm_n"].dataType)))
    # One row per key on each side: a grouping with partial aggregation instead of a full outer join.
    met = both.groupBy(*keys).agg(F.first("__tm_n", True).alias("n"), F.first("__tm_o", True).alias("o"))
    seen, known = F.col("n").isNotNull(), F.col("o").isNotNull()

    def value(c: str) -> Column:
        n, o = F.col(f"n.`{c}`"), F.col(f"o.`{c}`")
        if c in kept:
            return F.when(known, o).otherwise(n)
        if c in filled:
            return F.when(seen & n.isNotNull() & (n.cast("string") != ""), n).otherwise(F.when(known, o).otherwise(n))
        return F.when(seen, n).otherwise(o)

    merged = met.select(*keys, *[value(c).alias(c) for c in values], F.when(known, F.col("o.first_seen")).otherwise(now).alias("first_seen"), F.when(seen, now).otherwise(F.col("o.last_seen")).alias("last_seen"), F.when(seen, True).otherwise(F.col("o.is_live")).alias("__tm_live"), F.col("o.went_dead_at").alias("__tm_dead"), seen.alias("__tm_seen"))
    complete = boards.select(*board).distinct().withColumn("__tm_read", F.lit(True))
    merged = merged.join(complete, board, "left")
    closing = F.col("__tm_read").isNotNull() & ~F.col("__tm_seen") & F.coalesce("__tm_live", F.lit(True))
    merged = merged.withColumns({"is_live": F.when(closing, False).otherwise(F.coalesce("__tm_live", F.lit(True))), "went_dead_at": F.when(closing, now).otherwise(F.col("__tm_dead"))})
    return merged.select(*keys, *values, *LIFE)


def replay(seen: DataFrame, reads: DataFrame, board: list[str], job: str, at: str) -> DataFrame:
    """The state that upserting run after run would leave, in one pass over the history.

    ``seen``: ``board``, ``job``, ``at`` (the run's place in time), a row per sighting; ``reads``: ``board``,
    ``at`` of the complete reads. Gives ``board``, ``job``, ``first_seen``, ``last_seen``, ``is_live``,
    ``went_dead_at`` (the last closing). Null jobs are ignored.
    """
    life = seen.where(F.col(job).isNotNull()).select(*board, job, at).distinct()
    # A sighting closes at the first complete read after it, if that comes before the next sighting.
    follows = W.partitionBy(*board, job).orderBy(at)
    life = life.withColumn("__tm_next", F.lead(at).over(follows))
    marks = reads.select(*board, F.col(at).alias("__tm_at")).distinct().withColumn("__tm_kind", F.lit(0)).union(life.select(*board, F.col(at).alias("__tm_at")).distinct().withColumn("__tm_kind", F.lit(1)))
    # For each run of a board the complete read next after it; grouped by board, with one row per run.
    after = marks.withColumn("__tm_read", F.when(F.col("__tm_kind") == 0, F.col("__tm_at")))
    upto = W.partitionBy(*board).orderBy(F.col("__tm_at").desc()).rangeBetween(W.unboundedPreceding, -1)
    after = after.withColumn("__tm_close", F.min("__tm_read").over(upto)).where("__tm_kind = 1").select(*board, F.col("__tm_at").alias(at), "__tm_close")
    closed = life.join(after, [*board, at], "left")
    gone = F.col("__tm_close").isNotNull() & (F.col("__tm_next").isNull() | (F.col("__tm_close") < F.col("__tm_next")))
    return closed.groupBy(*board, job).agg(
        F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), (~F.max_by(gone, at)).alias("is_live"), F.max(F.when(gone, F.col("__tm_close"))).alias("went_dead_at")
    )


def reconcile(store: DataFrame, rejected: DataFrame, identity: list[str], reason: str, now: Column) -> DataFrame:
    """Rows of the store that another run rejects are marked with the reason and time; all rows stay.

    ``rejected`` has ``identity``, ``reason`` and ``ordinal``; the last of several counts. Identities with a null
    or empty part match nothing.
    """
    whole = F.lit(True)
    for c in identity:
        whole = whole & F.coalesce(F.col(c).cast("string") != "", F.lit(False))
    last = rejected.where(whole).groupBy(*identity).agg(F.max_by(reason, "ordinal").alias("__tm_reason"))
    hit = F.col("__tm_reason").isNotNull()
    joined = store.join(last, identity, "left")
    return joined.withColumns({"hidden_reason": F.when(hit, F.col("__tm_reason")), "reconciled_at": F.when(hit, now)}).drop("__tm_reason")


def absent(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` whose key isn't in ``right``."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")
