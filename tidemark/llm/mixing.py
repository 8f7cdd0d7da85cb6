"""Sources mixed to target shares of the total size.

Sizes are summed per source, giving each source the rate at which its records are repeated. A record is
emitted floor(rate) times, and once more if its hash falls below the rate's fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.scale import cut


def canonical(source: Column) -> Column:
    """One spelling of a source's name: trimmed, lower case, '_' for blanks and dashes."""
    return F.regexp_replace(F.lower(F.trim(source)), r"[\s_-]+", "_")


def rates(sizes: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """Repetition rate of each target source that has records: ``source``, ``target_share``, ``max_repeats``, ``available``, ``rate``.

    ``sizes``: source, available. ``targets``: source, target_share, max_repeats. Shares of the sources that
    have records are taken as parts of their sum. Without ``total`` the total is the largest at which every
    source reaches its share within its cap; with it, a source whose cap doesn't suffice stays below its share.
    """
    met = targets.where("target_share > 0 AND max_repeats > 0").join(sizes.where("available > 0"), "source")
    every = W.partitionBy(F.lit(0))  # the targets: a short list
    met = met.withColumns({"all": F.sum("target_share").over(every), "reach": F.min(F.col("available") * F.col("max_repeats") / F.col("target_share")).over(every)})
    wanted = F.lit(float(total)) if total is not None else F.col("reach") * F.col("all")
    rate = F.least(F.col("max_repeats").cast("double"), wanted * F.col("target_share") / F.col("all") / F.col("available"))
    return met.select("source", "target_share", "max_repeats", "available", rate.alias("rate"))


def mix(df: DataFrame, key: str, source: str, size: str, targets: DataFrame, total: int | None = None, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(records, report). records: ``key``, ``source``, ``copy_no`` from 1, ``size``, once per copy. report: the shares reached.

    Source names are compared in one spelling. Records of sources that aren't in ``targets``, without source
    or of null or negative size aren't emitted; repeated rows count as records of their own but share their
    hash. No record is emitted more than max_repeats times. The report has a row for every target and every
    source with records: ``target_share`` (0 if not wanted), ``available``, ``rate``, ``records``, ``size``, ``share``.
    """
    rows = cut(df.select(F.col(key).alias("__tm_key"), canonical(F.col(source)).alias("__tm_source"), F.col(size).cast("bigint").alias("__tm_size")).where("__tm_source IS NOT NULL AND __tm_source != '' AND __tm_size >= 0"))
    sizes = rows.groupBy(F.col("__tm_source").alias("source")).agg(F.sum("__tm_size").alias("available"))
    wanted = targets.select(canonical(F.col("source")).alias("source"), "target_share", "max_repeats").dropDuplicates(["source"])
    found = cut(rates(sizes, wanted, total))
    # One row per target: the targets are a short fixed list, and the broadcast is of what they name.
    placed = rows.join(F.broadcast(found.select(F.col("source").alias("__tm_source"), "rate", "max_repeats")), "__tm_source")
    unit = (F.pmod(F.xxhash64(F.lit(seed), F.col("__tm_key")), F.lit(1 << 53)) / F.lit(float(1 << 53))).cast("double")
    times = (F.floor("rate") + F.when(unit < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int")
    times = F.least(times, F.col("max_repeats"))
    copies = placed.withColumn("__tm_times", times).where("__tm_times > 0").select("__tm_key", "__tm_source", F.explode(F.sequence(F.lit(1), F.col("__tm_times"))).alias("copy_no"), "__tm_size")
    records = copies.select(F.col("__tm_key").alias(key), F.col("__tm_source").alias("source"), "copy_no", F.col("__tm_size").alias("size"))
    got = records.groupBy("source").agg(F.count(F.lit(1)).alias("records"), F.sum("size").alias("size"))
    every = wanted.select("source").union(sizes.select("source")).distinct()
    report = every.join(wanted.select("source", "target_share", "max_repeats"), "source", "left").join(sizes, "source", "left").join(found.select("source", "rate"), "source", "left").join(got, "source", "left")
    report = report.withColumn("whole", F.sum("size").over(W.partitionBy(F.lit(0))))  # a row per source
    zero = lambda c: F.coalesce(c, F.lit(0))
    report = report.select(
        "source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), zero("max_repeats").alias("max_repeats"), zero("available").alias("available"), F.coalesce("rate", F.lit(0.0)).alias("rate"),
        zero("records").alias("records"), zero("size").alias("size"), F.coalesce(F.col("size") / F.col("whole"), F.lit(0.0)).alias("share"),
    )
    return records, report
