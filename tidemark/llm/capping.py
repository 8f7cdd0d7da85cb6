"""Capping the records of each contributor by one global range sort.

Rows are range-sorted by group, contributor and descending score, so a dominant contributor spreads over
many partitions. A row's exact place is its place in its partition plus the sizes of all partitions before;
less the place at which its contributor starts, it is the row's rank there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.scale import cut, guarded_join

PART = 33  # monotonically_increasing_id: the partition stands above the lowest 33 bits


def over_cap(df: DataFrame, contributor: list[str], cap: int | str, score: str, tie: str, extra: list[str] | None = None) -> DataFrame:
    """The rows of ``df`` beyond their contributor's cap, with ``contributor``, ``tie``, ``extra`` and ``rank``.

    Rows rank by highest ``score`` (null last), then lowest ``tie`` (null first); rows equal in both, copies
    included, rank one after another, so callers that count copies once drop them before. ``cap`` is a number
    or the name of a column that is constant within each contributor; a null cap means none. Null contributors are
    contributors like others. An empty table gives no rows.
    """
    c = [f"__tm_c{i}" for i in range(len(contributor))]
    e = list(extra or [])
    slim = df.select(*[F.col(x).alias(a) for x, a in zip(contributor, c, strict=True)], F.col(score).alias("__tm_score"), F.col(tie).alias("__tm_tie"), (F.col(cap) if isinstance(cap, str) else F.lit(cap)).cast("bigint").alias("__tm_cap"), *[F.col(x).alias(f"__tm_e{i}") for i, x in enumerate(e)])
    by = [*[F.col(x).asc_nulls_first() for x in c], F.col("__tm_score").desc_nulls_last(), F.col("__tm_tie").asc_nulls_first()]
    placed = slim.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__tm_at", F.monotonically_increasing_id())
    placed = placed.withColumn("__tm_part", F.shiftright("__tm_at", PART).cast("int")).withColumn("__tm_at", F.col("__tm_at").bitwiseAND(F.lit((1 << PART) - 1)))
    placed = cut(placed)

    runs = placed.groupBy("__tm_part", *c).agg(F.min("__tm_at").alias("__tm_first"), F.count(F.lit(1)).alias("__tm_n"), F.first("__tm_cap").alias("__tm_limit"))
    runs = cut(runs)
    before = W.orderBy("__tm_part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition: small by nature
    offsets = runs.groupBy("__tm_part").agg(F.sum("__tm_n").alias("__tm_size")).select("__tm_part", F.coalesce(F.sum("__tm_size").over(before), F.lit(0)).alias("__tm_offset"))
    runs = runs.join(F.broadcast(offsets), "__tm_part").withColumn("__tm_start", F.col("__tm_first") + F.col("__tm_offset"))
    # One row per contributor and partition: a contributor has at most as many rows here as there are partitions.
    own = W.partitionBy(*c)
    runs = runs.withColumn("__tm_zero", F.min("__tm_start").over(own))
    # rank = place in partition + shift
    runs = runs.withColumn("__tm_shift", F.col("__tm_offset") - F.col("__tm_zero") + 1)
    beyond = runs.where(F.col("__tm_first") + F.col("__tm_n") - 1 + F.col("__tm_shift") > F.col("__tm_limit"))
    keys = [f"__tm_g{i}" for i in range(len(c))]  # nulls as keys of an equi-join
    flat = lambda d: d.withColumns({g: F.coalesce(F.concat(F.lit("="), F.col(x).cast("string")), F.lit("")) for g, x in zip(keys, c, strict=True)})
    small = flat(beyond).select("__tm_part", *keys, "__tm_shift")
    got = guarded_join(flat(placed), small, ["__tm_part", *keys], "inner", "__tm_tie")
    got = got.withColumn("__tm_rank", F.col("__tm_at") + F.col("__tm_shift")).where(F.col("__tm_rank") > F.col("__tm_cap"))
    return got.select(*[F.col(a).alias(x) for x, a in zip(contributor, c, strict=True)], F.col("__tm_tie").alias(tie), *[F.col(f"__tm_e{i}").alias(x) for i, x in enumerate(e)], F.col("__tm_rank").alias("rank"))
