"""One row per key, chosen by an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``; rows equal in it are settled by all their columns, so the result is one.

    Null keys are keys like others. Aggregated before the shuffle, so a hot key costs no more than others.
    Maps can't be ordered; a table with map columns needs an order that leaves no ties.
    """
    rest = [c for c, kind in df.dtypes if c not in keys and "map<" not in kind]
    sort = [o.alias(f"__tm_o{i}") for i, o in enumerate(order)]
    best = F.struct(*sort, *[F.col(f"`{c}`") for c in rest])
    maps = [F.min_by(F.col(f"`{c}`"), best).alias(c) for c, kind in df.dtypes if c not in keys and "map<" in kind]
    got = df.groupBy(*keys).agg(F.min(best).alias("__tm_best"), *maps)
    return got.select(*[F.col(f"`{c}`") if c in keys or c in [m for m, kind in df.dtypes if "map<" in kind] else F.col(f"__tm_best.`{c}`").alias(c) for c in df.columns])


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each key by the column ``order``, null first; among several the one greatest in all columns."""
    rest = [c for c in df.columns if c not in keys]
    best = F.struct(F.col(order).alias("__tm_o"), *[F.col(f"`{c}`") for c in rest])
    got = df.groupBy(*keys).agg(F.max(best).alias("__tm_best"))
    return got.select(*[F.col(f"`{c}`") if c in keys else F.col(f"__tm_best.`{c}`").alias(c) for c in df.columns])


def collapse(df: DataFrame, keys: list[str], order: list[Column], name: Column, out: str = "dup_of") -> DataFrame:
    """Every row kept; ``out`` names the first row of its key for the others (by ``name``), null for the first itself."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.when(F.row_number().over(w) > 1, F.first(name).over(w)))


def beyond(df: DataFrame, group: list[str], order: list[Column], cap: int, eligible: Column | None = None, out: str = "over_cap") -> DataFrame:
    """Every row kept; ``out`` is true for eligible rows that stand after ``cap`` others of their group."""
    if eligible is None:
        return df.withColumn(out, F.row_number().over(W.partitionBy(*group).orderBy(*order)) > cap)
    flag = F.coalesce(eligible, F.lit(False))
    marked = df.withColumn("__tm_e", flag)
    rank = F.row_number().over(W.partitionBy(*group, "__tm_e").orderBy(*order))
    return marked.withColumn(out, F.col("__tm_e") & (rank > cap)).drop("__tm_e")
