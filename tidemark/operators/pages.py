"""Pages read again and again: work is done only where the content changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def gate(pages: DataFrame, state: DataFrame, key: str, digest: str, force: bool = False) -> DataFrame:
    """Add ``outcome`` to freshly read pages: 'new', 'changed' or 'unchanged' against the stored digests.

    ``state`` has one row per ``key`` with ``digest``. A page without digest is 'failed'. ``force`` makes
    unchanged pages 'changed'.
    """
    old = state.select(F.col(key), F.col(digest).alias("__tm_old"), F.lit(True).alias("__tm_known"))
    same = F.col(digest).eqNullSafe(F.col("__tm_old"))
    what = F.when(F.col(digest).isNull(), "failed").when(F.col("__tm_known").isNull(), "new").when(same & F.lit(not force), "unchanged").otherwise("changed")
    return pages.join(old, key, "left").withColumn("outcome", what).drop("__tm_old", "__tm_known")


def changes(reads: DataFrame, by: list[str], order: list[str], digest: str) -> DataFrame:
    """The same over a whole history: each read against the one before it with the same ``by``."""
    w = W.partitionBy(*by).orderBy(*order)
    before, first = F.lag(digest).over(w), F.row_number().over(w) == 1
    return reads.withColumn("outcome", F.when(F.col(digest).isNull(), "failed").when(first, "new").when(before.eqNullSafe(F.col(digest)), "unchanged").otherwise("changed"))
