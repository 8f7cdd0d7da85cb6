"""Reads of boards: their outcome, completeness, and what a run adds up to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def truncated(n: Column, reported: Column) -> Column:
    """Fewer rows came than were reported; false where nothing was reported."""
    return F.coalesce(n < reported, F.lit(False))


def with_outcome(reads: DataFrame) -> DataFrame:
    """Add ``outcome`` ('failed', 'truncated', 'empty', 'ok') and ``complete``.

    Only a complete read is evidence that something is absent: no error and not truncated. An empty read
    without error is complete. A null count is no count: 'empty'.
    """
    n = F.coalesce(F.col("n_postings"), F.lit(0))
    short = truncated(n, F.col("reported_total"))
    outcome = F.when(F.col("error").isNotNull(), "failed").when(short, "truncated").when(n == 0, "empty").otherwise("ok")
    return reads.withColumns({"outcome": outcome, "complete": F.col("error").isNull() & ~short})


def totals(reads: DataFrame, by: list[str]) -> DataFrame:
    """Boards, outcomes and rows per ``by``, in one pass. A truncated read with rows counts as ok too."""
    o = F.col("outcome")
    n = F.coalesce(F.col("n_postings"), F.lit(0))
    return reads.groupBy(*by).agg(
        F.count(F.lit(1)).alias("boards"), F.count_if((o == "ok") | ((o == "truncated") & (n > 0))).alias("ok"), F.count_if((o == "empty") | ((o == "truncated") & (n == 0))).alias("empty"),
        F.count_if(o == "failed").alias("failed"), F.count_if(o == "truncated").alias("truncated"), F.sum(F.when(o != "failed", n).otherwise(0)).alias("postings"),
    )


def failure_modes(reads: DataFrame, k: int = 10, width: int = 40) -> DataFrame:
    """The ``k`` most frequent errors, cut to ``width`` characters; equal counts in order of the text."""
    named = reads.where("error IS NOT NULL").select(F.substring("error", 1, width).alias("mode"))
    return named.groupBy("mode").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "mode").limit(k)


def page_check(pages: DataFrame, by: list[str], page: str, rows: str, total: str, first: int = 1) -> DataFrame:
    """Whether the pages of each board are all there: ``error`` is null or names the first thing wrong.

    A board is complete if one total is reported, pages count on from ``first`` without gap or repeat, none
    but a single one is empty, and the rows add up to the total. Null totals count as 'no_total'.
    """
    got = pages.groupBy(*by).agg(
        F.count_distinct(total).alias("totals"), F.max(total).alias("total"), F.sum(rows).alias("rows"), F.min(page).alias("lo"), F.max(page).alias("hi"),
        F.count(F.lit(1)).alias("n"), F.count_distinct(page).alias("pages"), F.count_if(F.col(rows) == 0).alias("void"),
    )
    wrong = (
        F.when(F.col("totals") == 0, "no_total").when(F.col("totals") > 1, "unstable_total").when(F.col("n") != F.col("pages"), "page_repeated")
        .when((F.col("lo") != first) | (F.col("hi") - F.col("lo") + 1 != F.col("pages")), "page_missing").when((F.col("void") > 0) & (F.col("n") > 1), "empty_page")
        .when(F.col("rows") != F.col("total"), F.concat(F.lit("partial_at_"), F.col("rows").cast("string")))
    )
    return got.select(*by, "total", "rows", "pages", wrong.alias("error"))
