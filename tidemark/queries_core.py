"""Queries of the core operators over the tables of one data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.snapshots import diff_snapshots, squeezed
from tidemark.operators.timestamps import normalise, zones_in
from tidemark.scale import cut, guarded_join, table


def board_settings(spark: SparkSession, d: str) -> DataFrame:
    """Zone and locale of each board, as any of its reads gives them."""
    reads = table(spark, d, "board_reads")
    return reads.groupBy("platform", "token").agg(F.max(F.col("extra")["site_tz"]).alias("site_tz"), F.max(F.col("extra")["locale"]).alias("locale"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Each value of postings.posted_on and runs.ts that gives at least a date, as one UTC instant."""
    postings = table(spark, d, "postings").select("ordinal", "platform", "token", "posted_on").where(F.col("posted_on").rlike(r"\d"))
    settings = board_settings(spark, d)
    named = zones_in(postings.withColumn("posted_on", F.when(F.col("posted_on").rlike("[a-z]/[A-Z]"), F.col("posted_on"))), "posted_on", None)
    zones = named.union(settings.select("site_tz")).union(table(spark, d, "runs").select("tz"))
    postings = guarded_join(postings, settings, ["platform", "token"], "left", "ordinal")
    runs = table(spark, d, "runs").select(F.lit("runs").alias("source"), F.col("run_id").alias("row_id"), F.col("ts").alias("v"), F.col("tz").alias("zone"), F.lit(None).cast("string").alias("locale"))
    values = postings.select(F.lit("postings").alias("source"), F.col("ordinal").cast("string").alias("row_id"), F.col("posted_on").alias("v"), F.col("site_tz").alias("zone"), "locale").unionByName(runs)
    found = normalise(values, "v", "utc_ms", "zone", "locale", zones)
    return found.where(F.col("utc_ms").isNotNull()).select("source", "row_id", "utc_ms").distinct()


def complete_reads(spark: SparkSession, d: str) -> DataFrame:
    """Complete reads of runs that arrived whole: lane, run, board, ``read`` (an id) and ``before`` (that of the previous one)."""
    sent = table(spark, d, "postings").select("run_id", "ordinal").distinct().groupBy("run_id").agg(F.count("ordinal").alias("n"))
    runs = table(spark, d, "runs").select("run_id", "lane", "run_no", F.col("totals.postings").alias("total")).distinct()
    whole = runs.join(sent, "run_id", "left").where(F.col("total") == F.coalesce("n", F.lit(0))).select("run_id", "lane", "run_no")
    reads = table(spark, d, "board_reads").where("error IS NULL AND (reported_total IS NULL OR reported_total <= n_postings)")
    reads = reads.select("run_id", "platform", "token").distinct().join(whole, "run_id")
    reads = cut(reads.withColumn("read", F.monotonically_increasing_id()))
    by_run = W.partitionBy("lane", "platform", "token").orderBy("run_no", "run_id")
    return cut(reads.withColumn("before", F.lag("read").over(by_run)))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Jobs added, removed or changed between consecutive complete reads of a board in a lane."""
    reads = complete_reads(spark, d)
    key = F.upper(F.trim("job_id"))
    rows = table(spark, d, "postings").select(
        "run_id", "platform", "token", "ordinal", F.when(key != "", key).alias("job_id"), *[squeezed(F.col(c)).alias(c) for c in ("title", "location", "description")]
    )
    rows = guarded_join(rows, reads.select("run_id", "platform", "token", "read"), ["run_id", "platform", "token"], "inner", "ordinal")
    diff = diff_snapshots(rows, reads, "read", "before", ["job_id"], ["title", "location", "description"], "ordinal")
    return guarded_join(diff, reads.select("read", "run_id", "platform", "token"), ["read"], "inner").select("run_id", "platform", "token", "job_id", "change")


SQUEEZED = "nullif(trim(regexp_replace({0}, '[\\s\\x{{A0}}\\x{{200B}}\\x{{FEFF}}]+', ' ', 'g')), '')"
P3_SQL = f"""
WITH sent AS (SELECT run_id, count(DISTINCT ordinal) AS n FROM postings GROUP BY 1),
whole AS (SELECT DISTINCT r.run_id, lane, run_no FROM runs r LEFT JOIN sent s USING (run_id) WHERE r.totals.postings = coalesce(n, 0)),
reads AS (SELECT DISTINCT b.run_id, b.platform, b.token, lane, run_no FROM board_reads b JOIN whole USING (run_id)
  WHERE error IS NULL AND (reported_total IS NULL OR reported_total <= n_postings)),
pairs AS (SELECT *, lag(run_id) OVER (PARTITION BY lane, platform, token ORDER BY run_no, run_id) AS before FROM reads),
jobs AS (SELECT run_id, platform, token, upper(trim(job_id)) AS job_id, {SQUEEZED.format("title")} AS t, {SQUEEZED.format("location")} AS l,
  {SQUEEZED.format("description")} AS s FROM postings WHERE trim(job_id) <> ''
  QUALIFY row_number() OVER (PARTITION BY run_id, platform, token, upper(trim(job_id)) ORDER BY ordinal) = 1),
n AS (SELECT p.run_id, p.platform, p.token, j.job_id, t, l, s FROM pairs p JOIN jobs j ON (p.run_id, p.platform, p.token) = (j.run_id, j.platform, j.token) WHERE before IS NOT NULL),
o AS (SELECT p.run_id, p.platform, p.token, j.job_id, t, l, s FROM pairs p JOIN jobs j ON (p.before, p.platform, p.token) = (j.run_id, j.platform, j.token))
SELECT coalesce(n.run_id, o.run_id) AS run_id, coalesce(n.platform, o.platform) AS platform, coalesce(n.token, o.token) AS token, coalesce(n.job_id, o.job_id) AS job_id,
  CASE WHEN n.job_id IS NULL THEN 'removed' WHEN o.job_id IS NULL THEN 'added' ELSE 'changed' END AS change
FROM n FULL JOIN o ON n.run_id = o.run_id AND n.platform = o.platform AND n.token = o.token AND n.job_id = o.job_id
WHERE n.job_id IS NULL OR o.job_id IS NULL OR n.t <> o.t OR n.l <> o.l OR n.s <> o.s
"""

QUERIES = {"p1_found": p1_found, "p3_found": p3_found}
ORACLES = {"p3_found": P3_SQL}
