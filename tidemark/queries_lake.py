"""Queries of the store's operators over the tables of one data folder, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions import urls as U
from tidemark.operators import crawl, dedupe, lake, pages, reads, tiers
from tidemark.scale import cut, guarded_join, shared_path, table
from tidemark.sources import payloads
from tidemark.sources.stores import VersionedTable
from tidemark.streaming import lake as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BOARD = ["platform", "token"]


def query(sql: str | None = None) -> Callable:
    """Register a query under its name, with the SQL that gives the same."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def job() -> Column:
    """A job's id trimmed and in capitals, null if empty."""
    return F.nullif(F.upper(F.trim("job_id")), F.lit(""))


def board_reads(spark: SparkSession, d: str) -> DataFrame:
    """Reads without their map and copies, with outcome."""
    return reads.with_outcome(table(spark, d, "board_reads").drop("extra").distinct())


def lanes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "runs").select("run_id", "lane", "run_no").distinct()


READS = """r AS (SELECT DISTINCT run_id, platform, token, status, error, reported_total, n_postings FROM board_reads),
o AS (SELECT *, CASE WHEN error IS NOT NULL THEN 'failed' WHEN coalesce(n_postings < reported_total, false) THEN 'truncated' WHEN coalesce(n_postings, 0) = 0 THEN 'empty' ELSE 'ok' END AS outcome,
  error IS NULL AND NOT coalesce(n_postings < reported_total, false) AS complete FROM r)"""


@query(f"WITH {READS} SELECT run_id, platform, token, n_postings, outcome, complete FROM o")
def read_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Outcome and completeness of each read."""
    return board_reads(spark, d).select("run_id", "platform", "token", "n_postings", "outcome", "complete")


@query(f"""WITH {READS} SELECT run_id, count(*) AS boards, count(*) FILTER (outcome = 'ok' OR outcome = 'truncated' AND n_postings > 0) AS ok,
count(*) FILTER (outcome = 'empty' OR outcome = 'truncated' AND coalesce(n_postings, 0) = 0) AS empty, count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome = 'truncated') AS truncated,
CAST(coalesce(sum(n_postings) FILTER (outcome <> 'failed'), 0) AS BIGINT) AS postings FROM o GROUP BY 1""")
def sweep_totals(spark: SparkSession, d: str) -> DataFrame:
    """What the reads of each run add up to."""
    return reads.totals(board_reads(spark, d), ["run_id"])


@query("SELECT substr(error, 1, 40) AS mode, count(*) AS n FROM (SELECT DISTINCT run_id, platform, token, status, error, reported_total, n_postings FROM board_reads) WHERE error IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def failure_modes_topk(spark: SparkSession, d: str) -> DataFrame:
    """The ten most frequent errors."""
    return reads.failure_modes(board_reads(spark, d))


@query("""WITH s AS (SELECT run_id, count(DISTINCT ordinal) AS sent FROM postings GROUP BY 1)
SELECT DISTINCT r.run_id, r.totals.postings AS reported, coalesce(sent, 0) AS sent, coalesce(sent, 0) = r.totals.postings AS whole FROM runs r LEFT JOIN s USING (run_id)""")
def run_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Rows that arrived of each run against the rows it reports."""
    sent = table(spark, d, "postings").select("run_id", "ordinal").distinct().groupBy("run_id").agg(F.count("ordinal").alias("sent"))
    runs = table(spark, d, "runs").select("run_id", F.col("totals.postings").alias("reported")).distinct()
    return runs.join(sent, "run_id", "left").select("run_id", "reported", F.coalesce("sent", F.lit(0)).alias("sent"), (F.coalesce("sent", F.lit(0)) == F.col("reported")).alias("whole"))


@query("""WITH o AS (SELECT l_orderkey, count(*) AS pages, min(l_linenumber) AS lo, max(l_linenumber) AS hi, count(DISTINCT l_linenumber) AS distinct_pages FROM lineitem GROUP BY 1)
SELECT l_orderkey, pages AS rows, distinct_pages AS pages, CASE WHEN pages <> distinct_pages THEN 'page_repeated' WHEN lo <> 1 OR hi - lo + 1 <> distinct_pages THEN 'page_missing' END AS error FROM o""")
def pagination_completeness(spark: SparkSession, d: str) -> DataFrame:
    """Whether the numbered lines of each order are all there, as the pages of a paged read."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.lit(1).alias("rows"))
    counts = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("total"))
    return reads.page_check(lines.join(counts, "l_orderkey"), ["l_orderkey"], "l_linenumber", "rows", "total").select("l_orderkey", "rows", "pages", "error")


@query("""SELECT run_id, platform, token, job_id, ordinal, title, location FROM (SELECT run_id, platform, token, upper(trim(job_id)) AS job_id, ordinal, title, location,
row_number() OVER (PARTITION BY run_id, platform, token, upper(trim(job_id)) ORDER BY ordinal) AS k FROM (SELECT DISTINCT run_id, ordinal, platform, token, job_id, title, location FROM postings)) WHERE k = 1""")
def dedupe_keep_first(spark: SparkSession, d: str) -> DataFrame:
    """The first row of each job in each run."""
    rows = table(spark, d, "postings").select("run_id", "platform", "token", F.upper(F.trim("job_id")).alias("job_id"), "ordinal", "title", "location")
    return dedupe.keep_first(rows, ["run_id", "platform", "token", "job_id"], [F.col("ordinal")])


@query("""SELECT platform, token, job_id, ordinal, run_id FROM (SELECT platform, token, upper(trim(job_id)) AS job_id, ordinal, run_id,
row_number() OVER (PARTITION BY platform, token, upper(trim(job_id)) ORDER BY ordinal DESC, run_id DESC) AS k FROM (SELECT DISTINCT run_id, ordinal, platform, token, job_id FROM postings)) WHERE k = 1""")
def keep_last_by_job(spark: SparkSession, d: str) -> DataFrame:
    """The last row of each job, whatever the run."""
    rows = table(spark, d, "postings").select("platform", "token", F.upper(F.trim("job_id")).alias("job_id"), "ordinal", "run_id")
    return dedupe.keep_last(rows, ["platform", "token", "job_id"], "ordinal")


KEY_SQL = "CASE WHEN rtrim(trim(coalesce(url, '')), '/') <> '' THEN lower(rtrim(trim(url), '/')) ELSE coalesce(platform, 'None') || '|' || coalesce(token, 'None') || '|' || coalesce(title, 'None') END"


@query(f"SELECT {KEY_SQL} AS key, min(ordinal) AS ordinal, count(DISTINCT ordinal) AS n FROM postings GROUP BY 1")
def url_identity(spark: SparkSession, d: str) -> DataFrame:
    """Postings by identity: the first of each and how many there are."""
    rows = table(spark, d, "postings").select(U.identity(F.col("url"), F.col("platform"), F.col("token"), F.col("title")).alias("key"), "ordinal").distinct()
    return rows.groupBy("key").agg(F.min("ordinal").alias("ordinal"), F.count("ordinal").alias("n"))


LIFE_SQL = f"""WITH {READS}, l AS (SELECT DISTINCT run_id, lane, run_no FROM runs),
c AS (SELECT DISTINCT lane, platform, token, run_no FROM o JOIN l USING (run_id) WHERE complete),
s AS (SELECT DISTINCT lane, platform, token, upper(trim(job_id)) AS job_id, run_no FROM postings JOIN l USING (run_id) WHERE trim(job_id) <> ''),
n AS (SELECT *, lead(run_no) OVER (PARTITION BY lane, platform, token, job_id ORDER BY run_no) AS nxt FROM s),
a AS (SELECT u.lane, u.platform, u.token, u.run_no, min(c.run_no) AS closes FROM (SELECT DISTINCT lane, platform, token, run_no FROM s) u LEFT JOIN c ON c.lane = u.lane AND c.platform = u.platform AND c.token = u.token AND c.run_no > u.run_no GROUP BY ALL),
g AS (SELECT n.*, closes, closes IS NOT NULL AND (nxt IS NULL OR closes < nxt) AS gone FROM n JOIN a USING (lane, platform, token, run_no))
SELECT lane, platform, token, job_id, min(run_no) AS first_seen, max(run_no) AS last_seen, NOT arg_max(gone, run_no) AS is_live, max(closes) FILTER (gone) AS went_dead_at FROM g GROUP BY 1, 2, 3, 4"""


def sightings(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "postings").select("run_id", *BOARD, job().alias("job_id")).where("job_id IS NOT NULL")
    return guarded_join(rows, lanes(spark, d), ["run_id"], "inner", "job_id").select("lane", *BOARD, "job_id", "run_no")


def complete(spark: SparkSession, d: str) -> DataFrame:
    return board_reads(spark, d).where("complete").join(lanes(spark, d), "run_id").select("lane", *BOARD, "run_no").distinct()


@query(LIFE_SQL)
def lake_history(spark: SparkSession, d: str) -> DataFrame:
    """State of every job after all runs of its lane: first and last sighting, whether it lives, when it closed."""
    return lake.replay(sightings(spark, d), complete(spark, d), ["lane", *BOARD], "job_id", "run_no")


MERGE_SQL = f"""WITH {READS}, l AS (SELECT DISTINCT run_id, lane, run_no FROM runs), p AS (SELECT lane, run_no, platform, token, upper(trim(job_id)) AS job_id, title, ordinal FROM postings JOIN l USING (run_id) WHERE run_no <= 2 AND trim(job_id) <> ''),
a AS (SELECT lane, platform, token, job_id, title FROM p WHERE run_no = 1 QUALIFY row_number() OVER (PARTITION BY lane, platform, token, job_id ORDER BY ordinal, title) = 1),
b AS (SELECT lane, platform, token, job_id, title FROM p WHERE run_no = 2 QUALIFY row_number() OVER (PARTITION BY lane, platform, token, job_id ORDER BY ordinal, title) = 1),
c AS (SELECT DISTINCT lane, platform, token FROM o JOIN l USING (run_id) WHERE complete AND run_no = 2)
SELECT k.*, CASE WHEN b.job_id IS NOT NULL AND b.title <> '' THEN b.title WHEN a.job_id IS NOT NULL THEN a.title ELSE b.title END AS title, CASE WHEN a.job_id IS NOT NULL THEN 1 ELSE 2 END AS first_seen, CASE WHEN b.job_id IS NOT NULL THEN 2 ELSE 1 END AS last_seen,
  NOT (b.job_id IS NULL AND c.token IS NOT NULL) AS is_live, CASE WHEN b.job_id IS NULL AND c.token IS NOT NULL THEN 2 END AS went_dead_at
FROM (SELECT lane, platform, token, job_id FROM a UNION SELECT lane, platform, token, job_id FROM b) k LEFT JOIN a USING (lane, platform, token, job_id) LEFT JOIN b USING (lane, platform, token, job_id) LEFT JOIN c USING (lane, platform, token)"""


@query(MERGE_SQL)
def lake_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The store after the second run of each lane has been merged into that of the first."""
    keys = ["lane", *BOARD, "job_id"]
    rows = table(spark, d, "postings").select("run_id", *BOARD, job().alias("job_id"), "title", "ordinal").where("job_id IS NOT NULL")
    rows = guarded_join(rows, lanes(spark, d), ["run_id"], "inner", "ordinal")
    run = lambda n: dedupe.keep_first(rows.where(F.col("run_no") == n).select(*keys, "title", "ordinal"), keys, [F.col("ordinal")]).select(*keys, "title")
    store = run(1).select("*", F.lit(1).alias("first_seen"), F.lit(1).alias("last_seen"), F.lit(True).alias("is_live"), F.lit(None).cast("int").alias("went_dead_at"))
    return lake.upsert(store, run(2), keys, complete(spark, d).where("run_no = 2"), ["lane", *BOARD], F.lit(2), filled=["title"])


@query()
def lake_upsert_all(spark: SparkSession, d: str) -> DataFrame:
    """The store after all runs of each lane have been merged into it, one after the other."""
    keys = ["lane", *BOARD, "job_id"]
    rows = table(spark, d, "postings").select("run_id", *BOARD, job().alias("job_id"), "title", "ordinal").where("job_id IS NOT NULL")
    rows = guarded_join(rows, lanes(spark, d), ["run_id"], "inner", "ordinal").select("run_no", *keys, "title", "ordinal")
    rows = cut(dedupe.keep_first(rows, ["run_no", *keys], [F.col("ordinal")]).select("run_no", *keys, "title"))
    reads_ = cut(complete(spark, d))
    store = rows.limit(0).select(*keys, "title", *[F.lit(None).cast(t).alias(c) for c, t in zip(lake.LIFE, ("int", "int", "boolean", "int"), strict=True)])
    for (n,) in sorted(lanes(spark, d).select("run_no").distinct().dropna().collect()):
        at = F.col("run_no") == n
        store = cut(lake.upsert(store, rows.where(at).drop("run_no"), keys, reads_.where(at), ["lane", *BOARD], F.lit(n), filled=["title"]))
    return store


@query("""WITH l AS (SELECT DISTINCT run_id, lane, run_no FROM runs), j AS (SELECT platform, token, upper(trim(job_id)) AS job_id, count(DISTINCT ordinal) AS n FROM postings WHERE trim(job_id) <> '' GROUP BY 1, 2, 3),
x AS (SELECT platform, token, upper(trim(job_id)) AS job_id, arg_max(CASE WHEN trim(title) = '' OR title IS NULL THEN 'no_title' ELSE 'no_place' END, ordinal) AS reason FROM postings
  WHERE trim(job_id) <> '' AND platform <> '' AND token <> '' AND (title IS NULL OR trim(title) = '' OR location IS NULL) GROUP BY 1, 2, 3)
SELECT j.*, x.reason AS hidden_reason, CASE WHEN x.reason IS NOT NULL THEN '2026-01-01' END AS reconciled_at FROM j LEFT JOIN x USING (platform, token, job_id)""")
def reconcile_rejected(spark: SparkSession, d: str) -> DataFrame:
    """Jobs, those marked of which a later delivery lacked a title or place."""
    rows = table(spark, d, "postings").select(*BOARD, job().alias("job_id"), "ordinal", "title", "location").where("job_id IS NOT NULL")
    store = rows.select(*BOARD, "job_id", "ordinal").distinct().groupBy(*BOARD, "job_id").agg(F.count("ordinal").alias("n"))
    bare = F.coalesce(F.trim("title"), F.lit("")) == ""
    rejected = rows.where(bare | F.col("location").isNull()).withColumn("reason", F.when(bare, "no_title").otherwise("no_place"))
    return lake.reconcile(store, rejected, [*BOARD, "job_id"], "reason", F.lit("2026-01-01"))


@query("SELECT DISTINCT platform, token FROM registry WHERE (platform, token) NOT IN (SELECT (platform, token) FROM postings)")
def boards_without_postings(spark: SparkSession, d: str) -> DataFrame:
    """Registered boards that brought nothing."""
    return lake.absent(table(spark, d, "registry").select(*BOARD).distinct(), table(spark, d, "postings"), BOARD)


@query("SELECT platform, token FROM registry INTERSECT SELECT platform, token FROM postings")
def store_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Boards of both registry and postings."""
    return table(spark, d, "registry").select(*BOARD).intersect(table(spark, d, "postings").select(*BOARD))


@query("SELECT platform, token FROM registry UNION SELECT platform, token FROM postings UNION SELECT platform, token FROM board_reads")
def board_universe(spark: SparkSession, d: str) -> DataFrame:
    """Every board that any table names."""
    each = [table(spark, d, t).select(*BOARD) for t in ("registry", "postings", "board_reads")]
    return each[0].unionByName(each[1]).unionByName(each[2]).distinct()


SURVIVOR = "PARTITION BY run_id, token, lower(trim(coalesce(title, ''))), coalesce(location, '') ORDER BY ordinal"


@query(f"""WITH p AS (SELECT DISTINCT run_id, ordinal, token, title, location FROM postings)
SELECT run_id, ordinal, CASE WHEN row_number() OVER w > 1 THEN first_value(ordinal) OVER w END AS dup_of FROM p WINDOW w AS ({SURVIVOR})""")
def duplicate_collapse(spark: SparkSession, d: str) -> DataFrame:
    """Postings of a run that repeat an earlier one's board, title and place."""
    rows = table(spark, d, "postings").select("run_id", "ordinal", "token", F.lower(F.trim(F.coalesce("title", F.lit("")))).alias("t"), F.coalesce("location", F.lit("")).alias("l")).distinct()
    return dedupe.collapse(rows, ["run_id", "token", "t", "l"], [F.col("ordinal")], F.col("ordinal")).select("run_id", "ordinal", "dup_of")


@query(f"""WITH p AS (SELECT DISTINCT run_id, ordinal, token, title, location, quality FROM postings), u AS (SELECT *, row_number() OVER ({SURVIVOR}) = 1 AS sole FROM p)
SELECT run_id, ordinal, sole AND row_number() OVER (PARTITION BY run_id, token, sole ORDER BY quality DESC NULLS LAST, ordinal) > 10 AS over_cap FROM u""")
def surfaced_flags(spark: SparkSession, d: str) -> DataFrame:
    """Unrepeated postings that stand after ten others of their board and run."""
    rows = table(spark, d, "postings").select("run_id", "ordinal", "token", "quality", F.lower(F.trim(F.coalesce("title", F.lit("")))).alias("t"), F.coalesce("location", F.lit("")).alias("l")).distinct()
    marked = dedupe.collapse(rows, ["run_id", "token", "t", "l"], [F.col("ordinal")], F.col("ordinal"))
    return dedupe.beyond(marked, ["run_id", "token"], [F.col("quality").desc_nulls_last(), F.col("ordinal")], 10, F.col("dup_of").isNull()).select("run_id", "ordinal", "over_cap")


@query("""SELECT DISTINCT ordinal, CASE WHEN regexp_full_match(trim(posted_on), '\\d{4}-\\d{2}-\\d{2}.*') THEN date_diff('day', try_cast(substr(trim(posted_on), 1, 10) AS DATE), DATE '2026-03-15') END::INTEGER AS age,
coalesce(CASE WHEN regexp_full_match(trim(posted_on), '\\d{4}-\\d{2}-\\d{2}.*') THEN date_diff('day', try_cast(substr(trim(posted_on), 1, 10) AS DATE), DATE '2026-03-15') END > 180, false) AS is_stale FROM postings""".replace("\\\\", "\\"))
def staleness(spark: SparkSession, d: str) -> DataFrame:
    """Age in days of postings whose date is written year first; an unknown age is not stale."""
    t = F.trim("posted_on")
    age = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.datediff(F.lit("2026-03-15").cast("date"), F.substring(t, 1, 10).try_cast("date")))
    return table(spark, d, "postings").select("ordinal", age.alias("age"), F.coalesce(age > 180, F.lit(False)).alias("is_stale")).distinct()


@query(f"WITH {READS} SELECT platform, outcome, count(*) AS n FROM o GROUP BY GROUPING SETS ((platform, outcome), (platform), ())")
def report_group_counts(spark: SparkSession, d: str) -> DataFrame:
    """Reads by platform and outcome, with totals."""
    return board_reads(spark, d).groupingSets([[F.col("platform"), F.col("outcome")], [F.col("platform")], []], F.col("platform"), F.col("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT run_id, count(*) AS postings, count(DISTINCT (platform, token)) AS boards, count(*) FILTER (description IS NOT NULL) AS described, count(*) FILTER (quality IS NULL) AS unrated, count(*) FILTER (quality >= 50) AS good, round(avg(quality), 4) AS mean_quality
FROM (SELECT DISTINCT run_id, ordinal, platform, token, description, quality FROM postings) GROUP BY 1""")
def report_conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of each run in one pass; what is unknown is neither good nor bad."""
    rows = table(spark, d, "postings").select("run_id", "ordinal", *BOARD, F.col("description").isNotNull().alias("described"), "quality").distinct()
    return rows.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("postings"), F.count_distinct(*BOARD).alias("boards"), F.count_if("described").alias("described"), F.count_if(F.col("quality").isNull()).alias("unrated"), F.count_if(F.col("quality") >= 50).alias("good"), F.round(F.avg("quality"), 4).alias("mean_quality")
    )


PLATFORMS = ["ashby", "eightfold", "greenhouse", "keka", "lever", "personio", "recruitee", "smartrecruiters", "successfactors", "workable", "workday"]


@query("SELECT coalesce(segment, 'none') AS segment, " + ", ".join(f"count(*) FILTER (platform = '{p}') AS {p}" for p in PLATFORMS) + " FROM (SELECT DISTINCT platform, token, segment FROM registry) GROUP BY 1")
def segment_platform_pivot(spark: SparkSession, d: str) -> DataFrame:
    """Registered boards by segment and platform."""
    rows = table(spark, d, "registry").select(*BOARD, F.coalesce("segment", F.lit("none")).alias("segment")).distinct()
    got = rows.groupBy("segment").pivot("platform", PLATFORMS).count()
    return got.select("segment", *[F.coalesce(p, F.lit(0)).alias(p) for p in PLATFORMS])


HISTORY_SQL = """h AS (SELECT user_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS total_ever, CAST(sum(CASE WHEN event_type = 'purchase' AND ts > TIMESTAMP '2024-01-31' - INTERVAL 7 DAY THEN 1 ELSE 0 END) AS BIGINT) AS recent, count(*) AS sweeps, max(ts) AS last_swept FROM events GROUP BY 1),
t AS (SELECT *, CASE WHEN recent > 0 THEN 'hot' WHEN total_ever > 0 THEN 'warm' ELSE 'cold' END AS tier FROM h)"""


def tiered(spark: SparkSession, d: str) -> DataFrame:
    now = F.lit("2024-01-31").cast("timestamp_ntz")
    finds = table(spark, d, "events").withColumn("found", (F.col("event_type") == "purchase").cast("int"))
    boards = tiers.history(finds, ["user_id"], "found", "ts", now, 7)
    return boards.withColumn("tier", tiers.tier(F.col("total_ever"), F.col("recent"), F.col("sweeps")))


@query(f"WITH {HISTORY_SQL} SELECT user_id, total_ever, recent, sweeps, tier, round(total_ever / sweeps, 4) AS mean_yield, TIMESTAMP '2024-01-31' >= last_swept + CASE tier WHEN 'hot' THEN INTERVAL 6 HOUR WHEN 'warm' THEN INTERVAL 24 HOUR ELSE INTERVAL 168 HOUR END AS due FROM t")
def tier_assign(spark: SparkSession, d: str) -> DataFrame:
    """Tier of each source of events, its yield, and whether it is due at a fixed time."""
    now = F.lit("2024-01-31").cast("timestamp_ntz")
    return tiered(spark, d).select("user_id", "total_ever", "recent", "sweeps", "tier", F.round(tiers.board_yield(F.col("total_ever"), F.col("sweeps")), 4).alias("mean_yield"), tiers.due(F.col("tier"), F.col("last_swept"), now).alias("due"))


@query(f"WITH {HISTORY_SQL} SELECT tier, count(*) AS boards, CAST(sum(total_ever) AS BIGINT) AS total_ever, round(avg(total_ever / sweeps), 4) AS mean_yield FROM t GROUP BY 1")
def tier_report(spark: SparkSession, d: str) -> DataFrame:
    """What each tier holds and yields."""
    return tiers.report(tiered(spark, d))


RULES = [("*", False, "/"), ("*", True, "/careers"), ("*", True, "/job-board/"), ("*", False, "/careers-page/*d$"), ("tidebot", True, "/"), ("tidebot", False, "/forum-post/"), ("tidebot", False, "/*/1*9$")]


@query("""WITH d AS (SELECT doc_id, regexp_extract(url, '^https?://[^/]+(/.*)$', 1) AS path FROM documents WHERE url IS NOT NULL)
SELECT doc_id, path, NOT (regexp_matches(path, '^/.*/1.*9$') OR starts_with(path, '/forum-post/')) AS allowed FROM d""")
def robots_longest_match(spark: SparkSession, d: str) -> DataFrame:
    """Documents' addresses against the rules of an agent's own group."""
    rules = spark.createDataFrame([("any", a, ok, p, None) for a, ok, p in RULES], crawl.RULES)
    paths = table(spark, d, "documents").where("url IS NOT NULL").select("doc_id", F.lit("any").alias("origin"), U.path(F.col("url")).alias("path"))
    return crawl.allowed(paths, rules, "tidebot").select("doc_id", "path", "allowed")


@query("""SELECT event_id, date_diff('microsecond', lag(ts) OVER w, ts) AS gap, greatest(0, 3600000000 - coalesce(date_diff('microsecond', lag(ts) OVER w, ts), 3600000000)) AS wait
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def crawl_gap_audit(spark: SparkSession, d: str) -> DataFrame:
    """Time since the same source's event before, and what was missing to an hour, in microseconds."""
    return crawl.gaps(table(spark, d, "events"), "user_id", "ts", 3600.0, "event_id").select("event_id", "gap", "wait")


@query("""SELECT event_id, max(CASE WHEN event_type = 'error' THEN epoch(ts) + greatest(900.0, value) END) OVER (PARTITION BY user_id ORDER BY epoch(ts), event_id ROWS UNBOUNDED PRECEDING) AS until FROM events""")
def penalty_window(spark: SparkSession, d: str) -> DataFrame:
    """Until when each source was to be left alone after errors."""
    rows = table(spark, d, "events").withColumn("s", F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6))
    return crawl.penalties(rows, "user_id", "s", F.col("event_type") == "error", F.col("value"), "event_id").select("event_id", "until")


#: Domains that the test data give to hiring platforms.
INVENTED = {"ashby": ("ashby.example",), "eightfold": ("hire.example",), "workday": ("workboards.example",)}
KIND_SQL = "CASE WHEN regexp_matches(h, 'greenhouse\\.') THEN 'greenhouse' WHEN regexp_matches(h, 'lever\\.') THEN 'lever' WHEN regexp_matches(h, 'ashby\\.') THEN 'ashby' WHEN regexp_matches(h, '\\.keka') THEN 'keka' WHEN regexp_matches(h, 'smartrecruiters\\.') THEN 'smartrecruiters' WHEN regexp_matches(h, 'workable\\.') THEN 'workable' WHEN regexp_matches(h, 'workboards\\.') THEN 'workday' WHEN regexp_matches(h, 'personio\\.') THEN 'personio' WHEN regexp_matches(h, 'recruitee\\.') THEN 'recruitee' WHEN regexp_matches(h, 'eightfold\\.|\\.hire\\.') THEN 'eightfold' WHEN regexp_matches(h, 'successfactors\\.') OR contains(p, '/job/') AND contains(h, 'careers') THEN 'successfactors' ELSE 'generic_html' END"


@query(f"""WITH u AS (SELECT DISTINCT url, lower(regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)', 1)) AS h, lower(regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+([^#]*)', 1)) AS p FROM postings WHERE url IS NOT NULL), k AS (SELECT h, {KIND_SQL} AS kind FROM u)
SELECT kind, CASE WHEN kind = 'generic_html' THEN 'low_trust' ELSE 'trusted' END AS trust, count(*) AS urls, count(DISTINCT h) AS hosts FROM k GROUP BY 1, 2""")
def url_kind_route(spark: SparkSession, d: str) -> DataFrame:
    """Addresses by what serves them."""
    u = F.col("url")
    rows = table(spark, d, "postings").where("url IS NOT NULL").select("url").distinct()
    return rows.select(U.kind(u, INVENTED).alias("kind"), U.trust(u, INVENTED).alias("trust"), F.coalesce(U.host(u), F.lit("")).alias("h")).groupBy("kind", "trust").agg(F.count(F.lit(1)).alias("urls"), F.count_distinct("h").alias("hosts"))


SPACE = "[\\t\\n\\x0B\\f\\r ]+"


def decoded(sql: str) -> str:
    """SQL that decodes the common entities, in the order of the column function."""
    for entity, char in X.ENTITIES:
        sql = f"replace({sql}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return sql


STRIPPED = f"trim(regexp_replace({decoded(f"regexp_replace({decoded('description')}, '<[^>]+>', ' ', 'g')")}, '{SPACE}', ' ', 'g'))"


@query(f"WITH t AS (SELECT DISTINCT ordinal, {STRIPPED} AS t FROM postings WHERE description IS NOT NULL) SELECT ordinal, sha256(t) AS digest, length(t)::INTEGER AS chars FROM t")
def html_strip(spark: SparkSession, d: str) -> DataFrame:
    """Descriptions without markup: length and digest."""
    t = X.strip_html(F.col("description"))
    return table(spark, d, "postings").where("description IS NOT NULL").select("ordinal", F.sha2(t, 256).alias("digest"), F.length(t).alias("chars")).distinct()


@query("SELECT doc_id, sha256(url) AS key, substr(sha256(url), 1, 16) AS short_key FROM documents WHERE url IS NOT NULL")
def request_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys under which documents' addresses are recorded."""
    return table(spark, d, "documents").where("url IS NOT NULL").select("doc_id", X.cache_key(F.col("url")).alias("key"), X.short_key(F.col("url")).alias("short_key"))


@query("""WITH l AS (SELECT DISTINCT run_id, lane, run_no FROM runs), p AS (SELECT lane, platform, token, upper(trim(job_id)) AS job_id, run_no, min(ordinal) AS ordinal FROM postings JOIN l USING (run_id) WHERE trim(job_id) <> '' GROUP BY 1, 2, 3, 4, 5),
q AS (SELECT DISTINCT p.*, sha256(title) AS digest FROM p JOIN postings s USING (ordinal)), w AS (SELECT *, lag(digest) OVER k AS before, row_number() OVER k AS n FROM q WINDOW k AS (PARTITION BY lane, platform, token, job_id ORDER BY run_no))
SELECT lane, platform, token, job_id, run_no, CASE WHEN digest IS NULL THEN 'failed' WHEN n = 1 THEN 'new' WHEN before IS NOT DISTINCT FROM digest THEN 'unchanged' ELSE 'changed' END AS outcome FROM w""")
def hash_gate_history(spark: SparkSession, d: str) -> DataFrame:
    """Each job's title in each run against the run before: what would be worked on again."""
    rows = table(spark, d, "postings").select("run_id", *BOARD, job().alias("job_id"), "ordinal", F.sha2("title", 256).alias("digest")).where("job_id IS NOT NULL")
    rows = guarded_join(rows, lanes(spark, d), ["run_id"], "inner", "ordinal")
    keys = ["lane", *BOARD, "job_id"]
    one = rows.groupBy(*keys, "run_no").agg(F.min(F.struct("ordinal", "digest")).alias("m")).select(*keys, "run_no", "m.digest")
    return pages.changes(one, keys, ["run_no"], "digest").select(*keys, "run_no", "outcome")


@query(r"""WITH p AS (SELECT DISTINCT ordinal, lower(trim(regexp_replace(title, '[\t\n\x0B\f\r ]+', ' ', 'g'))) AS q, lower(trim(regexp_replace(description, '[\t\n\x0B\f\r ]+', ' ', 'g'))) AS b FROM postings WHERE title IS NOT NULL AND description IS NOT NULL AND regexp_full_match(title, '[\x20-\x7E]*') AND regexp_full_match(description, '[\x0A\x20-\x7E]*'))
SELECT ordinal, length(q) >= 12 AND contains(b, q) AS quoted FROM p""")
def quote_containment(spark: SparkSession, d: str) -> DataFrame:
    """Those of quote_containment_all that SQL can check: plain ASCII texts."""
    return quoted(table(spark, d, "postings").where(F.col("title").rlike(r"^[\x20-\x7E]*$") & F.col("description").rlike(r"^[\x0A\x20-\x7E]*$")))


@query()
def quote_containment_all(spark: SparkSession, d: str) -> DataFrame:
    """Whether a posting's title stands in its description word for word; false where either is missing."""
    return quoted(table(spark, d, "postings"))


def quoted(postings: DataFrame) -> DataFrame:
    return postings.select("ordinal", F.coalesce(X.quoted_in(F.col("title"), F.col("description")), F.lit(False)).alias("quoted")).distinct()


@query("SELECT DISTINCT lower(regexp_extract(evidence, '^https?://(?:www\\.)?([^/.]+)', 1)) AS token, platform FROM registry WHERE regexp_matches(evidence, '^https?://')")
def evidence_tokens(spark: SparkSession, d: str) -> DataFrame:
    """First labels of the hosts that registry entries cite."""
    h = F.regexp_replace(U.host(F.col("evidence")), r"^www\.", "")
    return table(spark, d, "registry").where(F.col("evidence").rlike("^https?://")).select(F.substring_index(h, ".", 1).alias("token"), "platform").distinct()


@query()
def company_identity_key(spark: SparkSession, d: str) -> DataFrame:
    """Boards that one firm's tokens stand for."""
    rows = table(spark, d, "postings").select(*BOARD).distinct()
    return rows.select(*BOARD, U.company_key(F.col("token")).alias("company"))


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_props_decode(spark: SparkSession, d: str) -> DataFrame:
    """A field of a JSON text, null where the text or field is missing or broken."""
    return table(spark, d, "events").select("event_id", F.expr("try_variant_get(try_parse_json(props), '$.k', 'bigint')").alias("k"))


@query("""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(text, '\\b((?:19|20|21)\\d{2})\\b', 1), lambda x: CAST(x AS INT)), lambda x: x BETWEEN 2020 AND 2035))), ',') AS years
FROM documents WHERE regexp_full_match(text, '[\\x0A\\x20-\\x7E]*') AND NOT regexp_matches(text, '\\b(?:19|20|21)\\d{2}\\s*-\\s*(?:19|20|21)\\d{2}\\b')""")
def years_named(spark: SparkSession, d: str) -> DataFrame:
    """Those of years_named_all that SQL can check: plain ASCII texts without ranges."""
    rows = table(spark, d, "documents").where(F.col("text").rlike(r"^[\x0A\x20-\x7E]*$") & ~F.col("text").rlike(r"\b(?:19|20|21)\d{2}\s*-\s*(?:19|20|21)\d{2}\b"))
    return years(rows)


@query()
def years_named_all(spark: SparkSession, d: str) -> DataFrame:
    """Years that texts name, ranges filled; '' where the text is missing."""
    return years(table(spark, d, "documents"))


def years(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", F.array_join(X.years_named(F.col("text")), ",").alias("years"))


@query("SELECT * FROM registry QUALIFY row_number() OVER (ORDER BY ordinal, platform, token, company, segment, source, evidence) <= 25")
def registry_first(spark: SparkSession, d: str) -> DataFrame:
    """The first 25 entries of the registry, which is what a limited run reads."""
    every = table(spark, d, "registry")
    return every.orderBy(*[F.col(c).asc_nulls_last() for c in every.columns]).limit(25)


@query("""SELECT DISTINCT p.ordinal, p.platform, p.token, r.company, r.segment FROM postings p LEFT JOIN (SELECT * FROM registry QUALIFY row_number() OVER (PARTITION BY platform, token ORDER BY ordinal, company, segment) = 1) r USING (platform, token)""")
def postings_with_registry(spark: SparkSession, d: str) -> DataFrame:
    """Postings with the company and segment of their board's first entry."""
    first = table(spark, d, "registry").groupBy(*BOARD).agg(F.min_by(F.struct("company", "segment"), "ordinal").alias("r")).select(*BOARD, "r.company", "r.segment")
    rows = table(spark, d, "postings").select("ordinal", *BOARD).distinct()
    return guarded_join(rows, first, BOARD, "left", "ordinal").select("ordinal", *BOARD, "company", "segment")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def events_tumbling(spark: SparkSession, d: str) -> DataFrame:
    """Events per hour and type."""
    return streams.tumbling(table(spark, d, "events"), "ts", ["event_type"], "1 hour").withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def events_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions of each source's events, six hours apart."""
    got = streams.sessions(table(spark, d, "events"), "ts", ["user_id"], "6 hours")
    return got.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


ANSWERS = [
    ("greenhouse", "acme", 1, '{"jobs": [{"id": 7, "title": "Cook", "location": {"name": "Oslo"}, "absolute_url": "https://x.example/7", "updated_at": "2025-01-02", "content": "&lt;p&gt;Soup &amp;amp; bread&lt;/p&gt;"}], "meta": {"total": 1}}'),
    ("lever", "bolt", 1, '[{"id": "a1", "text": "Smith", "categories": {"location": "Rome"}, "applyUrl": "https://y.example/a1", "createdAt": 1735689600000, "descriptionPlain": ""}]'),
    ("workday", "w.wd1.boards.example|acme|Site", 1, '{"total": 2, "jobPostings": [{"externalPath": "/job/Oslo/Cook_R1", "title": "Cook", "bulletFields": ["R1"]}, {"externalPath": "/job/Oslo/Baker_R2", "title": "Baker", "bulletFields": []}]}'),
    ("keka", "kit", 1, '[{"id": 3, "title": "Clerk", "jobLocations": [{"name": "HQ", "city": "Pune"}], "description": null}]'),
    ("recruitee", "rex", 1, '{"error": "gone"}'),
]


@query("""SELECT * FROM (VALUES ('greenhouse', 'acme', '7', 'Cook', 'Oslo', 'https://x.example/7', '2025-01-02', 'Soup & bread'), ('lever', 'bolt', 'a1', 'Smith', 'Rome', 'https://y.example/a1', '1735689600000', NULL),
('workday', 'w.wd1.boards.example|acme|Site', 'R1', 'Cook', '', 'https://w.wd1.boards.example/Site/job/Oslo/Cook_R1', '', NULL), ('workday', 'w.wd1.boards.example|acme|Site', 'Baker_R2', 'Baker', '', 'https://w.wd1.boards.example/Site/job/Oslo/Baker_R2', '', NULL),
('keka', 'kit', '3', 'Clerk', 'HQ Pune', 'https://kit.keka.com/careers/jobdetails/3', '', NULL)) t(platform, token, job_id, title, location, url, posted_on, description)""")
def adapter_parse(spark: SparkSession, d: str) -> DataFrame:
    """Captured answers of several platforms parsed to postings."""
    answers = spark.createDataFrame(ANSWERS, "platform string, token string, page int, payload string")
    return payloads.parse(answers).select("platform", "token", "job_id", "title", "location", "url", "posted_on", "description")


@query("SELECT * FROM (VALUES ('greenhouse', NULL, 1, 1), ('lever', NULL, 1, NULL), ('workday', NULL, 2, 2), ('keka', NULL, 1, NULL), ('recruitee', 'unexpected_shape', 0, NULL)) t(platform, error, n_postings, reported_total)")
def adapter_headers(spark: SparkSession, d: str) -> DataFrame:
    """What each captured answer amounts to."""
    answers = spark.createDataFrame(ANSWERS, "platform string, token string, page int, payload string")
    return payloads.headers(answers).select("platform", "error", "n_postings", "reported_total")


WEEK = 7 * 86_400_000_000


@query(f"""WITH e AS (SELECT CAST(user_id AS VARCHAR) AS board, event_type, epoch_us(ts) AS us, epoch_us(ts) // {WEEK} AS week FROM events), n AS (SELECT week, max(us) AS now FROM e GROUP BY 1),
k AS (SELECT board, event_type, min(week) AS f, max(week) AS l FROM e GROUP BY 1, 2), b AS (SELECT board, max(week) AS last FROM e GROUP BY 1), g AS (SELECT e.board, e.event_type, min(x.week) AS gone FROM k e JOIN (SELECT DISTINCT board, week FROM e) x ON x.board = e.board AND x.week > e.l GROUP BY 1, 2)
SELECT k.board, k.event_type, a.now AS first_seen, z.now AS last_seen, g.gone IS NULL AS is_live FROM k JOIN n a ON a.week = k.f JOIN n z ON z.week = k.l LEFT JOIN g ON g.board = k.board AND g.event_type = k.event_type""")
def stream_lake_merge(spark: SparkSession, d: str) -> DataFrame:
    """Events streamed week by week through the store: the last state of each source and type."""
    events = table(spark, d, "events").select(F.col("user_id").cast("string").alias("board"), "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"), "event_id")
    source = shared_path(spark, "stream-source")
    events = events.withColumn("week", F.floor(F.col("at") / WEEK))
    # Deliveries one after the other, as a stream takes files by their age: one append per week of the data.
    for (week,) in events.select("week").distinct().orderBy("week").collect():
        events.where(F.col("week") == week).coalesce(1).write.mode("append").parquet(source)
    store = VersionedTable(spark, shared_path(spark, "stream-store"), ["board"], 8)
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source).drop("week")
    streams.merge_stream(spark, rows, store, ["board", "event_type"], ["board"], "at", "event_id", shared_path(spark, "stream-checkpoint"))
    return store.read().select("board", "event_type", "first_seen", "last_seen", "is_live")
