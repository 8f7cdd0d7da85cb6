"""Queries of the sources, of crawling and of the page plans over the tables of one data folder, and the same in SQL.

The answers of platforms, pages and files are made of the tables' rows, so that the operators read whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import nested as N
from tidemark.functions import text as X
from tidemark.functions import urls as U
from tidemark.operators import crawl, discovery, pages, tiers
from tidemark.plans import single
from tidemark.plans.pages import read_pages
from tidemark.queries_lake import BOARD, INVENTED, STRIPPED, decoded, job, tiered
from tidemark.scale import table
from tidemark.sources import boards, payloads, stores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a query under its name, with the SQL that gives the same."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


C = F.col  # short, as nearly every expression here names one
PAGE = 50  # postings in one made answer


def postings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "postings").select("ordinal", *BOARD, "job_id", "title", "location", "url", "posted_on", "description").distinct()


def answers(rows: DataFrame, platform: str, wrap: Callable[[Column], Column], **fields: Column) -> DataFrame:
    """Postings as the answers of a platform, PAGE of them in each."""
    item = F.struct(*[c.alias(k) for k, c in fields.items()])
    page = F.floor(C("ordinal") / PAGE).cast("int")
    made = rows.groupBy(*BOARD, page.alias("page")).agg(F.to_json(wrap(F.collect_list(item))).alias("payload"))
    return made.select(F.lit(platform).alias("platform"), "token", "page", "payload")


def under(name: str, total: str | None = None) -> Callable[[Column], Column]:
    return lambda items: F.struct(items.alias(name), *([F.size(items).alias(total)] if total else []))


def inside(**fields: Column) -> Column:
    return F.struct(*[c.alias(k) for k, c in fields.items()])


def made_of() -> dict:
    """How each platform's answers are made of postings: the wrapping and the keys. (Columns need a session, so they are made when asked for.)"""
    id_, title, place, url, on, text, n = (C(c) for c in ("job_id", "title", "location", "url", "posted_on", "description", "ordinal"))
    return {
        "greenhouse": (under("jobs"), {"id": id_, "title": title, "location": inside(name=place), "absolute_url": url, "updated_at": on, "content": text}),
        "lever": (lambda items: items, {"id": id_, "text": title, "categories": inside(location=place), "hostedUrl": url, "createdAt": on, "descriptionPlain": text}),
        "ashby": (under("jobs"), {"id": id_, "title": title, "location": place, "applyUrl": url, "publishedAt": on, "descriptionPlain": text}),
        "smartrecruiters": (under("content", "totalFound"), {"id": n, "name": title, "location": inside(city=place, country=F.lit("Norway")), "releasedDate": on}),
        "workable": (under("jobs"), {"id": id_, "title": title, "location": inside(country=place), "application_url": url, "published_on": on}),
        "workday": (under("jobPostings", "total"), {"bulletFields": F.array(id_), "externalPath": F.concat(F.lit("/job/"), n), "title": title, "locationsText": place, "postedOn": on}),
        "personio": (lambda items: items, {"id": n, "name": title, "office": place, "createdAt": on}),
        "recruitee": (under("offers"), {"id": id_, "title": title, "city": place, "country": F.lit("Norway"), "careers_url": url, "published_at": on}),
        "keka": (lambda items: items, {"id": n, "title": title, "jobLocations": F.array(inside(city=place)), "postedOn": on, "jobDescription": text}),
        "amazon": (under("jobs", "hits"), {"id_icims": id_, "title": title, "normalized_location": place, "job_path": F.concat(F.lit("/en/jobs/"), n), "posted_date": on, "description": text}),
        "eightfold": (under("positions", "count"), {"id": id_, "name": title, "locations": F.array(place), "postedTs": n}),
    }


ABSENT = {c: f"coalesce({c}, '')" for c in ("job_id", "title", "location", "url", "posted_on")}
NORWAY = "CASE WHEN coalesce(location, '') = '' THEN 'Norway' ELSE location || ', Norway' END"
RAW, HTML, NO_TEXT = "coalesce(description, '')", f"coalesce({STRIPPED}, '')", "''"
SITE = "coalesce(nullif(split_part(token, '|', 3), ''), nullif(split_part(token, '|', 2), ''), split_part(split_part(token, '|', 1), '.', 1))"
#: What SQL says that each platform's answers hold, where it isn't ABSENT; the description last.
SAID = {
    "greenhouse": ({}, HTML), "lever": ({}, RAW), "ashby": ({}, RAW), "workable": ({}, NO_TEXT), "recruitee": ({"location": NORWAY}, NO_TEXT),
    "smartrecruiters": ({"job_id": "CAST(ordinal AS VARCHAR)", "location": NORWAY, "url": "'https://jobs.smartrecruiters.com/' || token || '/' || ordinal"}, NO_TEXT),
    "workday": ({"job_id": "coalesce(nullif(job_id, ''), CAST(ordinal AS VARCHAR))", "url": f"'https://' || split_part(token, '|', 1) || '/' || {SITE} || '/job/' || ordinal"}, NO_TEXT),
    "personio": ({"job_id": "CAST(ordinal AS VARCHAR)", "url": "'https://' || token || '.jobs.personio.de/job/' || ordinal"}, NO_TEXT),
    "keka": ({"job_id": "CAST(ordinal AS VARCHAR)", "location": "regexp_replace(coalesce(location, ''), '^\\s+|\\s+$', '', 'g')", "url": "'https://' || token || '.keka.com/careers/jobdetails/' || ordinal"}, HTML),
    "amazon": ({"location": "trim(coalesce(location, ''))", "url": "'https://www.amazon.jobs/en/jobs/' || ordinal"}, HTML),
    "eightfold": ({"url": "''", "posted_on": "strftime(make_timestamp(ordinal * 1000000), '%Y-%m-%dT%H:%M:%SZ')"}, NO_TEXT),
}


def source(platform: str) -> None:
    """Register the query that reads all postings as if ``platform`` had answered with them."""

    def read(spark: SparkSession, d: str) -> DataFrame:
        wrap, fields = made_of()[platform]
        got = payloads.parse(answers(postings(spark, d), platform, wrap, **fields))
        return got.select("token", "job_id", "title", "location", "url", "posted_on", F.sha2(F.coalesce("description", F.lit("")), 256).alias("digest")).distinct()

    own, text = SAID[platform]
    columns = ", ".join(f"{(ABSENT | own)[c]} AS {c}" for c in ABSENT)
    QUERIES[f"source_{platform}"] = read
    ORACLES[f"source_{platform}"] = f"SELECT DISTINCT token, {columns}, sha256({text}) AS digest FROM postings"


for _name in SAID:
    source(_name)


@query("""SELECT DISTINCT platform, token, CASE WHEN platform = 'smartrecruiters' THEN 'platform_robots_disallowed' WHEN platform NOT IN ('ashby', 'eightfold', 'greenhouse', 'keka', 'lever', 'personio', 'recruitee', 'successfactors', 'workable', 'workday') OR platform IS NULL THEN 'unsupported_platform' END AS error FROM board_reads""")
def board_dispatch(spark: SparkSession, d: str) -> DataFrame:
    """Boards that aren't read at all, and why."""
    return table(spark, d, "board_reads").select(*BOARD, boards.dispatch(C("platform")).alias("error")).distinct()


@query("""WITH b AS (SELECT run_id, platform, token, max(reported_total) AS total FROM board_reads GROUP BY 1, 2, 3), p AS (SELECT DISTINCT run_id, platform, token, ordinal FROM postings),
n AS (SELECT *, (row_number() OVER (PARTITION BY run_id, platform, token ORDER BY ordinal) - 1) // 20 + 1 AS page FROM p), g AS (SELECT run_id, platform, token, page, count(*) AS k FROM n GROUP BY ALL),
c AS (SELECT g.*, total, coalesce(sum(k) OVER (PARTITION BY run_id, platform, token ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g JOIN b USING (run_id, platform, token)),
f AS (SELECT run_id, platform, token, sum(k) AS n, max(total) AS total, count(*) AS pages, min(before) FILTER (before + k > total) AS over FROM c GROUP BY 1, 2, 3)
SELECT run_id, platform, token, CAST(CASE WHEN total IS NULL THEN 0 ELSE coalesce(over, n) END AS INTEGER) AS n_postings, total AS reported_total, CAST(pages AS INTEGER) AS pages,
CASE WHEN total IS NULL THEN 'pagination_unconfirmed' WHEN over = 0 THEN 'total_underreported' WHEN over IS NOT NULL THEN 'total_underreported_partial_at_' || CAST(over AS BIGINT) WHEN n < total THEN 'short_page_partial_at_' || CAST(n AS BIGINT) END AS error FROM f""")
def paged_boards(spark: SparkSession, d: str) -> DataFrame:
    """Each read's postings as pages of 20 under the total it reported: whether they make a whole."""
    rows = table(spark, d, "postings").select("run_id", *BOARD, "ordinal").distinct()
    key = ["run_id", *BOARD]
    page = F.floor((F.row_number().over(W.partitionBy(*key).orderBy("ordinal")) - 1) / 20).cast("int") + 1
    each = rows.withColumn("page", page).groupBy(*key, "page").agg(F.count(F.lit(1)).alias("n"))
    total = table(spark, d, "board_reads").groupBy(*key).agg(F.max("reported_total").alias("total"))
    return boards.paged_reads(each.join(total, key).withColumn("echo", C("page")), key, "page", "n", "total", "echo")


MAPS = "SELECT DISTINCT token, ordinal, ordinal % 14 AS part FROM postings"


def sitemap_files(spark: SparkSession, d: str) -> DataFrame:
    """Boards as lists of sitemaps: fourteen of jobs, as far as the board has any, and one of pages. Each entry is one element of its file."""
    rows = table(spark, d, "postings").select("token", "ordinal", (C("ordinal") % 14).alias("part")).distinct()
    at = F.concat(F.lit("https://s.example/"), C("token"), F.lit("/job-map-"), F.lpad(C("part").cast("string"), 2, "0"), F.lit(".xml"))
    entry = F.concat(F.lit("<url><loc>https://s.example/job/Pune-Cook-IND-411001/"), C("ordinal"), F.lit("/</loc><lastmod>2025-01-"), F.lpad((C("part") + 1).cast("string"), 2, "0"), F.lit("</lastmod></url>"))
    files = rows.select("token", at.alias("url"), entry.alias("x")).groupBy("token", "url").agg(F.array_join(F.sort_array(F.collect_list("x")), "").alias("payload"))
    loc = lambda u: F.concat(F.lit("<sitemap><loc>"), u, F.lit("</loc></sitemap>"))
    root = files.groupBy("token").agg(F.array_join(F.sort_array(F.collect_list(loc(C("url")))), "").alias("payload"))
    root = root.select("token", F.concat(F.lit("https://s.example/"), C("token"), F.lit("/sitemap.xml")).alias("url"), F.concat(F.lit("<sitemapindex><sitemap><loc>https://s.example/pages.xml</loc></sitemap>"), C("payload"), F.lit("</sitemapindex>")).alias("payload"))
    return files.unionByName(root)


@query(f"""WITH m AS ({MAPS}), c AS (SELECT token, part, dense_rank() OVER (PARTITION BY token ORDER BY part) AS k FROM m GROUP BY 1, 2)
SELECT token, CAST(ordinal AS VARCHAR) AS job_id, 'Cook' AS title, 'Pune, India 411001' AS location, 'https://s.example/job/Pune-Cook-IND-411001/' || ordinal || '/' AS url FROM m JOIN c USING (token, part) WHERE k <= 12""")
def sitemap_postings(spark: SparkSession, d: str) -> DataFrame:
    """Postings of boards that serve sitemaps of sitemaps, twelve of which are read."""
    return boards.sitemap_boards(sitemap_files(spark, d))[0].select("token", "job_id", "title", "location", "url")


@query(f"""WITH m AS ({MAPS}), c AS (SELECT token, part, count(*) AS n, dense_rank() OVER (PARTITION BY token ORDER BY part) AS k FROM m GROUP BY 1, 2)
SELECT token, NULL AS error, CAST(count(*) + 1 AS INTEGER) AS children, CAST(least(12, count(*)) AS INTEGER) AS children_read, '2025-01-' || lpad(CAST(max(part) FILTER (k <= 12) + 1 AS VARCHAR), 2, '0') AS lastmod, CAST(sum(n) FILTER (k <= 12) AS BIGINT) AS n_postings FROM c GROUP BY 1""")
def sitemap_headers(spark: SparkSession, d: str) -> DataFrame:
    """What each board's sitemaps amount to, with the latest change of its jobs."""
    return boards.sitemap_boards(sitemap_files(spark, d))[1]


PLAIN = "trim(regexp_replace(regexp_replace(coalesce(title, ''), '[^A-Za-z ]', '', 'g'), ' +', ' ', 'g'))"


@query(f"SELECT DISTINCT token, CAST(ordinal AS VARCHAR) AS job_id, {PLAIN} AS title, 'Oslo, NO' AS location, 'https://f.example/' || ordinal AS url FROM postings")
def feed_postings(spark: SparkSession, d: str) -> DataFrame:
    """Postings of job feeds, the place in brackets after the title."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce("title", F.lit("")), "[^A-Za-z ]", ""), " +", " "))
    item = F.concat(F.lit("<item><g:id>"), C("ordinal"), F.lit("</g:id><title><![CDATA["), plain, F.lit(" (Oslo, NO)]]></title><link>https://f.example/"), C("ordinal"), F.lit("</link></item>"))
    rows = table(spark, d, "postings").select("token", "ordinal", item.alias("x")).distinct()
    files = rows.groupBy("token", F.floor(C("ordinal") / PAGE).alias("page")).agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list("x"), ""), F.lit("</channel></rss>")).alias("payload"))
    return payloads.sitemap(files).select("token", "job_id", "title", "location", "url")


GUID = "'00000000-0000-4000-8000-' || lpad(CAST(company_id AS VARCHAR), 12, '0')"


@query(f"""SELECT company_id, CASE WHEN name IS NULL OR domain IS NULL THEN NULL ELSE {GUID} END AS guid, CASE WHEN name IS NULL THEN 'shell_not_text' WHEN domain IS NULL THEN 'no_board_guid' WHEN segment IS NULL THEN 'jobs_unreadable' END AS error,
CASE WHEN name IS NULL OR domain IS NULL OR segment IS NULL THEN NULL WHEN hq_city IS NULL THEN CAST(company_id AS VARCHAR) ELSE 'default' END AS portal FROM companies""")
def shell_boards(spark: SparkSession, d: str) -> DataFrame:
    """Boards whose page names the id that their jobs are asked for by: the employers, as if each had such a page."""
    firms = table(spark, d, "companies")
    guid = F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(C("company_id").cast("string"), 12, "0"))
    shell = F.when(C("name").isNotNull(), F.when(C("domain").isNull(), F.lit("<html>nothing</html>")).otherwise(F.concat(F.lit("<script src='/ats/documents/"), guid, F.lit("/x.js'></script>"))))
    shells = firms.select(C("company_id").cast("string").alias("token"), shell.alias("payload"))
    token = C("company_id").cast("string")
    full, empty = F.lit('[{"id": 1}]'), F.lit("[]")
    given = firms.where("segment IS NOT NULL").select(token.alias("token"), guid.alias("guid"), F.explode(F.array(F.struct(F.lit("default").alias("portal"), F.when(C("hq_city").isNull(), empty).otherwise(full).alias("payload")), F.struct(token.alias("portal"), full.alias("payload")))).alias("a")).select("token", "guid", "a.*")
    return boards.keka_boards(shells, given)[1].select(C("token").cast("bigint").alias("company_id"), "guid", "error", "portal")


@query("""SELECT DISTINCT token, coalesce(job_id, '') AS job_id, coalesce(title, '') AS title, coalesce(nullif(location, ''), '') AS location, strftime(make_timestamp(ordinal * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS posted_on, platform AS department FROM postings""")
def endpoint_postings(spark: SparkSession, d: str) -> DataFrame:
    """Postings of boards that one of two endpoints answers: here the one that wraps its list, the other refusing."""
    item = F.struct(C("job_id").alias("atsJobId"), C("title").alias("name"), F.array("location").alias("standardizedLocations"), C("ordinal").alias("creationTs"), C("platform").alias("department"))
    rows = postings(spark, d).groupBy("token", F.floor(C("ordinal") / PAGE).alias("part")).agg(F.to_json(F.struct(F.struct(F.collect_list(item).alias("positions")).alias("data"))).alias("payload"))
    rows = rows.select("token", F.lit("pcsx").alias("endpoint"), F.row_number().over(W.partitionBy("token").orderBy("part")).alias("page"), "payload")
    refused = rows.select("token", F.lit("apply").alias("endpoint"), "page", F.lit('{"message": "not authorized"}').alias("payload"))
    return boards.eightfold_boards(rows.unionByName(refused))[0].select("token", "job_id", "title", "location", "posted_on", "department").distinct()


@query("""WITH a AS (SELECT user_id, date_trunc('hour', ts) AS hour, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts, event_id) AS attempt, CASE event_type WHEN 'error' THEN 503 WHEN 'view' THEN 200 WHEN 'signup' THEN 429 WHEN 'purchase' THEN 404 END AS status, value > 5 AS good FROM events),
t AS (SELECT *, status IS NULL OR status = 503 AS again FROM a WHERE attempt <= 3), e AS (SELECT user_id, hour, coalesce(min(attempt) FILTER (NOT again), max(attempt)) AS attempt FROM t GROUP BY 1, 2)
SELECT user_id, hour, CAST(attempt AS INTEGER) AS attempts, status, CASE WHEN status IS NULL THEN 'network_error' WHEN status = 429 THEN 'rate_limited_429' WHEN status <> 200 THEN 'http_' || status WHEN NOT coalesce(good, false) THEN 'non_json_response' END AS error FROM e JOIN t USING (user_id, hour, attempt)""")
def request_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Events as attempts at one request an hour: what each request came to."""
    status = F.when(C("event_type") == "error", 503).when(C("event_type") == "view", 200).when(C("event_type") == "signup", 429).when(C("event_type") == "purchase", 404)
    rows = table(spark, d, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    rows = rows.select("user_id", "hour", F.row_number().over(W.partitionBy("user_id", "hour").orderBy("ts", "event_id")).alias("attempt"), status.alias("status"), (C("value") > 5).alias("good"))
    return crawl.settled(rows, ["user_id", "hour"], "attempt", "status", "good")


NOW = 1_760_000_000


def recorded(sql_outcome: str) -> str:
    return f"""WITH r AS (SELECT sha256(url) AS digest, epoch(collected_at) AS seen, title FROM documents WHERE url IS NOT NULL AND collected_at IS NOT NULL AND title IS NOT NULL), l AS (SELECT digest, max((seen, title)) AS m FROM r GROUP BY 1),
q AS (SELECT DISTINCT sha256(url) AS digest FROM documents WHERE url IS NOT NULL), o AS (SELECT q.digest, m[2] AS title, m[1] AS seen FROM q LEFT JOIN l USING (digest))
SELECT digest, {sql_outcome} AS outcome, CASE WHEN outcome = 'hit' THEN sha256(title) END AS digest_text, sha256(title) AS previous_hash FROM o"""


def from_records(spark: SparkSession, d: str, **how: object) -> DataFrame:
    docs = table(spark, d, "documents").where("url IS NOT NULL")
    record = F.when(C("title").isNull(), F.lit("{broken")).otherwise(F.to_json(F.struct(F.lit(200).alias("status"), C("title").alias("text"))))
    held = docs.where("collected_at IS NOT NULL").select(F.sha2("url", 256).alias("digest"), (F.unix_micros(C("collected_at").cast("timestamp")) / F.lit(1e6)).alias("fetched_at"), record.alias("record"))
    got = stores.recorded(docs.select(F.sha2("url", 256).alias("digest")).distinct(), held, float(NOW), **how)
    return got.select("digest", "outcome", F.sha2("text", 256).alias("digest_text"), "previous_hash")


@query(recorded(f"CASE WHEN seen IS NULL THEN 'miss' WHEN {NOW} - seen <= 2592000 THEN 'hit' ELSE 'stale' END"))
def recorded_answers(spark: SparkSession, d: str) -> DataFrame:
    """Recorded answers no older than thirty days; a broken record is none."""
    return from_records(spark, d, max_age=2_592_000.0)


@query(recorded("CASE WHEN seen IS NULL THEN 'miss' ELSE 'hit' END"))
def recorded_offline(spark: SparkSession, d: str) -> DataFrame:
    """The same without a network: age plays no part."""
    return from_records(spark, d, offline=True)


LINE = "coalesce(name, '') || CASE WHEN domain IS NULL THEN '' ELSE ',' || domain END || CASE WHEN domain IS NULL OR segment IS NULL THEN '' ELSE ', ' || segment END"


@query(f"""WITH l AS (SELECT trim({LINE}) AS v FROM companies), f AS (SELECT list_transform(string_split(v, ','), lambda x: trim(x)) AS f FROM l WHERE v <> '' AND NOT starts_with(v, '#'))
SELECT f[1] AS name, f[2] AS domain, coalesce(nullif(f[3], ''), 'unsorted') AS segment FROM f WHERE len(f) >= 2""")
def company_list(spark: SparkSession, d: str) -> DataFrame:
    """Employers read from text lines of name, domain and segment."""
    line = F.concat(F.coalesce("name", F.lit("")), F.coalesce(F.concat(F.lit(","), C("domain")), F.lit("")), F.when(C("domain").isNotNull(), F.coalesce(F.concat(F.lit(", "), C("segment")), F.lit(""))).otherwise(""))
    return stores.company_lines(table(spark, d, "companies").select(line.alias("value")))


@query("SELECT DISTINCT url FROM documents WHERE title IS NOT NULL AND url <> ''")
def index_lines(spark: SparkSession, d: str) -> DataFrame:
    """Addresses of an index's lines, those of documents without title being broken."""
    line = F.when(C("title").isNull(), F.concat(F.lit('{"url": '), C("url"))).otherwise(F.to_json(F.struct("url", "title")))
    return discovery.index_addresses(table(spark, d, "documents").where("url IS NOT NULL").select(line.alias("value")))


HOST, TOP = "lower(regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)', 1))", "lower(regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+/+([^/?#]*)', 1))"


@query(f"""WITH u AS (SELECT DISTINCT url, {HOST} AS h, {TOP} AS t, string_split({HOST}, '.') AS l FROM postings WHERE url IS NOT NULL)
SELECT url, CASE WHEN regexp_full_match(t, '[a-z0-9][a-z0-9._-]{{1,60}}') AND t NOT IN ('api', 'embed', 'assets', 'static', 'jobs', 'careers', 'search', 'login', 'robots.txt', 'favicon.ico', 'sitemap.xml') AND NOT regexp_full_match(t, '[0-9]{{5,}}') THEN t END AS in_path,
CASE WHEN len(l) >= 3 AND l[1] NOT IN ('www', 'api', 'jobs', 'careers', 'boards') THEN l[1] END AS in_host,
CASE WHEN regexp_matches(h, '^[^.]+\\.wd[0-9]+\\.') THEN h || '|' || l[1] || '|' || regexp_extract(trim(url), '://[^/]+/(?:[a-z]{{2}}-[A-Z]{{2}}/)?([^/?#]+)', 1) END AS workday FROM u""")
def address_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Tokens that addresses give by their path, by their host, and in three parts."""
    rows = table(spark, d, "postings").where("url IS NOT NULL").select("url").distinct()
    return rows.select("url", U.token_in_path(C("url")).alias("in_path"), U.token_in_host(C("url")).alias("in_host"), U.workday_token(C("url")).alias("workday"))


@query(r"""WITH u AS (SELECT DISTINCT url, lower(regexp_extract(trim(url), '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)', 1)) AS h FROM postings WHERE url IS NOT NULL), x AS (SELECT *, regexp_extract(url, '((?:[A-Za-z0-9-]+\.)+workboards\.example)/(?:[a-z]{2}-[A-Z]{2}/)?([A-Za-z0-9_-]+)', ['h', 's']) AS w, regexp_extract(url, '//boards\.greenhouse\.example/([A-Za-z0-9_-]+)', 1) AS g, regexp_extract(url, '([A-Za-z0-9_-]+)\.hire\.example(?:[^A-Za-z0-9.-]|$)', 1) AS e FROM u)
SELECT url, CASE WHEN w.h <> '' THEN 'workday' WHEN g <> '' THEN 'greenhouse' WHEN e <> '' THEN 'eightfold' END AS platform, CASE WHEN w.h <> '' THEN lower(w.h) || '|' || lower(split_part(w.h, '.', 1)) || '|' || w.s WHEN g <> '' THEN g WHEN e <> '' THEN e END AS token FROM x""")
def platforms_in_markup(spark: SparkSession, d: str) -> DataFrame:
    """Platforms and boards that a link to each posting names."""
    rows = table(spark, d, "postings").where("url IS NOT NULL").select("url").distinct()
    p = discovery.platforms_named(F.concat(F.lit("<a href='"), C("url"), F.lit("'>")), hosts=INVENTED)
    return rows.withColumn("p", p).select("url", "p.platform", "p.token")


@query(f"""WITH p AS (SELECT token, ordinal // {PAGE} AS page, ordinal, min(trim(url)) AS url, max(coalesce(quality, 0)) AS quality FROM postings WHERE regexp_matches(url, '^https?://[^/?#]+/[^#"'']*$') GROUP BY ALL), b AS (SELECT token, page, {HOST.replace('trim(url)', 'arg_min(url, ordinal)')} AS own FROM p GROUP BY 1, 2),
o AS (SELECT p.*, row_number() OVER (PARTITION BY token, page ORDER BY ordinal) - 1 AS pos FROM p), s AS (SELECT token, page, url AS link, min(pos) AS pos, max(CASE WHEN quality >= 50 THEN 2 ELSE 0 END + CASE WHEN regexp_matches(url, '(?i)^[a-z]+://[^/]+.*\\b(careers?|jobs?|openings?|vacanc(?:y|ies)|opportunit(?:y|ies)|hiring)\\b') AND regexp_matches(regexp_replace(url, '^[a-z]+://[^/]+', ''), '(?i)\\b(careers?|jobs?|openings?|hiring)\\b') THEN 1 ELSE 0 END) AS score
 FROM o JOIN b USING (token, page) WHERE {HOST} = own GROUP BY ALL)
SELECT token, page, row_number() OVER (PARTITION BY token, page ORDER BY score DESC, pos) AS rank, link, score FROM s WHERE score > 0 QUALIFY rank <= 3""")
def careers_links(spark: SparkSession, d: str) -> DataFrame:
    """The three links most worth following of pages made of a board's postings, {PAGE} to a page."""
    rows = table(spark, d, "postings").where(C("url").rlike(r"^https?://[^/?#]+/[^#\"']*$")).groupBy("token", F.floor(C("ordinal") / PAGE).alias("page"), "ordinal").agg(F.min(F.trim("url")).alias("url"), F.max(F.coalesce("quality", F.lit(0))).alias("quality"))
    link = F.concat(F.lit('<a href="'), C("url"), F.lit('">'), F.when(C("quality") >= 50, "Careers").otherwise("See"), F.lit("</a>"))
    made = rows.groupBy("token", "page").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", link.alias("a")))), lambda x: x["a"]), "\n").alias("html"), F.min_by("url", "ordinal").alias("base"))
    got = discovery.candidate_links(made.withColumn("k", F.struct("token", "page")), "k", "html", "base")
    return got.select("k.token", "k.page", "rank", "link", "score")


BLANKS = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINES = f"list_filter(list_transform(string_split({decoded('''regexp_replace(regexp_replace(description, '(?i)</?(?:''' + '|'.join(X.LINED) + ''')\\b[^>]*>', chr(10), 'g'), '<[^>]+>', ' ', 'g')''')}, chr(10)), lambda x: trim(regexp_replace(x, '{BLANKS}+', ' ', 'g'))), lambda x: x <> '')"
IDLE = ", ".join(f"'{a}{b}'" for a, more in X.IDLE.items() for b in more)


@query(f"""WITH l AS (SELECT DISTINCT ordinal, {LINES} AS l FROM postings WHERE description IS NOT NULL), s AS (SELECT ordinal, array_to_string(l, chr(10)) AS v, array_to_string(list_filter(l, lambda x: NOT (lower(x) IN ({IDLE}) OR starts_with(lower(x), '{X.IDLE_LEAD}'))), chr(10)) AS s FROM l)
SELECT ordinal, sha256(v) AS visible, length(v)::INTEGER AS chars, sha256(trim(regexp_replace(regexp_replace(s, '{X.volatile()}', '', 'g'), '{BLANKS}+', ' ', 'g'))) AS content_hash FROM s""")
def stable_texts(spark: SparkSession, d: str) -> DataFrame:
    """Descriptions as a reader sees them, and the hash of what stays the same between fetches."""
    rows = table(spark, d, "postings").where("description IS NOT NULL").select("ordinal", "description").distinct()
    seen = X.visible_text(C("description"))
    return rows.select("ordinal", F.sha2(seen, 256).alias("visible"), F.length(seen).alias("chars"), X.content_hash(C("description")).alias("content_hash")).distinct()


ROBOTS = "# rules\\nUser-agent: *\\nDisallow: /\\nAllow: /careers\\n\\nUser-agent: other\\nUser-agent: TideBot\\nDisallow: /forum\\nDisallow:\\nDisallow: /*/1*9$\\nAllow: /forum-post/a\\nCrawl-delay: 4\\n".encode().decode("unicode_escape")


@query(f"""WITH d AS (SELECT DISTINCT {HOST} AS h, lower(regexp_extract(trim(url), '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)', 1)) AS origin, regexp_extract(trim(url), '^[a-zA-Z]+://[^/?#]+([^#]*)', 1) AS p FROM documents WHERE url IS NOT NULL),
s AS (SELECT origin, CASE WHEN p = '' THEN '/' WHEN starts_with(p, '/') THEN p ELSE '/' || p END AS path, CASE length(h) % 3 WHEN 0 THEN 200 WHEN 1 THEN 404 ELSE 503 END AS status FROM d),
a AS (SELECT *, CASE status WHEN 404 THEN true WHEN 503 THEN false ELSE starts_with(path, '/forum-post/a') OR NOT (starts_with(path, '/forum') OR regexp_matches(path, '^/.*/1.*9$')) END AS allowed FROM s)
SELECT origin, path, allowed, CASE WHEN allowed THEN NULL WHEN status = 503 THEN 'robots_unreachable_503' ELSE 'robots_disallow' END AS reason FROM a""")
def robots_files(spark: SparkSession, d: str) -> DataFrame:
    """Documents' addresses against their hosts' robots files: parsed, absent or out of reach."""
    docs = table(spark, d, "documents").where("url IS NOT NULL").select(U.origin(C("url")).alias("origin"), U.host(C("url")).alias("h"), U.path(C("url")).alias("path")).distinct()
    kind = F.length("h") % 3
    files = docs.select("origin", F.when(kind == 0, 200).when(kind == 1, 404).otherwise(503).alias("status")).distinct().withColumn("text", F.when(C("status") == 200, F.lit(ROBOTS)))
    got = crawl.allowed(docs.select("origin", "path"), crawl.robots_rules(files), "tidebot").join(files.select("origin", "status"), "origin")
    return got.select("origin", "path", "allowed", crawl.why_denied(C("allowed"), C("status")).alias("reason"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 1.0 ELSE greatest(1.0, least(value, 10.0)) END AS delay FROM events")
def crawl_delays(spark: SparkSession, d: str) -> DataFrame:
    """The pause that each value asks for between requests; none asked for is the usual one."""
    return table(spark, d, "events").select("event_id", crawl.crawl_delay(F.when(C("event_type") != "error", C("value"))).alias("delay"))


@query("""WITH o AS (SELECT DISTINCT user_id AS origin FROM events), k AS (SELECT user_id AS origin, max(ts) AS seen FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT o.origin, seen IS NULL OR TIMESTAMP '2024-01-30' >= seen + INTERVAL 6 HOUR AS due FROM o LEFT JOIN k USING (origin)""")
def robots_due(spark: SparkSession, d: str) -> DataFrame:
    """Sources whose rules, read at their views, must be read again."""
    events = table(spark, d, "events")
    known = events.where("event_type = 'view'").select(C("user_id").alias("origin"), C("ts").alias("fetched_at"))
    return crawl.rules_due(events.select(C("user_id").alias("origin")).distinct(), known, F.lit("2024-01-30").cast("timestamp_ntz"))


@query("""WITH p AS (SELECT user_id AS host, max(epoch(ts) + greatest(900.0, value * 1000)) AS until FROM events WHERE event_type = 'error' AND epoch(ts) <= 1706000000 GROUP BY 1) SELECT host, until, until - 1706000000.0 AS left FROM p WHERE until > 1706000000""".replace(" AS left", ' AS "left"'))
def penalty_hosts(spark: SparkSession, d: str) -> DataFrame:
    """Sources that errors keep alone at a fixed time."""
    rows = table(spark, d, "events").withColumn("s", F.unix_micros(C("ts").cast("timestamp")) / F.lit(1e6))
    return crawl.penalty_report(rows, "user_id", "s", C("event_type") == "error", C("value") * 1000, 1706000000.0)


@query(f"""WITH d AS (SELECT {HOST} AS host, text FROM documents WHERE url IS NOT NULL) SELECT host, count(*) AS answers, CAST(sum(octet_length(encode(text))) AS BIGINT) AS bytes FROM d GROUP BY GROUPING SETS ((host), ())""")
def answers_held(spark: SparkSession, d: str) -> DataFrame:
    """Recorded documents and their bytes per host and in all."""
    return stores.usage(table(spark, d, "documents").where("url IS NOT NULL").select(U.host(C("url")).alias("host"), "text"), "host", "text")


@query("""WITH s AS (SELECT c_custkey AS user_id FROM customer), h AS (SELECT user_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS total_ever, CAST(sum(CASE WHEN event_type = 'purchase' AND ts > TIMESTAMP '2024-01-31' - INTERVAL 7 DAY THEN 1 ELSE 0 END) AS BIGINT) AS recent, count(*) AS sweeps, max(ts) AS last_swept FROM events GROUP BY 1),
j AS (SELECT user_id, coalesce(total_ever, 0) AS total_ever, coalesce(recent, 0) AS recent, coalesce(sweeps, 0) AS sweeps, last_swept FROM s LEFT JOIN h USING (user_id)), t AS (SELECT *, CASE WHEN recent > 0 THEN 'hot' WHEN total_ever > 0 THEN 'warm' ELSE 'cold' END AS tier FROM j)
SELECT user_id, total_ever, recent, sweeps, tier, last_swept IS NULL OR TIMESTAMP '2024-01-31' >= last_swept + CASE tier WHEN 'hot' THEN INTERVAL 6 HOUR WHEN 'warm' THEN INTERVAL 24 HOUR ELSE INTERVAL 168 HOUR END AS due FROM t""")
def sources_due(spark: SparkSession, d: str) -> DataFrame:
    """Customers as sources of events, with or without a history: their tier and whether they are due."""
    every = table(spark, d, "customer").select(C("c_custkey").alias("user_id"))
    got = tiers.due_boards(every, tiered(spark, d), ["user_id"], F.lit("2024-01-31").cast("timestamp_ntz"))
    return got.select("user_id", "total_ever", "recent", "sweeps", "tier", "due")


@query("""WITH l AS (SELECT DISTINCT run_id, lane, run_no FROM runs), m AS (SELECT lane, max(run_no) AS last FROM l GROUP BY 1), p AS (SELECT lane, platform, token, upper(trim(job_id)) AS job_id, run_no, min((ordinal, title)) AS t FROM postings JOIN l USING (run_id) WHERE trim(job_id) <> '' GROUP BY ALL),
a AS (SELECT lane, platform, token, job_id, sha256(t[2]) AS digest FROM p JOIN m USING (lane) WHERE run_no = last), b AS (SELECT lane, platform, token, job_id, sha256(t[2]) AS old FROM p JOIN m USING (lane) WHERE run_no = last - 1)
SELECT lane, platform, token, job_id, CASE WHEN digest IS NULL THEN 'failed' WHEN b.job_id IS NULL THEN 'new' WHEN digest IS NOT DISTINCT FROM old THEN 'unchanged' ELSE 'changed' END AS outcome FROM a LEFT JOIN b USING (lane, platform, token, job_id)""")
def page_gate(spark: SparkSession, d: str) -> DataFrame:
    """Jobs of each lane's last run against the state that the run before it left."""
    lanes = table(spark, d, "runs").select("run_id", "lane", "run_no").distinct()
    last = lanes.groupBy("lane").agg(F.max("run_no").alias("last"))
    rows = table(spark, d, "postings").select("run_id", *BOARD, job().alias("job_id"), "ordinal", "title").where("job_id IS NOT NULL").join(F.broadcast(lanes.join(last, "lane")), "run_id")
    keys = ["lane", *BOARD, "job_id"]
    one = rows.where(C("run_no") >= C("last") - 1).groupBy(*keys, "run_no", "last").agg(F.min(F.struct("ordinal", "title")).alias("t")).select(F.struct(*keys).alias("key"), "run_no", "last", F.sha2("t.title", 256).alias("digest"))
    got = pages.gate(one.where("run_no = last").select("key", "digest"), one.where("run_no = last - 1").select("key", "digest"), "key", "digest")
    return got.select("key.*", "outcome")


@query("SELECT o_orderkey, [CAST(year(o_orderdate) AS INTEGER), CAST(year(o_orderdate) + 1 AS INTEGER), CAST(year(o_orderdate) + 2 AS INTEGER), 2030] AS years, ['\"' || o_orderpriority || '\"', '[' || o_custkey || ', true]'] AS found FROM orders")
def nested_answers(spark: SparkSession, d: str) -> DataFrame:
    """Years and values found at any depth of JSON texts made of the orders."""
    y = F.year("o_orderdate").cast("string")
    text = F.concat(F.lit('{"a": {"Batch": ['), y, F.lit(', "'), y, F.lit(" - "), (F.year("o_orderdate") + 2).cast("string"), F.lit('", "all", true], "who": "'), C("o_orderpriority"), F.lit('"}, "b": [{"batch": "in 2030"}, {"WHO": ['), C("o_custkey"), F.lit(", true]}]}"))
    return table(spark, d, "orders").select("o_orderkey", N.nested_years(text, "batch").alias("years"), N.nested_values(text, "who").alias("found"))


@query(r"""SELECT doc_id, nullif(regexp_extract(text, '[Dd]egree\s+in\s+\S+', 0), '') AS quote, CASE WHEN regexp_matches(text, '[Dd]egree\s+in\s+\S+') THEN CAST(strpos(text, regexp_extract(text, '[Dd]egree\s+in\s+\S+', 0)) - 1 AS INTEGER) END AS "start" FROM documents""")
def source_quotes(spark: SparkSession, d: str) -> DataFrame:
    """What documents say of a degree, quoted as they have it, and where."""
    q = N.source_quote(C("text"), r"[Dd]egree in \S+", most=10_000)
    return table(spark, d, "documents").withColumn("q", q).select("doc_id", "q.quote", "q.start")


FOUND = "SELECT name AS company, segment, lower(ats) AS platform, domain AS token, hq_city IS NOT NULL AS readable, CASE WHEN domain IS NULL THEN 'unreachable' WHEN hq_city IS NULL THEN 're_resolve' WHEN ats IS NULL THEN 'page' ELSE 'board' END AS mechanism FROM companies"


@query(f"SELECT 'registry' AS part, company, platform, token, row_number() OVER (ORDER BY mechanism NULLS LAST, segment NULLS LAST, company NULLS LAST, token, platform) AS place FROM ({FOUND}) WHERE platform <> '' AND token <> '' AND readable UNION ALL SELECT 'pages', company, platform, token, NULL FROM ({FOUND}) WHERE mechanism <> 'board'")
def registry_rewrite(spark: SparkSession, d: str) -> DataFrame:
    """What a resolution of the employers leaves: the registry in its order, and the pages to read."""
    mechanism = F.when(C("domain").isNull(), "unreachable").when(C("hq_city").isNull(), "re_resolve").when(C("ats").isNull(), "page").otherwise("board")
    found = table(spark, d, "companies").select(C("name").alias("company"), "segment", F.lower("ats").alias("platform"), C("domain").alias("token"), C("hq_city").isNotNull().alias("readable"), C("domain").alias("careers_url"), mechanism.alias("mechanism"), F.lit("list").alias("source"), F.lit("").alias("evidence"))
    registry, targets = stores.registry_of(found)
    place = F.row_number().over(W.orderBy(*[C(c).asc_nulls_last() for c in ("segment", "company")], "token", "platform"))  # all of the mechanism 'board'; as many rows as there are boards
    return registry.select(F.lit("registry").alias("part"), "company", "platform", "token", place.cast("bigint").alias("place")).unionByName(targets.select(F.lit("pages").alias("part"), "company", "platform", "token", F.lit(None).cast("bigint").alias("place")))


@query("SELECT segment, ats, count(*) AS n, count(DISTINCT domain) AS domains FROM companies GROUP BY ROLLUP (segment, ats)")
def segment_totals(spark: SparkSession, d: str) -> DataFrame:
    """Employers by segment and platform, with totals."""
    return table(spark, d, "companies").rollup("segment", "ats").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("domain").alias("domains"))


@query("""WITH d AS (SELECT doc_id, coalesce(token, '') AS company, url, title, source, lang, text FROM documents WHERE url IS NOT NULL), o AS (SELECT *, CASE WHEN lang = 'xx' THEN 'robots_blocked' WHEN source IS NULL THEN 'fetch_failed' WHEN starts_with(source, 'careers') THEN 'unchanged_skipped' WHEN title IS NULL THEN 'extraction_failed' ELSE 'extracted' END AS outcome FROM d)
SELECT outcome, count(*) AS n FROM o GROUP BY 1""")
def page_run(spark: SparkSession, d: str) -> DataFrame:
    """One run over the documents as careers pages: what it came to."""
    run = page_reading(spark, d)
    return run.outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def page_reading(spark: SparkSession, d: str):
    docs = table(spark, d, "documents").where("url IS NOT NULL").select(F.concat("url", F.lit("?d="), C("doc_id")).alias("url"), F.coalesce("token", F.lit("")).alias("company"), "title", "source", "lang", "text")
    fetched = docs.select("url", F.lit(200).alias("status"), F.when(C("source").isNotNull(), F.concat(F.lit("<p>"), C("text"), F.lit("</p>"))).alias("html"), F.when(C("lang") == "xx", "robots_disallow").alias("denied"), F.lit(False).alias("paused"))
    state = fetched.join(docs.where(C("source").startswith("careers")).select("url"), "url", "left_semi").select("url", X.content_hash(C("html")).alias("content_hash"), F.lit("2025-01-01").alias("last_fetched"), F.lit("2025-01-01").alias("last_extracted"), F.lit(2).alias("last_role_count"))
    role = F.struct(C("title"), F.substring("text", 1, 60).alias("quote"))
    said = docs.where("title IS NOT NULL").select(X.short_key(C("url")).alias("key"), F.to_json(F.struct(F.array(role, F.struct(C("title"), F.lit("words that stand nowhere at all").alias("quote"))).alias("roles"))).alias("payload"))
    return read_pages(docs.select("company", "url"), fetched, state, said, F.lit("2025-02-01"))


@query("""WITH u AS (SELECT min(ordinal) AS ordinal, url FROM postings WHERE url IS NOT NULL AND trim(url) = url GROUP BY url), p AS (SELECT DISTINCT ordinal, title, location FROM postings), r AS (SELECT u.url, max((p.title IS NOT NULL, p.title)) AS t FROM u JOIN p USING (ordinal) GROUP BY 1)
SELECT url, CASE WHEN coalesce(trim(t[2]), '') = '' THEN 'error' ELSE 'ok' END AS state, trim(regexp_replace(coalesce(t[2], ''), '\\s+', ' ', 'g')) AS title, CASE WHEN coalesce(trim(t[2]), '') = '' THEN false ELSE true END AS is_live FROM r""".replace("\\\\", "\\"))
def single_records(spark: SparkSession, d: str) -> DataFrame:
    """One record for each address of a posting, from an answer about that job alone."""
    rows = table(spark, d, "postings").where("url IS NOT NULL AND trim(url) = url")
    first = rows.groupBy("url").agg(F.min("ordinal").alias("ordinal"))
    said = rows.select("url", "ordinal", "title").join(first, ["url", "ordinal"]).groupBy("url").agg(F.max(F.struct(C("title").isNotNull().alias("k"), "title")).alias("t"))
    given = said.where(F.trim(F.coalesce("t.title", F.lit(""))) != "").select("url", F.to_json(F.struct(F.struct(C("t.title").alias("title")).alias("job"))).alias("payload"))
    none = spark.createDataFrame([], "url string, why string, title string, location string, description string, posted_on string, board string, status int, html string, error string")
    got = single.read_urls(rows.select("url"), none, given, none, none, INVENTED)
    return got.select("url", "state", "record.title", "record.is_live")


@query("""WITH p AS (SELECT DISTINCT platform, token, url, ordinal, job_id, title FROM postings WHERE url IS NOT NULL), w AS (SELECT DISTINCT platform, token, url FROM p), i AS (SELECT platform, token, job_id, min(ordinal) AS o FROM p WHERE job_id IS NOT NULL GROUP BY ALL), a AS (SELECT platform, token, rtrim(url, '/') AS u, min(ordinal) AS o FROM p GROUP BY ALL)
SELECT w.url, w.platform, w.token, least(i.o, a.o) AS found_ordinal FROM w LEFT JOIN i ON i.platform = w.platform AND i.token = w.token AND i.job_id = regexp_extract(regexp_replace(regexp_replace(w.url, '[?#].*$', ''), '/+$', ''), '([^/]+)$', 1) LEFT JOIN a ON a.platform = w.platform AND a.token = w.token AND a.u = rtrim(w.url, '/')""")
def board_matches(spark: SparkSession, d: str) -> DataFrame:
    """The posting of its board that each address names, by id or by address."""
    rows = table(spark, d, "postings").where("url IS NOT NULL").select(*BOARD, "url", "ordinal", "job_id", "title").distinct()
    got = single.board_match(rows.select("url", *BOARD), rows, BOARD, "ordinal")
    return got.select("url", *BOARD, "found_ordinal")


API_SQL = r"""WITH u AS (SELECT DISTINCT url, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS h, list_filter(string_split(regexp_replace(regexp_replace(url, '^https?://[^/?#]+', ''), '[?#].*$', ''), '/'), lambda x: x <> '') AS p FROM postings WHERE url IS NOT NULL AND trim(url) = url)
SELECT url, CASE WHEN h = 'boards.greenhouse.example' AND list_position(p, 'jobs') > 1 AND list_position(p, 'jobs') < len(p) THEN 'https://boards-api.greenhouse.io/v1/boards/' || p[list_position(p, 'jobs') - 1] || '/jobs/' || p[list_position(p, 'jobs') + 1] || '?content=true' WHEN h = 'boards.lever.example' AND len(p) >= 2 THEN 'https://api.lever.co/v0/postings/' || p[len(p)] || '?mode=json'
 WHEN h = 'boards.ashby.example' AND len(p) >= 2 THEN 'https://api.ashbyhq.com/posting-api/job-board/' || p[1] WHEN h = 'boards.smartrecruiters.example' AND len(p) >= 2 THEN 'https://api.smartrecruiters.com/v1/companies/' || p[1] || '/postings/' || p[len(p)] WHEN ends_with(h, '.workboards.example') AND len(p) > 0 THEN 'https://' || h || '/wday/cxs/' || split_part(h, '.', 1) || '/' || p[1] || '/jobs' END AS api,
CASE WHEN ends_with(h, '.workboards.example') AND len(p) > 0 THEN '{"appliedFacets":{},"limit":20,"offset":0,"searchText":"' || p[len(p)] || '"}' END AS body FROM u"""


@query(API_SQL)
def api_targets(spark: SparkSession, d: str) -> DataFrame:
    """Where platforms' own interfaces give each posting."""
    rows = table(spark, d, "postings").where("url IS NOT NULL AND trim(url) = url").select("url").distinct()
    return rows.withColumn("t", single.api_target(C("url"), INVENTED)).select("url", "t.api", "t.body")


@query(f"""WITH u AS (SELECT DISTINCT url, {HOST} AS h FROM documents WHERE url IS NOT NULL) SELECT url, CASE WHEN contains(h, 'careers') AND contains(regexp_replace(lower(url), '[?#].*$', ''), '/job/') THEN 'trusted' ELSE 'low_trust' END AS trust,
[CASE WHEN contains(h, 'careers') AND contains(regexp_replace(lower(url), '[?#].*$', ''), '/job/') THEN 'known_public_ats_or_company_job_domain' ELSE 'unrecognised_source_domain_' || h END] AS reasons FROM u""")
def address_trust(spark: SparkSession, d: str) -> DataFrame:
    """How far documents' addresses are trusted, and why."""
    rows = table(spark, d, "documents").where("url IS NOT NULL").select("url").distinct()
    return rows.select("url", U.trust(C("url")).alias("trust"), U.trust_reasons(C("url")).alias("reasons"))
