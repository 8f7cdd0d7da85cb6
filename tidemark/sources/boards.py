"""Boards that take more than one answer: paged reads, sitemaps of sitemaps, shells that name a board, two endpoints.

Each operator takes captured answers and gives rows that ``payloads`` can parse, and a row per board with the
named error of what is missing. A board with an error is never taken as complete.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.text import truthy
from tidemark.sources.payloads import PLATFORMS, sitemap, xml_text

# Platforms whose pages only a page reader can read, with the error that says so; and those whose robots files forbid reading.
PAGE_READER_ONLY = {"zohorecruit": "zoho_recruit_portal_is_js_only_needs_page_reader", "darwinbox": "darwinbox_careers_is_js_only_needs_page_reader"}
ROBOTS_FORBIDDEN = ("smartrecruiters",)
PAGED = ("unstop", "successfactors")  # read by this module, not by one answer's schema
CHILDREN = 12  # child sitemaps that are read


def dispatch(platform: Column, ignore_robots: bool = False) -> Column:
    """Why a board isn't read at all, null if it is: the error its row carries."""
    known = F.coalesce(platform.isin([*PLATFORMS, *PAGED, *PAGE_READER_ONLY]), F.lit(False))
    out = F.when(~known, "unsupported_platform")
    if not ignore_robots:
        out = out.when(platform.isin(*ROBOTS_FORBIDDEN), "platform_robots_disallowed")
    for name, error in PAGE_READER_ONLY.items():
        out = out.when(platform == name, error)
    return out


def paged_reads(pages: DataFrame, by: list[str], page: str, rows: str, total: str, echo: str | None = None, last: str | None = None) -> DataFrame:
    """Whether the pages of each board make a whole: ``by``, ``n_postings``, ``reported_total``, ``pages``, ``error``.

    ``pages`` has a row per answer: the page asked for (1, 2, ...), its number of rows (null if it had no
    list), the total it reports, the page it says it is (``echo``) and the last page it names. The first
    page that is wrong stops the read and names the error; the rows of the pages before it count and stand in
    the name as '_partial_at_N' where there are any. Errors: 'unexpected_shape', 'pagination_unconfirmed' (no
    total, or another page than asked for), 'pagination_changed', 'total_underreported', 'empty_page',
    'page_missing' and, if all pages are well but the rows don't reach the total, 'short_page'.
    """
    w = W.partitionBy(*by).orderBy(page)
    n, t = F.coalesce(F.col(rows), F.lit(0)), F.col(total)
    told = pages.withColumns({
        "__tm_before": F.coalesce(F.sum(n).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)), "__tm_first": F.first(t).over(w),
        "__tm_last": F.first(F.col(last)).over(w) if last else F.lit(None).cast("int"), "__tm_at": F.row_number().over(w),
    })
    odd = F.lit(False) if echo is None else ~F.col(echo).eqNullSafe(F.col(page))
    moved = ~t.eqNullSafe(F.col("__tm_first")) | (~F.col(last).eqNullSafe(F.col("__tm_last")) if last else F.lit(False))
    wrong = (
        F.when(F.col("__tm_at") != F.col(page), "page_missing").when(F.col(rows).isNull(), "unexpected_shape").when(t.isNull() | (t < 0) | odd, "pagination_unconfirmed").when(moved, "pagination_changed")
        .when(F.col("__tm_before") + n > t, "total_underreported").when((n == 0) & (t > F.col("__tm_before")), "empty_page")
    )
    told = told.withColumn("__tm_wrong", wrong)
    fault = F.when(F.col("__tm_wrong").isNotNull(), F.struct(F.col("__tm_at").alias("at"), F.col("__tm_wrong").alias("error"), F.col("__tm_before").alias("before")))
    got = told.groupBy(*by).agg(F.min(fault).alias("f"), F.sum(n).alias("n"), F.min(F.struct("__tm_at", t.alias("t")))["t"].alias("reported_total"), F.count(F.lit(1)).cast("int").alias("pages"))
    short = F.when(F.col("n") < F.col("reported_total"), F.concat(F.lit("short_page_partial_at_"), F.col("n").cast("string")))
    part = F.when(F.col("f.before") > 0, F.concat(F.lit("_partial_at_"), F.col("f.before").cast("string"))).otherwise("")
    error = F.when(F.col("f").isNotNull(), F.concat(F.col("f.error"), part)).otherwise(short)
    return got.select(*by, F.coalesce("f.before", "n").cast("int").alias("n_postings"), "reported_total", "pages", error.alias("error"))


def sitemap_boards(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(postings, headers) of boards that serve a sitemap. ``files``: token, url, payload (null if it couldn't be read).

    A board's file that ends in '/sitemap.xml' is a job feed, a list of addresses, or a list of sitemaps. Of such
    a list those with job, requisition or position in their address are read, or all if none has, CHILDREN at
    most; one that is missing is an error, as the board would be incomplete. Of entries with one number the
    first stays. Headers: ``token``, ``error``, ``children``, ``children_read``, ``lastmod`` (the latest of the
    jobs' entries), ``n_postings``. Boards with an error give no postings.
    """
    text = F.lower("payload")
    feed, listing = F.contains(text, F.lit("<rss")) & F.contains(text, F.lit("<item")), F.contains(text, F.lit("<sitemapindex"))
    named = F.regexp_extract_all("payload", F.lit(r"(?i)<loc>\s*([^<\s]+)\s*</loc>"), F.lit(1))
    wanted = F.filter(named, lambda u: u.rlike("(?i)job|requisition|position"))
    roots = files.where(F.col("url").endswith("/sitemap.xml")).dropDuplicates(["token"])
    shape = F.when(F.col("payload").isNull(), "unreadable").when(feed, "feed").when(~F.contains(text, F.lit("<loc")), "not_xml").when(listing, "list").otherwise("addresses")
    roots = roots.select("token", "payload", shape.alias("shape"), F.when(listing & ~feed, named).otherwise(F.array().cast("array<string>")).alias("named"), F.slice(F.when(F.size(wanted) > 0, wanted).otherwise(named), 1, CHILDREN).alias("chosen"))
    child = roots.where("shape = 'list'").select("token", F.posexplode("chosen").alias("at", "url"))
    child = child.join(files.select("token", "url", "payload").dropDuplicates(["token", "url"]), ["token", "url"], "left")
    parts = child.select("token", "at", "payload").unionByName(roots.where("shape IN ('feed', 'addresses')").select("token", F.lit(0).alias("at"), "payload"))
    broken = child.where("payload IS NULL").select("token").distinct()
    # The place of a part goes with its board's name, so that the first entry over all parts can stay.
    key = F.concat_ws("\u0000", "token", F.lpad(F.col("at").cast("string"), 6, "0"))
    rows = sitemap(parts.where("payload IS NOT NULL").select(key.alias("token"), "payload"), named=True)
    rows = rows.withColumns({"at": F.substring_index("token", "\u0000", -1), "token": F.substring_index("token", "\u0000", 1)})
    best = F.struct("at", "position", "title", "location", "url", "description")
    one = rows.groupBy("token", "job_id").agg(F.min(best).alias("b")).join(broken, "token", "left_anti")
    postings = one.select("token", "job_id", "b.title", "b.location", "b.url", F.lit("").alias("posted_on"), "b.description")
    entry = parts.select("token", F.explode(F.regexp_extract_all("payload", F.lit(r"(?is)(<url\b.*?</url>)"), F.lit(1))).alias("x")).where(F.col("x").rlike(r"/job/[^/]+/\d+"))
    latest = entry.groupBy("token").agg(F.max(truthy(xml_text(F.col("x"), "lastmod"))).alias("lastmod"))
    counts = postings.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    head = roots.join(broken.withColumn("broken", F.lit(True)), "token", "left").join(latest, "token", "left").join(counts, "token", "left")
    error = F.when(F.col("shape") == "unreadable", "sitemap_unreadable").when(F.col("shape") == "not_xml", "sitemap_not_xml").when(F.col("broken"), "sitemap_child_unreadable")
    read = F.when(F.col("shape") == "list", F.size("chosen")).otherwise(0)
    return postings, head.select("token", error.alias("error"), F.size("named").alias("children"), read.alias("children_read"), F.when(error.isNull(), F.col("lastmod")).alias("lastmod"), F.coalesce("n", F.lit(0)).alias("n_postings"))


UUID = "[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
# Where a shell names its board, the surest place first.
GUIDS = [r"/ats/documents/([0-9a-fA-F-]{36})/", r"embedjobs/js/([0-9a-fA-F-]{36})", f"({UUID})"]


def board_guid(shell: Column) -> Column:
    """The id of the board that a shell page names, null if none."""
    return F.coalesce(*[truthy(F.regexp_extract(shell, g, 1)) for g in GUIDS])


def keka_boards(shells: DataFrame, answers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answers for parse(), headers) of boards whose page names the id that their jobs are asked for by.

    ``shells``: token, payload. ``answers``: token, guid, portal ('default' or the token), payload. The default
    portal's answer counts if it is a list with entries, else that of the board's own portal, else an empty
    list. Errors: 'shell_not_text', 'no_board_guid', 'jobs_unreadable'.
    """
    named = shells.dropDuplicates(["token"]).select("token", F.col("payload").isNotNull().alias("read"), board_guid(F.col("payload")).alias("guid"))
    size = F.size(F.from_json("payload", "array<string>"))
    rank = F.when((size > 0) & (F.col("portal") == "default"), 0).when(size > 0, 1).when(size == 0, 2)
    ranked = answers.select("token", "guid", F.struct(rank.alias("rank"), "portal", "payload").alias("a")).where("a.rank IS NOT NULL")
    best = ranked.groupBy("token", "guid").agg(F.min("a").alias("a"))
    met = named.join(best, ["token", "guid"], "left")
    error = F.when(~F.col("read"), "shell_not_text").when(F.col("guid").isNull(), "no_board_guid").when(F.col("a").isNull(), "jobs_unreadable")
    rows = met.where("a IS NOT NULL").select(F.lit("keka").alias("platform"), "token", F.lit(1).alias("page"), F.col("a.payload").alias("payload"))
    return rows, met.select("token", "guid", F.col("a.portal").alias("portal"), error.alias("error"))


POSITION = "array<struct<id:string,atsJobId:string,name:string,locations:array<string>,standardizedLocations:array<string>,postedTs:bigint,creationTs:bigint,department:string,workLocationOption:string>>"


def eightfold_boards(answers: DataFrame, place: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(postings, headers) of boards that one of two endpoints answers. ``answers``: token ('tenant|domain'), endpoint ('pcsx', 'apply'), page, payload.

    The 'pcsx' endpoint wraps its list in 'data'. The first endpoint with a list on its first page counts,
    with all its pages. ``place`` keeps the positions with a location that holds it, and is noted in the header.
    Postings carry ``department`` and ``work_location`` beside the usual columns. Without any list: 'unexpected_shape'.
    """
    body = f"positions:{POSITION},count:int"
    read = answers.withColumn("j", F.from_json("payload", f"struct<data:struct<{body}>,{body}>"))
    data = F.when(F.col("endpoint") == "pcsx", F.col("j.data")).otherwise(F.struct(F.col("j.positions").alias("positions"), F.col("j.count").alias("count")))
    read = read.select("token", "page", F.when(F.col("endpoint") == "pcsx", 0).when(F.col("endpoint") == "apply", 1).alias("order"), "endpoint", data["positions"].alias("items"), data["count"].alias("count"))
    first = read.where("page = 1 AND items IS NOT NULL AND order IS NOT NULL").groupBy("token").agg(F.min(F.struct("order", "endpoint", "count")).alias("f"))
    first = first.select("token", F.col("f.endpoint").alias("endpoint"), F.col("f.count").alias("reported_total"))
    rows = read.join(first.select("token", "endpoint"), ["token", "endpoint"]).select("token", "page", F.posexplode("items").alias("position", "p"))
    named = lambda c: F.filter(F.col(c), lambda x: x != "")
    places = F.when(F.size("p.locations") > 0, named("p.locations")).otherwise(F.coalesce(named("p.standardizedLocations"), F.array().cast("array<string>")))
    id_ = F.coalesce(truthy(F.col("p.id")), truthy(F.col("p.atsJobId")), F.lit(""))
    ts = F.coalesce(F.nullif(F.col("p.postedTs"), F.lit(0)), F.col("p.creationTs"))
    posted = F.when(ts > 0, F.date_format(F.timestamp_seconds(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("")
    url = F.concat(F.lit("https://"), F.substring_index("token", "|", 1), F.lit(".eightfold.ai/careers/job/"), id_)
    rows = rows.select("token", "page", "position", id_.alias("job_id"), F.coalesce("p.name", F.lit("")).alias("title"), F.array_join(places, "; ").alias("location"), url.alias("url"), posted.alias("posted_on"), F.col("p.department").alias("department"), F.col("p.workLocationOption").alias("work_location"))
    if place is not None:
        rows = rows.where(F.contains(F.lower("location"), F.lit(place.lower())))
    every = answers.select("token").distinct().join(first, "token", "left")
    return rows, every.select("token", "endpoint", "reported_total", F.lit(place).cast("string").alias("location_filter"), F.when(F.col("endpoint").isNull(), "unexpected_shape").alias("error"))
