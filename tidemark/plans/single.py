"""One record for one address: where it is asked for, which answer holds it, and what the record says."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import one_line, strip_html, truthy, visible_text
from tidemark.functions.urls import host, kind, path_parts, trust, trust_reasons

SHOWN = 200  # characters of a description that a record shows


def api_target(url: Column, hosts: dict | None = None) -> Column:
    """Where a platform's own interface gives the job of an address: struct of ``api`` and ``body`` (of a POST), null if it has none."""
    k, parts = kind(url, hosts), F.transform(path_parts(url), lambda x: F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))))
    at, size = F.array_position(parts, "jobs"), F.size(parts)
    part = lambda i: F.get(parts, i if isinstance(i, Column) else F.lit(i))
    last = F.element_at(parts, -1)
    number = F.get(F.filter(parts, lambda x: x.rlike(r"^\d{5,}$")), F.lit(0))
    given = lambda api, body=None: F.struct(api.alias("api"), (F.lit(None).cast("string") if body is None else body).alias("body"))
    search = F.to_json(F.struct(F.create_map().cast("map<string,string>").alias("appliedFacets"), F.lit(20).alias("limit"), F.lit(0).alias("offset"), last.alias("searchText")))
    workday = F.concat(F.lit("https://"), host(url), F.lit("/wday/cxs/"), F.substring_index(host(url), ".", 1), F.lit("/"), part(0), F.lit("/jobs"))
    return (
        F.when((k == "greenhouse") & (at > 1) & (at < size), given(F.concat(F.lit("https://boards-api.greenhouse.io/v1/boards/"), part((at - 2).cast("int")), F.lit("/jobs/"), part(at.cast("int")), F.lit("?content=true"))))
        .when((k == "lever") & (size >= 2), given(F.concat(F.lit("https://api.lever.co/v0/postings/"), last, F.lit("?mode=json")))).when((k == "ashby") & (size >= 2), given(F.concat(F.lit("https://api.ashbyhq.com/posting-api/job-board/"), part(0))))
        .when((k == "smartrecruiters") & (size >= 2), given(F.concat(F.lit("https://api.smartrecruiters.com/v1/companies/"), part(0), F.lit("/postings/"), last)))
        .when((k == "amazon.jobs") & number.isNotNull(), given(F.concat(F.lit("https://www.amazon.jobs/en/search.json?base_query="), number))).when((k == "workday") & (size > 0), given(workday, search))
    )


def wanted_id(url: Column, hosts: dict | None = None) -> Column:
    """The id that an address asks its board for: its last part, or at one platform the part after '/j/'."""
    parts = path_parts(url)
    return F.when((kind(url, hosts) == "workable") & (F.size(parts) > 2) & (F.lower(F.get(parts, F.lit(1))) == "j"), F.get(parts, F.lit(2))).otherwise(F.element_at(parts, -1))


def bare(url: Column) -> Column:
    return F.regexp_replace(url, "/+$", "")


def board_match(urls: DataFrame, postings: DataFrame, board: list[str], order: str, hosts: dict | None = None) -> DataFrame:
    """The posting of its board that each address names, by id or by address: the first in ``order`` of either.

    ``urls``: ``url`` and ``board``; ``postings``: ``board``, job_id, url, ``order`` and what else is wanted. Two
    equi-joins, one for each way to match, so that no pair of a board is met for nothing. Addresses that match none keep nulls.
    """
    want = urls.select("url", *board).distinct().withColumns({"__tm_id": wanted_id(F.col("url"), hosts), "__tm_u": bare(F.col("url"))})
    rest = [c for c in postings.columns if c not in board]
    # One posting for each id and each address of a board, before anything is joined.
    best = lambda by: postings.groupBy(*board, by.alias("__tm_by")).agg(F.min(F.struct(F.col(order).alias("__tm_order"), *[F.col(c).alias(f"__tm_c_{c}") for c in rest])).alias("m")).where("__tm_by IS NOT NULL")
    by_id = want.join(best(F.col("job_id")).withColumnRenamed("__tm_by", "__tm_id"), [*board, "__tm_id"], "left").select("url", *board, "__tm_u", F.col("m").alias("m1"))
    met = by_id.join(best(bare(F.col("url"))).withColumnRenamed("__tm_by", "__tm_u"), [*board, "__tm_u"], "left")
    found = F.least("m1", "m")
    return met.select("url", *board, *[found[f"__tm_c_{c}"].alias(f"found_{c}") for c in rest])


def html_fields(html: Column) -> Column:
    """Title and text of a page: struct of ``title`` (the first heading, else the page's title, without a closing 'careers' part) and ``description``."""
    inner = lambda tag: truthy(strip_html(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)))
    heading = truthy(strip_html(F.regexp_extract(html, r"(?is)<h[12]\b[^>]*>(.*?)</h[12]\s*>", 1)))
    title = F.regexp_replace(F.coalesce(heading, inner("title"), F.lit("")), r"(?i)\s*[|–—-]\s*(?:careers?|jobs?|google forms?).*$", "")
    return F.struct(F.trim(title).alias("title"), visible_text(html).alias("description"))


# The keys that hold a field in answers about one job, the first that isn't empty counts.
KEYS = {
    "title": ["title", "text", "name"], "description": ["descriptionPlain", "description", "content", "descriptionHtml", "jobDescription"], "company": ["company", "companyName"], "posted_on": ["updated_at", "publishedAt", "published_on", "postedOn", "releasedDate"],
    "deadline": ["deadline", "expirationDate"], "url": ["absolute_url", "hostedUrl", "jobUrl", "url"], "board": ["boardToken", "token"],
}
IDS = ["id", "shortcode", "jobId", "atsJobId"]
WRAPS, LISTS = ["job", "posting", "position"], ["jobs", "content", "jobPostings", "positions"]
ANSWER = ",".join(f"{k}:string" for k in dict.fromkeys([*IDS, *(k for ks in KEYS.values() for k in ks), "location", "locations", "locationsText"]))


def payload_fields(payload: Column, url: Column) -> Column:
    """The fields of the job that an answer is about, null if it is about none.

    An answer with a title is the job itself; else the job stands under one of WRAPS, or is the entry of a list
    (the answer itself or one of LISTS) whose id or address has the last part of ``url``.
    """
    usable = lambda j: j.isNotNull() & (truthy(j["title"]).isNotNull() | truthy(j["text"]).isNotNull() | truthy(j["name"]).isNotNull())
    last = F.element_at(path_parts(url), -1)

    def hit(j: Column, part: Column) -> Column:
        ids = F.array(*[F.coalesce(j[k], F.lit("")) for k in IDS])
        return F.coalesce(F.array_contains(ids, part), F.lit(False)) | F.coalesce(F.contains(F.coalesce(*[truthy(j[k]) for k in KEYS["url"]]), part), F.lit(False))

    job = bound(F.from_json(payload, f"struct<{ANSWER}>"), lambda j: F.when(usable(j), j))
    under = [F.get_json_object(payload, f"$.{k}") for k in WRAPS]
    wrapped = [F.from_json(F.when(t.rlike(r"^\s*\{"), t), f"struct<{ANSWER}>") for t in under]
    entries = F.coalesce(*[F.from_json(t, f"array<struct<{ANSWER}>>") for t in (F.when(payload.rlike(r"^\s*\["), payload), *[F.get_json_object(payload, f"$.{k}") for k in LISTS])])
    listed = bound(F.struct(entries.alias("e"), last.alias("p")), lambda x: F.get(F.filter(x["e"], lambda j: hit(j, x["p"])), F.lit(0)))

    def told(one: Column) -> Column:
        place = F.coalesce(truthy(one["location"]), truthy(one["locations"]), truthy(one["locationsText"]), F.lit(""))
        words = [F.coalesce(*[truthy(one[k]) for k in keys], F.lit("")).alias(name) for name, keys in KEYS.items()]
        return F.when(one.isNotNull(), F.struct(*words, place.alias("location")))

    return bound(F.coalesce(job, *wrapped, listed), told)


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``value``, which is worked out once however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def record(fields: Column, url: Column, state: Column, hosts: dict | None = None) -> Column:
    """The record of an address from its fields (title, location, description, company, posted_on, deadline, url, board); no field but the address need be there."""
    word = lambda c: F.trim(F.coalesce(fields[c], F.lit("")))
    site = F.coalesce(host(url), F.lit(""))
    name = F.coalesce(truthy(word("company")), F.initcap(F.replace(F.coalesce(truthy(word("board")), F.substring_index(site, ".", 1)), F.lit("-"), F.lit(" "))))
    other = truthy(word("url"))
    return F.struct(
        kind(url, hosts).alias("source_platform"), word("board").alias("source_board"), name.alias("company"), site.alias("company_domain"), word("title").alias("title"), one_line(word("location")).alias("location"), url.alias("url"),
        F.when(other != url, F.array(other)).otherwise(F.array().cast("array<string>")).alias("alt_urls"), word("posted_on").alias("posted_on"), word("deadline").alias("deadline"), F.substring(word("description"), 1, SHOWN).alias("description"),
        trust(url, hosts).alias("trust"), trust_reasons(url, hosts).alias("trust_reasons"), (state == "ok").alias("is_live"), state.alias("fetch_state"),
    )


def read_urls(urls: DataFrame, denied: DataFrame, answers: DataFrame, boards: DataFrame, pages: DataFrame, hosts: dict | None = None) -> DataFrame:
    """Addresses with their ``record``, each by the first way that gives one: the platform's interface, its board, the page.

    ``denied``: url, why. ``answers``: url, payload (of api_target()). ``boards``: url, title, location,
    description, posted_on, board (of board_match()). ``pages``: url, status, html, error. States: 'ok',
    'robots_disallowed', 'needs_pdf_reader' (told by address or first bytes), 'error', 'empty'.
    """
    u = F.col("url")
    met = urls.select("url").distinct()
    for side in (denied.select("url", "why"), answers.select("url", "payload"), boards.select("url", F.struct("title", "location", "description", "posted_on", "board").alias("b")), pages.select("url", "status", "html", "error")):
        met = met.join(side.dropDuplicates(["url"]), "url", "left")
    names = ["title", "location", "description", "company", "posted_on", "deadline", "url", "board"]
    shaped = lambda c, have: F.struct(*[(c[n] if n in have else F.lit("")).alias(n) for n in names])
    met = met.withColumns({"api": payload_fields(F.col("payload"), u), "page": html_fields(F.col("html"))})
    api, page = F.col("api"), F.col("page")
    bare_api = F.struct(*[(F.coalesce(truthy(api["url"]), u) if n == "url" else strip_html(api[n])).alias(n) for n in names])
    fields = F.when(api.isNotNull(), bare_api).when(F.col("b").isNotNull(), shaped(F.col("b"), ["title", "location", "description", "posted_on", "board"])).otherwise(shaped(page, ["title", "description"]))
    met = met.withColumn("fields", fields)
    fields = F.col("fields")
    own = api.isNotNull() | F.col("b").isNotNull()
    pdf = (kind(u, hosts) == "pdf") | (~own & F.coalesce(F.col("html").startswith("%PDF"), F.lit(False)))
    bad = ~own & (F.col("error").isNotNull() | ~F.coalesce(F.col("status").between(200, 299), F.lit(False)))
    state = F.when(F.col("why").isNotNull(), "robots_disallowed").when(pdf, "needs_pdf_reader").when(bad, "error").when((fields["title"] == "") & (fields["description"] == ""), "empty").otherwise("ok")
    met = met.withColumn("state", state)
    state = F.col("state")
    reason = F.when(state == "robots_disallowed", F.col("why")).when(state == "error", F.coalesce("error", F.concat(F.lit("http_"), F.coalesce(F.col("status").cast("string"), F.lit("None"))))).when(state == "empty", "no opportunity text").when(state == "needs_pdf_reader", "pdf").otherwise("")
    got = met.select("url", "state", reason.alias("reason"), "fields")
    blank = F.struct(*[F.lit("").alias(n) for n in names])
    return got.select("url", "state", "reason", record(F.when(F.col("state") == "ok", F.col("fields")).otherwise(blank), u, F.col("state"), hosts).alias("record"))
