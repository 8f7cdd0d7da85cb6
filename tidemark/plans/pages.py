"""A run over careers pages: what changed is read for roles, roles are held to the page's words, and rows enter the store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import content_hash, evidence_kept, quoted_in, short_key, visible_text
from tidemark.functions.urls import path
from tidemark.scale import cut

READ = ("page", "re_resolve")  # mechanisms whose pages are read
ROLE = "title:string,quote:string,apply_url:string,location:string,stage:string,grad_years_accepted:array<int>,evidence:map<string,string>"
LEAST_PAGE = 2000  # characters of a real page


def targets(rows: DataFrame, company: str | None = None, limit: int = 0) -> DataFrame:
    """Pages to read: those of a mechanism that is read and with an address, of companies that hold ``company``; the first ``limit`` by company and address."""
    kept = rows.where(F.col("mechanism").isin(*READ) & F.coalesce(F.col("careers_url") != "", F.lit(False)))
    if company:
        kept = kept.where(F.contains(F.lower("company"), F.lit(company.lower())))
    return kept.orderBy("company", "careers_url").limit(limit) if limit else kept


def real_page(status: Column, final_url: Column, html: Column) -> Column:
    """Whether an answer is a careers page: 2xx, longer than LEAST_PAGE, and not the host's root."""
    bare = F.regexp_replace(F.regexp_replace(path(final_url), r"\?.*$", ""), "^/+|/+$", "")
    return F.coalesce(status.between(200, 299) & (F.length(html) > LEAST_PAGE) & (bare != ""), F.lit(False))


def extracted(pages: DataFrame, answers: DataFrame) -> DataFrame:
    """The recorded answer of each page: ``url``, ``roles``, ``error``. ``answers``: key (short_key() of the address), payload (JSON of roles or error).

    Errors: 'no_fixture_for_url', 'fixture_unreadable', or what the answer itself names. No role is an answer too.
    """
    said = answers.dropDuplicates(["key"]).select("key", F.lit(True).alias("known"), F.from_json("payload", f"struct<roles:array<struct<{ROLE}>>,error:string>", {"mode": "PERMISSIVE"}).alias("j"), F.expr("try_parse_json(payload) IS NULL").alias("broken"))
    met = pages.select("url", short_key(F.col("url")).alias("key")).join(said, "key", "left")
    error = F.when(F.col("known").isNull(), "no_fixture_for_url").when(F.col("broken"), "fixture_unreadable").when(F.col("j.error") != "", F.col("j.error"))
    return met.select("url", F.when(error.isNull(), F.coalesce("j.roles", F.array().cast(f"array<struct<{ROLE}>>"))).alias("roles"), error.alias("error"))


def held(rows: DataFrame) -> DataFrame:
    """Roles (``url``, ``html``, ``roles``) whose quote stands on the page word for word: ``url``, ``role``, and ``discarded`` per page.

    A role without its quote goes; of its evidence only the entries that fail go.
    """
    text = visible_text(F.col("html"))
    each = rows.select("url", text.alias("text"), F.posexplode_outer("roles").alias("at", "role"))
    ok = F.coalesce(quoted_in(F.col("role.quote"), F.col("text")), F.lit(False))
    evidence = evidence_kept(F.coalesce("role.evidence", F.create_map().cast("map<string,string>")), F.col("text"))
    return each.where("role IS NOT NULL").select("url", "at", F.col("role").withField("evidence", evidence).alias("role"), ok.alias("kept"))


def store_rows(roles: DataFrame) -> DataFrame:
    """Rows of the store from held roles (``company``, ``url``, ``role``): the id is short_key() of where to apply, or of page and title."""
    word = lambda c: F.coalesce(F.col(f"role.{c}"), F.lit(""))
    apply = F.nullif(word("apply_url"), F.lit(""))
    return roles.select(
        F.lit("page_reader").alias("platform"), F.col("company").alias("token"), short_key(F.coalesce(apply, F.concat("url", word("title")))).alias("job_id"), word("title").alias("title"), word("location").alias("location"),
        F.coalesce(apply, F.col("url")).alias("url"), F.lit("").alias("posted_on"), F.lit("page").alias("source_mechanism"), word("quote").alias("quote"), F.coalesce("role.grad_years_accepted", F.array().cast("array<int>")).alias("grad_years_accepted"), F.col("role.evidence").alias("evidence"),
    )


def merge(store: DataFrame, rows: DataFrame, now: Column) -> DataFrame:
    """The store after a run: a row's key is its address, or its id without one; new values win, nothing closes.

    ``store`` has the columns of ``rows`` and first_seen, last_seen, is_live. Of several new rows with one key the last by id counts.
    """
    values = rows.columns
    key = F.coalesce(F.nullif("url", F.lit("")), "job_id")
    plain = [F.col(c) for c in values]
    best = rows.withColumn("__tm_k", key).groupBy("__tm_k").agg(F.max_by(F.struct(*plain), F.struct("job_id", "title", "location")).alias("n"))
    old = store.withColumn("__tm_k", key).dropDuplicates(["__tm_k"]).select("__tm_k", F.struct(*plain).alias("o"), F.struct("first_seen", "last_seen", "is_live").alias("life"))
    both = best.join(old, "__tm_k", "full_outer")
    new = F.col("n").isNotNull()
    return both.select(
        *[F.when(new, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in values], F.coalesce("life.first_seen", now).alias("first_seen"), F.when(new, now).otherwise(F.col("life.last_seen")).alias("last_seen"), F.coalesce("life.is_live", F.lit(True)).alias("is_live")
    )


@dataclass
class PageRun:
    outcomes: DataFrame  # one row per target: company, url, outcome, detail, roles, discarded
    state: DataFrame  # per address: content_hash, last_fetched, last_extracted, last_role_count
    rows: DataFrame  # of the store, from this run
    report: DataFrame  # outcomes counted, with roles and discards


def read_pages(wanted: DataFrame, fetched: DataFrame, state: DataFrame, answers: DataFrame, now: Column, force: bool = False) -> PageRun:
    """One run. ``wanted``: company, url. ``fetched``: url, status, html, denied (why it may not be read), paused.

    Outcomes, the first that holds: 'no_careers_url', 'robots_blocked', 'rate_limited', 'fetch_failed',
    'unchanged_skipped' (the stable text's hash is the stored one), 'extraction_failed', 'extracted'. Only
    changed pages are read for roles. An address wanted twice counts twice but is read once.
    """
    got = fetched.dropDuplicates(["url"]).withColumn("hash", content_hash(F.col("html")))
    old = state.select("url", F.col("content_hash").alias("old_hash"), F.col("last_extracted").alias("old_at"), F.col("last_role_count").alias("old_roles"))
    met = cut(wanted.select("company", "url").join(got, "url", "left").join(old, "url", "left"))
    none = ~F.coalesce(F.col("html") != "", F.lit(False))
    first = (
        F.when(~F.coalesce(F.col("url") != "", F.lit(False)), "no_careers_url").when(F.col("denied").isNotNull(), "robots_blocked").when(F.coalesce("paused", F.lit(False)), "rate_limited").when(none, "fetch_failed")
        .when((F.col("hash") == F.col("old_hash")) & F.lit(not force), "unchanged_skipped")
    )
    met = met.withColumn("outcome", first)
    fresh = met.where("outcome IS NULL").select("url", "html").dropDuplicates(["url"])
    read = cut(extracted(fresh, answers).join(fresh, "url"))
    roles = cut(held(read.where("error IS NULL")))
    counts = roles.groupBy("url").agg(F.count_if("kept").cast("int").alias("kept"), F.count_if(~F.col("kept")).cast("int").alias("discarded"))
    done = read.select("url", "error").join(counts, "url", "left")
    met = met.join(done, "url", "left").withColumn("outcome", F.coalesce("outcome", F.when(F.col("error").isNotNull(), "extraction_failed").otherwise("extracted")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    skipped, was = F.col("outcome") == "unchanged_skipped", F.col("outcome").isin("extracted", "extraction_failed")
    detail = F.when(F.col("outcome") == "robots_blocked", F.col("denied")).when(F.col("outcome") == "fetch_failed", F.coalesce(F.col("status").cast("string"), F.lit("None"))).when(F.col("outcome") == "extraction_failed", F.col("error")).otherwise("")
    outcomes = met.select("company", "url", "outcome", detail.alias("detail"), F.when(skipped, zero("old_roles")).when(was, zero("kept")).otherwise(0).alias("roles"), zero("discarded").alias("discarded"))
    seen = met.where(skipped | was).dropDuplicates(["url"])
    after = seen.select("url", F.col("hash").alias("content_hash"), now.alias("last_fetched"), F.when(was, now).otherwise(F.col("old_at")).alias("last_extracted"), F.when(skipped, zero("old_roles")).otherwise(zero("kept")).alias("last_role_count"))
    kept = state.select("url", "content_hash", "last_fetched", "last_extracted", "last_role_count").join(after.select("url"), "url", "left_anti")
    owner = met.where("outcome = 'extracted'").select("company", "url").distinct()
    rows = store_rows(owner.join(roles.where("kept"), "url"))
    report = outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum("roles").alias("roles"), F.sum("discarded").alias("discarded"))
    return PageRun(outcomes, kept.unionByName(after), rows, report)
