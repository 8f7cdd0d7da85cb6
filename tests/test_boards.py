"""Sources that take several answers, nested JSON, and the page plans, on small fixtures."""

from pyspark.sql import functions as F

from tidemark.functions import nested as N
from tidemark.functions import text as X
from tidemark.functions import urls as U
from tidemark.operators import crawl, discovery, tiers
from tidemark.plans import pages, single
from tidemark.sources import boards
from tidemark.sources.stores import VersionedTable, recorded


def col(spark, values, f, kind="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(f(F.col("v"))).collect()]


def test_nested(spark):
    texts = ['{"a": {"Batch": [2024, "2025-2027", "2030 - 2090", true, 1800]}, "b": [{"batch": "2024"}]}', "[]", "broken", None, '{"batch": {"batch": 1999}}']
    assert col(spark, texts, lambda c: N.nested_years(c, "batch")) == [[2024, 2025, 2026, 2027], [], [], [], [1999]]
    assert col(spark, texts, lambda c: N.nested_values(c, "batch"))[4] == ['{"batch": 1999}', "1999"]
    places = ['[{"name": "HQ", "city": "Pune"}, "x"]', " Oslo ", None, '{"city": "Rome", "state": null, "country": "IT"}', "[broken"]
    assert col(spark, places, N.place_text) == ["HQ Pune x", "Oslo", None, "Rome IT", "[broken"]
    assert col(spark, places[3:4], lambda c: N.place_text(c, "normal")) == ["Rome, IT"]
    assert col(spark, ["a  degree\n in   law x", "none", None, ""], lambda c: N.source_quote(c, r"degree in \w+")["quote"]) == ["degree\n in   law", None, None, None]
    assert col(spark, [" https://a.example/x ", "ftp://a", "https://", None], N.web_address) == ["https://a.example/x", "", "", ""]


def test_kinds_are_told_by_domain(spark):
    urls = ["https://clever.example/x", "https://boards.greenhouse.io/a", "https://jobs.lever.co:443/a", "https://notgreenhouse.io/a", "https://careers.acme.example/job/x/1", "https://lever.co.evil.example/x"]
    assert col(spark, urls, U.kind) == ["generic_html", "greenhouse", "lever", "generic_html", "successfactors", "generic_html"]
    assert col(spark, urls, U.trust)[0] == "low_trust" and col(spark, urls, U.trust_reasons)[0] == ["unrecognised_source_domain_clever.example"]
    assert col(spark, ["https://a.example/x"], lambda c: U.kind(c, content_type=F.lit("application/PDF; x"))) == ["pdf"]
    assert col(spark, ["https://a.example/x"], lambda c: U.kind(c, body=F.lit("%PDF-1.7"))) == ["pdf"]
    pages_ = ["https://jobs.lever.co/jobs https://jobs.lever.co/acme", "x.wd5.myworkdayjobs.com/en-US/Site and boards.greenhouse.io/b", "https://acme.recruitee.com/", "<i data-careersite-propertyid='1'>", None, "https://clever.co/acme"]
    got = col(spark, pages_, lambda c: discovery.platforms_named(c, F.lit("https://careers.acme.example/")))
    assert [tuple(g) if g else None for g in got] == [("lever", "acme"), ("workday", "x.wd5.myworkdayjobs.com|x|Site"), ("recruitee", "acme"), ("successfactors", "careers.acme.example"), None, None]


def test_paged_reads(spark):
    rows = [("ok", 1, 2, 3, 1), ("ok", 2, 1, 3, 2), ("short", 1, 2, 3, 1), ("gap", 1, 2, 4, 1), ("gap", 3, 2, 4, 3), ("drift", 1, 2, 4, 1), ("drift", 2, 2, 5, 2), ("none", 1, 2, None, 1), ("void", 1, 2, 4, 1), ("void", 2, 0, 4, 2), ("over", 1, 5, 4, 1), ("echo", 1, 2, 4, 7), ("shape", 1, None, 4, 1), ("empty", 1, 0, 0, 1)]
    df = spark.createDataFrame(rows, "b string, page int, n int, total int, echo int")
    got = {r["b"]: (r["error"], r["n_postings"]) for r in boards.paged_reads(df, ["b"], "page", "n", "total", "echo").collect()}
    assert got == {
        "ok": (None, 3), "short": ("short_page_partial_at_2", 2), "gap": ("page_missing_partial_at_2", 2), "drift": ("pagination_changed_partial_at_2", 2), "none": ("pagination_unconfirmed", 0), "void": ("empty_page_partial_at_2", 2),
        "over": ("total_underreported", 0), "echo": ("pagination_unconfirmed", 0), "shape": ("unexpected_shape", 0), "empty": (None, 0),
    }
    assert boards.paged_reads(df.limit(0), ["b"], "page", "n", "total").count() == 0


def test_sitemaps(spark):
    entry = lambda n, day: f"<url><loc>https://h.example/job/Pune-Cook-IND-411001/{n}/</loc><lastmod>2025-01-0{day}</lastmod></url>"
    index = "<sitemapindex><loc>https://h.example/a-job.xml</loc><loc>https://h.example/b.xml</loc><loc>https://h.example/c-job.xml</loc></sitemapindex>"
    files = [("h", "https://h.example/sitemap.xml", index), ("h", "https://h.example/a-job.xml", entry(1, 2)), ("h", "https://h.example/c-job.xml", entry(2, 3) + entry(1, 9)), ("h", "https://h.example/b.xml", entry(3, 1)),
             ("x", "https://x.example/sitemap.xml", index.replace("h.example", "x.example")), ("x", "https://x.example/a-job.xml", entry(1, 1)), ("n", "https://n.example/sitemap.xml", None), ("t", "https://t.example/sitemap.xml", "text"), ("l", "https://l.example/sitemap.xml", entry(5, 1))]
    rows, heads = boards.sitemap_boards(spark.createDataFrame(files, "token string, url string, payload string"))
    assert {(r["token"], r["job_id"], r["title"], r["location"]) for r in rows.collect()} == {(t, n, "Cook", "Pune, India 411001") for t, n in (("h", "1"), ("h", "2"), ("l", "5"))}
    got = {r["token"]: (r["error"], r["children"], r["children_read"], r["lastmod"], r["n_postings"]) for r in heads.collect()}
    assert got == {"h": (None, 3, 2, "2025-01-09", 2), "x": ("sitemap_child_unreadable", 3, 2, None, 0), "n": ("sitemap_unreadable", 0, 0, None, 0), "t": ("sitemap_not_xml", 0, 0, None, 0), "l": (None, 0, 0, "2025-01-01", 1)}


def test_requests_and_records(spark):
    rows = [("a", 1, 503), ("a", 2, None), ("a", 3, 200), ("b", 1, 429), ("b", 2, 200), ("c", 1, 503), ("c", 2, 503), ("c", 3, 503), ("c", 4, 200), ("d", 1, 404), ("e", 1, None)]
    got = {r["k"]: (r["attempts"], r["error"]) for r in crawl.settled(spark.createDataFrame(rows, "k string, n int, s int"), ["k"], "n", "s").collect()}
    assert got == {"a": (3, None), "b": (1, "rate_limited_429"), "c": (3, "http_503"), "d": (1, "http_404"), "e": (1, "network_error")}
    held = spark.createDataFrame([("k", 1.0, '{"status": 200, "text": "old"}'), ("k", 5.0, "{broken"), ("m", 1.0, "{}"), ("z", 9.0, '{"status": 200, "text": "z"}')], "digest string, fetched_at double, record string")
    asked = spark.createDataFrame([("k",), ("m",), ("q",), ("z",)], "digest string")
    out = lambda **how: {r["digest"]: r["outcome"] for r in recorded(asked, held, 10.0, **how).collect()}
    assert out() == dict.fromkeys("kmqz", "miss") and out(max_age=2.0) == {"k": "stale", "m": "miss", "q": "miss", "z": "hit"} and out(offline=True) == {"k": "hit", "m": "miss", "q": "miss", "z": "hit"}


def test_tables_survive_a_broken_write(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t", ["k"], 4)
    t.write(spark.createDataFrame([(i, "a") for i in range(20)], "k int, v string"))
    kept = {r["k"] for r in t.read().collect()}
    fs, real = t._fs, VersionedTable._point
    for broken in ("before", "half"):
        def point(self, parts, note, how=broken):
            if how == "half":  # the pointer was begun aside and never renamed, or is cut short
                (tmp_path / "t" / "_pointers" / f"{9:012d}").write_text('{"parts": {"0"')
            raise OSError("killed")

        VersionedTable._point = point
        try:
            t.write(spark.createDataFrame([(99, "b")], "k int, v string"))
            raise AssertionError
        except OSError:
            pass
        finally:
            VersionedTable._point = real
        assert {r["k"] for r in t.read().collect()} == kept
    (tmp_path / "t" / "_pointers" / f"{9:012d}").unlink()
    touched = sorted({r[0] for r in t.read().select(t.bucket()).where("k < 3").collect()})
    part = t.read(touched).withColumn("v", F.lit("new"))
    rest = {r["k"] for r in t.read().collect()} - {r["k"] for r in part.collect()}
    t.replace(part, touched, 7)
    assert t.pointer()["note"] == 7 and {r["k"] for r in t.read().where("v = 'a'").collect()} == rest and t.read().count() == 20


def test_page_run(spark):
    html = "<p>We seek a junior baker for our shop in Oslo.</p>"
    wanted = spark.createDataFrame([("A", "https://a.example/x"), ("B", "https://b.example/x"), ("C", None), ("D", "https://d.example/x"), ("E", "https://e.example/x"), ("F", "https://f.example/x"), ("G", "https://g.example/x")], "company string, url string")
    fetched = spark.createDataFrame([("https://a.example/x", 200, html, None, False), ("https://b.example/x", 200, html, None, False), ("https://d.example/x", 200, html, "robots_disallow", False), ("https://e.example/x", 500, None, None, False), ("https://f.example/x", 200, html, None, True), ("https://g.example/x", 200, html, None, None)], "url string, status int, html string, denied string, paused boolean")
    same = spark.createDataFrame([(html,)], "h string").select(X.content_hash(F.col("h"))).first()[0]
    state = spark.createDataFrame([("https://b.example/x", same, "t0", "t0", 4), ("https://old.example/", "h", "t0", "t0", 1)], "url string, content_hash string, last_fetched string, last_extracted string, last_role_count int")
    said = '{"roles": [{"title": "Baker", "quote": "seek a junior  baker", "evidence": {"x": "our shop in Oslo", "y": "not on the page at all"}}, {"title": "Ghost", "quote": "we seek a ghost today"}]}'
    answers = spark.createDataFrame([("https://a.example/x", said)], "u string, payload string").select(X.short_key(F.col("u")).alias("key"), "payload")
    run = pages.read_pages(wanted, fetched, state, answers, F.lit("t1"))
    got = {r["company"]: (r["outcome"], r["roles"], r["discarded"], r["detail"]) for r in run.outcomes.collect()}
    assert got == {"A": ("extracted", 1, 1, ""), "B": ("unchanged_skipped", 4, 0, ""), "C": ("no_careers_url", 0, 0, ""), "D": ("robots_blocked", 0, 0, "robots_disallow"), "E": ("fetch_failed", 0, 0, "500"), "F": ("rate_limited", 0, 0, ""), "G": ("extraction_failed", 0, 0, "no_fixture_for_url")}
    rows = run.rows.collect()
    assert [(r["title"], r["token"], r["url"], r["evidence"]) for r in rows] == [("Baker", "A", "https://a.example/x", {"x": "our shop in Oslo"})]
    assert {r["url"]: (r["last_extracted"], r["last_role_count"]) for r in run.state.collect()} == {"https://a.example/x": ("t1", 1), "https://b.example/x": ("t0", 4), "https://g.example/x": ("t1", 0), "https://old.example/": ("t0", 1)}
    store = run.rows.limit(0).select("*", F.lit("t").alias("first_seen"), F.lit("t").alias("last_seen"), F.lit(True).alias("is_live"))
    once = spark.createDataFrame(pages.merge(store, run.rows, F.lit("t1")).collect(), store.schema)
    twice = pages.merge(once, run.rows.withColumn("title", F.lit("Chief baker")), F.lit("t2")).collect()
    assert [(r["title"], r["first_seen"], r["last_seen"], r["is_live"]) for r in twice] == [("Chief baker", "t1", "t2", True)]
    assert col(spark, ["x" * 2001], lambda c: pages.real_page(F.lit(200), F.lit("https://a.example/jobs"), c)) == [True] and col(spark, ["x" * 2001], lambda c: pages.real_page(F.lit(200), F.lit("https://a.example/?q"), c)) == [False]


def test_single_records(spark):
    urls = ["https://boards.greenhouse.io/acme/jobs/7", "https://acme.keka.com/careers/jobdetails/3", "https://x.example/a", "https://x.example/b.pdf", "https://x.example/no", "https://x.example/void", "https://x.example/bin"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    api = [r["t"]["api"] if r["t"] else None for r in df.select(single.api_target(F.col("url")).alias("t")).collect()]
    assert api == ["https://boards-api.greenhouse.io/v1/boards/acme/jobs/7?content=true", *[None] * 6]
    denied = spark.createDataFrame([("https://x.example/no", "robots_disallow")], "url string, why string")
    answers = spark.createDataFrame([(urls[0], '{"jobs": [{"id": 6, "title": "Other"}, {"id": 7, "title": "Cook &amp; Co", "location": "Oslo"}]}')], "url string, payload string")
    postings = spark.createDataFrame([("acme", "3", "https://acme.keka.com/careers/jobdetails/3/", 2, "Clerk"), ("acme", "4", urls[1], 5, "Late")], "token string, job_id string, url string, o int, title string")
    found = single.board_match(df.select("url", F.lit("acme").alias("token")), postings, ["token"], "o").where("found_title IS NOT NULL")
    assert [(r["url"], r["found_title"]) for r in found.collect()] == [(urls[1], "Clerk")]
    boards_ = found.select("url", F.col("found_title").alias("title"), F.lit("").alias("location"), F.lit("").alias("description"), F.lit("").alias("posted_on"), F.col("token").alias("board"))
    html = "<title>Jobs</title><h1>Smith | Careers at X</h1><p>Work.</p>"
    fetched = spark.createDataFrame([(urls[2], 200, html, None), (urls[5], 200, "<b></b>", None), (urls[6], 200, "%PDF-1", None)], "url string, status int, html string, error string")
    got = {r["url"]: (r["state"], r["record"]["title"], r["record"]["trust"], r["record"]["is_live"]) for r in single.read_urls(df, denied, answers, boards_, fetched).collect()}
    assert got == {
        urls[0]: ("ok", "Cook & Co", "trusted", True), urls[1]: ("ok", "Clerk", "trusted", True), urls[2]: ("ok", "Smith", "low_trust", True), urls[3]: ("needs_pdf_reader", "", "low_trust", False), urls[4]: ("robots_disallowed", "", "low_trust", False),
        urls[5]: ("empty", "", "low_trust", False), urls[6]: ("needs_pdf_reader", "", "low_trust", False),
    }


def test_due_and_penalties(spark):
    registry = spark.createDataFrame([("p", "a"), ("p", "b"), ("p", "b"), ("p", None)], "platform string, token string")
    state = spark.createDataFrame([("p", "a", 3, 1, 2, 90)], "platform string, token string, total_ever bigint, recent bigint, sweeps bigint, m int").select("platform", "token", "total_ever", "recent", "sweeps", F.timestamp_seconds("m").alias("last_swept"))
    got = {r["token"]: (r["tier"], r["due"], r["sweeps"]) for r in tiers.due_boards(registry, state, ["platform", "token"], F.timestamp_seconds(F.lit(100))).collect()}
    assert got == {"a": ("hot", False, 2), "b": ("cold", True, 0), None: ("cold", True, 0)}
    rows = spark.createDataFrame([("h", 0.0, True, None), ("h", 10.0, True, 2000.0), ("h", 20.0, True, None), ("g", 0.0, True, None), ("f", 0.0, False, None)], "host string, s double, no boolean, after double")
    assert [tuple(r) for r in crawl.penalty_report(rows, "host", "s", F.col("no"), F.col("after"), 1000.0).collect()] == [("h", 2010.0, 1010.0)]
