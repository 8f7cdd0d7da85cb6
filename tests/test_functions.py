import hashlib

from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.functions import urls as U
from tidemark.sources import payloads
from tidemark.sources.stores import VersionedTable, company_lines, latest_answers


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v"))).first()[0]


def test_text(spark):
    page = "<html><head><title>T</title></head><!-- x --><script>var a;</script><p>Hello &amp; bye</p><div>Menu</div><li>a<br>b</li>"
    assert one(spark, page, X.visible_text) == "Hello & bye\nMenu\na\nb"
    assert one(spark, page, X.stable_text) == "Hello & bye a b"
    assert one(spark, "&lt;p&gt;A &amp;amp; B&lt;/p&gt;", X.strip_html) == "A & B"
    assert one(spark, None, X.strip_html) == "" and one(spark, None, X.visible_text) == ""
    volatile = "x 1767643088823 y 2025-01-01T00:00:00Z z 123e4567-e89b-12d3-a456-4266141740ab"
    assert one(spark, volatile, X.stable_text) == "x y z"
    assert one(spark, "x y z", X.content_hash) == hashlib.sha256(b"x y z").hexdigest()
    assert one(spark, "batch 2024-2026 or 2030, 1999", X.years_named) == [2024, 2025, 2026, 2030]
    assert one(spark, None, X.years_named) == []
    q = spark.createDataFrame([("“Full Stack – Lead”", 'we seek a "full  stack - lead" now'), ("short", "short"), (None, "x")], "q string, p string")
    assert [r[0] for r in q.select(X.quoted_in(F.col("q"), F.col("p"))).collect()] == [True, False, False]
    assert spark.createDataFrame([("é&eacute;",), (None,)], "v string").select(X.decode_entities("v")).collect()[0][0] == "éé"


def test_every_entity_is_decoded(spark):
    import html
    import random
    import re

    def strip(s):
        return " ".join(html.unescape(re.sub(r"<[^>]+>", " ", html.unescape(s))).split())

    assert one(spark, "Caf&eacute; M&uuml;ller &#8211; &#x27;x&rsquo;", X.strip_html) == "Café Müller – 'x’"
    assert one(spark, "<p>M&uuml;ller&#160;&#8211; A&amp;eacute;</p>", X.visible_text) == "Müller – A&eacute;"
    feed = "<rss><item><g:id>9</g:id><title>Caf&eacute; &#x27;x&rsquo;</title></item></rss>"
    assert [r["title"] for r in payloads.sitemap(spark.createDataFrame([("a", feed)], "token string, payload string")).collect()] == ["Café 'x’"]
    job = '{"jobs": [{"id": 1, "title": "T", "content": "&lt;p&gt;Z&amp;uuml;rich&lt;/p&gt;"}]}'
    answers = spark.createDataFrame([("greenhouse", "t", 1, job)], "platform string, token string, page int, payload string")
    assert [r["description"] for r in payloads.parse(answers).collect()] == ["Zürich"]
    random.seed(3)
    parts = ["&eacute;", "&amp;", "&lt;b&gt;", "&#39;", "&#x27;", "&nbsp;", "&#160;", "&copy", "&amp;#8211;", "&amp;amp;", "R&D", "&", "amp;", "lt;", "#39;", "<p>", " ", "x", "&rsquo;", "&hellip;"]
    texts = ["".join(random.choices(parts, k=random.randint(1, 6))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wrong = [(r[0], r[1], strip(r[0])) for r in df.select("t", X.strip_html(F.col("t"))).collect() if r[1] != strip(r[0])]
    assert wrong == []
    wrong = [(r[0], r[1]) for r in df.select("t", X.unescape(F.col("t"))).collect() if r[1].replace("\xa0", " ") != html.unescape(r[0]).replace("\xa0", " ")]
    assert wrong == []


def test_all_rows_by_brute_force(spark, tmp_path):
    import re
    import unicodedata

    from tidemark.queries_lake import QUERIES

    def plain(s):
        s = re.sub("[‘’]", "'", unicodedata.normalize("NFKC", s or ""))
        return re.sub(r"\s+", " ", re.sub("[\u2010-\u2015\u2212]", "-", re.sub("[“”]", '"', s))).strip().lower()

    rows = [
        (1, "Müller – Leiter Vertrieb", "Wir suchen: MÜLLER\u00a0—\u2003Leiter  Vertrieb (m/w/d)"), (2, "Ｓｅｎｉｏｒ Engineer", "a senior engineer"), (3, "oﬃce manager Köln", "Office\u2028Manager KÖLN"), (4, "सॉफ्टवेयर इंजीनियर", "हम सॉफ्टवेयर इंजीनियर खोज रहे हैं"),
        (5, "Développeur principal", "rien"), (6, "Plain old engineer", "• a plain old engineer ©"), (7, None, "x"), (8, "Plain old engineer", None), (9, "kurz ü", "kurz ü"),
    ]
    spark.createDataFrame(rows, "ordinal bigint, title string, description string").write.parquet(f"{tmp_path}/postings.parquet")
    want = {o: len(plain(q)) >= 12 and plain(q) in plain(p) for o, q, p in rows}
    assert want[1] and want[2] and want[3] and want[4] and want[6] and not want[5]
    assert {r["ordinal"]: r["quoted"] for r in QUERIES["quote_containment_all"](spark, str(tmp_path)).collect()} == want

    def named(text):
        found = {int(y) for y in re.findall(r"\b((?:19|20|21)\d{2})\b", text or "")}
        for a, b in re.findall(r"\b((?:19|20|21)\d{2})\s*[-–—]\s*((?:19|20|21)\d{2})\b", text or ""):
            found |= set(range(int(a), int(b) + 1)) if int(b) <= int(a) + 20 else set()
        return ",".join(str(y) for y in sorted(found) if 2020 <= y <= 2035)

    texts = ["für 2025", "2021 – 2024 • x", "2021-2023, then 2030", "2021\u00a0—\u00a02023", "2026-2024", "ab2025 2025年 é2026", None, "", "1990-2034 ©", "नमस्ते 2031"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["years"] for r in QUERIES["years_named_all"](spark, str(tmp_path)).collect()}
    assert got == {i: named(t) for i, t in enumerate(texts)} and got[1] == "2021,2022,2023,2024"


def test_urls(spark):
    assert one(spark, "HTTPS://U@Boards.Lever.example:8/A/b?x#f", U.host) == "boards.lever.example:8"
    assert one(spark, "https://x.example", U.path) == "/" and one(spark, "https://x.example?q=1", U.path) == "/?q=1"
    assert one(spark, "https://a.wd5.boards.example/en-US/Site/job/1", U.workday_token) == "a.wd5.boards.example|a|Site"
    assert one(spark, "https://x.example/page.PDF?a=1", U.kind) == "pdf" and one(spark, None, U.kind) == "generic_html"
    assert one(spark, "https://docs.google.com/forms/d/1", U.kind) == "google_form"
    for token, key in (("alphasenseindia", "alphasense"), ("cesna-group-2", "cesna"), ("Acme", "acme"), ("12", "12"), (None, ""), ("abcdtechnologiesinc", "abcd")):
        assert one(spark, token, U.company_key) == key
    df = spark.createDataFrame([(" HTTPS://X.example/A// ", "p", "t", "n"), ("", "p", None, "n")], "u string, p string, t string, n string")
    assert [r[0] for r in df.select(U.identity(F.col("u"), F.col("p"), F.col("t"), F.col("n"))).collect()] == ["https://x.example/a", "p|None|n"]


def test_payloads(spark):
    rows = [("greenhouse", "t", 1, None), ("greenhouse", "t", 2, "{}"), ("greenhouse", "t", 3, "not json"), ("other", "t", 1, "[]"), ("personio", "t", 1, '[{"id": 1, "name": "N", "office": null, "createdAt": 5}]')]
    df = spark.createDataFrame(rows, "platform string, token string, page int, payload string")
    assert [(r["job_id"], r["title"], r["location"], r["posted_on"]) for r in payloads.parse(df).collect()] == [("1", "N", "", "5")]
    got = {(r["platform"], r["page"]): r["error"] for r in payloads.headers(df).collect()}
    assert got == {("greenhouse", 1): "unexpected_shape", ("greenhouse", 2): "unexpected_shape", ("greenhouse", 3): "unexpected_shape", ("other", 1): "unsupported_platform", ("personio", 1): None}
    feed = "<rss><item><g:id>9</g:id><title><![CDATA[Cook (Oslo, NO)]]></title><link>https://c.example/job/x/9/</link></item><item><g:id>9</g:id><title>Again</title></item></rss>"
    maps = "<urlset><url><loc>https://c.example/job/Baker/777/</loc></url></urlset>"
    got = payloads.sitemap(spark.createDataFrame([("a", feed), ("b", maps), ("c", None)], "token string, payload string")).orderBy("token").collect()
    assert [(r["token"], r["job_id"], r["title"], r["location"]) for r in got] == [("a", "9", "Cook", "Oslo, NO"), ("b", "777", "", "")]


def test_sitemap_addresses_give_title_and_place(spark):
    slugs = [
        ("Bengaluru-Senior-Analyst-IND-560001", "Senior Analyst", "Bengaluru, India 560001"), ("Navi-Mumbai-Clerk-IND-400701", "Clerk", "Navi Mumbai, India 400701"), ("Lead-SAP", "Lead SAP", ""), ("Pune", "Pune", ""),
        ("Executive-with-Dutch-ROU", "Executive with Dutch", "Romania"), ("C%2B%2B+Dev-Z%C3%BCrich-CHE-8001", "C+++Dev Zürich", "Switzerland 8001"), ("Cook-xyz-12345", "Cook", "XYZ 12345"), ("Baker", "Baker", ""),
    ]
    maps = "<urlset>" + "".join(f"<url><loc>https://c.example/job/{s}/{i}/</loc></url>" for i, (s, _, _) in enumerate(slugs)) + "<url><loc>https://c.example/about</loc></url></urlset>"
    feed = "<rss><item><g:id>90</g:id><title>Cook</title><link>https://c.example/job/Pune-Baker/90/</link></item></rss>"
    answers = spark.createDataFrame([("a", maps), ("b", feed)], "token string, payload string")
    got = {(r["token"], r["job_id"]): (r["title"], r["location"]) for r in payloads.sitemap(answers, named=True).collect()}
    assert got == {("a", str(i)): (t, p) for i, (_, t, p) in enumerate(slugs)} | {("b", "90"): ("Cook", "")}
    assert payloads.sitemap(answers).count() == 9


def test_stores(spark, tmp_path):
    t = VersionedTable(spark, f"file://{tmp_path}/t")
    assert t.read() is None
    t.write(spark.range(3))
    t.write(t.read().where("id > 0"))  # reads and replaces itself
    assert sorted(r[0] for r in t.read().collect()) == [1, 2]
    try:
        t.write(spark.range(0), refuse_empty=True)
        raise AssertionError
    except ValueError:
        assert t.read().count() == 2
    lines = spark.createDataFrame([("# x",), ("",), ("A, a.example",), ("B,b.example,tech",), ("C",)], "value string")
    assert {tuple(r) for r in company_lines(lines).collect()} == {("A", "a.example", "unsorted"), ("B", "b.example", "tech")}
    answers = spark.createDataFrame([("k", 1.0, "old"), ("k", 5.0, "new"), ("m", 1.0, "m")], "digest string, fetched_at double, text string")
    assert {r["text"] for r in latest_answers(answers, now=6.0, max_age=2.0).collect()} == {"new"}


def test_stream_equals_batch(spark, tmp_path):
    from tidemark.streaming.lake import merge_stream

    rows = [("b", "k1", 1, 1), ("b", "k2", 1, 2), ("b", "k1", 1, 3), ("c", "k3", 1, 4)]
    df = spark.createDataFrame(rows, "board string, k string, at bigint, o bigint")
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    store = VersionedTable(spark, f"file://{tmp_path}/store")
    source = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    merge_stream(spark, source, store, ["board", "k"], ["board"], "at", "o", f"{tmp_path}/cp")
    assert {(r["board"], r["k"], r["is_live"], r["first_seen"]) for r in store.read().collect()} == {("b", "k1", True, 1), ("b", "k2", True, 1), ("c", "k3", True, 1)}


def test_discovery(spark):
    from tidemark.operators.discovery import absolute, candidate_links, index_addresses, platforms_named

    html = "<a href='/about'>About</a><a href=\"/jobs\">Open <b>jobs</b></a><a href='https://x.example/jobs#a'>again jobs</a><a href='team'>Careers</a><a href='mailto:jobs@x'>jobs</a><a href='https://y.example/jobs'>jobs</a><a href='/p/careers'>See</a>"
    df = spark.createDataFrame([(1, html, "https://x.example/en/"), (2, None, "https://x.example")], "rank int, h string, u string")
    got = [(r[1], r["link"], r["score"]) for r in candidate_links(df, "rank", "h", "u").collect()]
    assert sorted(got) == [(1, "https://x.example/jobs", 3), (2, "https://x.example/en/team", 2), (3, "https://x.example/p/careers", 1)]
    assert one(spark, "//c.example/x", lambda c: absolute(c, F.lit("https://a.example/b"))) == "https://c.example/x"
    page = "<script src='https://boards.greenhouse.example/embed/job_board?for=acme'></script><a href='https://jobs.lever.example/other'>"
    assert tuple(one(spark, page, platforms_named)) == ("greenhouse", "acme") and one(spark, "nothing", platforms_named) is None
    lines = spark.createDataFrame([('{"url": "https://a.example"}',), ("broken",), ('{"x": 1}',), ('{"url": "https://a.example"}',)], "value string")
    assert [r[0] for r in index_addresses(lines).collect()] == ["https://a.example"]
