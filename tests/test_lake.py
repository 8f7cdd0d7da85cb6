import random

from pyspark.sql import functions as F

from tidemark.operators import crawl, dedupe, lake, pages, reads, tiers

STORE = "b string, k string, v string, w string, first_seen int, last_seen int, is_live boolean, went_dead_at int"


def test_upsert(spark):
    store = spark.createDataFrame([("x", "1", "old", "keep", 1, 1, True, None), ("x", "2", "old", "w", 1, 1, True, None), ("y", "3", "old", "w", 1, 1, True, None), ("x", "4", "old", "w", 1, 1, False, 1)], STORE)
    run = spark.createDataFrame([("x", "1", "", "new"), ("x", "4", "back", "w"), ("z", "5", "fresh", None)], "b string, k string, v string, w string")
    boards = spark.createDataFrame([("x",), ("z",)], "b string")
    got = {r["k"]: r for r in lake.upsert(store, run, ["b", "k"], boards, ["b"], F.lit(2), kept=["w"], filled=["v"]).collect()}
    assert (got["1"]["v"], got["1"]["w"], got["1"]["first_seen"], got["1"]["last_seen"], got["1"]["is_live"]) == ("old", "keep", 1, 2, True)
    assert (got["2"]["is_live"], got["2"]["went_dead_at"]) == (False, 2)  # gone from a complete board
    assert (got["3"]["is_live"], got["3"]["went_dead_at"]) == (True, None)  # its board wasn't read
    assert (got["4"]["v"], got["4"]["is_live"], got["4"]["went_dead_at"]) == ("back", True, 1)  # lives again
    assert (got["5"]["first_seen"], got["5"]["is_live"]) == (2, True)


def test_replay_equals_upserts(spark):
    random.seed(5)
    jobs, boards, runs = "pqrs", "xy", 5
    seen, complete = [], []
    for at in range(1, runs + 1):
        for b in boards:
            if random.random() < 0.7:
                complete.append((b, at))
                seen += [(b, j, at) for j in jobs if random.random() < 0.5]
            elif random.random() < 0.5:  # cut off: rows came, but no proof of absence
                seen += [(b, j, at) for j in jobs if random.random() < 0.3]
    state = spark.createDataFrame([], "b string, j string, first_seen int, last_seen int, is_live boolean, went_dead_at int")
    for at in range(1, runs + 1):
        run = spark.createDataFrame([(b, j) for b, j, t in seen if t == at], "b string, j string")
        read = spark.createDataFrame([(b,) for b, t in complete if t == at], "b string")
        rows = lake.upsert(state, run, ["b", "j"], read, ["b"], F.lit(at)).collect()
        state = spark.createDataFrame(rows, state.schema)
    s = spark.createDataFrame(seen + seen[:3] + [("x", None, 1)], "b string, j string, at int")
    r = spark.createDataFrame(complete, "b string, at int")
    got = lake.replay(s, r, ["b"], "j", "at").collect()
    assert {tuple(x) for x in got} == {tuple(x) for x in state.collect()}


def test_reconcile_absent(spark):
    store = spark.createDataFrame([("a", "1"), ("a", None), ("", "2")], "t string, j string")
    bad = spark.createDataFrame([("a", "1", "r1", 1), ("a", "1", "r2", 2), ("", "2", "r3", 1), ("a", None, "r4", 1)], "t string, j string, reason string, ordinal int")
    got = {(r["t"], r["j"]): r["hidden_reason"] for r in lake.reconcile(store, bad, ["t", "j"], "reason", F.lit("now")).collect()}
    assert got == {("a", "1"): "r2", ("a", None): None, ("", "2"): None}
    assert lake.absent(store, bad.where("j = '1'"), ["t", "j"]).count() == 2


def test_keep_first_last(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a"), (None, 5, "n"), (None, 5, "n")], "k string, o int, `v.w` string")
    assert {tuple(r) for r in dedupe.keep_first(df, ["k"], [F.col("o")]).collect()} == {("k", 1, "a"), (None, 5, "n")}
    assert {tuple(r) for r in dedupe.keep_last(df, ["k"], "o").collect()} == {("k", 2, "b"), (None, 5, "n")}
    marked = dedupe.collapse(df, ["k"], [F.col("o"), F.col("`v.w`")], F.col("`v.w`"))
    assert sorted((r["o"], r["dup_of"] or "") for r in marked.collect()) == [(1, ""), (1, "a"), (2, "a"), (5, ""), (5, "n")]
    assert [r["over_cap"] for r in dedupe.beyond(df, ["k"], [F.col("o")], 1, F.col("o") > 1).orderBy("o").collect()].count(True) == 1


def test_reads_and_pages(spark):
    df = spark.createDataFrame([("e", None, 0), (None, 5, 3), (None, 5, 5), (None, None, 0), (None, None, None)], "error string, reported_total int, n_postings int")
    got = reads.with_outcome(df).collect()
    assert [(r["outcome"], r["complete"]) for r in got] == [("failed", False), ("truncated", False), ("ok", True), ("empty", True), ("empty", True)]
    assert reads.totals(reads.with_outcome(df).withColumn("r", F.lit(1)), ["r"]).first().asDict() == {"r": 1, "boards": 5, "ok": 2, "empty": 2, "failed": 1, "truncated": 1, "postings": 8}
    p = [("ok", 1, 2, 3), ("ok", 2, 1, 3), ("short", 1, 2, 3), ("gap", 1, 2, 4), ("gap", 3, 2, 4), ("twice", 1, 2, 4), ("twice", 1, 2, 4), ("drift", 1, 2, 4), ("drift", 2, 2, 5), ("none", 1, 2, None)]
    got = {r["b"]: r["error"] for r in reads.page_check(spark.createDataFrame(p, "b string, page int, n int, total int"), ["b"], "page", "n", "total").collect()}
    assert got == {"ok": None, "short": "partial_at_2", "gap": "page_missing", "twice": "page_repeated", "drift": "unstable_total", "none": "no_total"}


def test_robots(spark):
    text = "# c\nUser-agent: *\nDisallow: /\nAllow: /careers\n\nUser-agent: Bot\nUser-agent: other\nDisallow: /a*b$\nDisallow:\nCrawl-delay: 3\n"
    files = spark.createDataFrame([("h1", 200, text), ("h2", 404, None), ("h3", 503, None), ("h4", None, None)], "origin string, status int, text string")
    rules = crawl.robots_rules(files)
    paths = spark.createDataFrame([("h1", "/careers/x"), ("h1", "/other"), ("h2", "/x"), ("h3", "/x"), ("h4", "/x"), ("h5", "/x"), ("h1", "/aXb"), ("h1", "/aXbc"), ("h1", "/other")], "origin string, path string")
    got = [(r["origin"], r["path"], r["allowed"]) for r in crawl.allowed(paths, rules, "nobody").collect()]
    assert sorted(got) == sorted([("h1", "/careers/x", True), ("h1", "/other", False), ("h1", "/other", False), ("h1", "/aXb", False), ("h1", "/aXbc", False), ("h2", "/x", True), ("h3", "/x", False), ("h4", "/x", False), ("h5", "/x", True)])
    own = {(r["origin"], r["path"]): r["allowed"] for r in crawl.allowed(paths, rules, "bot").collect()}
    assert own["h1", "/other"] and not own["h1", "/aXb"] and own["h1", "/aXbc"]


def test_tiers_and_gate(spark):
    t = spark.createDataFrame([(0, 0, 0), (3, 1, 2), (3, 0, 2), (0, 0, 2)], "t int, r int, s int")
    assert [r[0] for r in t.select(tiers.tier(F.col("t"), F.col("r"), F.col("s"))).collect()] == ["cold", "hot", "warm", "cold"]
    assert [r[0] for r in t.select(tiers.board_yield(F.col("t"), F.col("s"))).collect()] == [None, 1.5, 1.5, 0.0]
    now = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", None), ("d", "4")], "u string, h string")
    state = spark.createDataFrame([("a", "1"), ("b", "9"), ("c", "3")], "u string, h string")
    assert {r["u"]: r["outcome"] for r in pages.gate(now, state, "u", "h").collect()} == {"a": "unchanged", "b": "changed", "c": "failed", "d": "new"}


def test_every_run_is_merged(spark, tmp_path):
    from tidemark.queries_lake import QUERIES

    runs = [(f"r{n}", "l", n) for n in range(1, 6)]
    # k closes in run 2, lives again in 3 without a title, and closes in 4; m enters in 5.
    posts = [("r1", "p", "t", "k", "Cook", 1), ("r1", "p", "t", "o", "Other", 2), ("r2", "p", "t", "o", "Other", 3), ("r3", "p", "t", "k", "", 4), ("r3", "p", "t", "o", "Renamed", 5), ("r4", "p", "t", "o", "", 6), ("r5", "p", "t", "m", "New", 7)]
    read = [(f"r{n}", "p", "t", 200, "cut" if n == 5 else None, None, 2, None) for n in range(1, 6)]
    for name, rows, schema in (("runs", runs, "run_id string, lane string, run_no int"), ("postings", posts, "run_id string, platform string, token string, job_id string, title string, ordinal bigint"),
                               ("board_reads", read, "run_id string, platform string, token string, status int, error string, reported_total int, n_postings int, extra string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {(r["job_id"], r["title"], *[r[c] for c in lake.LIFE]) for r in QUERIES["lake_upsert_all"](spark, str(tmp_path)).collect()}
    assert got == {("K", "Cook", 1, 3, False, 4), ("O", "Renamed", 1, 4, True, None), ("M", "New", 5, 5, True, None)}
    assert {(j, *life) for j, _, *life in got} == {(r["job_id"], *[r[c] for c in lake.LIFE]) for r in QUERIES["lake_history"](spark, str(tmp_path)).collect()}
