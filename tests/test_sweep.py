from pyspark.sql import functions as F

from tidemark.plans.sweep import sweep

ANSWERS = "platform string, token string, page int, payload string"


def job(i, total, text="x"):
    return '{"jobs": [%s], "meta": {"total": %d}}' % (", ".join('{"id": %d, "title": "T%d", "absolute_url": "https://x.example/%d/", "content": "%s"}' % (k, k, k, text) for k in i), total)


def test_two_sweeps(spark):
    one = sweep(spark.createDataFrame([("greenhouse", "a", 1, job([1, 2], 2)), ("greenhouse", "b", 1, job([3, 4], 2))], ANSWERS), None, F.lit(1))
    assert one.store.count() == 4 and one.report.first()["ok"] == 2
    rows = spark.createDataFrame(one.store.collect(), one.store.schema)
    # a: job 2 is gone; b: cut short, so nothing may close.
    two = sweep(spark.createDataFrame([("greenhouse", "a", 1, job([1, 1], 2, "")), ("greenhouse", "b", 1, job([3], 2)), ("greenhouse", "c", 1, "broken")], ANSWERS), rows, F.lit(2))
    got = {r["key"]: r for r in two.store.collect()}
    assert {k: r["is_live"] for k, r in got.items()} == {"https://x.example/1": True, "https://x.example/2": False, "https://x.example/3": True, "https://x.example/4": True}
    assert got["https://x.example/1"]["description"] == "x" and got["https://x.example/1"]["last_seen"] == 2 and got["https://x.example/2"]["went_dead_at"] == 2
    assert {r["token"]: r["outcome"] for r in two.reads.collect()} == {"a": "ok", "b": "truncated", "c": "failed"}
