import random
from collections import defaultdict

from tidemark.llm.capping import over_cap


def test_against_brute_force(spark):
    random.seed(1)
    rows = [(random.choice(["r1", "r2"]), random.choice(["hot"] * 8 + ["a", "b", None]), random.choice([None, 1, 2, 3]), i, 3 if i % 2 < 2 else 0, "x") for i in range(400)]
    df = spark.createDataFrame(rows, "run string, who string, q int, o int, most int, rank string")
    groups = defaultdict(list)
    for run, who, q, o, *_ in rows:
        groups[run, who].append((-(q if q is not None else -1), o))
    want = {o for g in groups.values() for _, o in sorted(g)[3:]}
    got = over_cap(df.drop("rank"), ["run", "who"], "most", "q", "o").collect()
    assert {r["o"] for r in got} == want and len(got) == len(want)
    assert min(r["rank"] for r in got) == 4


def test_ties_nulls_empty(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 5), ("a", 1, 6), ("a", None, None)], "c string, q int, t int")
    assert [(r["t"], r["rank"]) for r in over_cap(df, ["c"], 2, "q", "t").orderBy("rank").collect()] == [(6, 3), (None, 4)]
    assert over_cap(df.limit(0), ["c"], 2, "q", "t").count() == 0
    assert over_cap(df, ["c"], 10, "q", "t").count() == 0
