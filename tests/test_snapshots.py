import random

from tidemark.operators.snapshots import diff_snapshots, squeezed


def brute(rows, pairs):
    first = {}
    for s, k, v, w, o in rows:
        if s is not None and k is not None and ((s, k) not in first or o < first[s, k][0]):
            first[s, k] = (o, v, w)
    out = set()
    for s, b in pairs:
        if b is None:
            continue
        for k in {x for t, x in first if t in (s, b)}:
            n, o = first.get((s, k)), first.get((b, k))
            if n is None or o is None:
                out.add((s, k, "removed" if n is None else "added"))
            elif any(p is not None and q is not None and p != q for p, q in zip(n[1:], o[1:])):
                out.add((s, k, "changed"))
    return out


def test_diff_against_brute_force(spark):
    random.seed(3)
    rows = [(s, random.choice([None, *"abcdefghijklmnop"]), random.choice([None, "x", "y"]), random.choice(["u", "v"]), n) for n, s in enumerate(random.choices([1, 2, 3, 4, 9], k=300))]
    rows += rows[:20]  # exact copies
    pairs = [(2, 1), (3, 2), (4, 3), (1, None), (5, 4)]  # 5 is an empty snapshot
    df = spark.createDataFrame(rows, "s int, k string, change string, w string, o int")
    got = diff_snapshots(df, spark.createDataFrame(pairs, "s int, before int"), "s", "before", ["k"], ["change", "w"], "o").collect()
    assert len(got) == len({(r["s"], r["k"]) for r in got})
    assert {tuple(r) for r in got} == brute(rows, pairs)


def test_empty(spark):
    df = spark.createDataFrame([], "s int, k string, v string, o int")
    pairs = spark.createDataFrame([(2, 1)], "s int, before int")
    assert diff_snapshots(df, pairs, "s", "before", ["k"], ["v"], "o").count() == 0


def test_squeezed(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(" a \t\n b ",), ("   ",), (None,), ("",)], "v string")
    assert [r[0] for r in df.select(squeezed(F.col("v"))).collect()] == ["a b", None, None, None]
