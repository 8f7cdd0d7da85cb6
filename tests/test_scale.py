import pytest
from pyspark.sql import functions as F

from tidemark import scale


@pytest.mark.parametrize("limit", [0, 100])
@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_guarded_join_same_either_way(spark, how, limit):
    big = spark.createDataFrame([("hot", i) for i in range(50)] + [("b", 1), (None, 2), ("zz", 3)], "k string, v int")
    small = spark.createDataFrame([("hot", "x"), ("b", "y"), (None, "n")], "k string, w string")
    want = sorted(map(str, big.join(small, ["k"], how).collect()))
    assert sorted(map(str, scale.guarded_join(big, small, ["k"], how, "v", limit).collect())) == want


def test_counted_weighs(spark, monkeypatch):
    df = spark.range(10).select(F.repeat(F.lit("x"), 100).alias("s"))
    assert scale.counted(df) and not scale.counted(df, 9)
    monkeypatch.setattr(scale, "BROADCAST_BYTES", 500)
    assert not scale.counted(df) and scale.counted(df.limit(0))


def test_nothing_else_imports_llm():
    from pathlib import Path

    root = Path(scale.__file__).parent
    for p in root.rglob("*.py"):
        if root / "llm" not in p.parents:
            assert "tidemark.llm" not in p.read_text(), p
