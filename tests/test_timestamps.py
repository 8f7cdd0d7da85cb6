from datetime import datetime, timezone

import pytest

from tidemark.operators.timestamps import intervals_of, normalise


def ms(*parts, tz=timezone.utc):
    return int(datetime(*parts, tzinfo=tz).timestamp() * 1000)


CASES = [  # value, zone, locale, expected
    ("2025-03-09", "America/New_York", None, ms(2025, 3, 9, 5)),
    ("2025-11-02 01:30", "America/New_York", None, ms(2025, 11, 2, 5, 30)),  # twice: the first
    ("2025-03-09 02:30", "America/New_York", None, ms(2025, 3, 9, 7, 30)),  # skipped: the offset before
    ("Sun, 2 Nov 2025 01:30:00 EST", "America/New_York", None, ms(2025, 11, 2, 6, 30)),
    ("2025-11-02T01:30-05:00[America/New_York]", None, None, ms(2025, 11, 2, 6, 30)),
    ("2026-01-23 02:25:06 America/Chicago", "UTC", None, ms(2026, 1, 23, 8, 25, 6)),
    ("03/04/2025 10:00", "Asia/Kolkata", "en-IN", ms(2025, 4, 3, 4, 30)),
    ("03/04/2025", None, "en-US", ms(2025, 3, 4)),
    ("1/21/2026 5:55 PM", None, None, ms(2026, 1, 21, 17, 55)),
    ("22.01.2026, 11:29 Uhr", "Europe/Berlin", "de-DE", ms(2026, 1, 22, 10, 29)),
    ("21 décembre 2025 à 23h42", "Europe/Paris", "fr-FR", ms(2025, 12, 21, 22, 42)),
    ("13. März 2026", "Europe/Berlin", None, ms(2026, 3, 12, 23)),
    ("Mon Jul 21 02:19:51 2025", None, None, ms(2025, 7, 21, 2, 19, 51)),
    ("20250722T035737Z", "Asia/Kolkata", None, ms(2025, 7, 22, 3, 57, 37)),
    ("20260313", "UTC", None, ms(2026, 3, 13)),
    ("1767643088.823", None, None, 1767643088823),
    ("1747834861068098838", None, None, 1747834861068),
    (" 2025-09-20T10:21:49,416+05:30 ", None, None, ms(2025, 9, 20, 4, 51, 49) + 416),
    ("2025-09-13t01:38:32z", None, None, ms(2025, 9, 13, 1, 38, 32)),
    ("2026-2-2 7:05", "Nowhere/Zone", None, ms(2026, 2, 2, 7, 5)),
    ("2026-02-30", None, None, None), ("2026-13-05T00:00:00Z", None, None, None), ("0000-00-00", None, None, None), ("25:00", None, None, None), ("2025-07", None, None, None),
    ("Posted 30+ Days Ago", None, None, None), ("", "UTC", "en-US", None), ("   ", None, None, None), (None, None, None, None), ("x" * 20000, None, None, None),
]


def test_formats_and_zones(spark):
    # Clashing and unusual column names must survive.
    df = spark.createDataFrame([(i, v, z, l, "kept") for i, (v, z, l, _) in enumerate(CASES)], "year int, v string, zone string, locale string, `a.b` string")
    got = {r["year"]: r for r in normalise(df, "v", "utc_ms", "zone", "locale").collect()}
    assert len(got) == len(CASES)
    for i, (v, z, _, want) in enumerate(CASES):
        assert got[i]["utc_ms"] == want, (v, z, got[i]["utc_ms"], want)
    assert got[0]["a.b"] == "kept"


def test_repeated_and_empty(spark):
    df = spark.createDataFrame([("2025-01-01",), ("2025-01-01",)], "v string")
    assert [r["utc_ms"] for r in normalise(df, "v").collect()] == [ms(2025, 1, 1)] * 2
    assert normalise(df.limit(0), "v").count() == 0


@pytest.mark.parametrize("zone", ["Europe/Paris", "Australia/Sydney", "Asia/Kolkata", "Africa/Casablanca"])
def test_intervals_agree_with_library(zone):
    from zoneinfo import ZoneInfo

    z = ZoneInfo(zone)
    for lo, hi, off, abbr in intervals_of(zone):
        for local in (max(lo, ms(1990, 1, 1)) + 3_600_000, min(hi, ms(2030, 1, 1)) - 3_600_000):
            if lo < local < hi:
                at = datetime.fromtimestamp((local - off) / 1000, z)
                assert (at.utcoffset().total_seconds() * 1000, at.tzname()) == (off, abbr)
