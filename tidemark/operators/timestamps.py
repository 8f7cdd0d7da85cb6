"""Mixed timestamp formats and zones, brought to one UTC instant.

Values are parsed on the JVM into local parts. Local times without an offset are joined as of their
zone's offset intervals (exploded by local year): one matching interval gives the offset, two mean that
the local time occurs twice (the first is taken), none that it was skipped (the offset before the change).
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST_YEAR, LAST_YEAR = 1950, 2100  # local years outside take the first or last interval of their zone
DAY_MS = 86_400_000
FAR = 1 << 60

# Month names and their usual short forms by number, lower case.
MONTHS = {
    1: "january jan januar jänner janvier janv enero ene janeiro gennaio gen januari stycznia sty",
    2: "february feb februar février févr fevrier fevereiro fev febrero febbraio februari lutego lut",
    3: "march mar märz maerz mars marzo março marco maart mrt marca marts",
    4: "april apr avril avr abril abr aprile kwietnia kwi",
    5: "may mai mayo maio maggio mag mei maja maj",
    6: "june jun juni juin junio junho giugno giu czerwca cze",
    7: "july jul juli juillet juil julio julho luglio lug lipca lip",
    8: "august aug août aout agosto ago augustus augusti sierpnia sie",
    9: "september sep sept septembre septiembre setembro set settembre września wrz",
    10: "october oct oktober okt octobre octubre outubro out ottobre ott października paź",
    11: "november nov novembre noviembre novembro listopada lis",
    12: "december dec dezember dez décembre déc decembre diciembre dic dezembro dicembre grudnia gru",
}
MONTH_OF = {w: m for m, words in MONTHS.items() for w in words.split()}
WORD = r"[\p{L}]+"
TIME = r"(\d{1,2}(?:[:h]\d{2})(?::\d{2})?(?:[.,]\d+)?)(?: ?(am|pm|a\.m\.|p\.m\.)(?![a-z]))?(?: ?(?:uhr|hrs|h)\b)?"
ZONE = r"([+-]\d{2}(?::?\d{2})?(?:\[[^\]]+\])?|\[[^\]]+\]|z|[a-z]+/[a-z_/+-]+|[a-z]{2,5}(?:[+-]\d{1,2})?)"
TAIL = rf"(?:(?:t|,? (?:(?:à|at|um|a las|alle|às|om|kl\.?|o) )?){TIME}(?: ?{ZONE})?)?"
DAY_WORD = rf"(?:{WORD}\.?,? )?"
#: (pattern, replacement) that brings a value to order|a|b|c|time|half|zone; a, b, c in that order of parts.
SHAPES = [
    (rf"^(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}}){TAIL}$", "ymd|$1|$3|$4|$5|$6|$7"),
    (rf"^(\d{{1,2}})([/.-])(\d{{1,2}})\2(\d{{4}}){TAIL}$", "num|$1|$3|$4|$5|$6|$7"),
    (rf"^{DAY_WORD}(\d{{1,2}})(?:\.|st|nd|rd|th|er|º)?[ -](?:de )?({WORD})\.?(?: de|,)?[ -](\d{{4}}){TAIL}$", "dmy|$1|$2|$3|$4|$5|$6"),
    (rf"^{DAY_WORD}({WORD})\.? (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}}){TAIL}$", "mdy|$1|$2|$3|$4|$5|$6"),
    (rf"^{WORD} ({WORD}) (\d{{1,2}}) (\d{{1,2}}:\d{{2}}(?::\d{{2}})?(?:\.\d+)?)(?: {ZONE})? (\d{{4}})$", "mdy|$1|$2|$5|$3||$4"),
    (r"^(\d{4})(\d{2})(\d{2})t?(\d{2})(\d{2})(\d{2})?(z|[+-]\d{2}:?\d{2})$", "ymd|$1|$2|$3|$4:$5:$6||$7"),
    (r"^(\d{4})(\d{2})(\d{2})t(\d{2})(\d{2})(\d{2})?$", "ymd|$1|$2|$3|$4:$5:$6||"),
]


def zone_names() -> list[str]:
    import zoneinfo

    return sorted(n for n in zoneinfo.available_timezones() if not n.startswith(("posix/", "right/")))


def intervals_of(name: str) -> list[tuple[int, int, int, str]]:
    """(first local ms, local ms after the last, offset ms, abbreviation) of each interval of one zone."""
    import zoneinfo

    zone = zoneinfo.ZoneInfo(name)
    epoch = datetime(1970, 1, 1)

    def at(s: int) -> tuple[int, str]:
        d = (epoch + timedelta(seconds=s)).replace(tzinfo=timezone.utc).astimezone(zone)
        return int(d.utcoffset().total_seconds()), d.tzname()

    step = 28 * 86_400
    start = int((datetime(FIRST_YEAR, 1, 1) - epoch).total_seconds())
    end = int((datetime(LAST_YEAR + 1, 1, 1) - epoch).total_seconds())
    was, began, out = at(start), -FAR, []
    for s in range(start, end, step):
        if (now := at(s + step)) != was:
            lo, hi = s, s + step
            while hi - lo > 1:
                mid = (lo + hi) // 2
                lo, hi = (mid, hi) if at(mid) == was else (lo, mid)
            out.append((began, hi * 1000 + was[0] * 1000, was[0] * 1000, was[1]))
            was, began = at(hi), hi * 1000 + at(hi)[0] * 1000
            if was != now:  # a second change within the step
                for t in range(hi, s + step + 1, 3600):
                    if at(t) != was:
                        out.append((began, t * 1000 + was[0] * 1000, was[0] * 1000, was[1]))
                        was, began = at(t), t * 1000 + at(t)[0] * 1000
    return [*out, (began, FAR, was[0] * 1000, was[1])]


def zone_intervals(zones: DataFrame) -> DataFrame:
    """One row per zone and local year: ``zone`` (lower case), ``year``, ``ivs`` (intervals that touch the year).

    ``zones`` has the wanted names in ``zone``, in any case and with repeats. Names that aren't in the
    time-zone database (about 600 names) drop out, so the result's size is bounded by it and the years
    FIRST_YEAR to LAST_YEAR.
    """
    year0 = {y: int((datetime(y, 1, 1) - datetime(1970, 1, 1)).total_seconds()) * 1000 for y in range(FIRST_YEAR, LAST_YEAR + 2)}

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name in batch["name"]:
                for lo, hi, off, abbr in intervals_of(name):
                    a = FIRST_YEAR if lo == -FAR else max(FIRST_YEAR, 1970 + (lo - DAY_MS) // (366 * DAY_MS) - 1)
                    b = LAST_YEAR if hi == FAR else min(LAST_YEAR, 1970 + (hi + DAY_MS) // (365 * DAY_MS) + 1)
                    for y in range(a, b + 1):
                        if lo - DAY_MS < year0[y + 1] and hi + DAY_MS > year0[y]:
                            rows.append((name.lower(), y, lo, hi, off, abbr.lower()))
            yield pd.DataFrame(rows, columns=["zone", "year", "lo", "hi", "off", "abbr"])

    known = zones.sparkSession.createDataFrame([(n, n.lower()) for n in zone_names()], "name string, zone string")
    wanted = zones.select(F.lower(F.trim("zone")).alias("zone")).distinct()
    names = wanted.join(F.broadcast(known), "zone").select("name")
    flat = names.mapInPandas(expand, "zone string, year int, lo bigint, hi bigint, off bigint, abbr string")
    return flat.groupBy("zone", "year").agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "off", "abbr"))).alias("ivs"))


def cleaned(value: Column) -> Column:
    """Lower case, each run of blanks (also the unusual ones) one space, none at the ends."""
    return F.trim(F.lower(F.regexp_replace(value, r"[\s\u00a0\u2007\u202f\u3000\ufeff]+", " ")))


def _digits(s: Column) -> Column:
    """Milliseconds of Unix time written as digits, by size: seconds, milli-, micro- or nanoseconds."""
    whole = F.regexp_extract(s, r"^(-?\d+)", 1)
    n = F.length(F.regexp_replace(whole, "-", ""))
    v = whole.try_cast("bigint")
    frac = F.rpad(F.substring(F.regexp_extract(s, r"\.(\d+)$", 1), 1, 3), 3, "0").try_cast("bigint")
    def down(d: int) -> Column:
        return F.call_function("div", v - F.pmod(v, F.lit(d).cast("bigint")), F.lit(d).cast("bigint"))

    return F.when(n <= 11, v * 1000 + F.coalesce(frac, F.lit(0))).when(n <= 14, v).when(n <= 17, down(1000)).otherwise(down(1_000_000))


def zones_in(df: DataFrame, value: str, zone: str | None) -> DataFrame:
    """Names of zones that the texts or the column ``zone`` of ``df`` hold."""
    named = df.select(F.regexp_extract(value, r"([A-Za-z]+/[A-Za-z_/+-]+)", 1).alias("zone")).where("zone != ''").distinct()
    return named.unionByName(df.select(F.col(zone).alias("zone")).distinct()) if zone else named


def normalise(df: DataFrame, value: str, out: str = "utc_ms", zone: str | None = None, locale: str | None = None, zones: DataFrame | None = None) -> DataFrame:
    """Add ``out`` BIGINT: the UTC instant of the text column ``value`` in milliseconds, or null.

    ``zone`` and ``locale`` name columns with the zone in which a value without one is local time (UTC where
    null or unknown) and the locale that settles day and month where all is numeric (day first where null,
    but month first with AM or PM). ``zones`` may give the names of all zones that can occur (column ``zone``);
    else they are gathered from ``df``. All other columns are kept, whatever their names; ``out`` is replaced.

    * null, empty, blank, relative and impossible values: null
    * a date alone: 00:00 local; finer digits than milliseconds are dropped
    * a local time that occurs twice: the first; a skipped one: the offset before the change
    * an abbreviation: the offset that the zone has under this name; 'utc', 'gmt' and 'z' are always 0
    * digits alone: YYYYMMDD if eight, else Unix time in the unit its length shows
    * one row in gives one row out: repeated rows stay repeated
    """
    z = lambda c: f"__tm_{c}"
    s = F.col(z("s"))
    work = df.withColumn(z("s"), cleaned(F.col(value).cast("string")))
    work = work.withColumn(z("loc"), F.lower(F.col(locale)) if locale else F.lit(None).cast("string"))
    work = work.withColumn(z("home"), F.lower(F.trim(F.col(zone))) if zone else F.lit(None).cast("string"))
    shaped = F.lit(None).cast("string")
    for pattern, to in reversed(SHAPES):
        shaped = F.when(s.rlike(pattern), F.regexp_replace(s, pattern, to)).otherwise(shaped)
    digits = s.rlike(r"^-?\d{1,20}(?:\.\d+)?$")
    shaped = F.when(digits & (F.length(s) == 8) & ~s.contains("."), F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})$", "ymd|$1|$2|$3|||")).when(digits, F.lit(None).cast("string")).otherwise(shaped)
    work = work.withColumn(z("p"), F.split(shaped, r"\|", -1))
    work = work.withColumn(z("unix"), F.when(digits & ~((F.length(s) == 8) & ~s.contains(".")), _digits(s)))
    p = lambda i: F.get(F.col(z("p")), F.lit(i))
    kind, a, b, c = p(0), p(1), p(2), p(3)
    us = F.when(F.col(z("loc")).rlike(r"[-_](us|ph)$"), True).when(F.col(z("loc")).isNotNull() & (F.col(z("loc")) != ""), False).otherwise(F.length(p(5)) > 0)
    an, bn = a.try_cast("int"), b.try_cast("int")
    month_first = (us & (an <= 12)) | (~us & (bn > 12) & (an <= 12))
    months = F.create_map(*[x for w, m in sorted(MONTH_OF.items()) for x in (F.lit(w), F.lit(m))])
    named_month = F.element_at(months, F.when(kind == "dmy", b).otherwise(a))
    year = F.when(kind == "ymd", an).otherwise(c.try_cast("int"))
    month = F.when(kind == "ymd", bn).when(kind == "num", F.when(month_first, an).otherwise(bn)).otherwise(named_month)
    day = F.when(kind == "ymd", c.try_cast("int")).when(kind == "num", F.when(month_first, bn).otherwise(an)).when(kind == "dmy", an).otherwise(bn)
    work = work.withColumns({z("y"): year, z("mo"): month, z("da"): day, z("t"): F.split(F.translate(p(4), "h,.", ":::"), ":", -1), z("half"): F.substring(p(5), 1, 1), z("zt"): p(6)})
    t, half = F.col(z("t")), F.col(z("half"))
    num = lambda i: F.coalesce(F.get(t, F.lit(i)).try_cast("int"), F.lit(0))
    work = work.withColumns({z("h"): num(0), z("mi"): num(1), z("se"): num(2), z("fr"): F.rpad(F.substring(F.coalesce(F.get(t, F.lit(3)), F.lit("")), 1, 3), 3, "0").try_cast("bigint")})
    h, mi, se = F.col(z("h")), F.col(z("mi")), F.col(z("se"))
    clock = F.when(F.length(half) > 0, F.when(h.between(1, 12), F.pmod(h, F.lit(12)) + F.when(half == "p", 12).otherwise(0))).otherwise(h)
    work = work.withColumns({z("h"): clock, z("d"): F.concat_ws("-", z("y"), F.lpad(F.col(z("mo")).cast("string"), 2, "0"), F.lpad(F.col(z("da")).cast("string"), 2, "0")).try_cast("date")})
    # concat_ws leaves out nulls, so a missing part gives no date; '2025-07' alone would, hence the check of all three.
    whole = F.col(z("y")).isNotNull() & F.col(z("mo")).isNotNull() & F.col(z("da")).isNotNull()
    ok = (mi <= 59) & (se <= 59) & ((h <= 23) | ((h == 24) & (mi == 0) & (se == 0)))
    local = F.when(whole & ok, F.unix_date(F.col(z("d"))).cast("bigint") * DAY_MS + ((h * 60 + mi) * 60 + se).cast("bigint") * 1000 + F.col(z("fr")))
    work = work.withColumn(z("local"), local)
    zt, home = F.col(z("zt")), F.col(z("home"))
    offset = F.regexp_extract(zt, r"^(?:[a-z]{2,4})?([+-]\d{1,2}(?::?\d{2})?)", 1)
    hm = F.rpad(F.regexp_replace(F.regexp_replace(offset, ":", ""), r"^([+-])(\d)$", "$10$2"), 5, "0")
    named = F.regexp_replace(zt, r"[\[\]]", "")
    has_offset = F.length(offset) > 0
    minutes = F.substring(hm, 2, 2).try_cast("int") * 60 + F.substring(hm, 4, 2).try_cast("int")
    work = work.withColumn(
        z("off"),
        F.when(has_offset & (minutes <= 18 * 60), F.when(hm.startswith("-"), -minutes).otherwise(minutes).cast("bigint") * 60_000).when(named.isin("z", "utc", "gmt", "ut", "zulu", "etc/utc"), F.lit(0).cast("bigint")),
    )
    by_name = zt.contains("/") & ~has_offset
    work = work.withColumn(z("zone"), F.when(F.col(z("local")).isNull() | F.col(z("off")).isNotNull(), None).when(by_name, named).otherwise(home))
    work = work.withColumn(z("abbr"), F.when(~by_name & ~has_offset & (F.length(zt) > 0), named))
    work = work.withColumn(z("year"), F.greatest(F.lit(FIRST_YEAR), F.least(F.lit(LAST_YEAR), F.year(z("d")))))
    ivs = zone_intervals(zones if zones is not None else zones_in(df, value, zone)).select(F.col("zone").alias(z("zone")), F.col("year").alias(z("year")), F.col("ivs").alias(z("ivs")))
    work = work.join(F.broadcast(ivs), [z("zone"), z("year")], "left")
    x, i = F.col(z("local")), F.col(z("ivs"))
    inside = lambda v: (v["lo"] <= x) & (x < v["hi"])
    same = F.filter(i, lambda v: v["abbr"] == F.col(z("abbr")))
    work = work.withColumn(z("m"), F.filter(i, inside)).withColumn(z("same"), same)
    hits = F.col(z("m"))
    # Of two intervals the first in time has the larger offset before the clock went back: the earlier instant.
    first = F.array_min(F.transform(hits, lambda v: x - v["off"]))
    before = F.element_at(F.filter(i, lambda v: v["hi"] <= x), -1)["off"]
    named_ones = F.col(z("same"))
    named_hit = F.array_min(F.transform(F.filter(named_ones, inside), lambda v: x - v["off"]))
    by_zone = F.when(F.size(named_ones) > 0, F.coalesce(named_hit, x - F.get(named_ones, F.lit(0))["off"])).when(F.size(hits) > 0, first).when(F.size(i) > 0, x - before)
    got = F.coalesce(F.col(z("unix")), x - F.col(z("off")), by_zone, x)
    keep = [F.col(f"`{n}`") for n in df.columns if n != out]
    return work.select(*keep, got.alias(out))
