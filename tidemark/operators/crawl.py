"""Crawling manners as data: rules of robots files, gaps between requests, pauses after refusals, outcomes of requests."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DELAY, LONGEST_DELAY = 1.0, 10.0  # seconds between requests to a host: the least, and the most that is honoured
PAUSE = 900.0  # seconds without requests after a refusal, at least
RULES = "origin string, agent string, allow boolean, pattern string, crawl_delay double"


def parse_rules(text: str) -> list[tuple[str, bool | None, str | None, float | None]]:
    """(agent, allow, pattern, delay) for each directive of a robots file; a delay's row has no pattern.

    Agents named in a row share the directives after them; a directive or blank line ends the row. Empty
    patterns say nothing; comments and directives before any agent are ignored; a group without directives
    gives one row of nulls, so that it still is a group.
    """
    from urllib.parse import unquote

    out: list[tuple[str, bool | None, str | None, float | None]] = []
    agents: list[str] = []
    open_row = False
    for raw in text.splitlines():
        line = raw.partition("#")[0].strip()
        name, colon, value = (x.strip() for x in line.partition(":"))
        if not line:
            open_row = False
        elif colon and name.lower() == "user-agent":
            agents = [*agents, value.lower()] if open_row else [value.lower()]
            open_row = True
            out.append((value.lower(), None, None, None))
        elif colon and agents:
            open_row = False
            if name.lower() in ("allow", "disallow") and value:
                out += [(a, name.lower() == "allow", unquote(value), None) for a in agents]
            elif name.lower() == "crawl-delay":
                try:
                    out += [(a, None, None, float(value)) for a in agents]
                except ValueError:
                    pass
    return out


def robots_rules(files: DataFrame) -> DataFrame:
    """Rules of robots files. ``files``: origin, status INT, text. Status decides where there is no text to parse:

    2xx is parsed, any 4xx allows all (no rules), anything else or null denies all (agent '*', pattern '/').
    """

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for origin, status, text in zip(batch["origin"], batch["status"], batch["text"], strict=True):
                if status == status and status is not None and 200 <= status < 300:
                    rows += [(origin, *r) for r in parse_rules(text or "")]
                elif not (status == status and status is not None and 400 <= status < 500):
                    rows.append((origin, "*", False, "/", None))
            yield pd.DataFrame(rows, columns=["origin", "agent", "allow", "pattern", "crawl_delay"])

    return files.select("origin", "status", "text").mapInPandas(take, RULES)


def pattern_regex(pattern: Column) -> Column:
    """Regex of a path pattern: '*' is any run of characters, a closing '$' ends the path, all else is literal."""
    end = pattern.endswith("$")
    body = F.when(end, F.substr(pattern, F.lit(1), F.length(pattern) - 1)).otherwise(pattern)
    quoted = F.regexp_replace(body, r"([\\.\[\]{}()+?^$|])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(quoted, F.lit("*"), F.lit(".*")), F.when(end, "$").otherwise(""))


def allowed(paths: DataFrame, rules: DataFrame, agent: str, origin: str = "origin", path: str = "path") -> DataFrame:
    """Add ``allowed`` to each row of ``paths``.

    The group that names ``agent`` is used alone, else that of '*'. The longest matching pattern decides,
    allow wins ties, no match allows. The join is on the origin; a row is aggregated over its origin's rules
    before anything else joins it, so rows equal in origin and path are decided once.
    """
    named = rules.where(F.lower("agent").isin(agent.lower(), "*"))
    own = F.max(F.when(F.lower("agent") == agent.lower(), 1).otherwise(0)).over(W.partitionBy("origin"))
    active = named.withColumn("__tm_own", own).where((F.col("__tm_own") == 0) | (F.lower("agent") == agent.lower())).where("pattern IS NOT NULL")
    active = active.groupBy("origin").agg(F.collect_set(F.struct(pattern_regex(F.col("pattern")).alias("rx"), F.length("pattern").alias("n"), F.col("allow").alias("ok"))).alias("__tm_rules"))
    each = paths.select(F.col(origin).alias("origin"), F.col(path).alias("path")).distinct().join(active, "origin", "left")
    hit = F.filter(F.coalesce("__tm_rules", F.array().cast("array<struct<rx:string,n:int,ok:boolean>>")), lambda r: F.coalesce(F.rlike(F.col("path"), r["rx"]), F.lit(False)))
    longest = lambda ok: F.coalesce(F.array_max(F.transform(F.filter(hit, lambda r: r["ok"] == F.lit(ok)), lambda r: r["n"])), F.lit(-1))
    each = each.select(F.col("origin").alias(origin), F.col("path").alias(path), ((longest(False) < 0) | (longest(True) >= longest(False))).alias("allowed"))
    return paths.join(each, (paths[origin].eqNullSafe(each[origin])) & (paths[path].eqNullSafe(each[path])), "left").drop(each[origin]).drop(each[path])


def crawl_delay(delay: Column) -> Column:
    """Seconds between requests: the wish of the host, but no less than DELAY and no more than LONGEST_DELAY."""
    return F.when(delay.isNull(), F.lit(DELAY)).otherwise(F.greatest(F.lit(DELAY), F.least(delay, F.lit(LONGEST_DELAY))))


def gaps(requests: DataFrame, host: str, at: str, delay: float, tie: str) -> DataFrame:
    """Add ``gap`` (microseconds since the host's request before) and ``wait`` (those that were missing to ``delay`` seconds)."""
    w = W.partitionBy(host).orderBy(at, tie)
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    least = F.lit(int(delay * 1_000_000)).cast("bigint")
    gap = micros(F.col(at)) - micros(F.lag(at).over(w))
    return requests.withColumn("gap", gap).withColumn("wait", F.greatest(F.lit(0).cast("bigint"), least - F.coalesce("gap", least)))


def penalties(requests: DataFrame, host: str, at: str, refused: Column, retry_after: Column, tie: str) -> DataFrame:
    """Add ``until``: the time in seconds before which the host is to be left alone, as known at each request.

    A refusal asks for max(PAUSE, retry_after) seconds; a pause is only ever prolonged. Null before any refusal.
    """
    now = F.col(at)
    ask = F.when(refused, now + F.greatest(F.lit(PAUSE), F.coalesce(retry_after, F.lit(0.0))))
    w = W.partitionBy(host).orderBy(at, tie).rowsBetween(W.unboundedPreceding, 0)
    return requests.withColumn("until", F.max(ask).over(w))


def request_outcome(cached: Column, robots_ok: Column, paused: Column, offline: Column, status: Column, is_json: Column) -> Column:
    """What a request comes to, null if it is read: the first gate that stops it gives the name."""
    return (
        F.when(cached, F.lit(None).cast("string")).when(~robots_ok, "robots_disallow").when(paused, "rate_limited").when(offline, "offline_cache_miss")
        .when(status.isNull(), "network_error").when(status >= 400, F.concat(F.lit("http_"), status.cast("string"))).when(~is_json, "non_json_response")
    )


RETRIES = 3  # attempts at a request in all
TRANSIENT = (502, 503, 504)  # answers after which a request is tried again, as after none at all


def settled(attempts: DataFrame, by: list[str], attempt: str, status: str, is_json: str | None = None) -> DataFrame:
    """What each request came to: ``by``, ``attempts``, ``status``, ``error`` (null if it was read).

    Attempts are numbered from 1; a null status is a failed transport. The first attempt that isn't transient
    ends a request, as does the last of RETRIES; what is recorded after that plays no part. A refusal (429)
    is never tried again. Errors: 'network_error', 'rate_limited_429', 'http_N', 'non_json_response'.
    """
    again = F.col(status).isNull() | F.col(status).isin(*TRANSIENT)
    good = F.col(status).between(200, 299)
    broken = ~F.coalesce(F.col(is_json), F.lit(False)) if is_json else F.lit(False)
    error = F.when(F.col(status).isNull(), "network_error").when(F.col(status) == 429, "rate_limited_429").when(~good, F.concat(F.lit("http_"), F.col(status).cast("string"))).when(broken, "non_json_response")
    made = F.struct(F.col(attempt).alias("attempt"), F.col(status).alias("status"), error.alias("error"))
    rows = attempts.where(F.col(attempt) <= RETRIES)
    got = rows.groupBy(*by).agg(F.min(F.when(~again, made)).alias("end"), F.max(made).alias("last"))
    end = F.coalesce("end", "last")
    return got.select(*by, end["attempt"].alias("attempts"), end["status"].alias("status"), end["error"].alias("error"))


FRESH_HOURS = 6  # how long the rules of a robots file hold


def rules_due(origins: DataFrame, known: DataFrame, now: Column, hours: int = FRESH_HOURS) -> DataFrame:
    """Add ``due`` to origins: whether their robots file must be read again, as it never was or ``hours`` ago or more.

    ``known``: origin, fetched_at; the latest of several counts.
    """
    latest = known.groupBy("origin").agg(F.max("fetched_at").alias("__tm_at"))
    old = F.col("__tm_at").isNull() | (now >= F.col("__tm_at") + F.make_dt_interval(F.lit(0), F.lit(hours)))
    return origins.join(latest, "origin", "left").withColumn("due", old).drop("__tm_at")


def penalty_report(requests: DataFrame, host: str, at: str, refused: Column, retry_after: Column, now: float) -> DataFrame:
    """Hosts that are to be left alone at ``now``: ``host``, ``until``, ``left`` (seconds). A pause is only ever prolonged."""
    ask = F.when(refused, F.col(at) + F.greatest(F.lit(PAUSE), F.coalesce(retry_after, F.lit(0.0))))
    got = requests.where(F.col(at) <= now).groupBy(F.col(host).alias("host")).agg(F.max(ask).alias("until"))
    return got.where(F.col("until") > now).withColumn("left", F.col("until") - F.lit(now))


def why_denied(allowed_: Column, status: Column) -> Column:
    """The reason that goes with allowed(): null if allowed, else whether the robots file forbids or couldn't be had."""
    had = F.coalesce(status.between(200, 499), F.lit(False))
    return F.when(~allowed_, F.when(had, "robots_disallow").otherwise(F.concat(F.lit("robots_unreachable_"), F.coalesce(status.cast("string"), F.lit("none")))))
