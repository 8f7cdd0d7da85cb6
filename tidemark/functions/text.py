"""Column functions on text and markup: visible text, text that is stable between fetches, hashes, quotes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Elements that hold no text to read, and elements that stand on lines of their own.
SILENT = ["head", "iframe", "noscript", "script", "style", "svg", "template"]
LINED = ["article", "blockquote", "br", "dd", "div", "dt", "footer", "h1", "h2", "h3", "h4", "h5", "h6", "header", "li", "nav", "ol", "option", "p", "section", "table", "tr", "ul"]
# The entities that are decoded on the JVM; texts with any other go through decode_entities.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"), ("&ndash;", "–"), ("&mdash;", "—"), ("&hellip;", "…"), ("&amp;", "&")]
# What else can be an entity, at once or after '&amp;' is decoded; such texts are decoded whole, so that nothing is decoded twice.
OTHER = r"&(?:amp;)*(?!(?:" + "|".join(e[1:-1] for e, _ in ENTITIES) + r");)(?:#[0-9xX]|[A-Za-z])"
# What Python's \s and str.split() take for a blank, more than \s here.
BLANK = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
# Lines of every page that say nothing of this one. Each is a lead and what may follow it; a line is idle if it is one of these as a whole.
IDLE = {
    "accept": ["", " all", " cookies", " all cookies"], "cookie": [" policy", " settings", " preferences"], "manage": [" cookies", " preferences"], "privacy": [" policy"], "terms": [" of use", " of service"],
    "skip to": [" content", " main content"], "sign": [" in"], "log": [" in"], "menu": [""], "search": [""],
}
#: A line that begins so is idle whatever follows.
IDLE_LEAD = "we use cookies"
HEX = "[0-9a-fA-F]"
#: What a server puts into every answer anew, as (from, to) lengths of runs and what they are runs of.
RUNS = [(32, 64, HEX), (10, 13, r"\d")]
GROUPS = (8, 4, 4, 4, 12)  # hex digits of a UUID
# Names of query parameters that only keep caches from answering.
BUSTERS = ["_", "cb", "t", "ts", "v"]


def volatile() -> str:
    """One regex of all that differs between two fetches of an unchanged page."""
    runs = [rf"\b{what}{{{a},{b}}}\b" for a, b, what in RUNS]
    uuid = r"\b" + "-".join(f"{HEX}{{{n}}}" for n in GROUPS) + r"\b"
    instant = r"\b\d{4}(?:-\d{2}){2}T[\d:.]+Z?\b"
    buster = rf"\?(?i:{'|'.join(BUSTERS)})=[\w.-]+"
    return "|".join([uuid, runs[0], instant, runs[1], buster])


def truthy(c: Column) -> Column:
    """``c``, or null where it is the empty string."""
    return F.when(c != "", c)


def one_line(c: Column) -> Column:
    """Trimmed, each run of blanks one space; '' for null."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), BLANK + "+", " "))


def unescape(c: Column) -> Column:
    """Entities decoded once: only common ones in a chain of literal replacements, '&amp;' last; else by decode_entities."""
    return F.when(F.contains(c, F.lit("&")), F.coalesce(decode_entities(F.when(c.rlike(OTHER), c)), common(c))).otherwise(c)


def common(c: Column) -> Column:
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


@F.pandas_udf(StringType())
def decode_entities(s: pd.Series) -> pd.Series:
    """Every HTML entity, for texts that need more than the common ones."""
    import html

    return s.map(html.unescape, na_action="ignore")


def strip_html(c: Column) -> Column:
    """Markup removed in one line: decoded, tags to blanks, decoded again; '' for null."""
    decoded = lambda t: F.when(F.contains(t, F.lit("&")), common(t)).otherwise(t)
    text = F.coalesce(c, F.lit(""))
    tagless = F.regexp_replace(decoded(text), r"<[^>]+>", " ")
    return one_line(F.coalesce(strip_entities(F.when(text.rlike(OTHER), text)), decoded(tagless)))


@F.pandas_udf(StringType())
def strip_entities(s: pd.Series) -> pd.Series:
    """strip_html() for texts with any HTML entity; blanks stay."""
    import html
    import re

    return s.map(lambda t: html.unescape(re.sub(r"<[^>]+>", " ", html.unescape(t))), na_action="ignore")


def visible_text(c: Column) -> Column:
    """What a reader sees, in lines without blank ones; '' for null.

    Comments and silent elements go first, in one pass; of a silent element that never ends its tag goes
    alone. Then the elements of LINED break lines, other tags part words, and entities are decoded.
    """
    silent = "|".join(SILENT)
    heard = F.regexp_replace(F.coalesce(c, F.lit("")), rf"(?is)<!--.*?-->|<({silent})\b[^>]*>.*?</\1\s*>", " ")
    parted = F.regexp_replace(F.regexp_replace(heard, rf"(?i)</?(?:{'|'.join(LINED)})\b[^>]*>", "\n"), r"<[^>]+>", " ")
    lines = F.transform(F.split(unescape(parted), "\n"), one_line)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def idle(line: Column) -> Column:
    """Whether a line is one that every page has."""
    t = F.lower(line)
    whole = [lead + rest for lead, more in IDLE.items() for rest in more]
    return t.isin(whole) | t.startswith(IDLE_LEAD)


def stable_text(c: Column) -> Column:
    """Visible text without idle lines and what differs from fetch to fetch, in one line."""
    told = F.filter(F.split(visible_text(c), "\n"), lambda x: ~idle(x))
    return one_line(F.regexp_replace(F.array_join(told, "\n"), volatile(), ""))


def content_hash(c: Column) -> Column:
    """SHA-256 of the stable text: equal hashes mean that nothing changed for a reader."""
    return F.sha2(stable_text(c), 256)


def cache_key(url: Column, body: Column | None = None) -> Column:
    """Key of a request: SHA-256 of the address, with a NUL and the body if there is one."""
    whole = url if body is None else F.when(body.isNull(), url).otherwise(F.concat(url, F.lit("\0"), body))
    return F.sha2(whole, 256)


def short_key(url: Column) -> Column:
    """First 16 hex digits of the address's SHA-256."""
    return F.substring(F.sha2(url, 256), 1, 16)


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Compatibility forms made plain (Unicode NFKC)."""
    import unicodedata

    return s.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


@F.pandas_udf(ArrayType(StringType()))
def nfkc_each(s: pd.Series) -> pd.Series:
    """nfkc() of each text of an array."""
    import unicodedata

    return s.map(lambda a: [None if t is None else unicodedata.normalize("NFKC", t) for t in a], na_action="ignore")


def plain_form(c: Column) -> Column:
    """Quotes and dashes made plain, one line, lower case; '' for null."""
    t = F.translate(F.coalesce(c, F.lit("")), "‘’‚‛“”„‟‐‑‒–—―− ", "''''\"\"\"\"------- ")
    return F.lower(one_line(t))


def for_match(c: Column) -> Column:
    """NFKC, quotes and dashes made plain, one line, lower case. Only texts that aren't plain ASCII leave the JVM."""
    return plain_form(F.coalesce(nfkc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c))


def quoted_in(quote: Column, page: Column, least: int = 12) -> Column:
    """Whether ``quote``, at least ``least`` characters long, stands on the page word for word; false for nulls."""
    q = for_match(quote)
    return (F.length(q) >= least) & F.contains(for_match(page), q)


def evidence_kept(evidence: Column, page: Column, least: int = 12) -> Column:
    """Entries of a map of quotes that stand on the page; an empty map for null."""
    entries = F.coalesce(F.map_entries(evidence), F.array().cast("array<struct<key:string,value:string>>"))
    forms = F.transform(nfkc_each(F.transform(entries, lambda e: e["value"])), plain_form)
    # The page goes beside each entry, as no lambda may hold a Python function.
    rows = F.arrays_zip(entries, forms, F.array_repeat(for_match(page), F.size(entries)))
    kept = F.filter(rows, lambda x: (F.length(x["1"]) >= least) & F.contains(x["2"], x["1"]))
    return F.map_from_entries(F.transform(kept, lambda x: x["0"]))


def years_named(c: Column, first: int = 2020, last: int = 2035) -> Column:
    """Sorted distinct years that a text names, ranges such as '2025-2027' filled; [] for null."""
    text = F.coalesce(c, F.lit(""))
    ranges = F.regexp_extract_all(text, F.lit(rf"\b((?:19|20|21)\d{{2}}{BLANK}*[-–—]{BLANK}*(?:19|20|21)\d{{2}})\b"), F.lit(1))
    filled = F.transform(
        ranges,
        lambda r: F.when(
            F.substring(r, -4, 4).cast("int").between(F.substring(r, 1, 4).cast("int"), F.substring(r, 1, 4).cast("int") + 20),
            F.sequence(F.substring(r, 1, 4).cast("int"), F.greatest(F.substring(r, -4, 4).cast("int"), F.substring(r, 1, 4).cast("int"))),
        ).otherwise(F.array().cast("array<int>")),
    )
    singles = F.transform(F.regexp_extract_all(text, F.lit(r"\b((?:19|20|21)\d{2})\b"), F.lit(1)), lambda y: y.cast("int"))
    return F.filter(F.array_sort(F.array_distinct(F.concat(F.flatten(filled), singles))), lambda y: y.between(first, last))
