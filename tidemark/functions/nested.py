"""Column functions on JSON of any depth: values under keys, years, places; and quotes with their place in a text."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

YEAR, DASH = r"(?:19|20|21)\d{2}", r"\s*[-–—]\s*"
FIRST_YEAR, LAST_YEAR, WIDEST = 1900, 2100, 20


def parsed(text: str | None):
    """The value of a JSON text, None for null and broken ones."""
    try:
        return json.loads(text) if text is not None else None
    except (ValueError, RecursionError):
        return None


def walk(value, keys: frozenset[str]) -> list:
    """Values under any of ``keys`` (lower case) at any depth, in the order of the text."""
    out, todo = [], [value]
    while todo:  # a stack in reverse keeps the order without recursion
        at = todo.pop()
        if isinstance(at, tuple):
            out.append(at[0])
        elif isinstance(at, dict):
            for k, v in reversed(at.items()):
                todo.append(v)
                if str(k).lower() in keys:
                    todo.append((v,))
        elif isinstance(at, list):
            todo += reversed(at)
    return out


def years_in(value) -> list[int]:
    """Years that a number, text or list names, ranges of at most WIDEST years filled first, each once; a truth value names none."""
    if isinstance(value, bool):
        return []
    if isinstance(value, int):
        named = [value]
    elif isinstance(value, str):
        spans = [(int(a), int(b)) for a, b in re.findall(rf"\b({YEAR}){DASH}({YEAR})\b", value)]
        named = [y for a, b in spans if a <= b <= a + WIDEST for y in range(a, b + 1)]
        named += [int(y) for y in re.findall(rf"\b{YEAR}\b", re.sub(rf"\b{YEAR}{DASH}{YEAR}\b", "", value))]
    elif isinstance(value, list):
        named = [y for v in value for y in years_in(v)]
    else:
        named = []
    return [y for y in dict.fromkeys(named) if FIRST_YEAR <= y <= LAST_YEAR]


def nested_values(c: Column, *keys: str) -> Column:
    """JSON texts of the values under ``keys`` at any depth of a JSON text; [] for null and broken ones."""
    wanted = frozenset(k.lower() for k in keys)

    @F.pandas_udf("array<string>")
    def take(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [json.dumps(v, ensure_ascii=False) for v in walk(parsed(t), wanted)])

    return take(c)


def nested_years(c: Column, *keys: str) -> Column:
    """Years under ``keys`` of a JSON text, in the order they are named, each once."""
    wanted = frozenset(k.lower() for k in keys)

    @F.pandas_udf("array<int>")
    def take(s: pd.Series) -> pd.Series:
        return s.map(lambda t: list(dict.fromkeys(y for v in walk(parsed(t), wanted) for y in years_in(v))))

    return take(c)


# The keys of a place, by how it is written out.
PARTS = {"plain": [("name",), ("city",), ("state",), ("country",)], "normal": [("normalizedCityName", "city"), ("normalizedStateName", "state"), ("normalizedCountryName", "country")]}
WHOLE = ("normalizedLocation", "location", "name")


def place_of(value, style: str) -> str:
    """A place in words: 'plain' joins all parts by blanks, 'normal' parts by ', ' and several places by '; '."""
    if isinstance(value, str):
        t = value.strip()
        inner = parsed(t) if style == "normal" and t.startswith("{") and t.endswith("}") else None
        return t if inner is None else place_of(inner, style)
    if isinstance(value, dict):
        told = [str(next((value[k] for k in keys if value.get(k)), "")).strip() for keys in PARTS[style]]
        told = [t for t in told if t]
        if style == "plain":
            return " ".join(told)
        return ", ".join(told) or str(next((value[k] for k in WHOLE if value.get(k)), "")).strip()
    if isinstance(value, list):
        each = [place_of(v, style) if isinstance(v, str | dict | list) else str(v) for v in value]
        return (" " if style == "plain" else "; ").join(t for t in each if t)
    return ""


def place_text(c: Column, style: str = "plain") -> Column:
    """A place given as text, or as a JSON object or list of such, in words. Only JSON leaves the JVM."""

    @F.pandas_udf("string")
    def told(s: pd.Series) -> pd.Series:
        return s.map(lambda t: place_of(v, style).strip() if (v := parsed(t)) is not None else t, na_action="ignore")

    return F.coalesce(told(F.when(c.rlike(r"^\s*[\[{]"), c)), F.trim(c))


def web_address(c: Column) -> Column:
    """The trimmed address if it is one of the web's with a host, else ''."""
    t = F.trim(c)
    return F.when(t.rlike(r"(?i)^https?://[^/?#]"), t).otherwise("")


def source_quote(c: Column, pattern: str, most: int = 160) -> Column:
    """The first match of ``pattern`` in the text with its blanks reduced: struct of ``quote`` as the source has it, ``start`` and ``end`` there.

    ``start`` and ``end`` are offsets in the untouched text (``end`` exclusive, before the quote is cut to
    ``most`` characters); null without a match and for null texts.
    """
    found = re.compile(pattern)

    def one(text: str) -> tuple | None:
        marks = [(m.start(), m.end()) for m in re.finditer(r"\S+", text)]
        flat, at = [], []  # characters of the reduced text, and where each stands in the source
        for a, b in marks:
            if flat:
                flat.append(" ")
                at.append(a - 1)
            flat.append(text[a:b])
            at += range(a, b)
        m = found.search("".join(flat))
        if not m or m.start() == m.end():
            return None
        start, end = at[m.start()], at[m.end() - 1] + 1
        return text[start:end][:most], start, end

    @F.pandas_udf("quote string, start int, end int")
    def take(s: pd.Series) -> pd.DataFrame:
        got = [one(t) if t is not None else None for t in s]
        return pd.DataFrame([g or (None, None, None) for g in got], columns=["quote", "start", "end"]).astype({"start": "Int32", "end": "Int32"})

    return take(c)
