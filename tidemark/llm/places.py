"""Free-entered place names mapped to the entries of a reference list.

Distinct tokens of the texts are repaired: those not in the list's vocabulary meet it through shared
deletion variants and keep the vocabulary tokens within an edit distance. A text's repaired tokens are
then combined: names found among them are ranked as complete entries by soft TF-IDF over all of an
entry's tokens (name, region, country, codes), so that what stands around a name decides between entries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scale import cut, guarded_join

#: The reference list is held in the memory of every task; more entries than this are refused unless the caller allows more.
MAX_ENTRIES = 20_000
EDITS = 2
TOKEN = r"[\p{L}\p{M}\p{Nd}]+"
# Letters folded to their base, in the same order.
FOLD_FROM = "àáâãäåāăąçćčďđèéêëēėęěğìíîïīįıłľñńňòóôõöøōőŕřśşšșťţțùúûüūůűųýÿźżž"
FOLD_TO = "aaaaaaaaacccddeeeeeeeegiiiiiiillnnnoooooooorrsssstttuuuuuuuuyyzzz"
# Ordinary words of location texts that are never taken for a misspelt name.
PLAIN = set(
    "remote home house office offices onsite site hybrid work from anywhere global worldwide various multiple location locations see description field based area areas near greater "
    "campus block floor tower hq headquarters city town centre center building street road north south east west and or the of for with any all region regional country national "
    "international world europe asia africa america americas emea apac latam union none null tbd tba not applicable unknown only fully partly full part time team open store plant depot "
    "new san los saint port fort park lake bay hill hills airport station".split()
)
# Usual short forms of countries beside their codes.
SHORT_COUNTRIES = {"gb": "uk", "us": "usa", "ae": "uae"}
STRONG = r"\s*[|;&+•\n]\s*|\s+(?:and|or|und|oder|et|ou|y|o|e)\s+"


def fold(text: Column) -> Column:
    """Lower case, without combining accents over Latin letters, special letters as their base."""
    return F.translate(F.translate(F.lower(text), "̧̀́̂̃̇̈̊̌", ""), FOLD_FROM, FOLD_TO)


def fold_text(text: str) -> str:
    drop = dict.fromkeys([0x300, 0x301, 0x302, 0x303, 0x307, 0x308, 0x30A, 0x30C, 0x327])
    return text.lower().translate(drop).translate(str.maketrans(FOLD_FROM, FOLD_TO))


def variants(token: Column) -> Column:
    """All texts that ``token`` gives by up to EDITS deletions."""
    less = lambda t: F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substr(t, F.lit(1), i - 1), F.substr(t, i + 1)))
    one = less(token)
    two = F.flatten(F.transform(one, lambda t: F.when(F.length(t) > 0, less(t)).otherwise(F.array(t))))
    return F.array_distinct(F.concat(F.array(token), one, two))


def edits(a: str, b: str, most: int) -> int:
    """Damerau-Levenshtein distance of two tokens (a swap of neighbours may be edited further), or most + 1 if larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    far = len(a) + len(b)
    d = [[far] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        d[i + 1][1] = i
    for j in range(len(b) + 1):
        d[1][j + 1] = j
    last_row: dict[str, int] = {}
    for i, x in enumerate(a, 1):
        last_col = 0
        for j, y in enumerate(b, 1):
            k, m = last_row.get(y, 0), last_col
            if x == y:
                last_col = j
            d[i + 1][j + 1] = min(d[i][j] + (x != y), d[i + 1][j] + 1, d[i][j + 1] + 1, d[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last_row[x] = i
    return min(d[-1][-1], most + 1)


def allowed(length: int) -> int:
    """Edits allowed in a name of so many letters."""
    return 0 if length < 4 else 1 if length < 6 else 2


class Gazetteer:
    """The reference list, its vocabulary and weights, small enough for every task."""

    def __init__(self, rows: list[dict], name: str, others: str, code: str, context: list[str], key: str) -> None:
        import regex

        cut = lambda s: regex.findall(TOKEN, fold_text(s or ""))
        self.names: dict[str, list[tuple[tuple[str, ...], int, str]]] = {}  # first token: (tokens, entry, raw name)
        self.codes: dict[str, list[int]] = {}
        self.context: dict[int, set[str]] = {}
        self.vocabulary: set[str] = set()
        self.name_tokens: set[str] = set()
        counts: dict[str, int] = {}
        for r in rows:
            k = r[key]
            for raw in [r[name], *(r[others] or "").split(";")]:
                toks = tuple(cut(raw))
                for form in {toks, ("".join(toks),)} if toks else ():
                    entry = (form, k, raw.strip())
                    if entry not in self.names.setdefault(form[0], []):
                        self.names[form[0]].append(entry)
                    self.vocabulary.update(form)
                    self.name_tokens.update(form)
            if r[code]:
                self.codes.setdefault(r[code].strip().upper(), []).append(k)
            own = {t for c in context for t in cut(r[c])}
            own |= {v for c, v in SHORT_COUNTRIES.items() if c in own}
            self.context[k] = own
            self.vocabulary |= own
            for t in own:
                counts[t] = counts.get(t, 0) + 1
        n = max(1, len(rows))
        self.idf = {t: math.log((1 + n) / (0.5 + c)) for t, c in counts.items()}
        for forms in self.names.values():
            forms.sort(key=lambda f: (-len(f[0]), f[1]))

    def found(self, text: str, repaired: dict[str, list[tuple[str, int]]]) -> list[int]:
        """Keys of the entries that ``text`` names. repaired: vocabulary tokens and distances for each token."""
        import regex

        out: list[int] = []
        for strong in regex.split(STRONG, text, flags=regex.IGNORECASE):
            parts = []
            for weak in strong.split("/"):
                toks = [(m.group(), fold_text(m.group())) for m in regex.finditer(TOKEN, weak)]
                hits, used, i = [], set(), 0
                while i < len(toks):
                    hit = self._at(toks, i, repaired)
                    if hit:
                        hits.append(hit)
                        used.update(range(i, i + hit[0]))
                        i += hit[0]
                    else:
                        i += 1
                rest = {v: 1 - d / 4 for j, (_, t) in enumerate(toks) if j not in used for v, d in repaired.get(t, [(t, 0)])}
                again = [t for j, (_, t) in enumerate(toks) if j in used]
                parts.append((weak, hits, rest, again))
            for p, (weak, hits, rest, again) in enumerate(parts):
                for k, (size, keys, raws) in enumerate(hits):
                    best = keys
                    if len(keys) > 1:
                        others = [v for j, h in enumerate(hits) if j != k for v in h[2]]
                        near = [rest | dict.fromkeys(others, 1.0)]
                        near += [self._tokens(parts[q]) for q in (p + 1, p - 1) if 0 <= q < len(parts)]
                        best = self._rank(keys, near, weak)
                    out.extend(x for x in best if x not in out)
        return out

    def _tokens(self, part: tuple) -> dict[str, float]:
        return part[2] | dict.fromkeys(part[3], 1.0)

    def _at(self, toks: list[tuple[str, str]], i: int, repaired: dict) -> tuple[int, list[int], list[str]] | None:
        """The best name that starts at token i: its number of tokens, entries and tokens."""
        raw, folded = toks[i]
        best: tuple | None = None
        starts = repaired.get(folded, [])
        for v, _ in starts:
            for form, key, _name in self.names.get(v, ()):
                if i + len(form) > len(toks):
                    continue
                total, letters = 0, sum(map(len, form))
                for j, want in enumerate(form):
                    d = next((d for w, d in repaired.get(toks[i + j][1], ()) if w == want), None)
                    if d is None or d >= len(want) or (2 * d > len(want) and len(form) == 1):
                        break
                    total += d
                else:
                    if total <= allowed(letters):
                        rank = (-len(form), total)
                        if best is None or rank < best[0]:
                            best = (rank, [key], list(form))
                        elif rank == best[0] and key not in best[1]:
                            best[1].append(key)
        if raw.isupper() and len(raw) <= 4 and raw in self.codes and (best is None or -best[0][0] == 1 and best[0][1] > 0):
            return 1, list(self.codes[raw]), [folded]
        return (-best[0][0], best[1], best[2]) if best else None

    def _rank(self, keys: list[int], near: list[dict[str, float]], weak: str) -> list[int]:
        """Soft TF-IDF of each entry's tokens over what stands nearest; the first context that tells decides."""
        for tokens in near:
            score = {}
            for k in keys:
                norm = math.sqrt(sum(self.idf[t] ** 2 for t in self.context[k])) or 1.0
                score[k] = sum(self.idf[t] * tokens[t] for t in self.context[k] if t in tokens) / norm
            top = max(score.values())
            if top > 0:
                keys = [k for k in keys if score[k] == top]
                break
        if len(keys) > 1:  # the name as the list spells it, then the first entry
            spelt = [k for k in keys for forms in self.names.values() for f in forms if f[1] == k and len(f[0]) >= 1 and f[2].lower() in weak.lower()]
            keys = spelt or keys
        return [min(keys)]


def match_places(df: DataFrame, value: str, places: DataFrame, key: str = "place_id", name: str = "city", others: str = "other_names", code: str = "code", context: tuple[str, ...] = ("region", "country", "country_code"), most: int = MAX_ENTRIES) -> DataFrame:
    """Distinct texts of ``value`` with the entries they name: ``text``, ``found`` (array of keys, empty if none).

    ``places`` is the reference list: unique integer ``key``, ``name``, ``others`` (separated by ';'), ``code``
    (matched only in capitals) and ``context`` columns; it is refused beyond ``most`` entries. Texts are trimmed;
    null and blank ones give no row; texts of any length are matched as a whole. With an empty list every
    text names nothing. Ties between entries go to the one spelt as written, then to the lowest key. Join
    the result to the rows by their trimmed text.
    """
    wanted = [key, name, others, code, *context]
    rows = places.select(*wanted).dropna(subset=[key, name]).orderBy(key).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the reference list has more than {most} entries")
    gazetteer = Gazetteer([r.asDict() for r in rows], name, others, code, list(context), key)
    spark = df.sparkSession

    texts = df.select(F.trim(value).alias("text")).where("text != ''").distinct()
    tokens = texts.select("text", F.explode(F.array_distinct(F.regexp_extract_all(fold(F.col("text")), F.lit(TOKEN), F.lit(0)))).alias("token"))
    words = sorted(gazetteer.vocabulary)
    vocabulary = spark.createDataFrame([(w,) for w in words], "word string")
    longest = max(map(len, words), default=0)
    distinct = tokens.select("token").distinct()

    # Tokens of the vocabulary stand for themselves; others meet it through deletion variants.
    strange = distinct.where((F.length("token") > 1) & (F.length("token") <= longest + EDITS) & ~F.col("token").rlike(r"^\d+$"))
    strange = guarded_join(strange, vocabulary.withColumnRenamed("word", "token"), ["token"], "left_anti")
    strange = strange.where(~F.col("token").isin(sorted(PLAIN)))
    reachable = spark.createDataFrame([(w,) for w in words if len(w) > 3 or (len(w) > 1 and w in gazetteer.name_tokens)], "word string")
    # The list's variants grow with it, so that they are weighed before they are broadcast; beyond that the parts of both sides are shuffled.
    reach = reachable.select("word", F.explode(variants(F.col("word"))).alias("part"))
    parts = strange.select("token", F.explode(variants(F.col("token"))).alias("part"))
    pairs = guarded_join(parts, reach, ["part"], "inner", "token").select("token", "word").distinct()

    @F.pandas_udf("int")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([edits(x, y, EDITS) for x, y in zip(a, b, strict=True)], dtype="int32")

    near = pairs.withColumn("d", distance("token", "word")).where(F.col("d") <= EDITS)
    exact = guarded_join(distinct, vocabulary.select(F.col("word").alias("token"), "word"), ["token"], "inner").select("token", "word", F.lit(0).alias("d"))
    fixes = near.unionByName(exact).groupBy("token").agg(F.sort_array(F.collect_list(F.struct("d", "word"))).alias("fixes"))
    fixes = cut(fixes)
    mended = guarded_join(tokens, fixes, ["token"], "left", "text")
    whole = mended.groupBy("text").agg(F.collect_list(F.when(F.col("fixes").isNotNull(), F.struct("token", "fixes"))).alias("repaired"))

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, repaired in zip(batch["text"], batch["repaired"], strict=True):
                known = {r["token"]: [(f["word"], f["d"]) for f in r["fixes"]] for r in repaired}
                out.append(gazetteer.found(text, known))
            yield pd.DataFrame({"text": batch["text"], "found": out})

    tokenless = texts.where(~F.col("text").rlike(TOKEN)).select("text", F.array().cast("array<int>").alias("found"))
    return whole.mapInPandas(rank, "text string, found array<int>").unionByName(tokenless)
