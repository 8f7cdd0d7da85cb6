"""Language of documents and of their paragraphs, by the nearest of several centroids per language.

Sentences become normalised TF-IDF vectors of hashed character n-grams; in how many sentences an n-gram
stands is counted over all documents. Each language has a few centroids, clustered from a bounded sample of
labelled documents. A sentence takes the language of the centroid with the greatest cosine, or none if that
is too far. Paragraphs and documents add up their sentences' characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# The languages, and the other notations of each, lower case with '-' for '_'.
NOTATIONS = {
    "en": "en eng english englisch anglais inglés ingles", "de": "de deu ger german deutsch allemand", "fr": "fr fra fre french français francais französisch", "es": "es spa spanish español espanol castellano spanisch",
    "pt": "pt por portuguese português portugues portugiesisch", "it": "it ita italian italiano italienisch", "nl": "nl nld dut dutch nederlands niederländisch", "pl": "pl pol polish polski polnisch",
    "hi": "hi hin hindi हिन्दी हिंदी", "sv": "sv swe swedish svenska schwedisch", "da": "da dan danish dansk dänisch",
}
CODE_OF = {w: code for code, text in NOTATIONS.items() for w in text.split()}
# Labels that say nothing.
NO_LABEL = ["", "und", "unknown", "xx", "zxx", "mul", "n/a", "na", "none", "null", "-", "?"]

ORDERS = (2, 3, 4)  # lengths of character n-grams; words' ends count as a blank
DIM = 1 << 16
CLUSTERS = 8  # centroids per language
LEAST_USES = 3  # uses of sentences that a centroid needs
SAMPLE = 300  # labelled documents per language that the centroids are fitted on, of different texts
SAMPLE_SENTENCES = 60  # sentences taken of each of them, spread over the document
SAMPLE_CHARS = 400  # characters that one sentence adds to the fit; a longer one is parted
CLEAR = 1.4  # a sentence is taken as wrongly labelled if its cosine to another language is so many times that to its own
ROUNDS = 8  # most rounds of cleaning, and of moving centroids
FAR = 0.06  # a sentence with a smaller cosine to every centroid has no language
SENTENCE = re.compile(r"(?<=[.!?।…])\s+|\n+")
WORDLESS = re.compile(r"https?://\S+|www\.\S+|\S+@\S+|[\w-]*\d[\w-]*|_+|[^\w\s]+(?<![ऀ-ॿ])")
UNSURE = 0.05  # a sentence whose two nearest languages are closer than this hardly votes
SOLID_CHARS, SOLID = 20, 0.15  # a paragraph shows a document to be mixed by so many sure characters, at such confidence
BATCH = 1 << 18  # characters that are hashed at once
SLICE = 1 << 23  # characters of texts that are judged at once, or one text's
STEP = 1 << 12  # n-grams whose weights are gathered at once
MEMORY = 1 << 17  # sentences whose language a worker remembers
MEMORY_CHARS = 1 << 10  # longer sentences aren't remembered


def label_code(label: Column) -> Column:
    """Code of a label in any notation; '' for a missing or empty one, the label itself if of no known language."""
    t = F.regexp_replace(F.lower(F.trim(label)), "_", "-")
    known = F.create_map(*[F.lit(x) for pair in CODE_OF.items() for x in pair])
    code = F.coalesce(F.element_at(known, t), F.element_at(known, F.split(t, "-")[0]))
    return F.when(t.isNull() | t.isin(NO_LABEL), "").otherwise(F.coalesce(code, t))


def paragraphs(text: str) -> list[str]:
    """Runs of lines between blank ones."""
    out: list[str] = []
    run: list[str] = []
    for line in text.split("\n"):
        if line.strip():
            run.append(line)
        elif run:
            out.append("\n".join(run))
            run = []
    return [*out, "\n".join(run)] if run else out


def parted(text: str) -> Iterator[tuple[int, str]]:
    """(number of the paragraph, sentence) of ``text``."""
    for number, part in enumerate(paragraphs(text), 1):
        for s in SENTENCE.split(part):
            if s.strip():
                yield number, s


def cleaned(sentences: list[str]) -> list[str]:
    """letters() of each; no sentence holds a line feed."""
    out = []
    for t in WORDLESS.sub(" ", "\n".join(sentences).lower()).split("\n") if sentences else ():
        t = " ".join(t.split())
        out.append(f" {t} " if t else "")
    return out


def letters(text: str) -> str:
    """Lower-case words with single blanks between and around; '' if there are none."""
    return cleaned([text.replace("\n", " ")])[0]


def hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, hash of an n-gram, times it stands there), in the order of the texts."""
    points = np.frombuffer("\0".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    owner = np.cumsum(points == 0, dtype=np.uint64)
    keys = []
    code = np.zeros(len(points), dtype=np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if len(points) < n:
            break
        code = (code[: len(points) - n + 1] if n > 1 else code) * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :] + np.uint64(n)
        if n in ORDERS:
            inside = owner[: len(code)] == owner[n - 1 :]
            inside &= points[: len(code)] != 0
            own = code[inside]
            mixed = ((own ^ (own >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 16)
            keys.append(owner[: len(code)][inside] * np.uint64(DIM) + mixed)
    every = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
    if len(texts) < DIM:  # short keys sort faster
        every = every.astype(np.uint32)
    every.sort()
    first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]]) if len(every) else np.zeros(0, dtype=np.int64)
    pair = every[first].astype(np.int64)
    return pair // DIM, pair % DIM, np.diff(np.r_[first, len(every)])


def portions(texts: list[str], most: int = BATCH) -> Iterator[tuple[int, list[str]]]:
    """(number of the first text, texts) of about ``most`` characters, or one text's."""
    size, first = 0, 0
    for at, t in enumerate(texts, 1):
        size += len(t) + 1
        if size >= most or at == len(texts):
            yield first, texts[first:at]
            first, size = at, 0


class Model:
    """Weights of n-grams and centroids: ``table`` has a row per hash, a column per centroid."""

    def __init__(self, idf: np.ndarray, table: np.ndarray, codes: list[str]) -> None:
        self.idf, self.table, self.codes = idf.astype(np.float32), np.ascontiguousarray(table.astype(np.float32)), np.array(codes)
        self.names = sorted(set(codes))
        self.memory: dict[str, tuple[int, float]] = {}

    def cosines(self, texts: list[str]) -> np.ndarray:
        """Cosine of each text to each centroid."""
        out = np.zeros((len(texts), self.table.shape[1]), dtype=np.float32)
        for first, some in portions(texts):
            row, col, count = hashed(some)
            if not len(row):
                continue
            tf = (1 + np.log(count)).astype(np.float32)
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            norm = np.sqrt(np.add.reduceat((tf * self.idf[col]) ** 2, starts))
            # A few texts at a time: the rows gathered for them stay within STEP, or one text's.
            a = 0
            while a < len(starts):
                b = max(a + 1, int(np.searchsorted(starts, starts[a] + STEP)))
                lo, hi = starts[a], starts[b] if b < len(starts) else len(row)
                sums = np.zeros((b - a, out.shape[1]), dtype=np.float32)
                for at in range(lo, hi, STEP) if b == a + 1 else (lo,):
                    to = min(hi, at + STEP) if b == a + 1 else hi
                    sums += np.add.reduceat(self.table[col[at:to]] * tf[at:to, None], starts[a:b] - lo, axis=0) if b > a + 1 else tf[at:to] @ self.table[col[at:to]]
                out[first + row[starts[a:b]]] = sums / np.maximum(norm[a:b, None], 1e-9)
                a = b
        return out

    def judged(self, clean: list[str]) -> list[tuple[int, float]]:
        """(place in ``names``, confidence) of different texts as of cleaned(); -1 without words or too far from all centroids."""
        cos = self.cosines(clean)
        by_name = np.stack([cos[:, self.codes == n].max(axis=1) for n in self.names], axis=1)
        best = by_name.argmax(axis=1)
        rows = np.arange(len(best))
        top = by_name[rows, best]
        by_name[rows, best] = -1
        sure = np.clip(top - np.maximum(by_name.max(axis=1), 0), 0, 1) / np.maximum(top, 1e-9)
        best[top < FAR] = -1
        return [(-1, 0.0) if not t else (b, s) for t, b, s in zip(clean, best.tolist(), sure.tolist(), strict=True)]

    def places(self, sentences: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``names`` of each sentence's language, -1 for none; and its confidence. Known sentences aren't judged again."""
        known = self.memory
        if len(known) > MEMORY:
            known.clear()
        strange = list(dict.fromkeys(s for s in sentences if s not in known))
        clean = cleaned(strange)
        fresh = list(dict.fromkeys(c for c in clean if c not in known))
        told = dict(zip(fresh, self.judged(fresh), strict=True)) if fresh else {}
        own = {s: known[c] if c in known else told[c] for s, c in zip(strange, clean, strict=True)}
        got = [own[s] if s in own else known[s] for s in sentences]
        for part in (told, own):
            known.update((s, v) for s, v in part.items() if len(s) <= MEMORY_CHARS)
        return np.array([g[0] for g in got], dtype=np.int64), np.array([g[1] for g in got])

    def languages(self, sentences: list[str]) -> tuple[list[str | None], np.ndarray]:
        """Code of each sentence, None if it has no words or is too far from all centroids; and its confidence."""
        place, sure = self.places(sentences)
        return [self.names[i] if i >= 0 else None for i in place.tolist()], sure


def spread(text: str) -> list[str]:
    """At most about SAMPLE_SENTENCES different sentences of a text, as of cleaned(), from all of it; short ones left out."""
    own = [x for x in dict.fromkeys(cleaned([s[i : i + SAMPLE_CHARS] for _, s in parted(text) for i in range(0, len(s), SAMPLE_CHARS)])) if len(x) > 12]
    return own[:: max(1, len(own) // SAMPLE_SENTENCES)]


def fit(rows: list[tuple[str, str, float]], idf: np.ndarray | None = None) -> Model:
    """Centroids from (code, text, weight) rows: clusters within each language, after the labels are cleaned.

    ``weight`` is that of a row's vote. A sentence counts only for the label that most of its uses give it, and
    only while no other label's mean is CLEAR times as near as the mean of that label's sentences, one use of it less. Centroids
    of fewer than LEAST_USES uses, and those nearer another language's mean, are dropped. ``idf``
    is counted over ``rows`` if not given.
    """
    votes: dict[str, dict[str, float]] = {}
    for code, t, weight in ((code, x, weight) for code, text, weight in rows for x in spread(text)):
        own = votes.setdefault(t, {})
        own[code] = own.get(code, 0.0) + weight
    texts = sorted(votes)
    if not texts:
        return Model(np.zeros(DIM), np.zeros((DIM, 1)), ["en"])
    codes = np.array([max(sorted(votes[t]), key=votes[t].get) for t in texts])
    row, col, count = hashed(texts)
    if idf is None:
        idf = weights(np.bincount(col, minlength=DIM), len(texts))
    val = (1 + np.log(count)) * idf[col]
    norm = np.sqrt(np.bincount(row, val**2, minlength=len(texts)))
    val = val / np.maximum(norm[row], 1e-9)
    often = np.array([votes[t][c] for t, c in zip(texts, codes, strict=True)])  # a sentence weighs as much as its label uses it
    weighed = val * often[row]

    def cosine(c: np.ndarray) -> np.ndarray:
        return np.bincount(row, val * c[col], minlength=len(texts))

    names = sorted(set(codes))
    keep = np.ones(len(texts), dtype=bool)
    means = np.zeros((0, DIM))
    rank = np.searchsorted(names, codes)
    for _ in range(ROUNDS):  # sentences clearly nearer another language's mean than that of all other uses of their own
        sums = np.bincount(rank[row] * DIM + col, weighed * keep[row], minlength=len(names) * DIM).reshape(-1, DIM)
        length = np.linalg.norm(sums, axis=1)
        means = sums / np.maximum(length[:, None], 1e-9)
        near = np.stack([cosine(m) for m in means])
        inner = near[rank, np.arange(len(texts))] * length[rank]
        own = np.where(keep, np.minimum(often, 1), 0)
        rest = (inner - own) / np.sqrt(np.maximum(length[rank] ** 2 - 2 * own * inner + own**2, 1e-9))
        near[rank, np.arange(len(texts))] = 0
        agreed = near.max(axis=0) <= CLEAR * np.maximum(rest, 1e-6)
        if (agreed == keep).all():
            break
        keep = agreed

    def clustered(own: np.ndarray) -> list[np.ndarray]:
        """Centroids of the sentences ``own``. All else is worked out on their n-grams alone."""
        mine = np.isin(row, own)
        place = np.searchsorted(own, row[mine])
        c_, v_ = col[mine], val[mine]
        use = often[own]

        def middle(member: np.ndarray) -> np.ndarray:
            c = np.bincount(c_, v_ * (member * use)[place], minlength=DIM)
            return c / max(np.linalg.norm(c), 1e-9)

        near = lambda c: np.bincount(place, v_ * c[c_], minlength=len(own))
        # Seeds: the most used sentence, then each time the one whose use times distance to all seeds is greatest.
        only = lambda i: middle(np.arange(len(own)) == i)
        centres = [only(int(use.argmax()))]
        closest = near(centres[0])
        while len(centres) < min(CLUSTERS, len(own)):
            gap = use * (1 - closest)
            if gap.max() <= 1e-6:
                break
            centres.append(only(int(gap.argmax())))
            closest = np.maximum(closest, near(centres[-1]))
        member = np.full(len(own), -1)
        for _ in range(ROUNDS):
            now = np.stack([near(c) for c in centres]).argmax(axis=0)
            if (now == member).all():
                break
            member = now
            centres = [middle(member == j) if (member == j).any() else c for j, c in enumerate(centres)]
        filled = [c for j, c in enumerate(centres) if use[member == j].sum() >= LEAST_USES]
        return filled or [middle(np.ones(len(own), dtype=bool))]

    centroids, owners = [], []
    for k, n in enumerate(names):
        own = np.flatnonzero((codes == n) & keep)
        if len(own):
            made = [c for c in clustered(own) if (means @ c).argmax() == k] or [means[k]]
            centroids += made
            owners += [n] * len(made)
    table = idf[:, None] * np.array(centroids).T if centroids else np.zeros((DIM, 1))
    return Model(idf, table, owners or ["en"])


def weights(counts: np.ndarray, total: int) -> np.ndarray:
    """IDF of each hash from the number of sentences that hold it; 0 if none does."""
    return np.log((1 + total) / (1 + counts)) * (counts > 0)


def frequencies(df: DataFrame, text: str) -> tuple[np.ndarray, int]:
    """(in how many sentences each hash stands, number of sentences) over all of ``df``: each task adds up its own."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, held = 0, np.zeros(DIM, dtype=np.int64)
        for batch in batches:
            uses: dict[str, int] = {}
            for t in batch["text"]:
                for _, s in parted(t):
                    uses[s] = uses.get(s, 0) + 1
            clean: dict[str, int] = {}
            for c, n in zip(cleaned(list(uses)), uses.values(), strict=True):
                if c:
                    clean[c] = clean.get(c, 0) + n
            total += sum(clean.values())
            times = np.array(list(clean.values()), dtype=float)
            for first, some in portions(list(clean)):
                row, col, _ = hashed(some)
                held += np.bincount(col, times[first + row], minlength=DIM).astype(np.int64)
        at = np.flatnonzero(held)
        yield pd.DataFrame({"gram": np.r_[-1, at], "n": np.r_[total, held[at]]})

    found = df.select(F.col(text).alias("text")).where(F.col("text").rlike(r"\S")).mapInPandas(count, "gram int, n bigint")
    held, total = np.zeros(DIM), 0
    for r in found.groupBy("gram").agg(F.sum("n").alias("n")).toLocalIterator():  # DIM + 1 rows at most
        if r["gram"] < 0:
            total = r["n"]
        else:
            held[r["gram"]] = r["n"]
    return held, total


def sample(df: DataFrame, text: str, label: str, per_language: int = SAMPLE) -> list[tuple[str, str, float]]:
    """(label, sentences as of spread(), weight of 1) of at most ``per_language`` different texts of each label.

    The texts are those whose hashes are lowest, so that copies of a row, whatever their keys, change nothing.
    """
    rows = df.select(label_code(F.col(label)).alias("c"), F.col(text).alias("t")).where(F.col("c").isin(sorted(NOTATIONS)) & F.col("t").rlike(r"\S"))
    chosen = rows.select("c", F.xxhash64("t").alias("h")).distinct().withColumn("n", F.row_number().over(W.partitionBy("c").orderBy("h"))).where(F.col("n") <= per_language).select("c", "h")
    hit = rows.withColumn("h", F.xxhash64("t")).join(F.broadcast(chosen), ["c", "h"]).dropDuplicates(["c", "h"])  # at most per_language rows a language

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"c": batch["c"], "h": batch["h"], "s": ["\n".join(spread(t)) for t in batch["t"]]})

    got = sorted(tuple(r) for r in hit.mapInPandas(take, "c string, h bigint, s string").collect())
    return [(c, s, 1.0) for c, _, s in got]


def trained(df: DataFrame, text: str, label: str) -> Model:
    """The model of the texts of ``df``: n-grams counted over all of them, centroids fitted on the sample."""
    return fit(sample(df, text, label), weights(*frequencies(df, text)))


def detect(df: DataFrame, key: str, text: str, label: str, model: Model | None = None) -> DataFrame:
    """Languages of each document and paragraph: ``key``, ``seg_no``, ``lang``, ``confidence``, ``chars``, ``label``, ``mixed``.

    ``seg_no`` 0 is the document; paragraphs count from 1 between blank lines, all are given. ``lang`` is
    null where there are no words of a known language. ``label`` is the given label's code ('' if it says
    nothing), ``mixed`` whether two or more languages each have a paragraph that shows them by SOLID_CHARS
    characters of sure sentences at a confidence of SOLID; a paragraph of a language that has none takes the
    document's. The main language has the most characters over all sentences; ties go to the first code. Null and blank texts give no rows;
    texts of any length are read whole. Repeated rows stay repeated. ``model`` is trained on ``df`` if not given.
    """
    spark = df.sparkSession
    model = model or trained(df, text, label)
    known = spark.sparkContext.broadcast((model.idf, model.table, model.codes.tolist()))
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), label_code(F.col(label)).alias("label")).where(F.col("text").rlike(r"\S"))
    kind = df.schema[key].dataType.simpleString()

    def slices(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Parts of a batch of about SLICE characters, so that long texts don't add up in memory."""
        part = batch["text"].str.len().cumsum() // SLICE
        for _, rows in batch.groupby(part, sort=False):
            yield rows

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Model(*known.value)
        for batch in (part for whole in batches for part in slices(whole)):
            yield segments(m, batch["key"].tolist(), batch["text"].tolist(), batch["label"].tolist())

    found = rows.mapInPandas(judge, f"key {kind}, seg_no int, lang string, confidence double, chars bigint, label string, mixed boolean")
    return found.withColumnRenamed("key", key)


def segments(m: Model, keys: list, texts: list[str], labels: list[str]) -> pd.DataFrame:
    """The rows of detect() for some documents."""
    flat: list[str] = []
    owner: list[int] = []  # number of the segment that a sentence is in
    doc: list[int] = []  # of a segment: its document, and its number there
    number: list[int] = []
    for i, t in enumerate(texts):
        last = 0
        doc.append(i)
        number.append(0)
        for p, s in parted(t):
            if p != last:
                doc.append(i)
                number.append(p)
                last = p
            flat.append(s)
            owner.append(len(doc) - 1)
    codes, sure = m.places(flat)
    of, wide = np.array(owner, dtype=np.int64), len(m.names)
    segment, place = np.array(doc, dtype=np.int64), np.array(number, dtype=np.int64)
    whole = np.flatnonzero(place == 0)  # the segment of each document
    size = np.array([len(s.strip()) for s in flat], dtype=float)
    hit = codes >= 0

    def votes(value: np.ndarray) -> np.ndarray:
        """Sums of ``value`` by segment and language; a document's are those of its paragraphs."""
        own = np.bincount(of[hit] * wide + codes[hit], value[hit], minlength=len(doc) * wide).reshape(-1, wide)
        every = np.bincount((segment[of[hit]]) * wide + codes[hit], value[hit], minlength=len(texts) * wide).reshape(-1, wide)
        own[whole] = every
        return own

    firm = votes(np.where(sure >= UNSURE, size, 0))
    chars = votes(size)
    ballot = firm + (chars - firm) / 1000  # unsure sentences decide only where nothing surer does
    trust = votes(size * sure)
    best = ballot.argmax(axis=1)
    each = np.arange(len(doc))
    total = chars.sum(axis=1)
    some = total > 0
    with np.errstate(invalid="ignore", divide="ignore"):
        confidence = trust[each, best] / total
    solid = some & (place > 0) & (firm[each, best] >= SOLID_CHARS) & (confidence >= SOLID)
    main = best[whole][segment]
    shown = np.zeros((len(texts), wide), dtype=bool)
    shown[segment[solid], best[solid]] = True
    mixed = (shown.sum(axis=1) > 1)[segment]
    # A paragraph of a language that no paragraph of the document shows is one of the document's language.
    lone = some & (place > 0) & mixed & ~shown[segment, best]
    best = np.where(lone, main, best)
    names = np.array([*m.names, None], dtype=object)
    with np.errstate(invalid="ignore", divide="ignore"):
        confidence = trust[each, best] / total
    return pd.DataFrame({
        "key": [keys[i] for i in doc], "seg_no": place.astype(np.int32), "lang": names[np.where(some, best, wide)], "confidence": np.where(some, confidence, np.nan),
        "chars": total.astype(np.int64), "label": [labels[i] for i in doc], "mixed": mixed,
    })
