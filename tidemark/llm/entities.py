"""Entities of two tables matched without a shared key.

Sorted neighbourhood: each record gives sort keys of several kinds (names, hosts and slugs; names alone; names
after their trade, city or platform, forwards and backwards; names after their consonants; see sort_keys()).
Each kind has its own order: its distinct keys are range-sorted over the cluster and each meets its neighbours
within a window. The records of neighbouring keys are compared by weighted similarities of their fields. Records of one side that are
the same entity are grouped; groups of both sides are then assigned one to one so that the total confidence
is greatest, and groups left over join the entity of an assigned pair they fit.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.places import edits
from tidemark.scale import cut, guarded_join

#: Keys up to this many places apart in the sorted order are compared.
WINDOW = 6
#: Least confidence of a match, and of an edge that groups records of one side.
LEAST, SAME = 0.70, 0.85
PART = 33

# Words of a firm's legal form, and other words that don't tell firms apart.
FORMS = set("inc llc ltd limited gmbh ag sa bv pvt private corp corporation company co the plc spa srl oy ab kg se nv group holding holdings sarl pte pty".split())
# Words for what a firm does; words of one line mean the same.
TRADES = "payments pay|capital cap|energy power|logistics log|freight cargo|foods food|retail stores store|health healthcare|diagnostics dx|learning learn|software sw|systems sys|technologies technology tech|consulting consultants|laboratories labs lab|robotics robots|semiconductors semi|international intl"
TRADE = {w: line.split()[0] for line in TRADES.split("|") for w in line.split()}
TRADE_WORDS = sorted(TRADE, key=lambda w: (-len(w), w))
# Additions to slugs of boards.
ADDED = "group careers career jobs job hq talent india eu us uk inc intl global external recruiting hiring team".split()


def words(text: str) -> list[str]:
    parted = re.sub(r"(?<=[a-zà-þ])(?=[A-ZÀ-Þ][a-zà-þ])", " ", text)
    parted = re.sub(r"\b([A-Za-z])\.([A-Za-z])\b\.?", r"\1\2", parted)
    return re.findall(r"[^\W_]+", parted.casefold())


def split_name(text: str | None) -> tuple[str, str | None, list[str]]:
    """(core, trade, other cores) of a firm's name; other cores are those it gives after 'ex' or a slash."""
    if not text:
        return "", None, []
    noted = [m for m in re.findall(r"\(([^)]*)\)", text)]
    former = [re.sub(r"^(?:ex|formerly|fka|previously)\W+", "", n, flags=re.I) for n in noted if re.match(r"(?:ex|formerly|fka|previously)\b", n, re.I)]
    main, *more = re.split(r"\s+/\s+", re.sub(r"\([^)]*\)", " ", text))

    def core(part: str) -> tuple[str, str | None]:
        toks = [w for w in words(part) if w not in FORMS]
        trade = next((TRADE[w] for w in reversed(toks) if w in TRADE), None)
        kept = "".join(w for w in toks if w not in TRADE)
        if trade is None:
            for w in TRADE_WORDS:
                if len(w) > 3 and kept.endswith(w) and len(kept) - len(w) >= 4:
                    return kept[: -len(w)], TRADE[w]
        return kept, trade

    name, trade = core(main)
    others = [core(m) for m in [*more, *former]]
    return name, trade or next((t for _, t in others if t), None), [c for c, _ in others if c]


def host_of(text: str | None) -> str:
    """First label of the firm's host named in ``text``, letters and digits; '' if there is none."""
    m = re.search(r"([a-z0-9.-]+\.[a-z]{2,})(?:[/|\s:]|$)", (text or "").casefold())
    if not m:
        return ""
    labels = [x for x in m.group(1).split(".") if x not in ("www", "careers", "career", "jobs", "job")]
    if len(labels) > 2 or not labels:  # a host within another's, such as a hiring platform
        return ""
    label = re.sub(r"^get(?=[a-z]{5})", "", labels[0])
    return re.sub(r"[^a-z0-9]", "", re.sub(r"(?:-old|-new|(?<=[a-z]{4})group)$", "", label))


def slugs_of(token: str) -> list[str]:
    """The parts of a board's token that can be the firm's own, letters and digits."""
    t = token.casefold()
    parts = t.split("|")[1:] if "|" in t else [t]
    out = []
    for part in parts:
        labels = [x for x in part.split(".") if x not in ("www", "careers", "career", "jobs", "job")]
        slug = re.sub(r"[^a-z0-9]", "", labels[0] if labels else "")
        if len(slug) > 5 and slug not in ADDED:
            out.append(slug)
    return list(dict.fromkeys(out))


def guess(slug: str) -> tuple[str, str | None]:
    """(core, trade) that a slug or host seems to have: additions and then one trade are taken off its end."""
    core = slug
    while True:
        core = core.rstrip("0123456789")
        hit = next((w for w in sorted(ADDED, key=len, reverse=True) if core.endswith(w) and len(core) - len(w) >= 5), None)
        if not hit:
            break
        core = core[: -len(hit)]
    w = next((w for w in TRADE_WORDS if len(w) > 2 and core.endswith(w) and len(core) - len(w) >= 5), None)
    return (core[: -len(w)], TRADE[w]) if w else (core, None)


def rest_of(slug: str, core: str) -> tuple[bool, str | None]:
    """Whether ``slug`` is ``core`` with a trade and additions, and the trade."""
    if len(core) < 4 or not slug.startswith(core):
        return False, None
    rest, trade = slug[len(core) :], None
    for w in TRADE_WORDS:
        if rest.startswith(w):
            rest, trade = rest[len(w) :], TRADE[w]
            break
    while True:
        rest = rest.strip("0123456789")
        hit = next((w for w in ADDED if rest.startswith(w)), None)
        if not hit:
            return rest == "", trade
        rest = rest[len(hit) :]


def shortened(slug: str, core: str, trade: str | None) -> bool:
    """Whether ``slug`` is the start of ``core``, the start of the trade, and a number."""
    m = re.match(r"([a-z]{5})([a-z]{2})\d", slug)
    return bool(m and len(core) > 5 and core.startswith(m.group(1)) and trade and trade.startswith(m.group(2)))


def likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if min(len(a), len(b)) < 5:
        return 0.0
    d = edits(a, b, 2)
    return 1 - d / max(len(a), len(b)) if d <= 2 else 0.0


def compare(x: dict, y: dict) -> float:
    """Confidence that two records are one entity, 0 to 1."""
    base, how = 0.0, ""
    tx, ty = x["trade"], y["trade"]
    for a in x["cores"]:
        for b in y["cores"]:
            v = likeness(a, b)
            if v > base:
                base, how = v, "name" if v == 1 else "near"
    for p, q in ((x, y), (y, x)):
        for slug in p["slugs"]:
            if base < 0.98:  # a slug or host without its endings against names, slugs and hosts of the other
                own = guess(slug)[0]
                for other in [*q["cores"], *(guess(o)[0] for o in q["slugs"])]:
                    v = 0.98 * likeness(own, other)
                    if v > base:
                        base, how = v, "slug" if v >= 0.98 else "near"
            for core in [*q["cores"], *q["hosts"]]:
                fits, trade = rest_of(slug, core)
                if fits and base < 1:
                    base, how = 0.98, "slug"
                if fits and trade and not p["trade"]:
                    tx, ty = (trade, ty) if p is x else (tx, trade)
                if base < 0.85 and shortened(slug, core, q["trade"]):
                    base, how = 0.85, "short"
    if base < 0.98 and any(a == b for a in x["hosts"] for b in y["hosts"]):
        base, how = 0.98, "host"
    if base < 0.75:
        return 0.0
    agree = lambda a, b: 0.5 if not a or not b else float(a == b)
    trade, city, system, segment = agree(tx, ty), agree(x["place"], y["place"]), agree(x["system"], y["system"]), agree(x["segment"], y["segment"])
    if trade == 0:
        return 0.0
    if how == "short" and city + system < 1.5 or how == "near" and base < 0.86 and (city + system < 1.5 or city == 0):
        return 0.0
    return round(0.6 * base + 0.2 * trade + 0.08 * city + 0.07 * system + 0.05 * segment, 4)


def sort_keys(cores: list[str], slugs: list[str], trade: str | None, place: str | None, system: str | None) -> list[tuple[int, str]]:
    """(order, key) of a record; ``slugs`` with hosts. Names are also those that slugs and hosts seem to have."""
    out = [(i, k[::step]) for k in [*cores, *slugs] if len(k) > 2 for i, step in ((0, 1), (1, -1))]
    for n in dict.fromkeys([*cores, *(guess(k)[0] for k in slugs)]):
        if len(n) < 3:
            continue
        out += [(2, n), (3, n[::-1]), (4, f"{re.sub('[aeiouy]', '', n)} {n}")]
        for i, lead in ((5, trade), (7, place), (9, system)):
            if lead:
                out += [(i, f"{lead} {n}"), (i + 1, f"{lead} {n[::-1]}")]
    return list(dict.fromkeys(out))


FIELDS = "side string, id string, cores array<string>, slugs array<string>, hosts array<string>, trade string, place string, system string, segment string"


def described(df: DataFrame) -> DataFrame:
    """Records with their names, slugs, hosts and trade taken apart.

    ``df``: side, id (unique in its side), names ARRAY, token, urls ARRAY, place, system, segment; any may be null but side and id.
    """

    def take(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.to_dict("records"):
                cores, trade = [], None
                for n in r["names"] if r["names"] is not None else []:
                    core, t, others = split_name(n)
                    cores += [c for c in [core, *others] if len(c) > 2]
                    trade = trade or t
                hosts = [h for u in (r["urls"] if r["urls"] is not None else []) if (h := host_of(u))]
                slugs = slugs_of(r["token"]) if isinstance(r["token"], str) else []
                own = list(dict.fromkeys(cores))
                for h in [*hosts, *slugs]:
                    for c in own:
                        fits, t = rest_of(h, c)
                        if fits and t and not trade:
                            trade = t
                trade = trade or next((t for h in [*hosts, *slugs] if (t := guess(h)[1])), None)
                text = lambda v: v.strip().casefold() if isinstance(v, str) and v.strip() else None
                out.append((r["side"], r["id"], own, list(dict.fromkeys([*slugs, *hosts])), list(dict.fromkeys(hosts)), trade, text(r["place"]), text(r["system"]), text(r["segment"])))
            yield pd.DataFrame(out, columns=["side", "id", "cores", "slugs", "hosts", "trade", "place", "system", "segment"])

    return df.mapInPandas(take, FIELDS)


def neighbours(records: DataFrame) -> DataFrame:
    """Pairs of records whose keys stand within WINDOW places of each other in one of the sorted orders.

    Pairs whose trades are known and differ are left out, as compare() gives them 0 whatever else they share.
    Records of different sides meet each other. Those of one side that share key and trade meet their first
    alone, and these first ones meet each other, so that a firm with many records gives as many pairs.
    """
    key = F.col("key")

    @F.pandas_udf("array<struct<order:int,key:string>>")
    def kinds(cores: pd.Series, slugs: pd.Series, trade: pd.Series, place: pd.Series, system: pd.Series) -> pd.Series:
        rows = zip(cores, slugs, trade, place, system, strict=True)
        return pd.Series([[{"order": i, "key": k} for i, k in sort_keys(list(c), list(g), t, p, y)] for c, g, t, p, y in rows])

    made = F.explode(kinds("cores", "slugs", "trade", "place", "system")).alias("k")
    both = records.select("side", "id", F.coalesce("trade", F.lit("")).alias("trade"), made).select("side", "id", "trade", "k.order", "k.key")
    both = cut(both)
    distinct = both.select("order", "key").distinct()
    placed = distinct.repartitionByRange("order", "key").sortWithinPartitions("order", "key").withColumn("at", F.monotonically_increasing_id())
    placed = cut(placed.select("order", key, F.shiftright("at", PART).cast("int").alias("part"), F.col("at").bitwiseAND(F.lit((1 << PART) - 1)).alias("at")))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    placed = placed.join(F.broadcast(offsets), "part").select("order", "key", (F.col("at") + F.col("offset")).alias("at"))
    placed = cut(both.join(placed, ["order", "key"]).select("order", "at", "side", "trade", "id"))
    spot = ["order", "at"]
    firsts = placed.groupBy(*spot, "side", "trade").agg(F.min("id").alias("id"))
    name = lambda side, c: F.struct(F.col(side).alias("side"), F.col(c).alias("id"))
    steps = F.explode(F.array(*[F.lit(i) for i in range(WINDOW + 1)]))

    def meet(df: DataFrame) -> DataFrame:
        ahead = df.withColumn("step", steps).select("order", (F.col("at") + F.col("step")).alias("at"), F.col("side").alias("side_x"), F.col("id").alias("id_x"), F.col("trade").alias("trade_x"))
        met = ahead.join(df.select(*spot, F.col("side").alias("side_y"), F.col("id").alias("id_y"), F.col("trade").alias("trade_y")), spot)
        return met.where("trade_x = trade_y OR trade_x = '' OR trade_y = ''")

    across = meet(placed).where("side_x != side_y").select(name("side_x", "id_x").alias("x"), name("side_y", "id_y").alias("y"))
    along = meet(firsts).where("side_x = side_y").select(name("side_x", "id_x").alias("x"), name("side_y", "id_y").alias("y"))
    own = placed.join(firsts.withColumnRenamed("id", "first"), [*spot, "side", "trade"]).select(name("side", "id").alias("x"), name("side", "first").alias("y"))
    every = across.union(along).union(own)
    return every.where(F.col("x") != F.col("y")).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def groups(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Connected components: ``node``, ``group`` (its least node). Labels spread until none changes; each round is written."""
    both = cut(edges.select("a", "b").union(edges.select("b", "a")))
    labels = cut(nodes.select("node", F.col("node").alias("group")))
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("group").alias("least"))
        after = labels.join(near, labels["node"] == near["a"], "left").select("node", F.least("group", F.coalesce("least", "group")).alias("group"), (F.col("least") < F.col("group")).alias("moved"))
        after = cut(after)
        if after.where("moved").limit(1).count() == 0:
            return after.select("node", "group")
        jump = after.select(F.col("node").alias("group"), F.col("group").alias("further"))
        labels = cut(after.join(jump, "group", "left").select("node", F.coalesce("further", "group").alias("group")))


def assign(pairs: list[tuple[str, str, float]]) -> list[tuple[str, str, float]]:
    """One-to-one choice of the pairs with the greatest total confidence, by augmenting paths (best gain first)."""
    left: dict[str, list[tuple[str, float]]] = {}
    for a, b, w in sorted(pairs):
        left.setdefault(a, []).append((b, w))
    mate_l: dict[str, str] = {}
    mate_r: dict[str, str] = {}
    weight = {(a, b): w for a, b, w in pairs}
    while True:
        # Bellman-Ford over alternating paths from free left nodes; gain of the best path to each left node.
        gain = {a: (0.0 if a not in mate_l else float("-inf")) for a in left}
        came: dict[str, tuple[str, str]] = {}
        changed = True
        while changed:
            changed = False
            for a in left:
                if gain[a] == float("-inf"):
                    continue
                for b, w in left[a]:
                    if b in mate_r and mate_r[b] != a:
                        c = mate_r[b]
                        v = gain[a] + w - weight[c, b]
                        if v > gain[c] + 1e-9:
                            gain[c], came[c], changed = v, (a, b), True
        ends = [(gain[a] + w, a, b) for a in left if gain[a] > float("-inf") for b, w in left[a] if b not in mate_r]
        # A path may also end at a left node that gives its partner up.
        drops = [(gain[c], c) for c in came if gain[c] > 1e-9]
        best = max(ends, default=(0.0, "", ""))
        drop = max(drops, default=(0.0, ""))
        if max(best[0], drop[0]) <= 1e-9:
            return sorted((a, b, weight[a, b]) for a, b in mate_l.items())
        if best[0] >= drop[0]:
            a, b = best[1], best[2]
        else:
            a, b = came[drop[1]]
            mate_l.pop(drop[1])
        while True:
            before = came.get(a) if a in mate_l else None
            mate_l[a], mate_r[b] = b, a
            if before is None:
                break
            a, b = before


def match_entities(records: DataFrame) -> DataFrame:
    """Pairs of records of sides 'a' and 'b' that are one entity: ``id_a``, ``id_b``, ``confidence`` (of their groups).

    ``records`` as for described(). Records without name, host and slug match nothing. Several records of a
    side can be one entity; each gives pairs. Repeated ids must be merged before. Empty sides give no rows.
    """
    # Records equal in all that is compared are one node; its members come back at the end.
    what = ["side", "cores", "slugs", "hosts", "trade", "place", "system", "segment"]
    mark = {"hx": F.xxhash64(*what), "hy": F.xxhash64(F.lit(7919), *what)}
    told = cut(described(records).withColumns(mark))
    firsts = told.groupBy("hx", "hy").agg(F.min("id").alias("node"))
    member = cut(guarded_join(told, firsts, ["hx", "hy"], "inner", "id").select("side", "node", "id", *what[1:]))
    full = cut(member.where("id = node").select("id", *what).dropDuplicates(["side", "id"]))
    facts = F.struct("cores", "slugs", "hosts", "trade", "place", "system", "segment")
    left = full.select(F.struct("side", "id").alias("x"), facts.alias("fx"))
    right = full.select(F.struct("side", "id").alias("y"), facts.alias("fy"))
    pairs = neighbours(full).join(left, "x").join(right, "y")

    @F.pandas_udf("double")
    def score(fx: pd.DataFrame, fy: pd.DataFrame) -> pd.Series:
        clean = lambda d: [{k: (None if v is None or (isinstance(v, float) and v != v) else v) for k, v in r.items()} for r in d.to_dict("records")]
        return pd.Series([compare(p, q) for p, q in zip(clean(fx), clean(fy), strict=True)], dtype="float64")

    name = lambda c: F.concat(F.col(f"{c}.side"), F.lit(":"), F.col(f"{c}.id"))
    known = F.col("fx.trade").isNotNull() & F.col("fx.trade").eqNullSafe(F.col("fy.trade"))
    host = F.arrays_overlap("fx.hosts", "fy.hosts")
    scored = pairs.select(name("x").alias("a"), name("y").alias("b"), (F.col("x.side") == F.col("y.side")).alias("within"), (known | host).alias("firm"), score("fx", "fy").alias("w"))
    scored = cut(scored.where(F.col("w") >= LEAST))

    nodes = full.select(F.concat("side", F.lit(":"), "id").alias("node"))
    group = cut(groups(nodes, scored.where(F.col("within") & F.col("firm") & (F.col("w") >= SAME))))
    of = lambda c, to: group.select(F.col("node").alias(c), F.col("group").alias(to))
    across = scored.where(~F.col("within")).join(of("a", "ga"), "a").join(of("b", "gb"), "b")
    links = cut(across.groupBy("ga", "gb").agg(F.max("w").alias("w")))

    # Groups that compete are settled together: components of the graph of groups.
    ends = links.select(F.col("ga").alias("node")).union(links.select("gb")).distinct()
    contest = groups(ends, links.select(F.col("ga").alias("a"), F.col("gb").alias("b")))
    bound = links.join(contest.select(F.col("node").alias("ga"), F.col("group").alias("contest")), "ga")

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = list(zip(pdf["ga"], pdf["gb"], pdf["w"], strict=True))
        taken = assign(rows)
        mate_a, mate_b = {a: b for a, b, _ in taken}, {b: a for a, b, _ in taken}
        # What is left over is one more record group of the entity it fits best, if nothing else claims it.
        out = list(taken)
        for side, mine in ((0, mate_a), (1, mate_b)):
            free: dict[str, tuple[float, str]] = {}
            for r in rows:
                if r[side] not in mine:
                    free[r[side]] = max(free.get(r[side], (0.0, "")), (r[2], r[1 - side]))
            out += [(me, to, w) if side == 0 else (to, me, w) for me, (w, to) in free.items()]
        return pd.DataFrame(out, columns=["ga", "gb", "confidence"])

    chosen = bound.groupBy("contest").applyInPandas(settle, "ga string, gb string, confidence double")
    everyone = member.select(F.concat("side", F.lit(":"), "node").alias("node"), "id").join(group, "node")
    members = lambda c, to: everyone.select(F.col("group").alias(c), F.col("id").alias(to))
    return chosen.join(members("ga", "id_a"), "ga").join(members("gb", "id_b"), "gb").select("id_a", "id_b", "confidence")
