import random
from collections import defaultdict

from tidemark.llm.mixing import mix
from tidemark.llm.packing import best_fit, complete, fewer, fillings, pack, packed
from tidemark.llm.tokens import count_tokens


def least_bins(sizes, capacity):
    """Fewest containers by trying all partitions."""
    best = [len(sizes)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i]:
                go(i + 1, [*rooms[:k], rooms[k] - sizes[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - sizes[i]])

    go(0, [])
    return best[0]


def test_bin_completion_is_least():
    random.seed(4)
    for _ in range(80):
        sizes = [random.randint(1, 60) for _ in range(random.randint(0, 9))]
        got = complete(sizes, 100)
        assert sorted(i for b in got for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) <= 100 for b in got)
        assert len(got) == least_bins(sizes, 100)
    assert len(best_fit([6, 5, 4, 3, 2], 10)) == 2 and fewer([6, 6], 10, 1) is None


def test_pack(spark):
    rows = [(1, 5000), (2, 2048), (3, 0), (4, None), (5, 1000), (5, 1000), (6, 48), (7, -1)]
    df = spark.createDataFrame(rows, "container int, n int")
    got = pack(df, "container", "n", 2048).collect()
    names = [f for f in got[0].__fields__]
    assert names == ["container", "container", "piece", "start", "size", "fill"]
    got = [tuple(r) for r in got]
    by = defaultdict(int)
    for c, _, _, _, s, _ in got:
        by[c] += s
    assert all(by[c] == fill <= 2048 for c, *_, fill in got)
    assert sorted((p, st, s) for _, k, p, st, s, _ in got if k == 1) == [(0, 0, 2048), (1, 2048, 2048), (2, 4096, 904)]
    assert sum(1 for _, k, *_ in got if k == 5) == 2 and {k for _, k, *_ in got} == {1, 2, 3, 5, 6}
    assert pack(df.limit(0), "container", "n", 2048).count() == 0


def test_pack_blocks_agree(spark):
    df = spark.range(300).selectExpr("id", "CAST(pmod(xxhash64(id), 900) AS BIGINT) AS n")
    got = pack(df, "id", "n", 1000, block=50).collect()
    assert sorted(r["id"] for r in got) == list(range(300))
    assert len({r["container"] for r in got}) <= sum(r["size"] for r in got) / 1000 * 1.1 + 8


def test_tokens_round_trip(spark):
    texts = ["", None, "hello world", "<|endoftext|>", "नमस्ते", "a" * 5000, "x y  z\n" * 2000]
    got = [r["n_tokens"] for r in count_tokens(spark.createDataFrame([(t,) for t in texts], "v string"), "v").collect()]
    assert got[0] == 0 and got[1] is None and got[2] == 2 and got[3] > 1 and all(g > 0 for g in got[4:])


def test_mix(spark):
    rows = [(i, "Big-Source", 10) for i in range(2000)] + [(10_000 + i, "small", 10) for i in range(100)] + [(1, None, 10), (2, "", 10), (3, "unlisted", 10), (4, "small", None)]
    df = spark.createDataFrame(rows, "rate int, s string, n int")
    targets = spark.createDataFrame([("big_source", 0.7, 1), ("small", 0.2, 4), ("missing", 0.1, 2)], "source string, target_share double, max_repeats int")
    records, report = mix(df, "rate", "s", "n", targets)
    rep = {r["source"]: r.asDict() for r in report.collect()}
    assert abs(rep["small"]["rate"] - 4) < 1e-9 and abs(rep["big_source"]["rate"] - 0.7) < 1e-9
    assert abs(rep["big_source"]["share"] - 7 / 9) < 0.02 and rep["missing"]["records"] == 0 and rep["unlisted"]["target_share"] == 0
    copies = defaultdict(int)
    for r in records.collect():
        copies[r["rate"], r["source"]] += 1
    assert max(copies.values()) <= 4 and {s for _, s in copies} == {"big_source", "small"}
    over = {r["source"]: r for r in mix(df, "rate", "s", "n", targets, total=100_000)[1].collect()}
    assert over["big_source"]["rate"] == 1 and over["small"]["rate"] == 4
    assert mix(df.limit(0), "rate", "s", "n", targets)[0].count() == 0


def test_search_beats_best_fit_at_a_thousand_items():
    k = 33  # six containers of 1034, 522, 492 and three of twice 532, twice 492
    sizes = [1034] * 6 * k + [522] * 6 * k + [492] * 12 * k + [532] * 6 * k
    boxes, known = packed(sizes, 2048)
    assert len(best_fit(sizes, 2048)) == 11 * k and len(boxes) == 9 * k and known == "bound"
    assert sorted(i for b in boxes for i in b) == list(range(len(sizes))) and all(sum(sizes[i] for i in b) == 2048 for b in boxes)


def test_how_a_number_is_known():
    random.seed(9)
    seen = set()
    for _ in range(150):
        sizes = [random.randint(8, 60) for _ in range(random.randint(6, 10))]
        boxes, known = packed(sizes, 100)
        seen.add(known)
        assert known in ("bound", "search") and len(boxes) == least_bins(sizes, 100)
    assert seen == {"bound", "search"}
    hard = [random.randint(600, 1100) for _ in range(200)]
    boxes, known = packed(hard, 2048, nodes_limit=50)
    assert known == "limit" and len(boxes) == len(best_fit(hard, 2048)) and packed([], 10) == ([], "bound")


def test_fillings_are_all_undominated():
    from itertools import combinations

    sizes = [50, 40, 30, 20, 20, 7]
    counts = {s: sizes.count(s) for s in sizes}
    got, whole = fillings(counts, sorted(counts, reverse=True), 70)
    fit = {tuple(sorted(c, reverse=True)) for n in range(1, 7) for c in combinations(sizes, n) if sum(c) <= 70}

    def dominated(c):
        left = list(sizes)
        for x in c:
            left.remove(x)
        room = 70 - sum(c)
        return any(x <= room for x in left) or any(x < y <= x + room for x in c for y in left)

    assert whole and set(got) == {c for c in fit if not dominated(c)} and not fillings(counts, sorted(counts, reverse=True), 70, 2)[1]
