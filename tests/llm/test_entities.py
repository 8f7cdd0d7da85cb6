import itertools
import random

from tidemark.llm.entities import assign, compare, host_of, match_entities, rest_of, shortened, split_name


def test_names():
    assert split_name("Energy, Quobra") == ("quobra", "energy", []) and split_name("QuobraLearning GmbH") == ("quobra", "learning", [])
    assert split_name("Figlo Systems (ex Rutra)") == ("figlo", "systems", ["rutra"]) and split_name(None) == ("", None, [])
    assert host_of("https://www.getquobra.example/careers") == "quobra" and host_of("https://boards.lever.example/x") == "" and host_of("common_crawl") == ""
    assert rest_of("quobrasw2india", "quobra") == (True, "software") and rest_of("quobranova", "quobra") == (False, None)
    assert shortened("gofufpa64", "gofufuba", "payments") and not shortened("gofufpa64", "gofufuba", "energy")


def brute(pairs):
    best = 0.0
    for n in range(len(pairs) + 1):
        for chosen in itertools.combinations(pairs, n):
            if len({a for a, _, _ in chosen}) == n == len({b for _, b, _ in chosen}):
                best = max(best, sum(w for _, _, w in chosen))
    return best


def test_assignment_is_best():
    random.seed(2)
    for _ in range(60):
        pairs = [(a, b, round(random.uniform(0.7, 1), 2)) for a in "abcd" for b in "wxyz" if random.random() < 0.5]
        got = assign(pairs)
        assert len({a for a, _, _ in got}) == len(got) == len({b for _, b, _ in got})
        assert abs(sum(w for _, _, w in got) - brute(pairs)) < 1e-6


SCHEMA = "side string, id string, names array<string>, token string, urls array<string>, place string, system string, segment string"


def test_matching(spark):
    rows = [
        ("a", "1", ["Quobra Energy GmbH"], None, ["quobraenergy.example"], "1", "lever", None), ("a", "2", ["QUOBRA ENERGY"], None, [None], None, None, None), ("a", "3", ["Quobra Health"], None, None, None, None, None),
        ("a", "4", ["Newname Systems"], None, ["oldone-sys.example"], "2", "keka", None), ("a", "5", [None], None, [None], None, None, None), ("a", "6", ["Lonelyfirm Capital"], None, None, None, None, None),
        ("b", "p1", ["quobraa energy"], "quobra-energy", None, "1", "lever", None), ("b", "p2", [None], "quobrahealthcarehq", None, None, "lever", None), ("b", "p3", ["Oldone Systems"], "oldone-sys", [None], "2", "keka", None),
        ("b", "p4", [], "zzz", [], None, None, None), ("b", "p5", None, "", None, None, None, None),
    ]
    got = {(r["id_a"], r["id_b"]) for r in match_entities(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {("1", "p1"), ("2", "p1"), ("3", "p2"), ("4", "p3")}
    assert match_entities(spark.createDataFrame([], SCHEMA)).count() == 0
    assert match_entities(spark.createDataFrame(rows[:3], SCHEMA)).count() == 0


def test_typo_among_crowded_keys(spark):
    """More than WINDOW names stand between the two spellings in the order of names and in that of reversed names."""
    crowd = [f"quobre{c}a" for c in "bcdfghklm"] + [f"{c}abezani" for c in "bcdfghklm"]
    rows = [("b", f"x{i}", [f"{n} Health"], None, None, None, None, None) for i, n in enumerate(crowd)]
    rows += [("a", "1", ["Quobrazani Energy"], None, None, None, None, None), ("b", "p1", ["Quobrizani Energy"], None, None, None, None, None)]
    got = {(r["id_a"], r["id_b"]) for r in match_entities(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {("1", "p1")}


def test_conflicting_trade_never_matches():
    x = {"cores": ["quobra"], "slugs": [], "hosts": ["quobra"], "trade": "energy", "place": "1", "system": "lever", "segment": None}
    assert compare(x, x | {"trade": "health"}) == 0.0 and compare(x, x) > 0.95
