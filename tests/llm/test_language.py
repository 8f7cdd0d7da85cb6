import random

from pyspark.sql import functions as F

from tidemark.llm.language import NOTATIONS, detect, fit, frequencies, hashed, label_code, letters, paragraphs, sample, segments, trained

TEXTS = {
    "en": "The process has two steps and we answer every application. You help new people learn how the service works. Most days you write down what the team decided.",
    "de": "Wir suchen zum nächsten Termin Verstärkung für unseren Standort. Bitte schicke uns deinen Lebenslauf und nenne deinen Termin. Du prüfst die Daten und sprichst mit den Kollegen.",
    "fr": "Nous recherchons une personne curieuse pour notre équipe. Merci d'envoyer votre lettre avant la fin du mois. Le poste est à pourvoir dès que possible dans notre maison.",
    "es": "Ofrecemos un sueldo justo y una persona te enseña todo. Envía tu currículum antes de que termine el plazo. La empresa nació hace años y hoy cuenta con muchos empleados.",
}


def model():
    random.seed(1)
    rows = [(c, "\n\n".join(random.sample(t.split(". "), 2)), 1.0) for c, t in TEXTS.items() for _ in range(30)]
    return fit([*rows, ("fr", TEXTS["en"], 1.0)])  # one wrong label


def test_labels(spark):

    cases = {"EN": "en", "en_GB": "en", "German": "de", "fre": "fr", "Dansk": "da", "xx": "", " ": "", None: "", "fi": "fi", "हिन्दी": "hi"}
    got = spark.createDataFrame([(k,) for k in cases], "v string").select("v", label_code(F.col("v")).alias("c")).collect()
    assert {r["v"]: r["c"] for r in got} == cases
    assert len(NOTATIONS) == 11 or len(NOTATIONS) == 12


def test_segments(spark):
    mixed = f"{TEXTS['en']}\n \n{TEXTS['de'].upper()}\n\n123 -- 45\n\n{TEXTS['es']}"
    rows = [(1, TEXTS["de"], "en"), (2, mixed, "English"), (3, None, "en"), (4, "  \n ", "en"), (5, "123 456", None), (6, TEXTS["fr"], "fr-FR"), (6, TEXTS["fr"], "fr-FR"), (7, TEXTS["en"] * 2000, None)]
    df = spark.createDataFrame(rows, "lang int, text string, label string")
    out = detect(df.withColumnRenamed("lang", "k").withColumn("seg_no", F.col("k")), "k", "text", "label", model()).collect()
    got = {(r["k"], r["seg_no"]): r for r in out}
    assert got[1, 0]["lang"] == "de" and got[1, 0]["label"] == "en" and not got[1, 0]["mixed"]
    assert [got[2, i]["lang"] for i in (1, 2, 3, 4)] == ["en", "de", None, "es"] and got[2, 0]["mixed"]
    assert (3, 0) not in got and (4, 0) not in got and got[5, 0]["lang"] is None
    assert sum(1 for r in out if (r["k"], r["seg_no"]) == (6, 0)) == 2 and got[6, 0]["lang"] == "fr" and got[7, 0]["lang"] == "en"
    assert all(0 <= r["confidence"] <= 1 for r in out if r["lang"])
    assert detect(df.limit(0), "lang", "text", "label", model()).count() == 0


def test_paragraphs():
    assert paragraphs("a\nb\n \n\nc\n") == ["a\nb", "c"] and paragraphs("") == [] and letters("12 -- !!") == ""


def test_held_out_accuracy():
    m = model()
    held = {"en": "We decided how people learn new steps of the process every day.", "de": "Bitte nenne den Kollegen deinen Standort und die Daten.", "fr": "Merci pour votre lettre, notre équipe recherche une personne.", "es": "La empresa termina el plazo y envía un currículum antes."}
    assert m.languages(list(held.values()))[0] == list(held)


def test_same_model_for_repeated_tables(spark):
    random.seed(5)
    rows = [(c, ". ".join(random.sample(t.split(". "), 2))) for c, t in TEXTS.items() for _ in range(6)] + [("sv", TEXTS["en"]), ("de", None), ("fr", " \n ")]
    once = spark.createDataFrame([(i, t, c) for i, (c, t) in enumerate(rows)], "k int, text string, label string")
    more = spark.createDataFrame([(1000 * j + i, t, c) for j in range(10) for i, (c, t) in enumerate(rows)], "k int, text string, label string")
    assert sample(once, "text", "label") == sample(more, "text", "label")
    one, ten = frequencies(once, "text"), frequencies(more, "text")
    assert ten[1] == 10 * one[1] and (ten[0] == 10 * one[0]).all()
    a, b = trained(once, "text", "label"), trained(more, "text", "label")
    assert a.codes.tolist() == b.codes.tolist()
    held = [s for t in TEXTS.values() for s in t.split(". ")]
    assert a.languages(held)[0] == b.languages(held)[0]


def test_wrong_labels_stay_out_of_the_centroids():
    random.seed(7)
    right = [(c, "\n".join(random.sample(t.split(". "), 2)), 1.0) for c, t in TEXTS.items() for _ in range(30)]
    wrong = [("fr", TEXTS["en"].split(". ")[i % 3], 1.0) for i in range(8)]  # fewer than the label's own texts
    m = fit([*right, *wrong])
    assert m.languages(TEXTS["en"].split(". "))[0] == ["en"] * 3 and m.languages(TEXTS["fr"].split(". "))[0] == ["fr"] * 3


def test_counts_by_brute_force(spark):
    texts = ["Ab cd. Ab cd.\n\nxyz 12", "", None, "xyz", "REQ-12 44/7"]
    held, total = frequencies(spark.createDataFrame([(t,) for t in texts], "text string"), "text")
    assert total == 4  # ab cd twice, xyz twice; digits and codes are no words
    row, col, times = hashed([" ab cd ", " xyz "])
    for r, c in zip(row, col, strict=True):
        assert held[c] == 2 * len(set(row[col == c]))
    assert sum(times[row == 1]) == len(" xyz ") * 3 - (1 + 2 + 3)


def test_one_unsure_paragraph_makes_no_mixed_document():
    m = model()
    out = segments(m, [1, 2], [f"{TEXTS['en']}\n\nOk.\n\n{TEXTS['en']}", f"{TEXTS['en']}\n\n{TEXTS['es']}"], ["en", "en"])
    assert not out[out.key == 1].mixed.any() and out[out.key == 2].mixed.all()
    assert segments(m, [], [], []).empty
