"""Problem 4: held-out accuracy on sentences made here, segments and labels."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language as lg

PARTS = {
    "en": (["The house", "A small dog", "My brother", "This book"], ["stands near", "looks at", "belongs to", "was found behind"], ["the old bridge", "our neighbours", "the green hill", "a broken window"]),
    "de": (["Das Haus", "Ein kleiner Hund", "Mein Bruder", "Dieses Buch"], ["steht neben", "schaut auf", "gehört zu", "lag hinter"], ["der alten Brücke", "unseren Nachbarn", "dem grünen Hügel", "einem zerbrochenen Fenster"]),
    "fr": (["La maison", "Un petit chien", "Mon frère", "Ce livre"], ["se trouve près de", "regarde vers", "appartient à", "était derrière"], ["la vieille rivière", "nos voisins", "la colline verte", "une fenêtre cassée"]),
    "ru": (["Этот дом", "Маленькая собака", "Мой брат", "Эта книга"], ["стоит около", "смотрит на", "принадлежит", "лежала за"], ["старого моста", "наших соседей", "зелёного холма", "разбитого окна"]),
}


def text(lang, rng, n=4):
    a, b, c = PARTS[lang]
    return " ".join(f"{rng.choice(a)} {rng.choice(b)} {rng.choice(c)}." for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(1)
    rows = [(i, text(k := list(PARTS)[i % 4], rng, 6), k.upper() + "-X" if i % 3 else k) for i in range(200)] + [(900, None, "en"), (901, "", "de"), (902, "abc", None), (None, "x", "fr"), (903, "zzz", "unknown")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


@pytest.fixture(scope="module")
def filters(docs):
    return lg.train(docs)


def test_held_out_accuracy(filters):
    assert filters.languages == ["de", "en", "fr", "ru"]
    rng, table = random.Random(2), lg.letters()
    right = 0
    for i in range(200):
        want = list(PARTS)[i % 4]
        m = filters.look_up(lg.gram_hashes(text(want, rng, 1), table))
        lang, sure = filters.decide(m, np.array([0]), np.array([m.shape[1]]))
        right += filters.languages[lang[0]] == want and 0 < sure[0] <= 1
    assert right >= 198


def test_false_positives_are_corrected(filters):
    rng = np.random.default_rng(0)
    h = rng.integers(1, 2**63, 200_000).astype(np.uint64)
    masks = filters.look_up(h)
    for i in range(4):
        assert abs(((masks[0] >> np.uint64(i)) & np.uint64(1)).mean() - filters.rates[i]) < 0.002
    lang, _ = filters.decide(masks, np.array([0]), np.array([100]))
    assert lang[0] == -1 or filters.rates.max() > 0.01


PAGES = "page_id bigint, url string, title string, text string, lang string, label int, keep int"


def test_found(spark, docs):
    rng = random.Random(3)
    de, fr = text("de", rng), text("fr", rng)
    rows = [
        (1, "https://a1.example/x", "t", f"{de}\n{de}\n{fr}", "de-AT", 1, 1), (2, "https://a2.example/x", "t", f"{fr}\n\n{fr}", "DE", 1, 1), (3, "https://a3.example/x", "t", fr, None, 1, 1), (4, "https://a4.example/x", "t", fr, "und", 1, 1),
        (5, "https://a5.example/x", None, None, "en", 1, 1), (6, "https://a6.example/x", "", " \n", "en", 1, 1), (7, "https://a7.example/x", "t", f"{de}\nMon frère", "de", 1, 1), (1, "https://a1.example/x", "t", f"{de}\n{de}\n{fr}", "de-AT", 1, 1), (8, "https://a8.example/x", None, "12345 67890", "de", 1, 1),
    ]
    rules = [("a", text("en", rng), 1), ("b", text("ru", rng) + "\n" + text("en", rng, 1), 1), ("c", None, 1), ("d", "", 1), (None, "x", 1), ("b2", text("en", rng) + "\n" + text("ru", rng, 2), 1)]
    got = sorted(tuple(r) for r in lg.found(spark.createDataFrame(rows, PAGES), spark.createDataFrame(rules, "id string, then_logic string, lang int"), docs).collect())
    assert got == [
        ("changed_urls", "1", 2, "fr"), ("changed_urls", "2", -1, "fr"), ("changed_urls", "3", -1, "fr"), ("changed_urls", "4", -1, "fr"),
        ("rules", "b", -1, "ru"), *([("rules", "b", 1, "en")] if len(rules[1][1].split("\n")[1]) >= 40 else []), ("rules", "b2", 1, "ru"),
    ]
    all_ = lg.identify(spark.createDataFrame(rows, PAGES), spark.createDataFrame(rules, "id string, then_logic string, lang int"), docs)
    assert all_.filter((F.col("confidence") <= 0) | (F.col("confidence") > 1)).count() == 0


def test_empty_tables(spark, docs):
    p, r = spark.createDataFrame([], PAGES), spark.createDataFrame([], "id string, then_logic string")
    assert lg.found(p, r, docs).count() == 0
    none = lg.found(p, spark.createDataFrame([("a", "some words here")], "id string, then_logic string"), docs.limit(0))
    assert none.count() == 0


def test_long_line(spark, filters):
    rng = random.Random(5)
    long = text("ru", rng, 20_000)
    got = lg.line_languages(spark.createDataFrame([(1, long + "\n" + text("en", rng))], "row bigint, text string"), filters).first()
    assert [filters.languages[i] for i in got["lang"]] == ["ru", "en"]


def test_any_number_of_languages_and_codes_of_three_letters(spark):
    """70 invented languages, each with words of its own letters."""
    rng = random.Random(7)
    codes = [chr(97 + i // 26) + chr(97 + i % 26) + ("x" if i % 2 else "") for i in range(70)]
    words = {c: ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(30)] for c in codes}
    say = lambda c, n: " ".join(rng.choice(words[c]) for _ in range(n))
    rows = [(i, say(c := codes[i % 70], 40), c) for i in range(420)] + [(1000 + i, say(codes[0], 40), "und") for i in range(9)]
    f = lg.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert f.languages == sorted(codes) and f.masks.shape == (2, 1 << lg.BITS)
    table = lg.letters()
    for c in codes:
        m = f.look_up(lg.gram_hashes(say(c, 12), table))
        assert f.languages[f.decide(m, np.array([0]), np.array([m.shape[1]]))[0][0]] == c


def test_sample_is_bounded(spark):
    rows = [(i, text("en", random.Random(i), 1), "en") for i in range(3000)] + [(5000 + i, text("de", random.Random(i), 1), "de") for i in range(5)]
    f = lg.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), sample=40)
    assert f.languages == ["de", "en"]
