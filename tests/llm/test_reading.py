"""Problem 10: held-out agreement on texts made here, isotonic fit, edge cases."""

import random

import numpy as np

from tidemark.llm import reading as rd

DDL = "doc_id bigint, text string, lang string, level int"
WORDS = {1: "cat dog sun run big red hat".split(), 2: "garden window teacher market simple colour".split(), 3: "structure consistent comparison approach evidence".split(), 4: "reconciliation accountability infrastructure methodology".split(), 5: "epistemological phenomenological incommensurability operationalisation".split()}


def text(level, rng, n=80):
    out = []
    while len(out) < n:
        pool = WORDS[min(5, max(1, level + rng.choice([0, 0, 0, 0, -1, 1])))]
        out += [rng.choice(pool) for _ in range(2 + 2 * level)]
        out[-1] += "."
    return " ".join(out)


def make(spark, n=300, seed=0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        level = i % 5 + 1
        docs.append((i, text(level, rng), "en" if i % 4 else "EN-gb", level))
        if i % 2:
            for r in range(rng.choice([1, 1, 2, 3])):
                labels.append((i, f"r{r}", min(5, max(1, level + rng.choice([0] * 9 + [rng.choice([-1, 1])]))), None))
            labels.append(labels[-1])
    labels += [(1, "r", None, None), (99999, "r", 3, None), (None, "r", 2, None), (3, "r", 9, None)]
    return docs, spark.createDataFrame(labels, "doc_id bigint, rater string, level int, rated_at timestamp")


def test_held_out(spark):
    docs, labels = make(spark)
    got = {r["doc_id"]: r["level"] for r in rd.grade(spark.createDataFrame(docs, DDL), labels).collect()}
    assert set(got) == set(range(300))
    held = [i for i in range(0, 300, 2)]
    assert np.mean([got[i] == i % 5 + 1 for i in held]) > 0.9 and all(abs(got[i] - (i % 5 + 1)) <= 1 for i in held)


def test_which_documents_count(spark):
    docs, labels = make(spark, 100)
    rng = random.Random(1)
    more = [(1000, text(1, rng, 40), "en", 0), (1001, None, "en", 0), (1002, "", "en", 0), (1003, text(1, rng), "de", 0), (1004, text(5, rng), None, 0), (1005, "12 34 " * 40, "en", 0), (1006, text(3, rng, 30_000), "en", 0), (1007, "слово и дело здесь " * 30, None, 0), (1, docs[1][1], "en", 2)]
    got = [tuple(r) for r in rd.grade(spark.createDataFrame(docs + more, DDL), labels).collect()]
    ids = {i for i, _ in got}
    assert len(ids) == len(got) and ids & set(range(1000, 1010)) == {1004, 1005, 1006} and all(1 <= v <= 5 for _, v in got)
    assert dict(got)[1004] == 5


def test_without_ratings_or_documents(spark):
    docs, labels = make(spark, 20)
    df = spark.createDataFrame(docs, DDL)
    assert rd.grade(df, labels.limit(0)).count() == 0 and rd.grade(df.limit(0), labels).count() == 0
    assert rd.grade(df, labels.limit(1)).count() <= 20


def test_isotonic_is_the_least_squares_monotone_fit():
    rng = np.random.default_rng(0)
    for _ in range(20):
        x, y = rng.normal(size=40), rng.normal(size=40)
        kx, ky = rd.isotonic(x, y)
        fit = np.interp(x, kx, ky)
        assert (np.diff(fit[np.argsort(x)]) >= -1e-12).all()
        ys = y[np.argsort(x)]
        best = [max(min(ys[a : b + 1].mean() for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
        assert np.allclose(fit[np.argsort(x)], best)


def test_model_probabilities_sum_to_one():
    rng = random.Random(0)
    texts = [text(k, rng) for k in (1, 2, 3, 4, 5)]
    g = rd.fit(texts, np.array([1.0, 2, 3, 4, 5]))
    v = len(g.models.ids) + 1 + rd.ENDS
    stream = np.array(rd.encode(texts[2], g.models.ids))
    a, b, _ = rd.contexts(stream[:6])
    for x, y in zip(a, b):
        p = np.exp(-g.models.surprisal(np.full(v, x), np.full(v, y), np.arange(v)))
        assert np.allclose(p.sum(0), 1)


def test_sample_is_bounded_in_documents_and_characters(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('word ', 20) AS text")
    labels = spark.range(4000).selectExpr("id AS doc_id", "'r' AS rater", "1 + cast(id % 5 AS int) AS level", "timestamp'2025-01-01' AS rated_at")
    assert 300 < rd.rated(docs, labels, sample=400).count() < 500
    assert 150 < rd.rated(docs, labels, chars=20_000).count() < 250
    assert rd.rated(docs, labels).count() == 4000 and rd.rated(docs, labels.limit(0)).count() == 0
