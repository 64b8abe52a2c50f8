"""Problem 3 on spellings made here, and its parts."""

import random

import pytest

from tidemark.llm import names

ORGS = ["Githdoby Labs", "Halzowick Bramsevane Studio", "Mirmoford & Velriholt", "Hallacrest Analytics", "Hallacrest Digital", "Oskzowica Group", "Oskzowick Group", "Alexander Calzoford", "Patricia Mirdonix", "Quilzovane Institute"]


def lcs(a, b):
    p = [0] * (len(b) + 1)
    for x in a:
        q = [0]
        for j, y in enumerate(b):
            q.append(p[j] + 1 if x == y else max(p[j + 1], q[j]))
        p = q
    return p[-1]


def test_lcs_ratio_equals_the_table():
    rng = random.Random(0)
    for _ in range(500):
        a, b = ("".join(rng.choice("abcé") for _ in range(rng.randrange(0, 90))) for _ in range(2))
        assert names.lcs_ratio(a, b) == pytest.approx(2 * lcs(a, b) / (len(a) + len(b)) if a and b else 0)


VARIANTS = {
    "Githdoby Labs": ["  Githdoby Labs", "GITHDOBY LABS", "Githdoby_Labs", "GithdobyLabs", "Gihtdoby Labs", "Githdob yLabs", "Labs, Githdoby", "The Githdoby Labs Team", "Githdoby Labs, Inc.", "Gith. Labs", "Githdoby Lab.", "Githdoby", "docs.githdoby-labs.example", "Githdóby Labs", "githdoy las ltd"],
    "Halzowick Bramsevane Studio": ["HBS", "H.B. Studio", "Halz. Studio", "Studio, Halzowick Bramsevane", "Hazowick Stud.", "halzowickbramsevanestudio.example"],
    "Mirmoford & Velriholt": ["Mirmoford and Velriholt", "Mirmoford&Velriholt", "M&V", "Velriholt, Mirmoford &"],
    "Alexander Calzoford": ["Alex Calzoford", "Calzoford, A.", "calzoford alexander", "A. Calzoford", "alex calzooord"],
    "Patricia Mirdonix": ["Pat Mirdonix", "P. Mirdonix"],
    "Oskzowica Group": ["oskzowica group", "Oskzowica Group Blog"],
}
NOBODY = ["Unknown", "Personal Blog", "", "  ", "unattributed-legacy", "Hallacrest", "Thalrinix Mirzocrest", "Kesgusen Oskmovane Notes", "Hallacrest Media", "Oskzowic Group", "N/A", "?", None]


def resolved(spark, typed):
    reg = spark.createDataFrame([(o, i) for i, o in enumerate(ORGS)] + [(None, 99), ("", 98)], "canonical_org string, name int")
    return {r["name"]: r["canonical_org"] for r in names.resolve(spark.createDataFrame([(t,) for t in typed], "name string"), reg).collect()}


def test_spellings(spark):
    typed = [v for vs in VARIANTS.values() for v in vs] + NOBODY + ORGS
    got = resolved(spark, typed + typed)
    assert {v: got.get(v) for vs in VARIANTS.values() for v in vs} == {v: k for k, vs in VARIANTS.items() for v in vs}
    assert {o: got.get(o) for o in ORGS} == {o: o for o in ORGS} and not set(NOBODY) & set(got)
    assert resolved(spark, []) == {}


def test_found(spark):
    rules = spark.createDataFrame([("1", "githdoby labs", "x"), ("2", "Githdoby Labs", "x"), ("3", None, "x"), ("4", "Nobody Here Known", "x"), ("5", "HALLACREST", "x"), ("1", "githdoby labs", "x"), ("6", "Short Name Co", "x")], "id string, source_org string, canonical_org string")
    aliases = spark.createDataFrame([("githdoby", None), ("hallacrest", "Hallacrest Digitl"), ("quilzovane institute", "Quilzovane Institute"), ("Nobody", None), (None, "x"), ("short name co", "Quilzovane Institute"), ("githdoby", None)], "alias string, canonical_org string")
    reg = spark.createDataFrame([(o,) for o in ORGS], "canonical_org string")
    got = sorted(tuple(r) for r in names.found(rules, aliases, reg).distinct().collect())
    assert got == [("org_aliases", "githdoby", "Githdoby Labs"), ("org_aliases", "hallacrest", "Hallacrest Digital"), ("rules", "1", "Githdoby Labs"), ("rules", "5", "Hallacrest Digital"), ("rules", "6", "Quilzovane Institute")]
    assert names.found(rules.limit(0), aliases.limit(0), reg).count() == 0 and names.found(rules, aliases, reg.limit(0)).count() == 0


def test_common_suffixes_are_refined(spark):
    reg = spark.createDataFrame([(f"{chr(97 + i % 26)}{chr(97 + i // 26)}zq Labs",) for i in range(60)], "canonical_org string")
    got = names.resolve(spark.createDataFrame([("abzq  LABS",)], "name string"), reg).collect()
    assert [r["canonical_org"] for r in got] == ["abzq Labs"]


def test_no_name_goes_without_candidates(spark):
    """600 registered names that differ in their middle only: every key of the typed ones is common at every refinement."""
    mid = ["".join((chr(97 + i % 26), chr(97 + i // 26 % 26), chr(97 + i // 676), "x")) for i in range(600)]
    reg = spark.createDataFrame([(f"Calz {m} Labs", None) for m in mid], "name string, site string")
    typed = spark.createDataFrame([(f"CALZ {mid[i]} labs", None) for i in (0, 299, 599)] + [("calz 9999 labs", None)], "name string, site string")
    pairs = names.candidates(typed, reg).groupBy("name").count().collect()
    assert {r["name"] for r in pairs} == {f"CALZ {mid[i]} labs" for i in (0, 299, 599)} | {"calz 9999 labs"}
    assert {r["name"]: r["count"] for r in pairs}["calz 9999 labs"] == 600
    got = {r["name"]: r["canonical_org"] for r in names.resolve(typed, reg.withColumnRenamed("name", "canonical_org")).collect()}
    assert {k: got.get(k) for k in (f"CALZ {mid[i]} labs" for i in (0, 299, 599))} == {f"CALZ {mid[i]} labs": f"Calz {mid[i]} Labs" for i in (0, 299, 599)}


def test_the_site_refines_common_suffixes(spark):
    reg = spark.createDataFrame([(f"C{chr(97 + i)}rion Labs", f"https://www.c{i}.example/start") for i in range(26)], "canonical_org string, root_url string")
    typed = spark.createDataFrame([("Cxxxx Labs", "c3.example")], "name string, site string")
    keys = {r["canonical"] for r in names.candidates(typed, reg.select(reg.canonical_org.alias("name"), names.site_of(reg.root_url).alias("site"))).collect()}
    assert keys == {"Cdrion Labs"}
    df = spark.createDataFrame([("https://a.b.example:80/x",), ("http://localhost/",), (None,)], "u string")
    assert [r[0] for r in df.select(names.site_of(df.u)).collect()] == ["b.example", None, None]
