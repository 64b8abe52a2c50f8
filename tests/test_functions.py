"""Scalars against plain Python versions of their definitions."""

import hashlib
import random
import re
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.functions import urls as ux
from tidemark.functions.salvage import rules_from_answer, salvage


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def py_norm(u):
    p = urlsplit(u.strip())
    q = [(k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if not re.match(r"(?i)(hl|utm_[a-z]+|gclid|fbclid)\Z", k)]
    return urlunsplit((p.scheme, p.netloc, p.path.rstrip("/") or "/", urlencode(q), ""))


def test_url_spellings_collapse(spark):
    same = ["https://example.test/guide", "https://example.test/guide/", "HTTPS://example.test/guide?hl=zh-CN", "https://example.test/guide?utm_source=x#top", " https://example.test/guide?gclid=1 "]
    assert set(column(spark, same, ux.normalize_url)) == {"https://example.test/guide"}


def test_url_normalize_equals_python(spark):
    rng = random.Random(4)
    keys = ["hl", "UTM_source", "utm_x", "ref", "page", "q", "gclid", "a b", "x%20y", "k*", "t~"]
    urls = []
    for _ in range(300):
        q = "&".join(rng.choice([f"{k}={v}", k, ""]) for k, v in ((rng.choice(keys), rng.choice(["1", "", "a+b", "%C3%A9", "x=y", "*-._~"])) for _ in range(rng.randrange(4))))
        urls.append(rng.choice(["http", "HTTPS"]) + "://" + rng.choice(["a.example", "B.example:80"]) + rng.choice(["", "/", "/p//", "/p/q"]) + rng.choice(["", "?" + q]) + rng.choice(["", "#f"]))
    urls += ["mailto:a@b.example", "", "/", "www.x.example/y/", "https://a.example?x"]
    assert column(spark, urls, ux.normalize_url) == [py_norm(u) for u in urls]
    assert column(spark, [None], ux.normalize_url) == [None]


@pytest.mark.parametrize(
    "path,reason",
    [("/login", "root"), ("/en-US/about", "root"), ("/advertising", "root"), ("/404", "root"), ("/x/y.pdf", "path"), ("/blog/page/2", "path"), ("/tags/x", "path"), ("/list?page=3", "query"),
     ("/en-US/docs/Web/Privacy", None), ("/docs/authentication", None), ("/search/docs", None), ("/guide?ref=page", None), ("/guide", None)],
)
def test_denylist(spark, path, reason):
    assert column(spark, ["https://x.example" + path], ux.deny_reason) == [reason]


def test_url_filter(spark):
    df = spark.createDataFrame([("https://x.example/docs/a", "^/(docs)/"), ("https://x.example/news/a", "^/(docs)/"), ("https://x.example/news/a", None), ("https://x.example/login", None)], "u string, p string")
    assert [r[0] for r in df.select(ux.url_allowed(F.col("u"), F.col("p"))).collect()] == [True, False, True, False]


def test_valid_url(spark):
    good = ["https://a.example", "HTTP://a-b.example:8080/x?y#z", "http://a.example?x", "https://1.2/"]
    bad = ["ftp://a.example", "https://localhost/x", "https://a..example/", "https://a.example/x y", "https://a.example/<b>", " https://a.example", "https://a.example/\n", "", "https://é.example/"]
    assert column(spark, good + bad + [None], ux.valid_url) == [True] * len(good) + [False] * (len(bad) + 1)


def test_specificity_host_org(spark):
    u = ["https://a.example/b/c/", "", None]
    assert column(spark, u, ux.specificity) == [5, -1, -1]
    assert column(spark, u, ux.specificity_upsert) == [4, 0, 0]
    assert column(spark, ["https://www.A.example/x", "b.example"], ux.host) == ["a.example", "b.example"]
    assert column(spark, ["www.Moz.com", "A.IO", "plain.ai"], ux.org_key) == ["moz", "a.io", "plain"]


SPACES = ["a b", " a\t\nb ", " a b ", "　x", "\x1cx\x1f", "", None, "x" * 5]


def test_squeeze_hash_key_equal_python(spark):
    norm = [re.sub(r"\s+", " ", s or "").strip() for s in SPACES]
    assert column(spark, SPACES, tx.squeeze) == norm
    assert column(spark, SPACES, tx.content_hash) == [hashlib.sha256(n.encode()).hexdigest() for n in norm]
    assert column(spark, SPACES, tx.strip) == [None if s is None else s.strip() for s in SPACES]
    key = lambda n, i: "rk_" + hashlib.sha256(f"{(n or '').strip().lower()}|{(i or '').strip().lower()}".encode()).hexdigest()[:20]
    assert column(spark, SPACES, lambda c: tx.rule_key(c, F.lit(" If\n"))) == [key(s, " If\n") for s in SPACES]


def test_chunks(spark):
    def py(t):
        if len(t) <= 12000:
            return [t]
        at = t.rfind("\n", 0, 12000)
        at = at if at > 6000 else 12000
        return [t[:at], t[at : at + 12000]]

    rng = random.Random(1)
    texts = ["", "x" * 12000, "x" * 12001, "a\n" * 12000, "x" * 7000 + "\n" + "y" * 30000, "x" * 5000 + "\n" + "y" * 30000]
    texts += ["".join(rng.choice("ab\n" if rng.random() < 0.01 else "ab") for _ in range(rng.randrange(11000, 26000))) for _ in range(20)]
    assert column(spark, texts, tx.chunks) == [py(t) for t in texts]
    assert column(spark, [None], tx.chunks) == [None]


def test_small_scalars(spark):
    assert column(spark, ["0.9", "0.90", "-0.9", " 0.9", "1e-1", "high", "", None, "5", "0.9\n", ".9"], lambda c: tx.numeric_at_least(c, 0.9)) == [True, True, False, False, False, False, False, False, True, False, False]
    assert column(spark, [" Deprecated", "sunset", "active", None, ""], tx.rule_status) == ["deprecated", "deprecated", "active", "active", "active"]
    assert column(spark, ["SEO", "other", "geo"], tx.observation_tag) == ["seo", "general", "geo"]
    html = ["<title> How to | Site</title>", "<TITLE>a - lower</title>", "no", None, "<title>| X</title>"]
    assert column(spark, html, tx.page_title) == ["How to", "a - lower", "", "", "| X"]
    assert column(spark, ["<p>a<script>x<y</script> b&amp;</p>", None], tx.main_text) == ["a b&amp;", ""]
    assert column(spark, ["robots robots", "Robots and SITEMAP", None], lambda c: tx.relevance_hits(c, "robots|sitemap")) == [1, 2, 0]


def test_embed_texts(spark):
    df = spark.createDataFrame([("a", None, "c"), (None, None, None), (" ", "", "")], "x string, y string, z string")
    cols = [F.col(c) for c in "xyz"]
    assert [tuple(r) for r in df.select(tx.embed_text_batch(*cols), tx.embed_text_cycle(*cols)).collect()] == [("a  c", "a | c"), (" ", ""), (" ", " ")]


@pytest.mark.parametrize(
    "raw,names",
    [('[{"name":"a"},{"name":"b"}]', ["a", "b"]), ('Sure: [{"name":"a"},{"name":"b"', ["a"]), ('[{"name":"]}"}] and [more]', ["]}"]), ("nothing", None), ("[1, 2]", None), ("[", None), ("[]", []),
     ('[{"name":"a"}, {"name":"x', ["a"]), (None, None), ('[{"name":"a"},{"name":"b","more":{"c":1}', None), ('[see] [{"name":"a"}]', None), ('{"a":1}', None)],
)
def test_salvage(raw, names):
    got = salvage(raw)
    assert (None if got is None else [x["name"] for x in got]) == names


def test_salvage_column(spark):
    got = column(spark, ['[{"name":"a","confidence_score":0.7}', None, "x"], rules_from_answer)
    assert got[0][0]["name"] == "a" and got[0][0]["confidence_score"] == "0.7" and got[1:] == [None, None]
