"""Problem 2 on sites made here."""

import random

from tidemark.llm import boilerplate as bp

DDL = "page_id bigint, url string, title string, text string, row string, label int, site int"
TOPICS = ["oak trees", "river mud", "cold tea", "tin roofs", "old maps", "wet sand", "red kites", "salt pans"]
HEADS = ["All about {}", "A guide to {}", "Why {} matter", "Questions on {}"]
WORDS = "stone grass light water bread paper glass sound cloud field horse table green sharp quick heavy small round".split()


def site(host, n, seed, first, ids=None):
    """Pages of one site with menu, breadcrumb, author line, list of other articles and footer; returns rows and truth."""
    rng = random.Random(seed)
    name = host.split(".")[0]
    rows, truth = [], {}
    for i in range(n):
        topic, out = rng.choice(TOPICS), []
        title = rng.choice(HEADS).format(topic)
        add = lambda line, art: out.append((line, art))
        para = lambda: " ".join(rng.choice(WORDS) for _ in range(rng.randrange(8, 30))).capitalize() + "."
        add("Home | Shop | Contact | Help", False)
        if rng.random() < 0.7:
            add("We keep small files on your device.", False)
        add(f"Home › {rng.choice(['Shop', 'News'])} › {title[:12]}", False)
        add(title, True)
        add(f"Written by {rng.choice(WORDS)}{rng.choice(WORDS)} on {rng.randrange(1, 28)}.{rng.randrange(1, 12)}.2025 - {rng.randrange(2, 20)} min read", False)
        for _ in range(rng.randrange(2, 5)):
            add(para(), True)
            if rng.random() < 0.4:
                add(rng.choice(HEADS).format(topic), True)
                add(para(), True)
            if rng.random() < 0.3:
                add("", None)
        if rng.random() < 0.6:
            add("More to read", False)
            for _ in range(rng.randrange(2, 5)):
                add(rng.choice(HEADS).format(rng.choice(TOPICS)) + rng.choice(["", f" ({rng.randrange(90)})"]), False)
            add(para(), True)
        if rng.random() < 0.5:
            add(f"{rng.choice(WORDS)}{rng.randrange(99)}: I like this a lot!", False)
        add(f"  © {rng.randrange(2020, 2026)} {name.capitalize()} - all rights kept", False)
        pid = first + i
        rows.append((pid, f"https://{host}/a/{pid}", title, "\n".join(x for x, _ in out), "clash", 1, 2))
        truth[pid] = {k for k, (_, art) in enumerate(out) if art is False}
    return rows, truth


def test_sites(spark):
    rows, truth = [], {}
    for k, host in enumerate(["oakmill.example", "www.fernbay.example", "docs.stonelea.example", "brinewell.example"]):
        r, t = site(host, 60, k, 1000 * k)
        rows, truth = rows + r, truth | t
    got = {}
    for r in bp.found(spark.createDataFrame(rows, DDL)).collect():
        got.setdefault(r["page_id"], set()).add(r["line_no"])
    wrong = sum(len(truth[p] ^ got.get(p, set())) for p in truth)
    total = sum(len(r[3].split("\n")) for r in rows)
    assert wrong / total < 0.03, wrong / total


def test_edge_cases(spark):
    text = "Home | Shop\nA title\nSome words here."
    rows = [(1, "https://a.example/x", "A title", text, "", 1, 2)] * 2 + [(2, None, None, None, None, None, None), (3, "https://a.example/y", None, "", "", 1, 2), (4, "https://a.example/z", None, " \n\t\n", "", 1, 2), (None, "https://b.example", None, "x" * 300_000 + "\ny", "", 1, 2)]
    df = spark.createDataFrame(rows, DDL)
    assert bp.found(df).count() <= 3
    lines = {r["page_id"]: r["line_no"] for r in bp.lines(df).collect()}
    assert lines == {1: [0, 1, 2], None: [0, 1]}
    assert bp.found(df.limit(0)).count() == 0


def test_repeated_captures_do_not_vouch(spark):
    text = "Only title\nThe same words in every capture.\nAnd a last line."
    rows = [(i, f"https://a.example/x{'/' * (i % 2)}?utm_source={i}", "Only title", text, "", 1, 2) for i in range(30)]
    assert bp.found(spark.createDataFrame(rows, DDL)).count() == 0


def test_nodes():
    assert bp.node("  Posted by Ann42 on 2025-01-02 - 7 min read")[1] == "slots # on # - # min read"
    assert bp.node("A title (17)") == ("a title", "", True) and bp.node("Home › News › Án item")[:2] == ("home › news › an item", "parts ›")
    assert bp.node("Subscribe to the Oak Mill newsletter", "oakmill")[0] == "subscribe to the oak @ newsletter"
    long = "We keep 12 small files on your device " * 20
    assert bp.node(long + "until 2025-01-02")[0] == bp.node(long + "until 2026-11-30")[0] and bp.node(long)[1] == ""
    for odd in ("x" * 300_000, "x1" * 150_000, "x" + " " * 300_000 + "y", "1 " * 100_000, "| " * 100_000, "(" * 300_000):
        assert bp.node(odd)[0]


def test_matching_is_a_longest_common_sequence():
    rng = random.Random(0)

    def lcs(a, b):
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        return t[-1][-1]

    for _ in range(200):
        a, b = ([rng.randrange(1, k) for _ in range(rng.randrange(1, 30))] for k in (8, 8))
        hit = bp.match_trees(a, [0] * len(a), bp._places(b), {})
        assert len(hit) == len(set(hit)) == lcs(a, b)
    many = [7] * 20_000
    assert len(bp.match_trees(many, [0] * len(many), bp._places(many), {})) == 20_000


def test_a_line_can_be_template_on_one_host_and_content_on_another(spark):
    """The line closes every page of one site; on another it is the sentence of one article among many."""
    rows, truth = [], {}
    for k, host in enumerate(["oakmill.example", "fernbay.example", "stonelea.example"]):
        r, t = site(host, 60, k, 1000 * k)
        rows, truth = rows + r, truth | t
    line = "Water the plants before the sun is high."
    rows = [(p, u, t, x + "\n" + line if 0 <= p < 60 or p == 2007 else x, *rest) for p, u, t, x, *rest in rows]
    rows = [(p, u, t, x.replace("\n" + line, "").replace("\n" + t + "\n", "\n" + t + "\n" + line + "\n", 1) if p == 2007 else x, *rest) for p, u, t, x, *rest in rows]
    got = {}
    for r in bp.found(spark.createDataFrame(rows, DDL)).collect():
        got.setdefault(r["page_id"], set()).add(r["line_no"])
    texts = {r[0]: r[3].split("\n") for r in rows}
    assert all(len(texts[p]) - 1 in got[p] for p in range(60))
    assert texts[2007].index(line) not in got[2007]
