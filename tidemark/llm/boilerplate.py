"""Problem 2: the article of a web page without everything its site puts around it.

Method: wrapper induction. The text of a page is read as a tree: the page, its lines, and the parts of a line that are
set off by separators. A line's node label is the line without case, accents and numbers; lines that are mostly slots
(dates with a name, rows of separated parts) have a second label for their frame. Pages of one host that end alike
(one template of the site in one language) are put into blocks of at most BLOCK pages, and each page's tree is
aligned with those of a few other articles of its block by simple tree matching, i.e. the longest common sequence of
equal nodes in order, whatever labels repeat. A label that is found again in a large share of these alignments is a
constant of the site's template. Every host has a wrapper of its own: shares are summed over the blocks of all hosts, so
sites with few pages profit from others with the same parts, but where a host's own pages say clearly otherwise they decide,
so that a line may be template on one host and content on another. Labels that serve as titles of pages are slots, whatever
their share. Constants whose following lines carry counts are heads of lists: the run of title-like lines after them is a
repeated slot of the template and not of the article.

Edge cases: null and blank texts have no lines; blank lines are never returned; a host with a single page has
only the constants learned elsewhere; repeated captures of a page never vouch for each other; repeated rows give their
lines once; a block is bounded, so a host with a third of all pages is spread over many tasks.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import host, normalize_url
from ..session import stored

BLOCK, PILOTS = 64, 5
#: Share of alignments from which a label is a constant, and the alignments assumed to have failed beforehand.
CONSTANT, PRIOR = 0.07, 4.0
#: A host decides for itself that a label is content if, of at least SURE recurrences to be expected among its own pages, it has
#: fewer than ABSENT of them; and that it is a constant from OWN_PAGES pages on that find it in OWN of their alignments. Pages
#: count for the first if they share at least TYPICAL of the lines that the median page of their block shares with others.
SURE, ABSENT, OWN_PAGES, OWN, TYPICAL = 30, 0.05, 10, 0.3, 0.8
#: Share of a label's lines that must be titles for it to be a slot, and share of counted followers for a list head.
TITLE, HEAD = 0.02, 0.15
#: Share of its host's pages below which a template's own last line is no evidence for itself.
RARE = 0.02
#: What a frame looks like: characters a separated part has on the average at most, those of a name before the first slot,
#: and letters after it.
PART, NAME, REST = 40, 40, 16
#: Places of a label in a page above which its repetitions are matched in turn and not in every way.
MANY = 32

_NUMBER = re.compile(r"(?<!\w)[^\W\d]*\d\w*")
_JOINED = re.compile(r"#(?:[./:\-]#)+")
_SPACES = re.compile(r"\s+")
_SEPARATED = re.compile(r" *(?:[|·•›»>/]|  ) +")
_WORD = re.compile(r"[a-z0-9]{4,}")
_NAMES = re.compile(r"@(?:[ &]+@)*")
# Separators that set off parts even where there is only one.
_STRONG = {"|", "·", "•", "›", "»"}


def _label(line: str) -> str:
    s = unicodedata.normalize("NFKD", line.strip().lower())
    if not s.isascii():
        s = "".join(c for c in s if not unicodedata.combining(c))
    s = _NUMBER.sub("#", s)
    return _JOINED.sub("#", s) if "#" in s else s


def site_core(site: str) -> str:
    """The letters and digits of a host without its last label; '' for what is too long for a host."""
    return re.sub(r"[^a-z0-9]", "", site.lower().rpartition(".")[0]) if len(site) <= 253 else ""


def _parts_of(core: str) -> frozenset[str]:
    """What a word must be to stand for a part of the site's name."""
    return frozenset(core[i:j] for i in range(len(core)) for j in range(i + 4, len(core) + 1))


def node(line: str, core: str = "", parts: frozenset[str] | None = None) -> tuple[str, str, bool]:
    """(label, frame or '', counted): the frame is what stays the same in a line whose parts or names vary. Words of
    the site's own name (core) become one mark, so that equal parts of different sites have equal labels; parts: what
    words those are, if it is at hand."""
    s = _label(line)
    if core and not (_parts_of(core) if parts is None else parts).isdisjoint(_WORD.findall(s)):
        s = _NAMES.sub("@", _WORD.sub(lambda m: "@" if m[0] in core else m[0], s))
    counted = s.endswith("(#)")
    if counted:
        s = s[:-3].rstrip()
    frame = ""
    marks = _SEPARATED.findall(s)
    at = s.find("#")
    n = len(marks) + 1
    # parts and slots are short on the average; a sentence with a bar or two numbers in it is neither
    if marks and len(s) <= PART * n and len(set(m.strip() for m in marks)) == 1 and (n >= 3 or marks[0].strip() in _STRONG):
        frame = "parts " + marks[0].strip()
    elif 0 < at <= NAME and s.count("#") >= 2 and sum(c.isalpha() for c in s[at:]) <= REST:
        frame = "slots " + s[at:]
    return _SPACES.sub(" ", s), frame, counted


_TREES = "row long, page_id long, article long, site long, template long, title long, line_no array<int>, label array<long>, frame array<long>, counted array<boolean>"


def _trees(batches):
    import xxhash

    def code(s: str) -> int:
        return xxhash.xxh3_64_intdigest(s) - (1 << 63) if s else 0

    known: dict[str, frozenset[str]] = {}
    for b in batches:
        rows = []
        for row, page, article, site, title, text in zip(*(c.to_pylist() for c in b.columns)):
            core = site_core(site)
            parts = known.get(core)
            if parts is None:
                if len(known) > 10_000:
                    known.clear()
                parts = known[core] = _parts_of(core)
            lines = [(i, *node(x, core, parts)) for i, x in enumerate(text.split("\n")) if x.strip()]
            if lines:
                last = code(f"{site}\n{lines[-1][2] or lines[-1][1]}")
                t = code(node(title, core, parts)[0]) if title and title.strip() else 0
                rows.append((row, page, article, code(site), last, t, [x[0] for x in lines], [code(x[1]) for x in lines], [code(x[2]) for x in lines], [x[3] for x in lines]))
        types = [pa.int64()] * 6 + [pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_())]
        names = ["row", "page_id", "article", "site", "template", "title", "line_no", "label", "frame", "counted"]
        cols = list(zip(*rows)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def with_row(pages: DataFrame) -> DataFrame:
    """The pages with `row`, a hash that tells rows apart; exact repetitions share it."""
    return pages.withColumn("row", F.xxhash64("page_id", "url", "title", "text"))


def trees(pages: DataFrame) -> DataFrame:
    """One row per page with at least one line: hashes of its nodes' labels, its article (page, whatever its capture),
    its template (host and kind of last line) and its title."""
    p = with_row(pages).filter(F.col("text").isNotNull())
    article = F.regexp_replace(normalize_url(F.coalesce("url", F.lit(""))), r"/print\z", "")
    p = p.select("row", "page_id", F.xxhash64(article).alias("article"), host(F.coalesce("url", F.lit(""))).alias("site"), "title", "text")
    return stored(p.mapInArrow(_trees, _TREES).dropDuplicates(["row"]))


def _longest(places: list[list[int]]) -> list[int]:
    """Indices of a longest run whose places, one of each index's, strictly increase. Of one index the places are taken
    from the last to the first, so that it cannot follow itself."""
    tails, at, owner, back = [], [], [], []
    for i, ps in enumerate(places):
        for p in reversed(ps):
            k = bisect_left(tails, p)
            owner.append(i)
            back.append(at[k - 1] if k else -1)
            if k == len(tails):
                tails.append(p)
                at.append(len(owner) - 1)
            else:
                tails[k], at[k] = p, len(owner) - 1
    out, n = [], at[-1] if at else -1
    while n >= 0:
        out.append(owner[n])
        n = back[n]
    return out


def match_trees(label: list[int], frame: list[int], pilot: dict[int, list[int]], pilot_frames: dict[int, list[int]]) -> list[int]:
    """Simple tree matching of two pages with ordered lines: the indices of the lines matched, in any order.
    A line may stand for one with the same label or, failing that, the same frame; pilot and pilot_frames hold the
    places of each, in order."""
    none: list[int] = []
    places, nth = [], {}
    for a, f in zip(label, frame):
        ps = pilot.get(a) or (pilot_frames.get(f, none) if f else none)
        if len(ps) > MANY:  # the same line over and over: the n-th stands for the n-th
            n = nth[a] = nth.get(a, -1) + 1
            ps = ps[n : n + 1]
        places.append(ps)
    return _longest(places)


_SHARES = "site long, label long, found double, tried double, lines long, listing long, titles long, pairs double, again double"


def _places(v: list[int]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, x in enumerate(v):
        if x:
            out.setdefault(x, []).append(i)
    return out


def _align(block: pa.Table) -> pa.Table:
    """Aligns the pages of one block; per label: alignments in which it was found again and tried, and its lines."""
    article, labels, frames, counted = (block.column(c).to_pylist() for c in ("article", "label", "frame", "counted"))
    ends, rows = bool(block.column("ends")[0].as_py()), block.column("row").to_pylist()
    first, first_frames = [_places(v) for v in labels], [_places(v) for v in frames]
    order = sorted(range(len(article)), key=lambda i: (article[i], rows[i]))
    sums: dict[int, list[float]] = {}
    shared = [0.0] * len(order)
    for at, i in enumerate(order):
        pilots = []
        for step in range(1, len(order)):
            j = order[(at + step * 7919) % len(order)] if len(order) % 7919 else order[(at + step) % len(order)]
            if article[j] != article[i]:
                pilots.append(j)
                if len(pilots) == PILOTS:
                    break
        got: dict[int, float] = {}
        for j in pilots:
            hit = match_trees(labels[i], frames[i], first[j], first_frames[j])
            seen = set()
            for x in hit if ends else [y for y in hit if y + 1 < len(labels[i])]:
                if labels[i][x] in first[j]:
                    seen.add(labels[i][x])
                if frames[i][x] in first_frames[j]:
                    seen.add(frames[i][x])
            for x in seen:
                got[x] = got.get(x, 0.0) + 1.0 / len(pilots)
        shared[i] = sum(got.values())
        for x in {*labels[i], *frames[i]} - {0}:
            s = sums.setdefault(x, [0.0, 0.0, 0, 0])
            s[0] += got.get(x, 0.0)
            s[1] += bool(pilots)
            s[2] += 1
        follow = counted[i]
        for k, x in enumerate(labels[i]):
            if any(follow[k + 1 : k + 3]) and not follow[k]:
                sums[x][3] += 1
    holders: dict[int, set] = {}
    typical = [i for i in order if shared[i] >= TYPICAL * sorted(shared)[len(shared) // 2]]
    for i in typical:
        for x in {*labels[i], *frames[i]} - {0}:
            holders.setdefault(x, set()).add(article[i])
    held = [len(holders.get(x, ())) for x in sums]
    others = max(0, len({article[i] for i in typical}) - 1)
    cols = list(zip(*sums.values())) if sums else [[]] * 4
    site = block.column("site")[0].as_py()
    arrays = [pa.array([site] * len(sums), pa.int64()), pa.array(list(sums), pa.int64()), pa.array(cols[0], pa.float64()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array([0] * len(sums), pa.int64())]
    arrays += [pa.array([float(c * others) for c in held], pa.float64()), pa.array([float(c * (c - 1)) for c in held], pa.float64())]
    return pa.Table.from_arrays(arrays, names=["site", "label", "found", "tried", "lines", "listing", "titles", "pairs", "again"])


def wrapper(t: DataFrame) -> DataFrame:
    """(site, label, kind): the wrapper of each host: its labels that are constants (1), slots of titles (2) and heads of
    lists (3)."""
    sizes = t.groupBy("site", "template").agg(F.count(F.lit(1)).alias("size"))
    hosts = sizes.groupBy("site").agg(F.sum("size").alias("pages"))
    sizes = sizes.join(hosts, "site").select("template", "size", (F.col("size") >= RARE * F.col("pages")).alias("ends"))
    blocks = t.join(sizes, "template").withColumn("salt", F.pmod(F.xxhash64("article"), F.ceil(F.col("size") / BLOCK)))
    shares = blocks.select("site", "template", "salt", "row", "article", "label", "frame", "counted", "ends").groupBy("template", "salt").applyInArrow(_align, _SHARES)
    zero, none = F.lit(0.0), F.lit(0).cast("long")
    titles = t.filter("title <> 0").select("site", F.col("title").alias("label"), zero.alias("found"), zero.alias("tried"), none.alias("lines"), none.alias("listing"), F.lit(1).cast("long").alias("titles"), zero.alias("pairs"), zero.alias("again"))
    cols = ("found", "tried", "lines", "listing", "titles", "pairs", "again")
    own = stored(shares.unionByName(titles).groupBy("site", "label").agg(*[F.sum(c).alias(c) for c in cols]))
    s = own.groupBy("label").agg(*[F.sum(c).alias(c) for c in cols])
    slot = (F.col("titles") > 0) & (F.col("titles") >= TITLE * F.col("lines"))
    head = F.col("listing") >= HEAD * F.col("lines")
    general = F.col("found") >= CONSTANT * (F.col("tried") + PRIOR)
    s = s.select("label", F.try_divide("again", "pairs").alias("share"), general.alias("general"), slot.alias("slot"), head.alias("head"))
    j = own.select("site", "label", "found", "tried", "pairs", "again").join(s, "label")
    expected = F.col("pairs") * F.coalesce("share", F.lit(0.0))
    content = (expected >= SURE) & (F.col("again") < ABSENT * expected)
    constant = F.col("general") & ~content | (F.col("tried") >= OWN_PAGES) & (F.col("found") >= OWN * F.col("tried"))
    kind = F.when(F.col("slot"), 2).when(constant & F.col("head"), 3).when(constant, 1).otherwise(0)
    return j.select("site", "label", kind.alias("kind")).filter("kind > 0")


def article_mask(label: list[int], frame: list[int], counted: list[bool], kinds: dict[int, int], title: int) -> list[bool]:
    """Which lines of a page belong to its article."""
    out, listing = [], False
    for a, f, c in zip(label, frame, counted):
        kind = kinds.get(a, 0)
        if a == title and not c and not listing:
            out.append(True)
            continue
        if kind in (1, 3) or kinds.get(f, 0) in (1, 3):
            listing = kind == 3
            out.append(False)
        elif listing and (c or kind == 2):
            out.append(False)
        else:
            listing = False
            out.append(True)
    return out


_LINES = "row long, page_id long, line_no array<int>, article array<boolean>"


def _apply(batches):
    for b in batches:
        masks = [
            article_mask(a, f, c, {int(x["label"]): int(x["kind"]) for x in k or []}, t)
            for a, f, c, k, t in zip(*(b.column(n).to_pylist() for n in ("label", "frame", "counted", "kinds", "title")))
        ]
        yield pa.RecordBatch.from_arrays([b.column("row"), b.column("page_id"), b.column("line_no"), pa.array(masks, pa.list_(pa.bool_()))], names=["row", "page_id", "line_no", "article"])


def lines(pages: DataFrame) -> DataFrame:
    """(row, page_id, line_no, article): per page its non-blank lines and whether they belong to the article."""
    t = trees(pages)
    known = stored(wrapper(t))
    used = t.select("row", "site", F.explode(F.array_distinct(F.concat("label", "frame"))).alias("label"))
    kinds = used.join(known, ["site", "label"]).groupBy("row").agg(F.collect_list(F.struct("label", "kind")).alias("kinds"))
    return t.drop("article", "site", "template").join(kinds, "row", "left").mapInArrow(_apply, _LINES)


def found(pages: DataFrame) -> DataFrame:
    """p2_found: (page_id, line_no) of every non-blank line that is not part of the article."""
    at = lines(pages).select("page_id", F.explode(F.arrays_zip("line_no", "article")).alias("x"))
    return at.filter(~F.col("x.article")).select("page_id", F.col("x.line_no").alias("line_no")).distinct()
