"""Problem 3: typed spellings of organisations and persons, led to the registered name they mean or to none.

Method: suffix blocking. Names are taken once per spelling. Every token gives its suffixes of at least MIN_SUFFIX
characters as keys, read forwards and backwards, a shorter token itself; so does the name written together. A key that
stands for more than MAX_BLOCK registered names is refined by other fields: the first letter of the name; if that is still
too common, the first letters of its first and last word; and, where the rows have a field that points to the
registered one (a host of the source), by that field. A key that no refinement makes rare is discarded only then, and only
for names that have a rarer key; those that have none are compared with all names of their rarest key, in blocks, so no
name goes without candidates. Pairs that share a key are compared by the ratio of their longest common subsequence,
as whole strings and token by token, over the surface forms a name may be typed in (reordered, without its middle,
initials, acronym, abbreviated words, nicknames, host names). The best registered name wins if it is close enough and no
other is as close.

Edge cases: null, blank and meaningless names ("Unknown") lead to none; a name that is equally close to two registered
ones leads to none unless the alias table settles it; repeated rows share one decision; registry rows without a name
are ignored; empty tables give no rows.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.urls import host
from ..session import stored

MIN_SUFFIX = 4
MAX_BLOCK = 12
#: Least score of a match, least score of each token, and the lead over the second best.
LEAST, LEAST_TOKEN, LEAD = 0.86, 0.66, 0.004

# Words around a name that are no part of it.
_AROUND = {"inc", "ltd", "llc", "gmbh", "corp", "co", "limited", "plc", "blog", "team", "the"}
# First labels of a host that are no part of a name.
_LABELS = {"www", "docs", "blog", "help", "m"}
# Common short forms of English first names.
NICKNAMES = {
    "al": "albert alan", "alex": "alexander alexandra", "andy": "andrew", "becky": "rebecca", "ben": "benjamin",
    "beth": "elizabeth", "betty": "elizabeth", "bill": "william", "billy": "william", "bob": "robert", "bobby": "robert",
    "cathy": "catherine katherine", "charlie": "charles", "chris": "christopher christine", "chuck": "charles", "dan": "daniel",
    "danny": "daniel", "dave": "david", "deb": "deborah", "dick": "richard", "don": "donald", "ed": "edward", "eddie": "edward",
    "eliza": "elizabeth", "fred": "frederick", "greg": "gregory", "hank": "henry", "harry": "henry harold", "jack": "john",
    "jen": "jennifer", "jenny": "jennifer", "jerry": "gerald", "jim": "james", "jimmy": "james", "joe": "joseph", "johnny": "john",
    "jo": "josephine", "josie": "josephine", "kate": "katherine", "kathy": "katherine", "katie": "katherine", "ken": "kenneth",
    "larry": "lawrence", "libby": "elizabeth", "liz": "elizabeth", "maggie": "margaret", "matt": "matthew", "max": "maximilian maxwell",
    "meg": "margaret", "mel": "melanie melissa", "mick": "michael", "mike": "michael", "ned": "edward", "nick": "nicholas",
    "pat": "patricia patrick", "patty": "patricia", "peg": "margaret", "peggy": "margaret", "pete": "peter", "phil": "philip",
    "rich": "richard", "rick": "richard", "rob": "robert", "ron": "ronald", "sam": "samuel samantha", "sandy": "alexander sandra",
    "steve": "stephen steven", "sue": "susan susanna", "susie": "susan susanna", "ted": "edward theodore", "thea": "theodora",
    "theo": "theodore theodora", "tim": "timothy", "tom": "thomas", "tommy": "thomas", "tony": "anthony", "tricia": "patricia",
    "trish": "patricia", "vic": "victor victoria", "vicky": "victoria", "will": "william", "dora": "theodora", "tori": "victoria",
}
#: Spellings that name nobody.
_NOBODY = {"", "unknown", "personalblog", "unattributedlegacy", "na", "none", "null", "anonymous"}


def fold(name: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", name.lower()) if not unicodedata.combining(c))


def tokens(name: str) -> list[tuple[str, bool]]:
    """The words of a name as (word, abbreviated), without what stands around it."""
    s = fold(name).strip()
    if re.fullmatch(r"(https?://)?[a-z0-9\-]+(\.[a-z0-9\-]+)+/?", s) and not re.fullmatch(r"([a-z]\.)+[a-z]?", s):
        labels = re.sub(r"^https?://", "", s).strip("/").split(".")
        s = " ".join([x for x in labels[:-1] if x not in _LABELS] or labels[:1])
    found = [(w, dot == ".") for w, dot in re.findall(r"([^\W_]+)(\.?)", s) if w != "and"]
    words = [t for t in found if t[0] not in _AROUND]
    return words or found


def variants(name: str) -> list[list[tuple[str, bool]]]:
    """The tokens of a name, and those with a nickname written out."""
    base = tokens(name)
    out = [base]
    for i, (w, _) in enumerate(base):
        if len(base) > 1:
            out += [[*base[:i], (full, False), *base[i + 1 :]] for full in NICKNAMES.get(w, "").split()]
    return out


def surfaces(canonical: str) -> list[tuple[str, tuple[str, ...]]]:
    """The forms in which a registered name may be typed, by kind."""
    w = [t for t, _ in tokens(canonical)]
    out = [("full", tuple(w))]
    if len(w) >= 3:
        out += [("ends", (w[0], w[-1])), ("initials", (*[x[0] for x in w[:-1]], w[-1]))]
    if len(w) == 2:
        out += [("initials", (w[0][0], w[1]))]
    if len(w) >= 2:
        out += [("head", (w[0],))]
    if len(w) >= 3 or len(w) == 2 and "&" in canonical:
        out += [("acronym", ("".join(x[0] for x in w),))]
    return out


def lcs_ratio(a: str, b: str) -> float:
    """2 LCS / (len a + len b), the LCS by bit-parallel steps over a."""
    if not a or not b:
        return 0.0
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & at.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return 2 * (len(a) - v.bit_count()) / (len(a) + len(b))


def _token(t: tuple[str, bool], c: str) -> float:
    w, dot = t
    if w == c:
        return 1.0
    s = lcs_ratio(w, c)
    if len(c) > len(w) and (dot or 3 <= len(w) <= 4):
        s = max(s, 0.95 * lcs_ratio(w, c[: len(w)]))
    return s


def _aligned(t: list[tuple[str, bool]], c: tuple[str, ...]) -> float:
    """Mean over tokens, weighted by length, of the best of the orders in which names are turned round."""
    if len(t) != len(c):
        return 0.0
    best = 0.0
    for k in range(len(t)):
        s = [_token(x, y) for x, y in zip(t[k:] + t[:k], c)]
        if min(s) >= LEAST_TOKEN:
            best = max(best, sum(x * len(y) for x, y in zip(s, c)) / sum(map(len, c)))
    return best


def score(name: str, canonical: str, forms: list[tuple[str, tuple[str, ...]]] | None = None) -> float:
    """How surely name means canonical, from 0 to 1; forms: the surfaces of canonical, if they are at hand."""
    best, forms = 0.0, forms or surfaces(canonical)
    for t in variants(name):
        turns = {"".join(w for w, _ in t[k:] + t[:k]) for k in range(len(t))}
        joined = "".join(w for w, _ in t)
        for kind, c in forms:
            if kind == "full":
                whole = "".join(c)
                s = max(lcs_ratio(x, whole) for x in turns)
                best = max(best, s if s >= LEAST else 0.0, _aligned(t, c))
            elif kind == "acronym":
                best = max(best, 0.9 * (joined == c[0] and all(len(w) == 1 for w, _ in t) or joined == c[0] and len(t) == 1))
            elif kind == "initials":
                if len(t) == len(c) and any(all((a == b[:1]) if len(b) == 1 else _token((a, d), b) >= 0.8 for (a, d), b in zip(t[k:] + t[:k], c)) for k in range(len(t))):
                    long = max(t, key=lambda x: len(x[0]))
                    best = max(best, 0.9 + 0.08 * _token(long, c[-1]))
            elif kind == "head":
                best = max(best, 0.95 * (s if (s := lcs_ratio(joined, c[0])) >= 0.9 and len(joined) > 3 else 0.0))
            else:
                best = max(best, 0.97 * _aligned(t, c))
    return best


def _keys(words: list[str]) -> set[str]:
    out = set()
    for w in [*words, "".join(words)]:
        if len(w) <= MIN_SUFFIX:
            out.add("=" + w)
        for mark, x in ((">", w), ("<", w[::-1])):
            out |= {mark + x[i:] for i in range(len(x) - MIN_SUFFIX + 1)}
    return out


def name_keys(name: str, registered: bool) -> tuple[list[str], list[str], list[str]]:
    """(suffixes, firsts, lasts): the blocking keys of a name, and the letters by which they are refined, those its first
    and its last word begin with. Of typed names any word may be the first or the last one."""
    suffixes: set[str] = set()
    firsts: set[str] = set()
    lasts: set[str] = set()
    for words in [list(c) for _, c in surfaces(name)] if registered else [[w for w, _ in t] for t in variants(name)]:
        suffixes |= _keys(words)
        if not registered:
            firsts |= {w[0] for w in words}
    if registered:
        whole = [w for w, _ in tokens(name)]
        firsts, lasts = ({whole[0][0]}, {whole[-1][0]}) if whole else (firsts, lasts)
    else:
        lasts = firsts
    return sorted(suffixes), sorted(firsts), sorted(lasts)


def _keyed(names: DataFrame, registered: bool) -> DataFrame:
    """(name, site, suffix, firsts, lasts) of (name, site)."""

    def run(batches):
        lists = pa.list_(pa.string())
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                cols = list(zip(*(name_keys(n, registered) for n in b.column(0).to_pylist())))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(c, lists) for c in cols]], names=["name", "site", "suffixes", "firsts", "lasts"])

    k = names.select("name", "site").mapInArrow(run, "name string, site string, suffixes array<string>, firsts array<string>, lasts array<string>")
    return k.select("name", "site", F.explode("suffixes").alias("suffix"), "firsts", "lasts")


def _refined(keyed: DataFrame, keep: str) -> DataFrame:
    """(keep, suffix, level, key): the suffix with the first letter (1), with those of first and last word (2), with the
    site (3)."""
    one = F.transform("firsts", lambda a: F.struct(F.lit(1).alias("level"), F.concat(a, F.lit("|"), F.col("suffix")).alias("key")))
    two = F.flatten(F.transform("firsts", lambda a: F.transform(F.col("lasts"), lambda b: F.struct(F.lit(2).alias("level"), F.concat(a, b, F.lit("|"), F.col("suffix")).alias("key")))))
    three = F.array(F.struct(F.lit(3).alias("level"), F.concat("site", F.lit("@"), "suffix").alias("key")))
    k = keyed.select(keep, "suffix", F.explode(F.concat(one, two, three)).alias("k"))
    return k.select(keep, "suffix", "k.level", "k.key").filter("key IS NOT NULL").distinct()


def site_of(url: Column) -> Column:
    """The last two labels of a URL's host, which its subdomains share; null for none."""
    return F.nullif(F.regexp_extract(host(url), r"([^./:@?#]+\.[^./:@?#]+)(?::[0-9]+)?\z", 1), F.lit(""))


def _score(batches):
    """The two best candidates of each list; a name that is written the same but for case and accents is above all."""
    for b in batches:
        rows = []
        for n, cs in zip(b.column("name").to_pylist(), b.column("canonical").to_pylist()):
            plain = fold(n).split()
            ranked = sorted(((2.0 if fold(c).split() == plain else score(n, c), c) for c in cs), reverse=True)
            rows += [(n, s, c) for s, c in ranked[:2]]
        cols = list(zip(*rows)) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.float64(), pa.string()))], names=["name", "score", "canonical"])


def candidates(names: DataFrame, registered: DataFrame, most: int = MAX_BLOCK) -> DataFrame:
    """(name, canonical): the pairs to compare. A suffix is used by its least refined key that stands for at most `most`
    registered names; a name none of whose suffixes has one is compared with all names of its rarest key. Keys are counted
    before any name is looked up by them."""
    reg = stored(_keyed(registered, True).withColumnRenamed("name", "canonical"))
    plain = reg.select("canonical", "suffix", F.lit(0).alias("level"), F.col("suffix").alias("key")).distinct()
    common = plain.groupBy("suffix").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > most).select("suffix")
    theirs = stored(plain.unionByName(_refined(reg.join(common, "suffix"), "canonical")))
    sizes = theirs.groupBy("suffix", "level", "key").agg(F.count_distinct("canonical").alias("m"))
    # only suffixes that some registered name has go on, and only the common ones are refined
    own = stored(_keyed(names, False).join(reg.select("suffix").distinct(), "suffix", "left_semi"))
    mine = own.select("name", "suffix", F.lit(0).alias("level"), F.col("suffix").alias("key")).distinct()
    mine = mine.unionByName(_refined(own.join(common, "suffix", "left_semi"), "name"))
    met = stored(mine.join(sizes, ["suffix", "level", "key"]).select("name", "suffix", "level", "key", "m"))
    rare = met.filter(F.col("m") <= most)
    least = rare.groupBy("name", "suffix").agg(F.min("level").alias("level"))
    keys = rare.join(least, ["name", "suffix", "level"]).select("name", "key")
    left = met.join(keys.select("name").distinct(), "name", "left_anti").groupBy("name").agg(F.min_by("key", F.struct("m", "key")).alias("key"))
    return keys.unionByName(left).distinct().join(theirs.select("key", "canonical"), "key").select("name", "canonical").distinct()


#: Candidates of a name that are compared in one row, and rows of names a task compares at a time.
TOGETHER, PER_TASK = 256, 2000


def resolve(names: DataFrame, registry: DataFrame) -> DataFrame:
    """(name, canonical_org, score) of the distinct names in `names` (with their `site`, if it is known) that mean a
    registered one."""
    bare = F.lower(F.regexp_replace("name", r"[^\p{L}\p{N}]+", ""))
    root = site_of(F.col("root_url")) if "root_url" in registry.columns else F.lit(None).cast("string")
    reg = registry.filter(F.trim("canonical_org") != "").select(F.col("canonical_org").alias("name"), root.alias("site")).distinct()
    typed = names if "site" in names.columns else names.withColumn("site", F.lit(None).cast("string"))
    typed = typed.filter(F.col("name").isNotNull() & ~bare.isin(*_NOBODY)).select("name", "site").distinct()
    pairs = candidates(typed, reg)
    # lists of bounded length: a name with many candidates has several
    sizes = pairs.groupBy("name").agg(F.ceil(F.count(F.lit(1)) / TOGETHER).alias("_parts"))
    lists = pairs.join(sizes, "name").groupBy("name", F.pmod(F.xxhash64("canonical"), F.col("_parts")).alias("_part")).agg(F.sort_array(F.collect_list("canonical")).alias("canonical"))
    lists = stored(lists.select("name", "canonical"))
    tasks = max(1, min(-(-lists.count() // PER_TASK), 10_000))
    best = lists.repartition(max(tasks, names.sparkSession.sparkContext.defaultParallelism)).mapInArrow(_score, "name string, score double, canonical string")
    two = best.withColumn("_r", F.row_number().over(W.partitionBy("name").orderBy(F.desc("score"), F.desc("canonical")))).filter("_r <= 2")
    top = two.groupBy("name").agg(F.max(F.struct("score", "canonical")).alias("t"), F.min("score").alias("_low"), F.count(F.lit(1)).alias("_n"))
    clear = (F.col("t.score") >= LEAST) & ((F.col("_n") == 1) | (F.col("t.score") - F.col("_low") >= LEAD))
    return top.filter(clear).select("name", F.col("t.canonical").alias("canonical_org"), F.least(F.col("t.score"), F.lit(1.0)).alias("score"))


def found(rules: DataFrame, aliases: DataFrame, registry: DataFrame) -> DataFrame:
    """p3_found: rules and aliases that mean a registered name but are not written like it.

    A row of the alias table that states a canonical_org is led by that, else by the alias itself; a typed source_org
    is led by itself, else by the alias table (by its lower-cased spelling)."""
    exact = registry.filter("canonical_org IS NOT NULL").select(F.col("canonical_org").alias("name")).distinct()
    url = F.col("source_url") if "source_url" in rules.columns else F.lit(None).cast("string")
    org = rules.select("id", F.col("source_org").alias("name"), site_of(url).alias("site")).filter("name IS NOT NULL").join(exact, "name", "left_anti")
    al = aliases.filter("alias IS NOT NULL").select("alias", "canonical_org").distinct()
    # the commonest site of each spelling
    sited = org.groupBy("name", "site").agg(F.count(F.lit(1)).alias("n")).groupBy("name").agg(F.max_by("site", F.when(F.col("site").isNotNull(), F.struct("n", "site"))).alias("site"))
    names = sited.select("name").unionByName(al.select(F.col("alias").alias("name"))).unionByName(al.select(F.col("canonical_org").alias("name")).filter("name IS NOT NULL"))
    names = names.distinct().join(sited, "name", "left")
    known = stored(resolve(names, registry).select("name", F.col("canonical_org").alias("to")))
    by = lambda c, to: known.select(F.col("name").alias(c), F.col("to").alias(to))
    al = al.join(by("canonical_org", "by_canonical"), "canonical_org", "left").join(by("alias", "by_alias"), "alias", "left")
    al = al.withColumn("to", F.coalesce("by_canonical", "by_alias")).filter("`to` IS NOT NULL")
    out_al = al.filter(~F.col("canonical_org").eqNullSafe(F.col("to"))).select(F.lit("org_aliases").alias("src"), F.col("alias").alias("rec_key"), F.col("to").alias("canonical_org")).distinct()
    said = al.groupBy(F.lower(F.trim("alias")).alias("low")).agg(F.min("to").alias("said"), F.max("to").alias("other")).filter("said = other").select("low", "said")
    spelled = org.select("name").distinct().join(by("name", "own"), "name", "left").withColumn("low", F.lower(F.trim("name"))).join(said, "low", "left")
    spelled = spelled.select("name", F.coalesce("own", "said").alias("canonical_org")).filter("canonical_org IS NOT NULL AND canonical_org <> name")
    return org.join(spelled, "name").select(F.lit("rules").alias("src"), F.col("id").alias("rec_key"), "canonical_org").unionByName(out_al)
