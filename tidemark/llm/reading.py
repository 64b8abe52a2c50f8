"""Problem 10: a reading level from 1 to 5 for every English document, on the scale of rated ones.

Method: an interpolated trigram model of words is trained for each level on rated documents; every document is read in
full under all of them, and its surprisal per sentence under each gives the level it is expected to have. An isotonic
regression on the ratings, fitted on documents the models have not seen (two folds), maps that score to the scale, and
the nearest level is taken. Raters err, so documents whose whole text speaks for the neighbouring level are moved there
before the models are trained a second time.

Edge cases: a document counts as English by its label, or by its language filters where it has none; fewer than 60
words (parted at white space), null, empty and blank texts give no row; several ratings of a document are averaged,
repeated rows of one rater count once, null levels not at all; without ratings there are no rows; words the models do
not know share one symbol; repeated rows of a document give one result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .language import GRAM, Filters, gram_hashes, label_code, letters, train

LEVELS = 5
LEAST_WORDS = 60
#: Rated documents the models are trained on (about so many, by hash of their id) and their characters, and their commonest
#: words that count.
SAMPLE, SAMPLE_CHARS, VOCABULARY = 6000, 40_000_000, 30_000
#: Weight of the lower order where a context was seen w times: OPEN / (w + OPEN); count added to every word.
OPEN, ADDED = 3.0, 0.5
#: Words whose surprisal is held at once.
TOGETHER = 400_000
_TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]+")
#: 0 is any unknown word; a sentence or line ends with one of ENDS symbols, END for the shortest, by its length.
UNKNOWN, END, ENDS = 0, 1, 14
_FIRST = END + ENDS
_END_OF = [END + min(ENDS - 1, int(2 * np.log2(max(1, n)))) for n in range(1 << (ENDS // 2))]


def encode(text: str, ids: dict[str, int]) -> list[int]:
    """Word numbers; every sentence or line is followed by the symbol of its length, which doubles every two symbols.
    The stream begins with END."""
    out, n = [END], 0
    for w in _TOKEN.findall(text.lower()):
        if w[0].isalpha():
            out.append(ids.get(w, UNKNOWN))
            n += 1
        elif n:
            out.append(_END_OF[min(n, len(_END_OF) - 1)])
            n = 0
    if n:
        out.append(_END_OF[min(n, len(_END_OF) - 1)])
    return out


def contexts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The two words before each word of a stream that starts with END; nothing before the end of a sentence counts."""
    c, b = x[1:].astype(np.int64), x[:-1].astype(np.int64)
    b = np.where((b >= END) & (b < _FIRST), END, b)
    a = np.concatenate([[END], b[:-1]])[: len(b)]
    return np.where(b == END, END, a), b, c


def _counts(keys: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, inv = np.unique(keys, return_inverse=True)
    n = np.zeros((len(u), LEVELS))
    np.add.at(n, (inv, levels), 1)
    return u, n


def _look(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    known, n = table
    if not len(known):
        return np.zeros((len(keys), LEVELS))
    i = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where((known[i] == keys)[:, None], n[i], 0.0)


@dataclass
class LevelModels:
    """Counts of one to three words by level."""

    ids: dict[str, int]
    orders: list[tuple[np.ndarray, np.ndarray]]
    before: list[tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def fit(streams: list[np.ndarray], levels: np.ndarray, ids: dict[str, int]) -> LevelModels:
        v = len(ids) + _FIRST
        if not streams:
            empty = (np.zeros(0, np.int64), np.zeros((0, LEVELS)))
            return LevelModels(ids, [empty] * 3, [empty] * 3)
        abc = [np.concatenate(p) for p in zip(*(contexts(s) for s in streams))]
        lv = np.repeat(levels - 1, [len(s) - 1 for s in streams])
        a, b, c = abc
        zero = np.zeros_like(c)
        return LevelModels(ids, [_counts(c, lv), _counts(b * v + c, lv), _counts((a * v + b) * v + c, lv)], [_counts(zero, lv), _counts(b, lv), _counts(a * v + b, lv)])

    def surprisal(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """-log p of each word under each level's interpolated model; distinct trigrams are computed once."""
        v = len(self.ids) + _FIRST
        u, inv = np.unique((a * v + b) * v + c, return_inverse=True)
        c, b, a = u % v, u // v % v, u // (v * v)
        p = (_look(c, self.orders[0]) + ADDED) / (_look(np.zeros_like(c), self.before[0]) + ADDED * v)
        for n, keys, seen in ((1, b * v + c, b), (2, u, a * v + b)):
            w = _look(seen, self.before[n])
            p = (OPEN * p + _look(keys, self.orders[n])) / (w + OPEN)
        return -np.log(p)[inv]

    def per_document(self, streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(sum of surprisal by level, number of sentences) of each stream."""
        total, sentences = np.zeros((len(streams), LEVELS)), np.zeros(len(streams))
        full = [i for i, s in enumerate(streams) if len(s) > 1]
        if full:
            a, b, c = (np.concatenate(p) for p in zip(*(contexts(streams[i]) for i in full)))
            starts = np.concatenate([[0], np.cumsum([len(streams[i]) - 1 for i in full])[:-1]]).astype(np.int64)
            total[full] = np.add.reduceat(self.surprisal(a, b, c), starts, axis=0)
            sentences[full] = np.add.reduceat(((c >= END) & (c < _FIRST)).astype(float), starts)
        return total, sentences


def scores(total: np.ndarray, sentences: np.ndarray) -> np.ndarray:
    """The expected level, each level weighted by how likely it makes an average sentence."""
    w = np.exp(-(total - total.min(1, keepdims=True)) / np.maximum(sentences, 1)[:, None])
    return (w * np.arange(1, LEVELS + 1)).sum(1) / w.sum(1)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the knots of a monotone fit of y on x."""
    pools: list[list[float]] = []
    for i in np.lexsort((y, x)):
        pools.append([float(y[i]), 1.0, float(x[i]), float(x[i])])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m, n, _, hi = pools.pop()
            q = pools[-1]
            q[0], q[1], q[3] = (q[0] * q[1] + m * n) / (q[1] + n), q[1] + n, hi
    return np.array([v for p in pools for v in p[2:]]), np.array([p[0] for p in pools for _ in (0, 1)])


@dataclass
class Grader:
    models: LevelModels
    knots: tuple[np.ndarray, np.ndarray]

    def levels(self, streams: list[np.ndarray]) -> np.ndarray:
        """Level of each stream; streams are taken together up to TOGETHER words."""
        out, now, words = [np.zeros(0, np.int32)], [], 0
        for s in streams:
            if now and words + len(s) > TOGETHER:
                out.append(self._levels(now))
                now, words = [], 0
            now.append(s)
            words += len(s)
        return np.concatenate([*out, self._levels(now)])

    def _levels(self, streams: list[np.ndarray]) -> np.ndarray:
        total, sentences = self.models.per_document(streams)
        return np.clip(np.floor(np.interp(scores(total, sentences), *self.knots) + 0.5), 1, LEVELS).astype(np.int32)


def fit(texts: list[str], ratings: np.ndarray) -> Grader:
    """Trains models and scale on rated texts (ratings may be fractions)."""
    n: dict[str, int] = {}
    for t in texts:
        for w in _TOKEN.findall(t.lower()):
            if w[0].isalpha():
                n[w] = n.get(w, 0) + 1
    ids = {w: i + _FIRST for i, w in enumerate(sorted(n, key=lambda w: (-n[w], w))[:VOCABULARY])}
    streams = [np.array(encode(t, ids)) for t in texts]
    level = np.clip(np.floor(ratings + 0.5), 1, LEVELS).astype(np.int64)

    def learn(pick: np.ndarray) -> LevelModels:
        some, lv = [streams[i] for i in pick], level[pick]
        total, _ = LevelModels.fit(some, lv, ids).per_document(some)
        said = total.argmin(1) + 1 if len(total) else lv
        return LevelModels.fit(some, np.where(np.abs(said - ratings[pick]) <= 1, said, lv), ids)

    x = np.zeros(len(texts))
    for fold in (0, 1):
        out = np.flatnonzero(np.arange(len(texts)) % 2 == fold)
        rest = np.flatnonzero(np.arange(len(texts)) % 2 != fold)
        x[out] = scores(*learn(rest).per_document([streams[i] for i in out]))
    return Grader(learn(np.arange(len(texts))), isotonic(x, ratings))


def rated(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> DataFrame:
    """(doc_id, rating, text) of about `sample` rated documents and `chars` characters at most (all if there are fewer), drawn by
    a plain filter on the hash of their id, so that no task returns more than its share. Documents and characters are counted
    first."""
    r = labels.select("doc_id", "rater", "level", "rated_at").distinct().filter(F.col("level").between(1, LEVELS) & F.col("doc_id").isNotNull())
    r = r.groupBy("doc_id").agg(F.avg("level").alias("rating"))
    texts = docs.select("doc_id", "text").filter(F.trim("text") != "")
    n, total = texts.select("doc_id", F.length("text").alias("c")).join(r, "doc_id").agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    share = min(1.0, sample / max(n, 1), chars / max(total, 1))
    some = r.filter(F.xxhash64("doc_id", F.lit(6)) / F.lit(2.0**64) + 0.5 < share)
    return texts.join(F.broadcast(some), "doc_id").dropDuplicates(["doc_id"])  # about `sample` ids


def grade(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """p10_found: (doc_id, level). What reaches the driver is bounded by `sample` rated documents of SAMPLE_CHARS characters."""
    got = sorted(rated(docs, labels, sample).collect(), key=lambda r: r["doc_id"])
    spark = docs.sparkSession
    if not got:
        return spark.createDataFrame([], "doc_id long, level int")
    grader = fit([r["text"] for r in got], np.array([r["rating"] for r in got], float))
    filters: Filters = train(docs, sample=100)
    m = grader.models
    # plain arrays, bounded by sample and VOCABULARY; the classes travel with the function
    shared = spark.sparkContext.broadcast((m.ids, m.orders, m.before, grader.knots, filters.parts(), letters()))

    def run(batches):
        ids, orders, before, knots, parts, table = shared.value
        g, f = Grader(LevelModels(ids, orders, before), knots), Filters(*parts)
        english = f.languages.index("en") if "en" in f.languages else -2
        for b in batches:
            keep, streams = [], []
            for doc, text, code in zip(*(c.to_pylist() for c in b.columns)):
                if len(text.split()) < LEAST_WORDS:
                    continue
                if code != "en":
                    m = f.look_up(gram_hashes(text, table))
                    lang, _ = f.decide(m, np.array([0]), np.array([max(0, m.shape[1] - GRAM + 1)]))
                    if lang[0] != english:
                        continue
                keep.append(doc)
                streams.append(np.array(encode(text, g.models.ids)))
            yield pa.RecordBatch.from_arrays([pa.array(keep, pa.int64()), pa.array(g.levels(streams), pa.int32())], names=["doc_id", "level"])

    code = label_code(F.col("lang"))
    some = docs.select("doc_id", "text", code.alias("code")).filter((F.col("code").isin("en", "")) & F.col("text").isNotNull())
    return some.mapInArrow(run, "doc_id long, level int").distinct()
