"""Problem 4: the language of every document and of every foreign line in it, with a confidence.

Method: language-bitmask n-gram filters. From a bounded sample of documents with a label, the character 4-grams that are
at home in each language are put into one bit-sliced Bloom filter: every position holds a mask with one bit per
language (as many words of 64 bits as the languages need), and the masks at a gram's positions, and-ed, are all languages
that contain it. A line's counts of set bits per language, corrected for the filter's false positives, decide its
language; a record's main language is the one of most of its characters. All grams of a batch are looked up at once.

Edge cases: null, empty and blank texts, and texts without a known gram, have no language and give no row; a label
is what stands before '-' or '_', in any case, two or three letters; a label that names none of the known languages counts
as missing; equal counts go to the language that comes first in the alphabet, with confidence 0; repeated rows give one
result. The number of languages is not limited; the filters take 8 MB for every 64 of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import boilerplate

#: Labelled documents a language is learned from (about so many, by hash of the id; all of a language with fewer).
SAMPLE_DOCS = 300
#: A gram belongs to a language if it was seen at least LEAST_SEEN times and is not FOREIGN times rarer than elsewhere.
LEAST_SEEN, FOREIGN = 3, 0.1
GRAM, BITS, HASHES = 4, 20, 2
#: Characters whose grams are looked up at once (a longer line is taken alone).
TOGETHER = 1_000_000
#: Characters from which a foreign line is a segment of its own.
SEGMENT = 40
#: Confidence below which a line is not taken for a foreign one.
LEAST_SURE = 0.2

# Codes of three letters that name no language.
NO_LANGUAGE = ("mis", "mul", "und", "zxx")

_WEIGHTS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def letters() -> np.ndarray:
    """Code point to lower-case letter, anything but letters to a space."""
    out = np.full(1 << 16, 32, np.uint32)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalpha() and len(c.lower()) == 1:
            out[i] = ord(c.lower())
    return out


def gram_hashes(text: str, table: np.ndarray) -> np.ndarray:
    """One 64-bit hash per position of the text; the last GRAM - 1 are of padding."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    x = np.concatenate([table[np.where(cp < 65536, cp, 32)], np.full(GRAM - 1, 32, np.uint32)]).astype(np.uint64)
    h = np.zeros(len(cp), np.uint64)
    for k in range(GRAM):
        h += x[k : k + len(cp)] * _WEIGHTS[k]
    h ^= h >> np.uint64(29)
    h *= _SECOND
    h ^= h >> np.uint64(32)
    blank = (x[: len(cp)] == 32) & (x[1 : len(cp) + 1] == 32)
    h[blank] = 0
    return h


@dataclass
class Filters:
    """languages in order of their bits; masks by position; each language's rate of false positives."""

    languages: list[str]
    masks: np.ndarray
    rates: np.ndarray

    @staticmethod
    def build(languages: list[str], hashes: np.ndarray, bit: np.ndarray) -> Filters:
        """From grams and the number of the language each belongs to."""
        words = max(1, -(-len(languages) // 64))
        masks = np.zeros((words, 1 << BITS), np.uint64)
        for w in range(words):
            here = (bit >= 64 * w) & (bit < 64 * (w + 1))
            one = np.uint64(1) << (bit[here] - 64 * w).astype(np.uint64)
            for k in range(HASHES):
                np.bitwise_or.at(masks[w], Filters._at(hashes[here], k), one)
        fill = np.array([((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
        return Filters(languages, masks, fill**HASHES)

    def parts(self) -> tuple[list[str], np.ndarray, np.ndarray]:
        """What a filter is made of, for a broadcast."""
        return self.languages, self.masks, self.rates

    @staticmethod
    def _at(h: np.ndarray, k: int) -> np.ndarray:
        return ((h if k == 0 else h * _WEIGHTS[k]) >> np.uint64(64 - BITS)).astype(np.int64)

    def look_up(self, h: np.ndarray) -> np.ndarray:
        """words x grams: the languages that contain each gram."""
        out = self.masks[:, self._at(h, 0)]
        for k in range(1, HASHES):
            out &= self.masks[:, self._at(h, k)]
        out[:, h == 0] = 0
        return out

    def decide(self, masks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language number (-1: none) and confidence of the texts that hold the grams from starts to ends."""
        n = np.maximum(ends - starts, 0)
        counts = np.zeros((len(self.languages), len(starts)))
        for i in range(len(self.languages)):
            total = np.concatenate([[0], np.cumsum((masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1), dtype=np.int64)])
            counts[i] = np.maximum(0, total[np.maximum(starts, ends)] - total[starts] - n * self.rates[i]) / (1 - self.rates[i])
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0)
        best = counts.argmax(0)
        top = np.take_along_axis(counts, best[None], 0)[0]
        second = np.sort(counts, 0)[-2] if len(self.languages) > 1 else np.zeros_like(top)
        sure = np.where(top > 0, (top - second) / np.maximum(top, 1e-9), 0)
        return np.where(top >= 1, best, -1), sure


def label_code(label: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(F.coalesce(label, F.lit(""))), r"\A([^_\-]*)", 1))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE_DOCS) -> Filters:
    """Learns the filters from about `sample` documents of each language, drawn by a plain filter on the hash of their id, so
    that no task returns more than its share; what reaches the driver is the grams of that sample. The labels are counted
    first, one row a language."""
    table = letters()
    code = label_code(F.col(lang_col))
    good = F.col("code").rlike(r"\A[a-z]{2,3}\z") & ~F.col("code").isin(*NO_LANGUAGE) & F.col(id_col).isNotNull()
    labelled = docs.select(id_col, text_col, code.alias("code")).filter(good)
    sizes = labelled.groupBy("code").agg(F.count(F.lit(1)).alias("_n"))
    share = F.xxhash64(id_col, F.lit(4)) / F.lit(2.0**64) + 0.5
    chosen = labelled.join(F.broadcast(sizes), "code").filter(share * F.col("_n") < sample).filter(F.trim(text_col) != "").select("code", text_col)  # a row a language

    def run(batches):
        for b in batches:
            codes, texts = (np.array(c.to_pylist(), dtype=object) for c in b.columns)
            for code in sorted(set(codes)):
                h = np.concatenate([gram_hashes(t, table) for t in texts[codes == code]])
                g, n = np.unique(h[h != 0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([code] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))], names=["code", "gram", "n"])

    grams = chosen.mapInArrow(run, "code string, gram long, n long").groupBy("code", "gram").agg(F.sum("n").alias("n"))
    total = W.partitionBy("code")
    rate = grams.withColumn("rate", F.col("n") / F.sum("n").over(total)).filter(F.col("n") >= LEAST_SEEN)
    kept = rate.withColumn("most", F.max("rate").over(W.partitionBy("gram"))).filter(F.col("rate") >= FOREIGN * F.col("most")).select("code", "gram")
    got = kept.toPandas()
    languages = sorted(got["code"].unique())
    if not len(languages):
        return Filters([], np.zeros((1, 1 << BITS), np.uint64), np.zeros(0))
    bit = got["code"].map({c: i for i, c in enumerate(languages)}).to_numpy(np.int64)
    return Filters.build(languages, got["gram"].to_numpy(np.int64).view(np.uint64), bit)


_LINES = "row long, line_no array<int>, size array<int>, lang array<int>, sure array<double>"


def line_languages(texts: DataFrame, filters: Filters) -> DataFrame:
    """(row, line_no, size, lang, sure) for the non-blank lines of (row, text): the language of each by its number."""
    shared = texts.sparkSession.sparkContext.broadcast((filters.parts(), letters()))  # of fixed size

    def run(batches):
        parts, table = shared.value
        f = Filters(*parts)

        def decided(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
            if not f.languages:
                return np.full(len(lines), -1), np.zeros(len(lines))
            starts = np.cumsum([0, *(len(x) + 1 for x in lines[:-1])])
            masks = f.look_up(gram_hashes("\n".join(lines), table))
            return f.decide(masks, starts, np.minimum(starts + [len(x) - GRAM + 2 for x in lines], masks.shape[1]))

        for b in batches:
            size, no, owner, waiting, chars, got = [], [], [], [], 0, []
            for r, text in enumerate(b.column(1)):
                for i, line in enumerate((text.as_py() or "").split("\n")):
                    if bare := line.strip():
                        size.append(len(bare))
                        no.append(i)
                        owner.append(r)
                        waiting.append(line)
                        chars += len(line)
                        if chars > TOGETHER:
                            got.append(decided(waiting))
                            waiting, chars = [], 0
            if waiting:
                got.append(decided(waiting))
            lang, sure = (np.concatenate(x) for x in zip(*got)) if got else (np.zeros(0), np.zeros(0))
            cut = np.searchsorted(np.array(owner, np.int64), np.arange(b.num_rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(np.asarray(v, t))) for v, t in ((no, np.int32), (size, np.int32), (lang, np.int32), (sure, np.float64))]
            yield pa.RecordBatch.from_arrays([b.column(0), *lists], names=["row", "line_no", "size", "lang", "sure"])

    return texts.mapInArrow(run, _LINES)


_SEGMENTS = "src string, rec_key string, label string, seg_no int, lang string, confidence double"


def segments(lines: DataFrame, languages: list[str], least: int = SEGMENT) -> DataFrame:
    """From (src, rec_key, label, line_no, size, lang, sure, keep): seg_no -1 with each record's main language, and
    its lines of at least `least` characters in another one. keep: the lines that count, null for all."""

    def run(batches):
        for b in batches:
            out = []
            for src, key, label, no, size, lang, sure, keep in zip(*(c.to_pylist() for c in b.columns)):
                votes: dict[int, list[float]] = {}
                for k, (n, g, s) in enumerate(zip(size, lang, sure)):
                    if g >= 0 and (keep is None or keep[k]):
                        v = votes.setdefault(g, [0, 0.0])
                        v[0] += n
                        v[1] += n * s
                if not votes:
                    continue
                main = max(votes, key=lambda g: (votes[g][0], -g))
                whole = sum(v[0] for v in votes.values())
                out.append((src, key, label, -1, languages[main], votes[main][1] / whole))
                out += [(src, key, label, i, languages[g], s) for k, (i, n, g, s) in enumerate(zip(no, size, lang, sure)) if g >= 0 and g != main and n >= least and s >= LEAST_SURE and (keep is None or keep[k])]
            cols = list(zip(*out)) if out else [[]] * 6
            types = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["src", "rec_key", "label", "seg_no", "lang", "confidence"])

    return lines.select("src", "rec_key", "label", "line_no", "size", "lang", "sure", "keep").mapInArrow(run, _SEGMENTS)


def identify(pages: DataFrame, rules: DataFrame, docs: DataFrame) -> DataFrame:
    """(src, rec_key, label, seg_no, lang, confidence): the main language (seg_no -1) and the foreign lines of every
    page's article and every rule's then_logic."""
    filters = train(docs)
    p = boilerplate.with_row(pages).filter(F.col("text").isNotNull())
    spoken = line_languages(p.select("row", "text"), filters).dropDuplicates(["row"])
    kept = boilerplate.lines(pages).select("row", F.col("article").alias("keep"))
    labels = p.select("row", F.col("page_id").cast("string").alias("rec_key"), label_code(F.col("lang")).alias("label")).distinct()
    of_pages = spoken.join(kept, "row").join(labels, "row").withColumn("src", F.lit("changed_urls"))
    r = rules.filter(F.col("id").isNotNull() & F.col("then_logic").isNotNull()).select(F.xxhash64("id", "then_logic").alias("row"), "id", "then_logic")
    of_rules = line_languages(r.select("row", "then_logic"), filters).dropDuplicates(["row"]).join(r.select("row", F.col("id").alias("rec_key")).distinct(), "row")
    of_rules = of_rules.withColumns({"src": F.lit("rules"), "label": F.lit("en"), "keep": F.lit(None).cast("array<boolean>")})
    cols = ["src", "rec_key", "label", "line_no", "size", "lang", "sure", "keep"]
    return segments(of_pages.select(cols).unionByName(of_rules.select(cols)), filters.languages)


def found(pages: DataFrame, rules: DataFrame, docs: DataFrame) -> DataFrame:
    """p4_found: (src, rec_key, seg_no, lang) where the main language is not the label's, and all foreign lines."""
    s = identify(pages, rules, docs)
    return s.filter((F.col("seg_no") >= 0) | (F.col("lang") != F.col("label"))).select("src", "rec_key", "seg_no", "lang").distinct()
