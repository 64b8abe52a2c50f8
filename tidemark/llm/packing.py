"""Problem 9: documents, sized in tokens, put into containers of fixed capacity with little unused room.

Method: best-two-fit. A container is filled greedily with the largest piece that still fits; then its smallest piece
is given back if two pieces not yet placed fill the gap, widened by that piece, more tightly. A group keeps only how
many pieces of each size are left, so a step costs a look into a bit set of sizes. Documents are spread by hash over
groups of bounded size that are packed independently, which leaves at most a container or so of room a group.

Result: one row per piece (container, doc_id, offset, length, container_offset); offset counts from the start of the
document, container_offset from the start of the container. A document longer than the capacity gives full
pieces and a rest, any other is one piece. Null, empty and otherwise token-free documents have length 0: they take no
room and lie in the first container of their group. Repeated and null doc_ids are packed as separate documents, null ones
spread over all groups. An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .tokens import VOCABULARY, token_counts

CAPACITY = 2048
DOCS_PER_GROUP = 20_000

_SCHEMA = "container long, doc_id long, offset long, length int, container_offset int, place long"


class SizePool:
    """How many pieces of each size are left."""

    def __init__(self, sizes):
        self.n: dict[int, int] = defaultdict(int)
        self.mask = 0
        for s in sizes:
            self.put(s)

    def put(self, s: int) -> None:
        self.n[s] += 1
        self.mask |= 1 << s

    def take(self, s: int) -> None:
        self.n[s] -= 1
        if not self.n[s]:
            self.mask ^= 1 << s

    def largest(self, most: int) -> int:
        """The largest size left that is at most `most`; 0 if none."""
        return max(0, (self.mask & ((1 << (most + 1)) - 1)).bit_length() - 1) if most > 0 else 0

    def best_pair(self, room: int, more_than: int) -> tuple[int, int] | None:
        """Two pieces whose sum is the largest one at most `room` and above `more_than`."""
        best, got, a = more_than, None, self.largest(room - 1)
        while a and 2 * a > best:
            b = self.largest(min(a, room - a))
            if b == a and self.n[a] < 2:
                b = self.largest(a - 1)
            if b and a + b > best:
                best, got = a + b, (a, b)
                if best == room:
                    break
            a = self.largest(a - 1)
        return got


def pack_sizes(sizes, capacity: int = CAPACITY) -> list[list[int]]:
    """Containers as lists of sizes, by best-two-fit; every size is from 1 to capacity."""
    pool, bins = SizePool(sizes), []
    while pool.mask:
        held, room = [], capacity
        while s := pool.largest(room):
            pool.take(s)
            held.append(s)
            room -= s
        while room and (pair := pool.best_pair(room + held[-1], held[-1])):
            back = held.pop()
            pool.put(back)
            for s in pair:
                pool.take(s)
            held.extend(pair)
            held.sort(reverse=True)
            room += back - sum(pair)
        bins.append(held)
    return bins


def _pack_group(group: int, docs: list, sizes: list[int], places: list[int], capacity: int) -> list[tuple]:
    """The rows of one group of documents."""
    by_size, out = defaultdict(list), []
    first, bins = group << 32, 0
    for doc, n, place in sorted(zip(docs, sizes, places), key=lambda x: (x[0] is None, x[0] or 0, *x[1:])):
        at = 0
        while n - at > capacity:
            out.append((first + bins, doc, at, capacity, 0, place))
            bins, at = bins + 1, at + capacity
        by_size[n - at].append((doc, at, place))
    empty = by_size.pop(0, [])
    for held in pack_sizes([s for s, x in by_size.items() for _ in x], capacity):
        used = 0
        for s in held:
            doc, at, place = by_size[s].pop()
            out.append((first + bins, doc, at, s, used, place))
            used += s
        bins += 1
    return out + [(first, doc, at, 0, 0, place) for doc, at, place in empty]


def _placed(sizes: DataFrame) -> DataFrame:
    """(doc_id, n_ids, place), stored: the place tells documents with one or no doc_id apart."""
    return stored(sizes.withColumn("place", F.monotonically_increasing_id()))


def _pack(sizes: DataFrame, capacity: int, docs_per_group: int = DOCS_PER_GROUP) -> DataFrame:
    """The pieces of _placed sizes, with the place of their document. The rows are counted once, to choose the number of groups."""
    groups = max(1, -(-sizes.count() // docs_per_group))
    # rows without an id are spread by their place in the stored table, so that they are no hot group
    keyed = sizes.withColumn("group", F.pmod(F.xxhash64(F.coalesce("doc_id", "place"), F.lit(9)), F.lit(groups)).cast("long"))

    def run(t: pa.Table) -> pa.Table:
        rows = _pack_group(t.column("group")[0].as_py(), *(t.column(c).to_pylist() for c in ("doc_id", "n_ids", "place")), capacity)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
        return pa.table({k: pa.array(c, x) for k, c, x in zip(("container", "doc_id", "offset", "length", "container_offset", "place"), zip(*rows), types)})

    return keyed.groupBy("group").applyInArrow(run, _SCHEMA)


def pack(sizes: DataFrame, capacity: int = CAPACITY, docs_per_group: int = DOCS_PER_GROUP) -> DataFrame:
    """Packs (doc_id, n_ids)."""
    return _pack(_placed(sizes), capacity, docs_per_group).drop("place")


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """p9_containers: the documents of a corpus in containers of `capacity` tokens."""
    return pack(token_counts(docs, vocabulary), capacity)


def checks(packed: DataFrame, capacity: int = CAPACITY, sizes: DataFrame | None = None) -> DataFrame:
    """What must hold of any packing: (docs, over, torn, overlapping): documents; containers above the capacity; documents
    whose pieces leave a gap, overlap or are more than they may be; containers whose pieces leave a gap or overlap.

    Documents are told apart by doc_id. With sizes (place, n_ids), they are by the place, whatever their doc_ids, and one is
    torn, too, if its pieces have not as many tokens as it has, or if it has none."""

    def laid(key: str, at: str) -> DataFrame:
        before = F.lag(F.col(at) + F.col("length"), 1, 0).over(Window.partitionBy(key).orderBy(at, "length"))
        rows = packed.select(key, "length", (F.col(at) != before).alias("apart"))
        return rows.groupBy(key).agg(F.sum("length").alias("n"), F.count(F.lit(1)).alias("pieces"), F.bool_or("apart").alias("apart"))

    over = laid("container", "container_offset").agg(F.count_if(F.col("n") > capacity).alias("over"), F.count_if("apart").alias("overlapping"))
    per = laid("doc_id" if sizes is None else "place", "offset")
    torn = F.col("apart") | (F.col("pieces") > F.greatest(F.lit(1), F.ceil(F.col("n") / capacity)))
    if sizes is not None:
        per = per.join(sizes.select("place", "n_ids"), "place", "full")
        torn = F.coalesce(torn | (F.col("n") != F.col("n_ids")), F.lit(True))  # null where either side is missing
    per = per.agg(F.count("pieces").alias("docs"), F.count_if(torn).alias("torn"))
    return per.join(F.broadcast(over)).select("docs", "over", "torn", "overlapping")  # one row each


def check_documents(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """p9_checks: the packing of p9_containers held against the documents' sizes."""
    sizes = _placed(token_counts(docs, vocabulary))
    return checks(stored(_pack(sizes, capacity)), capacity, sizes)
