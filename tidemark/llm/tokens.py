"""Problem 8: encoding of the whole corpus with a public byte-level BPE, each distinct word encoded once.

Method: global distinct-word shuffle. One pass splits every text into pre-tokens by the tokenizer's pattern and turns
them into positions in a word list; documents are taken in blocks of bounded size, so that a word crosses the network
once per block and not once per occurrence. The words of all blocks are made distinct by a shuffle, each is encoded
once, the ids are joined back to the (block, word) rows, and every block is reassembled by position. No byte of the
text itself is shuffled, only the compressed positions.

Edge cases: null and empty texts give an empty list; blank texts are encoded as they are; strings of special tokens
are ordinary text; repeated and null doc_ids give one row each; an empty table gives no rows; a text of any length is one
piece of one block and is never cut. Extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

#: Where the vocabulary files of the public tokenizers lie on the driver; pass another path where they lie elsewhere.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern by which this vocabulary's tokenizer parts a text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bounds of a block: characters of text (a longer text is a block of its own) and documents.
BLOCK_CHARS = 4_000_000
BLOCK_DOCS = 4096

_BLOCKS = "block long, doc_ids array<long>, sizes array<int>, words array<string>, seq binary"


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: one base64 token and its id a line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _split_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import regex
    import zstandard
    from pyspark import TaskContext

    split, pack = regex.compile(PATTERN).findall, zstandard.ZstdCompressor(level=1)
    number = TaskContext.get().partitionId() << 32
    schema = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("words", pa.list_(pa.string())), ("seq", pa.binary())])

    def new():
        words: defaultdict = defaultdict()
        words.default_factory = words.__len__
        return words, [], [], []

    words, ids, sizes, seq, chars = *new(), 0

    def block():
        raw = np.concatenate(seq) if seq else np.zeros(0, np.int32)
        row = [[number], [ids], [sizes], [list(words)], [pack.compress(raw.astype("<u2" if len(words) <= 65536 else "<u4").tobytes())]]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, schema.types)], schema=schema)

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            if ids and (chars + len(text) > BLOCK_CHARS or len(ids) >= BLOCK_DOCS):
                yield block()
                number += 1
                words, ids, sizes, seq, chars = *new(), 0
            found = split(text)
            ids.append(doc)
            sizes.append(len(found))
            seq.append(np.fromiter(map(words.__getitem__, found), np.int32, len(found)))
            chars += len(text)
    if ids:
        yield block()


def word_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(block, doc_ids, sizes, words, seq): the documents' pre-tokens as positions in the block's list of words."""
    return stored(docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(_split_blocks, _BLOCKS))


def encode_words(words: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(word, ids) for a DataFrame of distinct words. The vocabulary, of fixed size, is read by the driver and broadcast."""
    ranks = words.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches):
        import tiktoken

        e = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks.value, special_tokens={})
        for b in batches:
            ids = [e.encode_ordinary(w) for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["word", "ids"])

    return words.mapInArrow(run, "word string, ids array<int>")


def block_dictionaries(blocks: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(block, known): the ids of each block's words, in the order of its list; every distinct word is encoded once."""
    rows = blocks.select("block", F.posexplode("words").alias("at", "word"))
    known = encode_words(rows.select("word").distinct(), vocabulary)
    back = rows.join(known, "word").select("block", "at", "ids")
    return back.groupBy("block").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "ids"))), lambda x: x["ids"]).alias("known"))


def _unpacked(batch: pa.RecordBatch, i: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, sizes, word positions, and the flat ids of the words with their offsets, of row i."""
    import zstandard

    doc_ids, sizes = batch.column("doc_ids")[i].values, batch.column("sizes")[i].values.to_numpy(zero_copy_only=False)
    known = batch.column("known")[i]
    known = known.values if known.is_valid else pa.array([], pa.list_(pa.int32()))
    flat = known.flatten().to_numpy(zero_copy_only=False)
    starts = np.zeros(len(known) + 1, np.int64)
    np.cumsum(known.value_lengths().to_numpy(zero_copy_only=False), out=starts[1:])
    raw = zstandard.ZstdDecompressor().decompress(batch.column("seq")[i].as_py())
    return doc_ids, sizes, np.frombuffer(raw, "<u2" if len(known) <= 65536 else "<u4"), flat, starts


def _per_doc(lengths: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Offsets of the documents in the ids, from the ids' counts per word occurrence and the words per document."""
    total = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return total[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]


#: Ids sent to the JVM in one batch.
_BATCH_IDS = 1_000_000


def _reassemble(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            doc_ids, sizes, seq, flat, starts = _unpacked(batch, i)
            lengths = (starts[1:] - starts[:-1])[seq]
            ends = np.cumsum(lengths)
            at = np.arange(ends[-1] if len(ends) else 0, dtype=np.int64) + np.repeat(starts[seq] - (ends - lengths), lengths)
            ids, offsets = flat[at].astype(np.int32), _per_doc(lengths, sizes)
            a = 0
            while a < len(doc_ids):
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _BATCH_IDS, "right")) - 1)
                part = pa.ListArray.from_arrays(pa.array((offsets[a : b + 1] - offsets[a]).astype(np.int32)), pa.array(ids[offsets[a] : offsets[b]]))
                yield pa.RecordBatch.from_arrays([doc_ids.slice(a, b - a), part], names=["doc_id", "ids"])
                a = b


def _count(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            doc_ids, sizes, seq, _, starts = _unpacked(batch, i)
            n = np.diff(_per_doc((starts[1:] - starts[:-1])[seq], sizes))
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(n, pa.int64())], names=["doc_id", "n_ids"])


def _with_dictionaries(docs: DataFrame, vocabulary: str, id_col: str, text_col: str) -> DataFrame:
    blocks = word_blocks(docs, id_col, text_col)
    return blocks.select("block", "doc_ids", "sizes", "seq").join(block_dictionaries(blocks, vocabulary), "block", "left")


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """p8_ids: (doc_id, ids) of every document, without special tokens."""
    return _with_dictionaries(docs, vocabulary, id_col, text_col).mapInArrow(_reassemble, "doc_id long, ids array<int>")


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_ids): the sizes of the documents in tokens, by the same words; the ids are not built."""
    return _with_dictionaries(docs, vocabulary, id_col, text_col).mapInArrow(_count, "doc_id long, n_ids long")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): every id is joined to the table of token bytes, which has the vocabulary's fixed
    size and is broadcast, and the bytes are put together by position. An empty list gives '', a null one or one with an
    unknown id null; bytes that are no UTF-8 are replaced."""
    tokens = sorted((i, t) for t, i in read_ranks(vocabulary).items())
    sizes = np.zeros(tokens[-1][0] + 1, np.int64)
    for i, t in tokens:
        sizes[i] = len(t)
    shared = encoded.sparkSession.sparkContext.broadcast((np.frombuffer(b"".join(t for _, t in tokens), np.uint8), sizes))

    def run(batches):
        blob, size = shared.value
        start = np.cumsum(size) - size
        for b in batches:
            out = []
            for ids in b.column("ids"):
                x = ids.values.to_numpy(zero_copy_only=False) if ids.is_valid else None
                if x is None or len(x) and (x.min() < 0 or x.max() >= len(size) or not size[x].all()):
                    out.append(None)
                    continue
                n = size[x]
                at = np.arange(n.sum()) + np.repeat(start[x] - (np.cumsum(n) - n), n)
                out.append(blob[at].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
