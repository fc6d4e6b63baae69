"""Concatenate and cut: all documents in one stream of ids, cut into windows of ``window``.

Two passes. The first tokenizes each partition and notes every document's start within its
partition; the partitions' totals (one row per partition) get prefix sums, which turn those
into places in the whole stream. The second pass cuts each document at the window borders: a
document over a border leaves a record on each side. Texts are never shuffled or sorted, and
the only padding is in the last sequence.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docket.llm.common import arrow_batches, saved

WINDOW = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k.json"
CACHED_WORDS = 250_000  # pre-tokens in a generation whose ids a worker remembers


# The public pattern for texts of ASCII alone, where its letter and number classes are these.
ASCII_PATTERN = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary (a fixed rule): printable
    Latin-1 for itself, the others for those from 256 on, in turn."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(plain)))}


class Encoder(dict):
    """Ids of a text, as packed little-endian integers, by the ``tokenizers`` library.

    Byte-level merges never cross a pre-token, so each goes to the library's model alone and the
    ids of those met lately are remembered in two generations of bounded size.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.bytes = self.tokenizer.model, byte_characters()
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.split_ascii = re.compile(ASCII_PATTERN, re.ASCII).findall
        self.special = regex.compile("|".join(regex.escape(t.content) for t in
                                              self.tokenizer.get_added_tokens_decoder().values()) or r"(?!)").search
        self.width = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array(self.width, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            mapped = word.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.bytes)
            ids = array(self.width, [t.id for t in self.model.tokenize(mapped)]).tobytes()
        if len(self) >= CACHED_WORDS:
            self.old = dict(self)
            self.clear()
        if len(word) <= 64:
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if self.special(text):
            return self.whole(text)
        return b"".join(map(self.__getitem__, self.split_ascii(text) if text.isascii() else self.split(text)))


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> Encoder:
    """One encoder for all tasks of a Python worker, so that it stays warm."""
    return Encoder(path)


def tokenize(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, end_id: int) -> DataFrame:
    """Id, ids (packed, with the end id), their count, the partition and the start within it."""
    arrow_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(public_tokenizers.path(vocabulary))
        last, size = array(encoder.width, [end_id]).tobytes(), array(encoder.width).itemsize
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            ids = [encoder.encode(t or "") + last for t in b.column(1).to_pylist()]
            n = np.array([len(x) // size for x in ids], np.int64)
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.binary()), pa.array(n), pa.array(np.full(len(n), size, np.int32)),
                 pa.array(np.full(len(n), part, np.int64)), pa.array(starts)],
                ["id", "ids", "n", "width", "part", "start"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, ids binary, n bigint, width int, part bigint, start bigint")


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, vocabulary: str = VOCABULARY,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with
    ``with_ids`` the ids themselves.

    A null or empty text is its end id alone. Every row is packed, also repeated ones and those
    with a null id; other columns are not read; an empty table gives no pieces. A very long text
    becomes as many pieces as windows it lies in.
    """
    ids = saved(tokenize(docs, id_col, text_col, vocabulary, end_id), "ids")
    totals = ids.groupBy("part").agg(F.sum("n").alias("total"))
    # one row per partition of the first pass, whatever the number of documents
    before = F.coalesce(F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = totals.select("part", before.alias("first"))
    placed = ids.join(F.broadcast(first), "part").select("id", "ids", "width", (F.col("start") + F.col("first")).alias("at"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, cols = [], [[] for _ in range(7)]
            for i, (packed, width, at) in enumerate(zip(*(b.column(k).to_pylist() for k in (1, 2, 3)), strict=True)):
                whole = np.frombuffer(packed, f"<u{width}").astype("<u4")
                data, n, start = memoryview(whole).cast("B"), len(whole), 0
                while start < n:
                    place = at + start
                    length = min(window - place % window, n - start)
                    rows.append(i)
                    piece = whole[start:start + length] if with_ids else None
                    for c, v in zip(cols, (start, length, zlib.crc32(data[4 * start:4 * (start + length)]), n,
                                           place // window, place % window, piece), strict=True):
                        c.append(v)
                    start += length
            out = [b.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in cols[:6])]
            yield pa.RecordBatch.from_arrays(
                out + ([pa.array([x.tolist() for x in cols[6]], pa.list_(pa.int64()))] if with_ids else []), names)

    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    kind = docs.schema[id_col].dataType.simpleString()
    return placed.mapInArrow(cut, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
                                  "sequence_id bigint, offset bigint" + ", ids array<bigint>" * with_ids
                             ).withColumnRenamed("id", id_col)


def padding(tokens: int, window: int = WINDOW) -> int:
    """Padding of a sequence of so many tokens: up to the window, none at a power of two."""
    return 0 if tokens & (tokens - 1) == 0 else window - tokens
