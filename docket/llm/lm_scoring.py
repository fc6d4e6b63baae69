"""Hashed maximum-entropy language model with n-gram and skip features.

    log P(w | h) = log P(class | h) + log P(slot | class, h) + log P(w | slot)

A word's slot and class come from its hash; the first two factors are softmax layers over
hashed features of the context (last word, last two, the word before the last, the two before
it), the third shares a slot among its words by smoothed corpus counts, one share being kept for
words never seen. So the probabilities of all words sum to one, and the model is of fixed size
while every corpus count stays exact.

The corpus is encoded once into blocks: token numbers with a vocabulary of the block's own, whose
words are told apart by their 64-bit hashes. Counts meet the blocks by a shuffle of (block, word)
rows, not of tokens. Training passes over
every training token once, in ``ROUNDS`` rounds: each task runs gradient steps over its blocks of
the round from the common weights, and the tasks' changes are averaged by tokens in Spark. Steps are
AdaGrad's with one sum of squares for each feature row, which goes from round to round with the weights.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docket.llm.common import saved, slices, words
from docket.session import scratch_path

BLOCK = 2_000_000            # tokens in a block, about; a longer document is a block of its own
CLASSES, SLOTS = 32, 32      # classes, and slots in each: powers of two
CLASS_ROWS, SLOT_ROWS = 1 << 13, 1 << 14
ROUNDS, STEP, BATCH = 4, 0.1, 4096
ADD = 0.1                    # added to every count
PIECES, SALT = 16, 32        # weights are averaged in so many pieces; first so many groups of tasks
ALONE = 8                    # gradients of a row in a batch that are added one by one; the rest in one go
ROW_GROUP = 4 << 20          # bytes of a row group of the blocks: about a block, so that tasks get even shares
END = b""                    # the end of a text; no word is empty


def encode(docs: DataFrame) -> DataFrame:
    """Blocks of ``docs`` (id, text, train): ids, train flags and lengths of the documents, tokens
    (compressed 32-bit numbers), the hashes of the block's words (and their low halves, which is all
    that slots and features use) and their counts in training texts."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0

        def block(ids, train, texts):
            n = np.array([len(t) for t in texts], np.int64)
            place: dict[bytes, int] = {}
            tokens = np.fromiter((place.setdefault(w, len(place)) for w in chain.from_iterable(texts)), np.int32, int(n.sum()))
            counts = np.bincount(tokens[np.repeat(np.array(train, bool), n)], minlength=len(place))
            hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in place), np.uint64, len(place)).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number]), pa.array([ids]), pa.array([train]), pa.array([n.tolist()]),
                 pa.array([zstandard.compress(tokens.tobytes(), 3)]), pa.array([hashes.astype(np.uint32).tobytes()]), _list(hashes),
                 _list(counts.astype(np.int64))],
                ["block", "ids", "train", "n", "tokens", "low", "hashes", "counts"])

        ids, train, texts, size = [], [], [], 0
        for b in slices(batches):
            for i, t, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ids.append(i)
                train.append(y)
                texts.append([*words(t), END])
                size += len(texts[-1])
                if size >= BLOCK:
                    yield block(pa.array(ids, b.column(0).type).to_pylist(), train, texts)
                    number, ids, train, texts, size = number + 1, [], [], [], 0
        if ids:
            yield block(ids, train, texts)

    return docs.select("id", "text", "train").mapInArrow(
        run, f"block bigint, ids array<{kind}>, train array<boolean>, n array<bigint>, tokens binary, "
             "low binary, hashes array<bigint>, counts array<bigint>")


def _list(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x))


def slot_of(h: np.ndarray) -> np.ndarray:
    """The hash's last bits: ``pmod`` of the whole, signed hash gives the same."""
    return (h % (CLASSES * SLOTS)).astype(np.int64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def with_counts(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(blocks with the corpus count of each of their words, one row per word and block: slot, count
    over all blocks, whether this is the word's first block). Blocks lie in a folder for each round."""
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    each = blocks.select("block", F.posexplode(F.arrays_zip("hashes", "counts")).alias("at", "x"))
    by = Window.partitionBy("h")  # at most one row a block, also for the most frequent word
    each = each.select("block", "at", F.col("x.hashes").alias("h"), F.col("x.counts").alias("own"))
    each = saved(each.select("block", "at", F.pmod("h", F.lit(CLASSES * SLOTS).cast("long")).cast("int").alias("slot"),
                             F.sum("own").over(by).alias("c"), (F.col("block") == F.min("block").over(by)).alias("first")), "word-counts")
    lists = each.select("block", "at", "c").groupBy("block").applyInArrow(_in_order, "block bigint, c binary")
    rounds = F.pmod(F.xxhash64("block"), F.lit(ROUNDS)).cast("int").alias("round")
    path = scratch_path(blocks.sparkSession, "llm", f"blocks-{uuid.uuid4().hex}")
    (blocks.drop("hashes", "counts").join(lists, "block").select("*", rounds).write.partitionBy("round")
     .option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(path))
    return blocks.sparkSession.read.schema(f"{_BLOCK_COLUMNS % kind}, round int").parquet(path), each


_BLOCK_COLUMNS = "block bigint, ids array<%s>, train array<boolean>, n array<bigint>, tokens binary, low binary, c binary"


def _in_order(key, table):
    c = np.zeros(table.num_rows, np.int64)
    c[table["at"].to_numpy()] = table["c"].to_numpy()
    return pa.table({"block": table["block"][:1], "c": pa.array([c.tobytes()], pa.binary())})


class Block:
    """A block's arrays."""

    def __init__(self, row: dict):
        self.ids, self.train = row["ids"], np.array(row["train"], bool)
        self.n = np.array(row["n"], np.int64)
        self.tokens = np.frombuffer(zstandard.decompress(row["tokens"]), np.int32)
        self.c = np.frombuffer(row["c"], np.int64)
        self.h = np.frombuffer(row["low"], np.uint32)
        self.slot = slot_of(self.h)[self.tokens]
        self.starts = np.cumsum(self.n) - self.n

    def contexts(self) -> np.ndarray:
        """Hashes of the four features, by token."""
        h = self.h.astype(np.uint64)[self.tokens] + np.uint64(2)
        at = np.arange(len(h)) - np.repeat(self.starts, self.n)

        def back(k):
            out = np.ones(len(h), np.uint64)
            out[k:] = np.where(at[k:] >= k, h[:-k], np.uint64(1))
            return out

        a, b, c = (back(k) if len(h) > k else np.ones(len(h), np.uint64) for k in (1, 2, 3))
        p, q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
        return np.stack([_mix(a * p), _mix(a * p + b * q + np.uint64(1)), _mix(b * q + np.uint64(2)), _mix(b * p + c * q + np.uint64(3))], axis=1)


class Model:
    def __init__(self, slot_tokens: np.ndarray, slot_words: np.ndarray):
        """From each slot's training tokens and distinct training words."""
        self.tokens, self.words = slot_tokens.astype(float), slot_words.astype(float)
        mass = (self.tokens + 0.5).reshape(CLASSES, SLOTS)
        self.class_bias = np.log(mass.sum(axis=1) / mass.sum()).astype(np.float32)
        self.slot_bias = np.log(mass / mass.sum(axis=1, keepdims=True)).astype(np.float32)
        self.class_w = np.zeros((CLASS_ROWS, CLASSES), np.float32)
        self.slot_w = np.zeros((SLOT_ROWS, SLOTS), np.float32)
        self.class_q, self.slot_q = np.zeros(CLASS_ROWS, np.float32), np.zeros(SLOT_ROWS, np.float32)

    def learnt(self) -> list[np.ndarray]:
        """What training changes: weights, and the sums of squares of their rows."""
        return [self.class_w, self.slot_w, self.class_q, self.slot_q]

    def rows(self, contexts: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the weights, as 16-bit numbers: sorting them is then linear."""
        inner = (contexts ^ ((cls + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]) * np.uint64(0xC2B2AE3D27D4EB4F)
        bits = np.uint64(64 - SLOT_ROWS.bit_length() + 1)
        return (contexts & np.uint64(CLASS_ROWS - 1)).astype(np.uint16), (inner >> bits).astype(np.uint16)

    def layers(self, contexts: np.ndarray, slot: np.ndarray):
        """For each layer: its weights, the rows in use, unnormalised probabilities of all outcomes, the
        outcome, and the log-probability of that."""
        cls, inner = slot // SLOTS, slot % SLOTS
        at = np.arange(len(slot))
        for w, rows, bias, y in zip((self.class_w, self.slot_w), self.rows(contexts, cls), (self.class_bias, self.slot_bias[cls]), (cls, inner), strict=True):
            z = w.take(rows[:, 0], axis=0)
            z += bias
            for k in range(1, rows.shape[1]):
                z += w.take(rows[:, k], axis=0)
            own = z[at, y]
            np.exp(z, out=z)
            total = z.sum(axis=1)
            yield w, rows, z, total, y, own - np.log(total)

    def log_slots(self, contexts: np.ndarray, slot: np.ndarray) -> np.ndarray:
        out = np.empty(len(slot))
        for at in range(0, len(slot), BATCH):
            s = slice(at, at + BATCH)
            out[s] = sum(x[-1] for x in self.layers(contexts[s], slot[s]))
        return out

    def log_word(self, c: np.ndarray, slot: np.ndarray) -> np.ndarray:
        return np.log((c + ADD) / (self.tokens[slot] + ADD * (self.words[slot] + 1)))

    def learn(self, contexts: np.ndarray, slot: np.ndarray) -> None:
        """AdaGrad steps over batches of tokens: a row's step is over the root of the sum of its gradients'
        mean squares."""
        for at in range(0, len(slot), BATCH):
            s = slice(at, at + BATCH)
            for (w, rows, g, total, y, _), square in zip(self.layers(contexts[s], slot[s]), (self.class_q, self.slot_q), strict=True):
                g /= total[:, None]
                g[np.arange(len(y)), y] -= 1
                used, g = by_row(g, rows)
                q = square[used] + np.einsum("ij,ij->i", g, g) / g.shape[1]
                square[used] = q
                g *= (STEP / np.sqrt(q + 1e-6))[:, None]
                w[used] -= g


def by_row(g: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows in use, and the sums of the gradients ``g`` (by token) over the tokens that use them. Most rows are used
    once or twice, so first, second, .. uses are added for all rows at once and only what is left of frequent
    rows is summed row by row."""
    flat = rows.ravel()
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    uses = np.diff(first, append=len(ordered))
    most = np.argsort(-uses, kind="stable")
    first, uses, token = first[most], uses[most], order // rows.shape[1]
    out = g.take(token[first], axis=0)
    more = np.searchsorted(-uses, -np.arange(1, ALONE + 1))  # rows with more than 1, 2, .. uses come first
    for k in range(1, ALONE):
        m = more[k - 1]
        out[:m] += g.take(token[first[:m] + k], axis=0)
    m = more[ALONE - 1]
    if m:
        left = uses[:m] - ALONE
        start = np.cumsum(left) - left
        at = np.arange(left.sum()) + np.repeat(first[:m] + ALONE - start, left)
        out[:m] += np.add.reduceat(g.take(token[at], axis=0), start, axis=0)
    return ordered[first], out


def train(blocks: DataFrame, model: Model) -> None:
    """Weights of ``model`` by one pass over the training tokens of ``blocks``, in rounds."""
    sc = blocks.sparkSession.sparkContext
    for r in range(ROUNDS):
        shared = sc.broadcast(model)  # 3 MB, whatever the data

        def run(rows: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            start = shared.value
            own, n = Model(start.tokens, start.words), 0
            for mine, common in zip(own.learnt(), start.learnt(), strict=True):
                mine[:] = common
            for batch in slices(rows, 1):
                b = Block(batch.to_pylist()[0])
                some = np.repeat(b.train, b.n)
                own.learn(b.contexts()[some], b.slot[some])
                n += int(some.sum())
            if n:
                change = np.concatenate([(x - y).ravel() for x, y in zip(own.learnt(), start.learnt(), strict=True)]) * n
                salt = TaskContext.get().partitionId() % SALT
                pieces = np.array_split(change.astype(np.float32), PIECES)
                yield pa.RecordBatch.from_arrays([pa.array(range(PIECES), pa.int32()), pa.array([salt] * PIECES, pa.int32()), pa.array([float(n)] * PIECES),
                                                  pa.array([p.tobytes() for p in pieces], pa.binary())], ["piece", "salt", "n", "change"])

        schema = "piece int, salt int, n double, change binary"
        changes = blocks.filter(F.col("round") == r).mapInArrow(run, schema)
        total = changes.groupBy("piece", "salt").applyInArrow(_added, schema)
        total = total.withColumn("salt", F.lit(0)).groupBy("piece", "salt").applyInArrow(_added, schema).toArrow().sort_by("piece")
        if total.num_rows:
            change = np.concatenate([np.frombuffer(x, np.float32) for x in total["change"].to_pylist()]) / total["n"][0].as_py()
            for x, part in zip(model.learnt(), np.split(change, np.cumsum([x.size for x in model.learnt()])[:-1]), strict=True):
                x += part.reshape(x.shape)
        shared.unpersist()


def _added(key, table):
    change = sum(np.frombuffer(x, np.float32) for x in table["change"].to_pylist())
    return pa.table({"piece": table["piece"][:1], "salt": table["salt"][:1], "n": pa.array([sum(table["n"].to_pylist())]),
                     "change": pa.array([change.astype(np.float32).tobytes()], pa.binary())})


def score_texts(docs: DataFrame, train_on: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, n_known, train_tokens, base_score, score (log10
    probabilities of the whole text with its end), learnt from the rows where ``train_on`` holds.

    Null and empty texts are their end alone. Rows with a null id and repeated rows count and are
    scored like others; other columns are not read; an empty table gives no rows. Where nothing may
    be learnt from, counts are zero and every word has the smoothed probability of an unseen one.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(train_on, F.lit(False)).alias("train"))
    kind = own.schema["id"].dataType.simpleString()
    encoded = saved(encode(own), "encoded")
    blocks, each = with_counts(encoded)
    got = each.filter("first AND c > 0").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = got["n"] or 0, got["v"] or 0
    model = Model(*_slots(each))
    train(blocks, model)
    shared = spark.sparkContext.broadcast(model)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(rows, 1):
            b = Block(batch.to_pylist()[0])
            c = b.c[b.tokens]
            base = np.log10((c + ADD) / (n + ADD * (v + 1)))
            score = (model.log_slots(b.contexts(), b.slot) + model.log_word(c, b.slot)) / np.log(10)
            total = lambda x: np.add.reduceat(x, b.starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.ids, batch.schema.field("ids").type.value_type), pa.array(b.n), pa.array(total((c > 0).astype(np.int64))),
                 pa.array(np.full(len(b.n), n, np.int64)), pa.array(total(base)), pa.array(total(score))],
                ["id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return blocks.mapInArrow(run, f"id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
                             ).withColumnRenamed("id", id_col)


def _slots(each: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and distinct training words by slot; a word counts in its first block."""
    got = each.filter("first AND c > 0").groupBy("slot").agg(F.sum("c").alias("tokens"), F.count(F.lit(1)).alias("words")).toArrow()
    out = np.zeros((2, CLASSES * SLOTS), np.int64)
    if got.num_rows:
        out[:, got["slot"].to_numpy()] = got["tokens"].to_numpy(), got["words"].to_numpy()
    return out[0], out[1]
