"""Toxicity by two class-conditional Kneser-Ney models of words.

A word backs off to its first 7, 5, 4 and 3 characters. The count of an expression in a class is
Kneser-Ney's continuation count: of how many distinct words it is the successor there, which a line
that is repeated cannot inflate. With N that count, T the sum over all expressions of an order, and g
the next shorter expression of f, a class c has

    P_c(f) = max(N_c(f) - D_c, 0) / T_c + BACKOFF * P_c(g) * S(f | g)

S, the share of f among the expressions that g begins, comes from the counts of both classes
together, and what it discounts is left to expressions never seen, so the probabilities sum to one.
The discount D_c of each order is the number that frees the mass ``BACKOFF`` in the class: the
larger class is discounted more, and a word that neither knows speaks for neither. Divided by the
shared probability (the product of S along the chain), P_c is a ratio, in which S cancels when the
classes are compared. Compared are the two log-likelihoods per word, over the whole text and over
its most toxic stretches (a single insult in a long text is lost in the text's mean). A logistic
curve, fitted on labelled texts that were not counted, turns these into a score from 0 to 1.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import chain as joined

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docket.llm.common import arrow_batches, saved, words

SAMPLE = 20_000        # labelled documents used for the fit, at most; half count, half calibrate
DISCOUNT = 0.75        # of the shared counts
BACKOFF = 0.6          # mass of a class that every order leaves to the next shorter one
PREFIXES = (3, 4, 5, 7)
STRETCHES = (1, 4, 16)  # words in the short stretches
CACHED_WORDS = 300_000
MARKS = string.punctuation.encode()
COUNTED = ["y", "key", "chain", "before"]
CHAIN = pa.list_(pa.int64())


def chain(word: bytes) -> list[int]:
    """The word's expressions of all orders, shortest first, without the marks around it, as hashes. A
    prefix as long as the word is the word."""
    w = word.strip(MARKS) or word
    text, own = w.decode("utf-8", "surrogatepass"), xxhash.xxh64_intdigest(w)
    return [xxhash.xxh64_intdigest(text[:k].encode("utf-8", "surrogatepass") + b"*") if len(text) > k else own for k in PREFIXES] + [own]


def discount(counts: np.ndarray, mass: float) -> float:
    """The number that, taken off every count as far as it goes, frees this share of their sum."""
    low, high = 0.0, float(counts.max())
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if np.minimum(counts, mid).sum() < mass * counts.sum() else (low, mid)
    return high


class Model:
    """By order, the hashes of the expressions (sorted) and what their own counts add to the ratio of
    class 0 (ordinary) and 1 (toxic). Both classes have an expression."""

    def __init__(self, chains: np.ndarray, keys: np.ndarray, counts: np.ndarray):
        """From the chains of all words (a row each) and the continuation counts of ``keys`` (sorted; a row a class)."""
        self.orders: list[tuple[np.ndarray, np.ndarray]] = []
        self.weights = np.zeros(2 + len(STRETCHES))
        shorter, shared = np.zeros(1, np.uint64), np.ones(1)
        for k in range(chains.shape[1]):
            own, first = np.unique(chains[:, k], return_index=True)
            begin = np.searchsorted(shorter, chains[first, k - 1]) if k else np.zeros(len(own), np.int64)
            n = counts[:, np.searchsorted(keys, own)].astype(float)
            both = n.sum(axis=0)
            shared = shared[begin] * (both - DISCOUNT) / np.bincount(begin, both, len(shorter))[begin]
            off = np.array([discount(x, BACKOFF) for x in n])
            gain = np.maximum(n - off[:, None], 0) / n.sum(axis=1, keepdims=True) / shared
            self.orders.append((own, gain.astype(np.float32)))
            shorter = own

    def ratios(self, chains: np.ndarray) -> np.ndarray:
        """P_c of each word (a row of ``chains``) divided by the shared probability; a row a class."""
        out = np.ones((2, len(chains)))
        for k, (keys, gain) in enumerate(self.orders):
            at = np.minimum(np.searchsorted(keys, chains[:, k]), len(keys) - 1)
            out = np.where(keys[at] == chains[:, k], gain[:, at], 0) + BACKOFF * out
        return out


class Scorer(dict):
    """A worker's view of a model: remembers the log-ratios of so many words."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.known = np.zeros(CACHED_WORDS, np.float32)

    def learn(self, new: list[bytes]) -> None:
        r = self.model.ratios(np.array([chain(w) for w in new], np.uint64).reshape(len(new), len(PREFIXES) + 1))
        first = len(self)
        self.known[first:first + len(new)] = np.log(r[1]) - np.log(r[0])
        self.update(zip(new, range(first, first + len(new)), strict=True))

    def log_ratio(self, each: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Toxic minus ordinary log-probability of each word; words by text."""
        n = np.array([len(w) for w in each], np.int64)
        there = set().union(*each)
        new = [w for w in there if w not in self]  # set.difference would walk all the words remembered
        if len(self) + len(new) > CACHED_WORDS:
            self.clear()
            new = there
        self.learn(sorted(new))
        return self.known[np.fromiter(map(self.__getitem__, joined.from_iterable(each)), np.int64, int(n.sum()))], n

    def features(self, texts: list[str | None]) -> np.ndarray:
        """By text: 1, the whole text's ratio per word, that of the most toxic stretch of each
        length (a shorter text is one stretch). Zeros for a text without words."""
        out = np.zeros((len(texts), 2 + len(STRETCHES)))
        out[:, 0] = 1
        at = 0
        while at < len(texts):  # so many texts at once as leave room for their words
            each, size = [], 0
            while at + len(each) < len(texts) and (not each or size < CACHED_WORDS // 4):
                each.append(words(texts[at + len(each)]))
                size += len(each[-1])
            self._fill(each, out[at:at + len(each)])
            at += len(each)
        return out

    def _fill(self, each: list[list[bytes]], out: np.ndarray) -> None:
        if sum(map(len, each)) > CACHED_WORDS:  # one very long text: in parts, whose words count alike
            parts = [ws[k:k + CACHED_WORDS // 2] for ws in each for k in range(0, len(ws), CACHED_WORDS // 2)]
            ratio = np.concatenate([self.log_ratio([p])[0] for p in parts])
            n = np.array([len(ws) for ws in each], np.int64)
        else:
            ratio, n = self.log_ratio(each)
        for i, (m, e) in enumerate(zip(n, np.cumsum(n), strict=True)):
            if m:
                total = np.concatenate([[0.0], np.cumsum(ratio[e - m:e], dtype=float)])
                out[i, 1] = total[-1] / m
                for k, w in enumerate(STRETCHES):
                    w = min(w, m)
                    out[i, 2 + k] = (total[w:] - total[:-w]).max() / w

    def score(self, texts: list[str | None]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.model.weights, -50, 50)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge * len(y) * np.eye(len(w)) * 0.01,
                               x.T @ (y - p) - ridge * len(y) * 0.01 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(labels: DataFrame, label: str, usable, size: int = SAMPLE) -> DataFrame:
    """(id, y): at most ``size`` labelled ids, those of least hash; conflicting labels count as
    the larger one, null labels and ids not at all."""
    one = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & usable)
           .groupBy("doc_id").agg(F.max(label).cast("int").alias("y")))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size).select(F.col("doc_id").alias("id"), "y")


def fit(docs: DataFrame, labels: DataFrame, usable, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Model from at most ``sample`` labelled documents; ``usable`` says which ids of ``labels``
    may be learnt from. None when a class has no word."""
    spark = docs.sparkSession
    arrow_batches(spark)
    picked = F.broadcast(labelled_sample(labels, "toxic", usable, sample))  # at most ``sample`` pairs of numbers
    half = F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)) == 0
    texts = saved(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(picked, "id")
                  .select("text", "y", half.alias("counted")), "toxic-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct (class, expression, word before it) of a batch, and with class -1 the chains of its words."""
        for b in batches:
            known: dict[bytes, int] = {}
            chains, seen = [], [set(), set()]
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ws = words(t)
                for w in set(ws).difference(known):
                    known[w] = len(chains)
                    chains.append(chain(w))
                x = [known[w] for w in ws]
                seen[y].update(zip([-1, *x], x))
            got = np.array([*chains, [0] * (len(PREFIXES) + 1)], np.uint64)
            word = np.unique(got[:-1], axis=0).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(word), -1, np.int32)), pa.array(word[:, -1]), pa.array(word.tolist(), CHAIN), pa.nulls(len(word), pa.int64())], COUNTED)
            for y, pairs in enumerate(seen):
                at = np.array(sorted(pairs), np.int64).reshape(-1, 2)
                before = got[at[:, 0], -1].view(np.int64)
                for k in range(len(PREFIXES) + 1):  # an expression of several orders counts once
                    mine = np.ones(len(at), bool) if k == len(PREFIXES) else got[at[:, 1], k] != got[at[:, 1], -1]
                    key = np.unique(np.stack([got[at[mine, 1], k].view(np.int64), before[mine]], axis=1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), y, np.int32)), pa.array(key[:, 0]), pa.nulls(len(key), CHAIN), pa.array(key[:, 1])], COUNTED)

    each = saved(texts.filter("counted").select("text", "y").mapInArrow(count, "y int, key bigint, chain array<bigint>, before bigint"), "toxic-counts")
    one = [F.sum(F.when(F.col("y") == y, 1).otherwise(0)).alias(f"n{y}") for y in (0, 1)]
    got = each.filter("y >= 0").select("y", "key", "before").distinct().groupBy("key").agg(*one).toArrow()  # expressions of the sample
    chains = each.filter("y < 0").groupBy("key").agg(F.first("chain").alias("chain")).select("chain").toArrow()["chain"].combine_chunks()
    counts = np.stack([got[f"n{y}"].to_numpy() for y in (0, 1)])
    if not counts.any(axis=1).all():
        return None
    keys = got["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    model = Model(np.asarray(chains.flatten()).view(np.uint64).reshape(len(chains), -1), keys[order], counts[:, order])
    shared = spark.sparkContext.broadcast(model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            x = scorer.features(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64())), b.column(1)], ["x", "y"])

    got = texts.filter("NOT counted").select("text", "y").mapInArrow(features, "x array<double>, y int").toArrow()
    y = got["y"].to_numpy().astype(float)
    if len(y):
        # an empty text is no sign of toxicity: one such row keeps the curve low at zero ratios
        model.weights = logistic(np.array([*got["x"].to_pylist(), [1.0] + [0.0] * (1 + len(STRETCHES))]), np.append(y, 0.0))
    return model


def with_score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, score): every row of ``docs`` whole in the struct ``row``, so that no column name can clash.

    Texts are scored whole; null and empty ones, and all when there is no model, get the score
    of a text without words (0 without a model). Repeated rows are each scored, null ids kept.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    own = docs.select(F.col(id_col).alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))
    if model is None:
        return own.select("id", "row", F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)  # the sample's expressions: 16 bytes each and order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scorer.score(b.column(2).to_pylist()))],
                                             ["id", "row", "score"])

    schema = own.select("id", "row").schema.add("score", "double")
    return own.mapInArrow(run, schema)
