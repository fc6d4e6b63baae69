"""Soft-membership mixing: rates for documents whose expected domain tokens match targets.

A softmax classifier, fitted on the labelled table, gives every document posteriors over the
domains. Nonnegative rates r minimise the squared relative errors of the domains' expected
token totals, sum_k ((sum_d n_d p_dk r_d - T_k) / S_k)^2, by projected gradient steps from
r = 1: each step needs one number per domain, which one distributed aggregation over narrow
rows gives, and a document's rate follows from its own posteriors and those few numbers. Where
poorly separated posteriors make these steps slow, Newton steps follow, which need a number for
each pair of domains, until the targets are met or nothing improves; what is missed is logged.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docket.llm.common import saved, slices, words
from docket.llm.quality import BYTE_CLASS, CLASSES
from docket.llm.toxicity import labelled_sample

SAMPLE = 6_000               # labelled documents used for the classifier, at most
WORD_FEATURES = 1 << 13
SHAPES = CLASSES * CLASSES
FEATURES = WORD_FEATURES + SHAPES
STEPS, CLOSE = 40, 1e-4      # gradient steps before Newton steps; relative error that ends both
CACHED_WORDS = 500_000
# production parameters: domains by the label ``quality``, their shares, tokens asked for per token there is
DOMAINS = {"good": 1, "poor": 0}
TARGETS = {"good": 0.95, "poor": 0.05}
VOLUME = 1.25


class Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = s = xxhash.xxh64_intdigest(word) % WORD_FEATURES
        return s


def features(text: str | None, buckets: Buckets) -> tuple[np.ndarray, np.ndarray, int]:
    """Numbers and values of a text's features (hashed words, character class pairs), and its count of words."""
    ws = words(text)
    if not ws:
        return np.zeros(0, np.int64), np.zeros(0, np.float32), 0
    w, n = np.unique(np.fromiter(map(buckets.__getitem__, ws), np.int64, len(ws)), return_counts=True)
    kind = BYTE_CLASS[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    pair = np.bincount(kind[:-1] * CLASSES + kind[1:], minlength=SHAPES)
    at = np.flatnonzero(pair)
    value = np.log1p(n)
    return (np.concatenate([w, WORD_FEATURES + at]),
            np.concatenate([value / np.linalg.norm(value), 3 * np.sqrt(pair[at] / max(len(kind) - 1, 1))]).astype(np.float32), len(ws))


class Classifier:
    """Softmax regression on sparse rows."""

    def __init__(self, k: int):
        self.w, self.b = np.zeros((FEATURES, k)), np.zeros(k)

    def posteriors(self, idx: np.ndarray, val: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Rows of posteriors; a row without features gets those of the constant alone."""
        z = np.tile(self.b, (len(size), 1))
        some = size > 0
        if some.any():
            starts = (np.cumsum(size) - size)[some]
            z[some] += np.add.reduceat(val[:, None] * self.w[idx], starts, axis=0)
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def train(self, idx, val, size, y, steps: int = 120, rate: float = 0.1, ridge: float = 1e-5):
        """Full-batch Adam."""
        one, k = np.eye(self.w.shape[1])[y], self.w.shape[1]
        row = np.repeat(np.arange(len(size)), size)
        state = [np.zeros_like(x) for x in (self.w, self.w, self.b, self.b)]
        for t in range(1, steps + 1):
            d = (self.posteriors(idx, val, size) - one) / len(y)
            gw = np.stack([np.bincount(idx, val * d[row, j], FEATURES) for j in range(k)], axis=1) + ridge * self.w
            for j, (x, g) in enumerate(((self.w, gw), (self.b, d.sum(axis=0)))):
                state[2 * j] = 0.9 * state[2 * j] + 0.1 * g
                state[2 * j + 1] = 0.999 * state[2 * j + 1] + 0.001 * g * g
                x -= rate * (1 - t / (steps + 1)) * (state[2 * j] / (1 - 0.9 ** t)) / (np.sqrt(state[2 * j + 1] / (1 - 0.999 ** t)) + 1e-8)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", domains: dict = DOMAINS, sample: int = SAMPLE,
        id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """Classifier from at most ``sample`` labelled documents. Without labelled documents every
    posterior is uniform."""
    picked = F.broadcast(labelled_sample(labels, label, F.col(label).isin(list(domains.values())), sample))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(picked, "id").select("id", "text", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for b in slices(batches):
            f = [features(t, buckets) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([x[0].astype("<u2").tobytes() for x in f], pa.binary()),
                 pa.array([x[1].astype("<f4").tobytes() for x in f], pa.binary())], ["id", "y", "idx", "val"])

    kind = texts.schema["id"].dataType.simpleString()
    got = texts.mapInArrow(run, f"id {kind}, y int, idx binary, val binary").toArrow().sort_by("id")
    out = Classifier(len(domains))
    if got.num_rows:
        each = [np.frombuffer(x, "<u2").astype(np.int64) for x in got["idx"].to_pylist()]
        val = np.concatenate([np.frombuffer(x, "<f4") for x in got["val"].to_pylist()])
        place = {v: i for i, v in enumerate(domains.values())}
        out.train(np.concatenate(each), val, np.array([len(x) for x in each]), np.array([place[v] for v in got["y"].to_pylist()]))
    return out


def with_posteriors(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, n, p, draw): the whole row in a struct, its words, its posteriors, a hash of id and text."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(classifier)  # FEATURES x domains numbers
    own = docs.select(F.col(id_col).alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"),
                      F.xxhash64(id_col, text_col).alias("draw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for b in slices(batches):
            f = [features(t, buckets) for t in b.column(2).to_pylist()]
            p = shared.value.posteriors(np.concatenate([x[0] for x in f] or [np.zeros(0, np.int64)]),
                                        np.concatenate([x[1] for x in f] or [np.zeros(0)]), np.array([len(x[0]) for x in f], np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x[2] for x in f], pa.int64()),
                                              pa.array(p.tolist(), pa.list_(pa.float64())), b.column(3)], ["id", "row", "n", "p", "draw"])

    schema = own.select("id", "row").schema.add("n", "long").add("p", T.ArrayType(T.DoubleType())).add("draw", "long")
    return own.mapInArrow(run, schema)


def rate(p: Column, steps: list[list[float]]) -> Column:
    """A document's rate after these gradient steps."""
    if not steps:
        return F.lit(1.0)
    moves = F.array(*[F.array(*[F.lit(float(x)) for x in g]) for g in steps])
    return F.aggregate(moves, F.lit(1.0), lambda r, g: F.greatest(F.lit(0.0), r - F.aggregate(
        F.zip_with(p, g, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)))


def fit_rates(table: DataFrame, targets: dict = TARGETS, volume: float = VOLUME) -> list[list[float]]:
    """Gradient steps for ``table`` (n, p): one list of a number per domain for each step.

    With S_k the tokens domain k has at rate 1, the step is p_d . g with g_k = (A_k - T_k) / S_k,
    A_k being the expected tokens so far; its matrix has no eigenvalue above 1, so the steps
    converge. A domain without tokens is left out (no rate can reach its target). After ``STEPS`` of
    them come Newton steps, halved while they do not help; they end when the largest relative error
    is under ``CLOSE`` or no step lowers the squared error by a hundredth (targets out of reach).
    """
    names = list(targets)
    steps: list[list[float]] = []
    start = None
    for _ in range(STEPS):
        r = rate(F.col("p"), steps)
        got = table.agg(*[F.sum(F.col("n") * F.col("p")[k] * r).alias(f"s{k}") for k in range(len(names))]).first()
        now = np.array([x or 0.0 for x in got])
        if start is None:
            start, total = now, now.sum()
            aim = np.array([targets[x] for x in names])
            aim = volume * total * aim / aim.sum()
        g = np.where(start > 0, (now - aim) / np.maximum(start, 1e-9), 0.0)
        if np.abs(g).max() < CLOSE:
            return steps
        steps.append(g.tolist())
    return _newton(table, steps, start, aim)


def _newton(table: DataFrame, steps: list[list[float]], start: np.ndarray, aim: np.ndarray) -> list[list[float]]:
    k = len(aim)

    def state(steps):
        """Relative errors, and how the totals answer to a step."""
        p, r = F.col("p"), F.col("r")
        live = F.when(r > 0, F.col("n")).otherwise(0)
        got = table.withColumn("r", rate(p, steps)).agg(
            *[F.sum(F.col("n") * p[i] * r) for i in range(k)], *[F.sum(live * p[i] * p[j]) for i in range(k) for j in range(k)]).first()
        x = np.array([v or 0.0 for v in got])
        some = (start > 0) / np.maximum(start, 1e-9)
        return (x[:k] - aim) * some, x[k:].reshape(k, k) * some[:, None]

    (error, answer), size = state(steps), 1.0
    while np.abs(error).max() >= CLOSE and size > 1 / 64:
        move = np.linalg.lstsq(answer, error, rcond=1e-9)[0]
        if ((error - answer @ move) ** 2).sum() > 0.99 * (error ** 2).sum():
            break
        longer = [*steps, (size * move).tolist()]
        then, other = state(longer)
        if (then ** 2).sum() < 0.99 * (error ** 2).sum():
            steps, error, answer, size = longer, then, other, 1.0
        else:
            size /= 2
    if np.abs(error).max() >= CLOSE:
        logging.getLogger(__name__).warning("rates miss their targets: relative errors %s", error.tolist())
    return steps


def copies(draw: Column, r: Column) -> Column:
    """The rate as a whole number of copies whose mean is the rate; the fraction is drawn by the hash of ``draw``."""
    u = F.pmod(F.xxhash64(draw, F.lit("copies")), F.lit(1 << 30).cast("long")) / float(1 << 30)
    return (F.floor(r) + (u < r - F.floor(r)).cast("long")).cast("long")


def mix(docs: DataFrame, labels: DataFrame, targets: dict = TARGETS, volume: float = VOLUME, label: str = "quality",
        domains: dict = DOMAINS, id_col: str = "doc_id", text_col: str = "text", with_rows: bool = True) -> tuple[DataFrame, list[str]]:
    """(id, row, n, p, rate, copies) of every row, and the domains' names in the order of ``p``.

    The posteriors are written once, narrow, for the gradient steps. ``with_rows`` computes them
    again beside the whole rows, which costs a second pass but no shuffle of the texts; without it
    there is no ``row`` and the written ones are used.

    Null and empty texts have no words: they get a rate like any other and weigh nothing. Rows
    with a null id and repeated rows are mixed like others, each drawn by its id and text, so that only rows equal
    in both are drawn alike; column names of ``docs`` cannot
    clash, as its rows come whole in ``row``. An empty table gives no rows.
    """
    model = fit(docs, labels, label, domains, id_col=id_col, text_col=text_col)
    scored = with_posteriors(docs, model, id_col, text_col)
    narrow = saved(scored.select("id", "n", "p", "draw"), "mixing")
    steps = fit_rates(narrow, targets, volume)
    out = (scored if with_rows else narrow).withColumn("rate", rate(F.col("p"), steps))
    return out.withColumn("copies", copies(F.col("draw"), F.col("rate"))).drop("draw"), list(targets)
