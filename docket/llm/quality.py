"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Each passage is encoded from how its
characters follow one another (frequencies of pairs of character classes) and how its words
repeat; a gated attention layer, learnt from document labels alone, weighs the passages, and a
logistic layer scores the weighted mean of their representations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docket.llm.common import SPACE, arrow_batches, saved
from docket.llm.toxicity import labelled_sample

SAMPLE = 6_000             # labelled documents used for the fit, at most, each with all its passages
SAMPLE_PASSAGES = 100_000  # passages of all of them together, at most: 100 MB on the driver
PASSAGE = 64               # words
HIDDEN, GATES = 32, 16
CLASSES = 16
FEATURES = CLASSES * CLASSES + 4


def _byte_classes() -> np.ndarray:
    """Class of each UTF-8 byte: white space, lower, upper, digit, eight marks apart, others."""
    out = np.full(256, 13, np.int64)  # other marks and controls
    for b in SPACE.encode():
        out[b] = 0
    out[10] = 15
    for first, last, k in ((97, 122, 1), (65, 90, 2), (48, 57, 3), (128, 191, 14), (192, 255, 1)):
        out[first:last + 1] = k
    for k, marks in enumerate((b".", b",", b"!", b"|", b"#$%&*", b"-_", b"'\"", b":;?", b"()[]{}<>")):
        for b in marks:
            out[b] = 4 + k
    return out


BYTE_CLASS = _byte_classes()


def encode(text: str | None) -> np.ndarray:
    """A row of ``FEATURES`` numbers for each passage of the text; a text without words is one passage of zeros."""
    data = (text or "").encode("utf-8", "surrogatepass")
    each = data.split()
    if not each:
        return np.zeros((1, FEATURES), np.float32)
    kind = BYTE_CLASS[np.frombuffer(data, np.uint8)]
    gap = (kind == 0) | (kind == 15)
    begins = ~gap
    begins[1:] &= gap[:-1]
    passage = np.maximum(np.cumsum(begins) - 1, 0) // PASSAGE
    n = int(passage[-1]) + 1
    pairs = np.bincount(passage[1:] * (CLASSES * CLASSES) + kind[:-1] * CLASSES + kind[1:], minlength=n * CLASSES * CLASSES)
    pairs = pairs.reshape(n, -1).astype(np.float32)
    size = np.maximum(pairs.sum(axis=1, keepdims=True), 1)
    lines = [x for x in data.split(b"\n") if x]
    repeated = 1 - len(set(lines)) / max(len(lines), 1)
    parts = [each[k * PASSAGE:(k + 1) * PASSAGE] for k in range(n)]
    more = np.array([[len(set(p)) / len(p), sum(map(len, p)) / len(p) / 10, len(p) / PASSAGE, repeated] for p in parts], np.float32)
    return np.hstack([np.sqrt(pairs / size), more])


class Model:
    """h = tanh(W x); a = softmax over passages of w . (tanh(V h) * sigmoid(U h)); score = sigmoid(c . sum a h + d)."""

    def __init__(self, rng: np.random.Generator):
        draw = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
        self.p = {"W": draw(FEATURES, HIDDEN), "B": np.zeros(HIDDEN), "V": draw(HIDDEN, GATES), "U": draw(HIDDEN, GATES),
                  "w": draw(GATES), "c": draw(HIDDEN), "d": np.zeros(1)}
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)

    def forward(self, x: np.ndarray, starts: np.ndarray):
        """x: passages of all documents in turn; starts: each document's first passage."""
        p, n = self.p, np.diff(starts, append=len(x))
        h = np.tanh(x @ p["W"] + p["B"])
        v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-h @ p["U"]))
        e = (v * u) @ p["w"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), n))
        a = e / np.repeat(np.add.reduceat(e, starts), n)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        s = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))
        return h, v, u, a, z, s, n

    def gradient(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict:
        p = self.p
        h, v, u, a, z, s, n = self.forward(x, starts)
        ds = (s - y) / len(y)
        dz = ds[:, None] * p["c"]
        dzr = np.repeat(dz, n, axis=0)
        da = (dzr * h).sum(axis=1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), n))
        dv, du = de[:, None] * p["w"] * u * (1 - v * v), de[:, None] * p["w"] * v * u * (1 - u)
        dh = (a[:, None] * dzr + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
        return {"W": x.T @ dh, "B": dh.sum(axis=0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ de, "c": z.T @ ds, "d": np.array([ds.sum()])}

    def train(self, bags: list[np.ndarray], y: np.ndarray, rng: np.random.Generator, epochs: int = 30, batch: int = 64, rate: float = 3e-3):
        """Adam over batches of documents."""
        x = np.concatenate(bags)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 0.02
        bags = [((b - self.mean) / self.scale).astype(np.float32) for b in bags]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        q, t = {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        for epoch in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), batch):
                pick = order[at:at + batch]
                sizes = np.array([len(bags[i]) for i in pick])
                g, t = self.gradient(np.concatenate([bags[i] for i in pick]), np.cumsum(sizes) - sizes, y[pick]), t + 1
                for k in self.p:
                    d = g[k] + 1e-4 * self.p[k]
                    m[k], q[k] = 0.9 * m[k] + 0.1 * d, 0.999 * q[k] + 0.001 * d * d
                    self.p[k] -= rate * (1 - epoch / epochs) * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(q[k] / (1 - 0.999 ** t)) + 1e-8)

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Score of each text, and the number of its passages."""
        if not texts:
            return np.zeros(0), np.zeros(0, np.int64)
        bags = [encode(t) for t in texts]
        n = np.array([len(b) for b in bags])
        x = ((np.concatenate(bags) - self.mean) / self.scale).astype(np.float32)
        return self.forward(x, np.cumsum(n) - n)[5], n


def beyond(sizes: list[int], most: int) -> list[int]:
    """Places of the sizes that, taken in turn, do not fit into ``most`` beside those before them that do."""
    total, out = 0, []
    for k, n in enumerate(sizes):
        if total + n > most:
            out.append(k)
        else:
            total += n
    return out


def fit(docs: DataFrame, labels: DataFrame, usable, sample: int = SAMPLE, seed: int = 7, id_col: str = "doc_id",
        text_col: str = "text") -> Model | None:
    """Model from at most ``sample`` labelled documents with all their passages; ``usable`` says which
    ids of ``labels`` may be learnt from. A document that would take the passages of the sample, in
    the order of the ids' hashes, beyond ``SAMPLE_PASSAGES`` is left out whole, which bounds what the
    driver trains on. Rows that repeat an id are learnt from each. None without two classes."""
    arrow_batches(docs.sparkSession)
    picked = F.broadcast(labelled_sample(labels, "quality", usable, sample))  # at most ``sample`` pairs of numbers
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(picked, "id").select("id", "text", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([len(k) for k in x], pa.int64()),
                                              pa.array([k.astype("<f2").tobytes() for k in x], pa.binary())], ["id", "y", "n", "x"])

    kind = texts.schema["id"].dataType.simpleString()
    encoded = saved(texts.mapInArrow(run, f"id {kind}, y int, n bigint, x binary").withColumn("place", F.xxhash64("id")), "passages")
    sizes = encoded.groupBy("place").agg(F.sum("n").alias("n")).toArrow().sort_by("place")  # at most ``sample`` rows
    over = beyond(sizes["n"].to_pylist(), SAMPLE_PASSAGES)
    left_out = [sizes["place"][k].as_py() for k in over]
    got = encoded.filter(~F.col("place").isin(left_out)).select("id", "y", "x").toArrow().sort_by("id")
    y = got["y"].to_numpy().astype(float)
    if len(set(y)) < 2:
        return None
    bags = [np.frombuffer(b, "<f2").reshape(-1, FEATURES).astype(np.float32) for b in got["x"].to_pylist()]
    rng = np.random.default_rng(seed)
    model = Model(rng)
    model.train(bags, y, rng)
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, n_passages) for every row, by its whole text.

    Null and empty texts are one empty passage; without a model (one class only) every score is
    1, which rejects nothing. Repeated rows are each scored, null ids kept, other columns not read.
    """
    spark = docs.sparkSession
    arrow_batches(spark)
    own = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("text"))
    if model is None:
        return own.select(id_col, F.lit(1.0).alias("score"), F.lit(0).cast("long").alias("n_passages"))
    shared = spark.sparkContext.broadcast(model)  # some 10,000 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, n = shared.value.score(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s.astype(float)), pa.array(n.astype(np.int64))], [id_col, "score", "n_passages"])

    return own.mapInArrow(run, own.select(id_col).schema.add("score", "double").add("n_passages", "long"))
