"""URL filter: host and path rules first, then a ratio of character language models.

The pages that a rule decides teach two variable-order Markov models, one of accepted and one
of rejected URLs (Witten-Bell smoothing from order ``ORDER`` down to single characters; an
unseen context falls to the next shorter one). A page without a rule is accepted when the
difference of the two log-likelihoods per character reaches a threshold, calibrated on the
rule-decided pages that were held back from counting. Counts are gathered in Spark into tables
of a fixed number of hash slots, so the model's size does not depend on the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docket.llm.common import arrow_batches, held_out, lower_ascii

ORDER = 5               # characters of context at most
EVENT_SLOTS = 1 << 20   # (context, character) counts of each model
CONTEXT_SLOTS = 1 << 18
ALPHABET = 256          # the uniform model below the single characters
BINS = 4000             # calibration histogram over -20 to 20 nats per character
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def host_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(u, pattern, 1)), F.regexp_extract(u, pattern, 2)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def places(urls: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every character and end of the URLs: the URL's number, and by order (rows) the slots
    of its context and of the context with it."""
    texts = [(u or "").partition("://")[2] or u or "" for u in urls]
    size = np.array([len(t) + 1 for t in texts])
    x = np.full(int((size + ORDER).sum()), 2, np.uint64)  # so many begin marks before each
    first = np.cumsum(size + ORDER) - size
    for t, a in zip(texts, first, strict=True):
        x[a:a + len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4")
        x[a + len(t)] = 3
    of = np.repeat(np.arange(len(texts)), size)
    at = np.arange(len(of)) + np.repeat(first - (np.cumsum(size) - size), size)
    h = np.zeros(len(of), np.uint64)
    contexts, events = [], []
    for k in range(ORDER + 1):
        if k:
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + x[at - k] + np.uint64(1))
        contexts.append(_mix(h + np.uint64(k)) % np.uint64(CONTEXT_SLOTS))
        events.append(_mix(h + np.uint64(k) + (x[at] << np.uint64(32)) + (x[at] << np.uint64(7))) % np.uint64(EVENT_SLOTS))
    return of, np.array(contexts, np.int64).reshape(ORDER + 1, -1), np.array(events, np.int64).reshape(ORDER + 1, -1)


class Model:
    """Counts of the rejected (0) and accepted (1) URLs by slot."""

    def __init__(self, events: np.ndarray, totals: np.ndarray, kinds: np.ndarray):
        self.events, self.totals, self.kinds = events, totals, kinds

    def ratio(self, urls: list[str | None]) -> np.ndarray:
        """Accepted minus rejected log-likelihood per character (the end counts as one)."""
        of, contexts, events = places(urls)
        log = []
        for c in (0, 1):
            p = np.full(len(of), 1 / ALPHABET)
            for ctx, ev in zip(contexts, events, strict=True):
                n, t = self.totals[c][ctx], self.kinds[c][ctx]
                p = np.where(n > 0, (self.events[c][ev] + t * p) / np.maximum(n + t, 1), p)
            log.append(np.log(np.maximum(p, 1e-300)))
        return np.bincount(of, log[1] - log[0], len(urls)) / np.bincount(of, minlength=len(urls))


def _collect(counts: DataFrame, slots: int, value: str) -> np.ndarray:
    out = np.zeros((2, slots), np.float32)
    got = counts.toArrow()  # at most two rows a slot
    out[got["cls"].to_numpy(), got["slot"].to_numpy()] = got[value].to_numpy()
    return out


def train(known: DataFrame) -> Model | None:
    """Model of ``known`` (url, cls 0 or 1); None when a class has no URL."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of, contexts, events = places(b.column(0).to_pylist())
            cls = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)[of]
            key = ((cls[None] * CONTEXT_SLOTS + contexts) * EVENT_SLOTS + events).ravel()
            key, n = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "n"])

    pairs = known.select("url", F.col("cls").cast("int")).mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    slot = F.col("key") % EVENT_SLOTS
    context = F.expr(f"(key div {EVENT_SLOTS}) % {CONTEXT_SLOTS}")
    cls = F.expr(f"key div {EVENT_SLOTS * CONTEXT_SLOTS}").cast("int")
    pairs = pairs.select(slot.alias("event"), context.alias("context"), cls.alias("cls"), "n").persist()
    events = _collect(pairs.groupBy("cls", F.col("event").alias("slot")).agg(F.sum("n").alias("n")), EVENT_SLOTS, "n")
    by = pairs.groupBy("cls", F.col("context").alias("slot")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).persist()
    model = Model(events, _collect(by, CONTEXT_SLOTS, "n"), _collect(by, CONTEXT_SLOTS, "kinds"))
    by.unpersist()
    pairs.unpersist()
    return model if model.totals.any(axis=1).all() else None


def ratios(pages: DataFrame, model) -> DataFrame:
    """``pages`` (row, url) with its ratio by the broadcast model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            r = model.value.ratio(b.column(1).to_pylist()) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(r)], [*b.schema.names, "ratio"])


    return pages.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pages.schema) + ", ratio double")


def threshold(scored: DataFrame) -> float:
    """The ratio that best parts ``scored`` (ratio, cls): least sum of both error rates; of equal
    ones the middle of the first range. From a histogram of ``BINS`` bins, so that any number of pages will do."""
    bin_ = F.floor((F.greatest(F.lit(-20.0), F.least(F.lit(19.99), F.col("ratio"))) + 20) * (BINS / 40))
    got = scored.groupBy(bin_.cast("int").alias("bin"), "cls").agg(F.count(F.lit(1)).alias("n")).toArrow()
    hist = np.zeros((2, BINS))
    hist[got["cls"].to_numpy(), got["bin"].to_numpy()] = got["n"].to_numpy()
    rate = hist / np.maximum(hist.sum(axis=1, keepdims=True), 1)
    # blocking below bin b loses accepted pages below it and lets rejected ones at or above it through
    below = np.concatenate([[[0.0], [0.0]], np.cumsum(rate, axis=1)], axis=1)
    wrong = below[1] + (1 - below[0])
    best = np.flatnonzero(wrong <= wrong.min() + 1e-12)
    run = best[: np.flatnonzero(np.diff(best, append=best[-1] + 2) > 1)[0] + 1]
    return float((run[0] + run[-1]) / 2 * (40 / BINS) - 20)


def filter_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, ratio.

    A null URL, or one without ``://``, has an empty host and path and so no rule; the models
    judge its text (null: empty). Repeated rows are each judged, a null id is kept, other columns
    are not read, very long URLs count whole. Where the rules leave one class without a page,
    nothing can be learnt and pages without a rule are allowed (ratio 0). A ratio equal to the
    threshold is accepted.
    """
    spark: SparkSession = pages.sparkSession
    arrow_batches(spark)
    host, path = host_path(F.col("url"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    own = (pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).withColumns({"host": host, "path": path})
           .withColumns({"rule": rule, "given": verdict}))
    known = own.filter(F.col("given").isNotNull()).select("id", "url", (F.col("given") == "allow").cast("int").alias("cls"))
    back = held_out(F.col("id"), 5, 0)
    model = train(known.filter(~back).select("url", "cls"))
    if model is None:
        out = own.withColumn("ratio", F.lit(0.0))
        cut = 0.0
    else:
        shared = spark.sparkContext.broadcast(model)  # fixed slots: 12 MB, whatever the data
        cut = threshold(ratios(known.filter(back).select("id", "url", "cls"), shared))
        out = ratios(own, shared)
    verdict = F.coalesce("given", F.when(F.col("ratio") >= cut, "allow").otherwise("block"))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "ratio")
