"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations.

Vectors that are equal (with one label) are one class and hashed once. A vector is rotated by
three rounds of random signs and a fast Hadamard transform; the nearest vertex of the
cross-polytope (the largest coordinate and its sign) of a few such rotations is its bucket in a
table. It also probes the buckets it came closest to. Pairs that meet in a bucket are compared
once, by cosine in double precision.

The more vectors a label has, the more rotations make a bucket, so that a bucket holds about one
unrelated vector at any size; tables and probes then grow so that a pair at the threshold is
missed as seldom: about 1e-5 at cosine 0.93, by the share of such pairs that one table finds
(``FOUND``, simulated in 64 to 2,048 dimensions). Longer vectors get more tables for that.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docket.llm.common import arrow_batches, saved
from docket.llm.components import components

THRESHOLD = 0.93
NEAR = 3  # vertices of a rotation that probes may use
MISS = 1e-5
PLANS = {1: (5, 3), 2: (8, 6), 3: (11, 12), 4: (14, 24)}  # rotations to a bucket: tables (up to 64 dimensions), probes in each
# share of pairs at the threshold that a table finds in 64 dimensions, its factor for each doubling
FOUND = {1: (0.92, 0.965), 2: (0.77, 0.935), 3: (0.65, 0.89), 4: (0.56, 0.85)}


def padded(dim: int) -> int:
    return 1 << max(1, (dim - 1).bit_length())


def rotations(most: int, dim: int) -> int:
    """Fewest rotations with as many buckets as the largest label has vectors."""
    return next((k for k in sorted(PLANS) if (2 * padded(dim)) ** k >= most), max(PLANS))


def tables_for(functions: int, dim: int) -> int:
    """Tables that together miss a pair at the threshold as seldom as ``MISS``."""
    found, factor = FOUND[functions]
    doublings = padded(dim).bit_length() - 7
    if doublings <= 0:
        return PLANS[functions][0]
    return math.ceil(math.log(MISS) / math.log(1 - found * factor ** doublings))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, whose length is a power of two; orthonormal."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def buckets(x: np.ndarray, functions: int = 2, seed: int = 0) -> np.ndarray:
    """(rows, tables, probes) bucket numbers, the row's own first, then the next best."""
    n, dim = x.shape
    d, tables, probes = padded(dim), tables_for(functions, dim), PLANS[functions][1]
    x = np.pad(x / np.linalg.norm(x, axis=1, keepdims=True), ((0, 0), (0, d - dim)))
    rng = np.random.default_rng((seed, dim))
    out = np.empty((n, tables, probes), np.int64)
    near = min(NEAR, d)
    ways = np.array(list(product(range(near), repeat=functions)))
    for t in range(tables):
        loss, code = np.zeros((n, len(ways))), np.zeros((n, len(ways)), np.int64)
        for f in range(functions):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], d))
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :near]
            size = np.abs(np.take_along_axis(y, top, 1))
            vertex = 2 * top + (np.take_along_axis(y, top, 1) < 0)
            loss += ((size[:, :1] - size) ** 2)[:, ways[:, f]]
            code = code * (2 * d) + vertex[:, ways[:, f]]
        order = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        got = np.take_along_axis(code, order, 1)
        out[:, t] = np.pad(got, ((0, 0), (0, probes - got.shape[1])), mode="edge")
    return out


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept.

    Only vectors of one label and length are compared. Rows with a null label, and vectors that are
    null, empty, zero or hold a null or non-finite number, link with nothing and are their own
    component. A row with a null id is a vector like others: it counts among its neighbours' links
    and has the least id of its component (null where all are). A repeated row is another vector of
    the same id. Other columns are not read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    arrow_batches(spark, 4096)
    own = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = (F.col("label").isNotNull() & (F.size("v") > 0) & F.exists("v", lambda x: x != 0)
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    own = own.withColumn("v", F.when(fine, F.col("v")))
    # classes have numbers of their own, as ids may be null
    found = own.filter("v IS NOT NULL").groupBy("label", "v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("size"))
    classes, kind = saved(found.withColumn("id", F.monotonically_increasing_id()), "vectors"), "bigint"
    most = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vs = b.column(1).to_pylist()
            length, out, probes = np.array([len(v) for v in vs], np.int64), [None] * len(vs), np.zeros(len(vs), np.int32)
            for n in np.unique(length):
                at, k = np.flatnonzero(length == n), rotations(most, int(n))
                probes[at] = PLANS[k][1]
                for i, row in zip(at, buckets(np.array([vs[i] for i in at], float), k).reshape(len(at), -1), strict=True):
                    out[i] = row
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(probes), pa.array(out, pa.list_(pa.int64()))], ["id", "probes", "b"])

    # a place in the list of buckets says the table and, if not the first of its table, that it is a probe
    codes = saved(classes.select("id", "v").mapInArrow(hashed, f"id {kind}, probes int, b array<bigint>"), "buckets")
    place = codes.join(classes.select("id", "label", F.size("v").alias("d")), "id").select("id", "label", "d", "probes", F.posexplode("b").alias("pos", "b"))
    place = saved(place.select("id", "label", "d", F.expr("pos div probes").alias("t"), (F.col("pos") % F.col("probes")).alias("probe"), "b"), "places")
    key = ["label", "d", "t", "b"]
    base = place.filter("probe = 0").select(*key, F.col("id").alias("x"))
    pairs = (place.select(*key, F.col("id").alias("y")).join(base, key).filter("x <> y")
             .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    sides = [classes.select(F.col("id").alias(k), F.col("v").alias(f"v_{k}"), F.col("size").alias(f"size_{k}")) for k in "ab"]

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keep = cosines(b.column(4), b.column(5)) >= threshold
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in b.columns[:4]], b.schema.names[:4])

    links = saved(pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "size_a", "size_b", "v_a", "v_b")
                  .mapInArrow(close, f"a {kind}, b {kind}, size_a bigint, size_b bigint"), "links")
    others = links.select(F.col("a").alias("rep"), F.col("size_b").alias("n")).unionByName(links.select(F.col("b").alias("rep"), F.col("size_a").alias("n")))
    others = others.groupBy("rep").agg(F.sum("n").alias("others"))
    joined = saved(components(links.select("a", "b")).join(classes.select("id", "least"), "id"), "components")
    ends = joined.groupBy("component").agg(F.min("least").alias("end"))
    linked = joined.join(ends, "component").join(others, joined["id"] == others["rep"]).select("id", "end", "others")
    hit = classes.join(linked, "id", "left").filter("size > 1 OR others IS NOT NULL")
    hit = hit.select("label", "v", "size", "others", F.coalesce("end", "least").alias("end"), F.lit(True).alias("hit"))
    out = own.join(hit, ["label", "v"], "left")
    component = F.when(F.col("hit"), F.col("end")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), (F.coalesce("size", F.lit(1)) - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def cosines(a: pa.ListArray, b: pa.ListArray) -> np.ndarray:
    """Cosine in double precision of each pair of vectors, which are of one length."""
    first, out = np.asarray(a.offsets), np.empty(len(a))
    x, y, other = np.asarray(a.values, float), np.asarray(b.values, float), np.asarray(b.offsets)
    size = np.diff(first)
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        v, w = (z[o[at][:, None] + np.arange(d)] for z, o in ((x, first), (y, other)))
        # scaled first, so that very large or small numbers neither overflow nor vanish
        v, w = (z / np.abs(z).max(axis=1, keepdims=True) for z in (v, w))
        out[at] = (v * w).sum(axis=1) / np.sqrt((v * v).sum(axis=1) * (w * w).sum(axis=1))
    return out


ORACLE_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), f AS (
  SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL AND len([x for x in e if x IS NULL OR NOT isfinite(x)]) = 0
  AND len([x for x in e if x <> 0]) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM f a JOIN f b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), r AS (
  SELECT vec_id AS id, vec_id AS c FROM v UNION SELECT r.id, l.b FROM r JOIN l ON r.c = l.a
)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links, m.c AS component_id, v.vec_id = m.c AS kept
FROM v JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON m.id = v.vec_id
"""
