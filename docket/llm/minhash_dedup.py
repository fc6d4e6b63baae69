"""MinHash near-dedup with sequential Bayesian verification.

Documents with one set of shingles are one class, and one of them stands for it. Bands of a
MinHash signature put representatives into buckets. Pairs of a bucket are judged by comparing a
compact signature (a byte for each hash) batch by batch: after each batch a pair is dropped once
the posterior probability that its similarity reaches the threshold is below ``MISS``. What
survives is confirmed on the full sets of words.

Not all pairs of a bucket are made. First every member is compared with its bucket's smallest
one, which joins a large group of near copies by as many pairs as it has members. Only buckets
that still hold several components then compare members across components, in blocks of bounded
size; pairs of one component cannot change the result, and of a document's links to one large
component any single one is enough.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docket.llm.common import only, saved, slices, without, words
from docket.llm.components import components

WIDTH = 5                     # words in a shingle
THRESHOLD = 75                # per cent
BANDS, ROWS = 50, 5           # a pair at the threshold meets in no band with probability 1.3e-6
HASHES = BANDS * ROWS
BATCH = 25                    # hashes compared at a time
MISS = 1e-6                   # posterior probability of reaching the threshold that drops a pair
BLOCK = 256                   # members of a large bucket compared with so many others at once
CACHED_WORDS = 500_000

_RNG = np.random.default_rng(20250)
_A = (_RNG.integers(1, 1 << 32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_C = _RNG.integers(1, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_hashes(text: str | None, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; of the whole sequence when it is shorter."""
    return _hashed(words(text), hashes)[0]


def _hashed(ws: list[bytes], hashes: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The shingles' sorted hashes, and where each first stands."""
    if not ws:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    x = np.fromiter(map(hashes.__getitem__, ws), np.uint64, len(ws))
    width = min(WIDTH, len(x))
    h = np.full(len(x) - width + 1, width, np.uint64)
    for k in range(width):
        h = h * _P + x[k:len(x) - width + 1 + k]
        h ^= h >> np.uint64(29)
    return np.unique(_mix(h), return_index=True)


def set_digest(ws: list[bytes], first: np.ndarray) -> bytes:
    """SHA-256 of the distinct shingles' words, in the order of their hashes: equal for equal sets only."""
    text, out = b" ".join(ws), hashlib.sha256()
    size = np.fromiter(map(len, ws), np.int64, len(ws))
    end = np.cumsum(size + 1) - 1
    for at in range(0, len(first), 10_000):
        some = first[at:at + 10_000]
        last = end[some + min(WIDTH, len(ws)) - 1]
        out.update(b"\n".join([text[a:b] for a, b in zip((end - size)[some].tolist(), last.tolist(), strict=True)]) + b"\n")
    return out.digest()


def signature(shingles: np.ndarray) -> np.ndarray:
    """``HASHES`` minima of 32-bit hashes."""
    x, best = (shingles >> np.uint64(32)).astype(np.uint32), np.full(HASHES, 0xFFFFFFFF, np.uint32)
    step = max(1, 16384 // HASHES * 8)
    for at in range(0, len(x), step):
        np.minimum(best, (_A[:, None] * x[None, at:at + step] + _B[:, None]).min(axis=1), out=best)
    return best


def bands(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each signature (row)."""
    h = (signatures.reshape(-1, BANDS, ROWS).astype(np.uint64) * _C).sum(axis=2, dtype=np.uint64)
    return _mix(h + np.arange(BANDS, dtype=np.uint64) * _P).view(np.int64)


def least_matches() -> np.ndarray:
    """By number of batches compared, the fewest matching bytes with which the posterior (uniform
    prior) of reaching the threshold is at least ``MISS``. Two bytes also match by chance."""
    p = (np.arange(20_000) + 0.5) / 20_000
    high = p >= THRESHOLD / 100 + (1 - THRESHOLD / 100) / 256
    out = [0]
    for n in range(BATCH, HASHES + 1, BATCH):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(p) + (n - m) * np.log1p(-p)
        w = np.exp(log - log.max(axis=1, keepdims=True))
        out.append(int(np.argmax((w * high).sum(axis=1) / w.sum(axis=1) >= MISS)))
    return np.array(out)


def surviving(a: np.ndarray, b: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (of equally many rows of bytes) that no batch drops, and their matches."""
    left, matched = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k in range(HASHES // BATCH):
        cut = slice(k * BATCH, (k + 1) * BATCH)
        matched = matched + (a[left, cut] == b[left, cut]).sum(axis=1)
        fine = matched >= least[k + 1]
        left, matched = left[fine], matched[fine]
    return left, matched


def sized(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Sets of these sizes can reach the threshold."""
    return 100 * np.minimum(n, m) >= THRESHOLD * np.maximum(n, m)


def similar(a: set, b: set) -> bool:
    both = len(a & b)
    return 100 * both >= THRESHOLD * (len(a) + len(b) - both) and bool(a)


def shingles(text: str | None) -> set:
    ws = words(text)
    return {tuple(ws[i:i + WIDTH]) for i in range(max(1, len(ws) - WIDTH + 1))} if ws else set()


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def features(docs: DataFrame) -> DataFrame:
    """``docs`` (id, text): n_shingles, digest of the set, band keys, signature bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in slices(batches):
            sets, digests = [], []
            for t in b.column(1).to_pylist():
                ws = words(t)
                found, first = _hashed(ws, hashes)
                sets.append(found)
                digests.append(set_digest(ws, first))
            sigs = np.array([signature(s) for s in sets]).reshape(-1, HASHES)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(digests, pa.binary()),
                pa.FixedSizeListArray.from_arrays(pa.array(bands(sigs).ravel()), BANDS).cast(pa.list_(pa.int64())),
                pa.array([(s & 255).astype(np.uint8).tobytes() for s in sigs], pa.binary())], ["id", "n", "digest", "bands", "sig"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, n bigint, digest binary, bands array<bigint>, sig binary")


def judged(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """``pairs`` (a, b) that the size test and the sequential test leave, with their matches."""
    least, kind = least_matches(), reps.schema["id"].dataType.simpleString()
    sides = [reps.select(F.col("id").alias(k), F.col("n").alias(f"n_{k}"), F.col("sig").alias(f"sig_{k}")) for k in "ab"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(pa.array(sized(b.column(2).to_numpy(), b.column(3).to_numpy())))
            if b.num_rows:
                left, matched = surviving(_bytes(b.column(4), HASHES), _bytes(b.column(5), HASHES), least)
                b = b.take(pa.array(left))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(matched)], ["a", "b", "matched"])

    joined = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b")
    return joined.mapInArrow(run, f"a {kind}, b {kind}, matched bigint")


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (a, b) whose full sets of word shingles reach the threshold."""
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()  # rows come sorted by b: its set is made once
        for batch in slices(batches):
            keep = []
            for b, ta, tb in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                if b != last:
                    last, own = b, shingles(tb)
                keep.append(similar(shingles(ta), own))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep, pa.bool_())) for k in (0, 1)], ["a", "b"])

    side = lambda k: only(texts, "id", pairs, k).select(F.col("id").alias(k), F.col("text").alias(f"t{k}"))
    joined = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "ta", "tb")
    return joined.mapInArrow(run, f"a {kind}, b {kind}")


def texts_of(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The texts that ``pairs`` need, once each."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    return saved(only(docs, "id", saved(ids, "ids")).dropDuplicates(["id"]), "texts")


def across(rows: DataFrame, labels: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) of different small components in the buckets ``rows`` (key, id) that hold
    several, as far as the size test and the sequential test leave them. Components of more than
    ``BLOCK`` members are left to ``beside_large``."""
    named = rows.join(labels, "id", "left").filter(f"size IS NULL OR size <= {BLOCK}").select("key", "id", F.coalesce("component", "id").alias("c"))
    open_ = saved(named.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.count(F.lit(1)).alias("members"))
                  .filter("c0 <> c1").select("key", "members"), "open")
    own = F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).cast("int")
    placed = (named.join(open_, "key").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")).withColumn("own", own)
              .select("key", "id", "c", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
              .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "c", "own")
              .join(reps.select("id", "n", "sig"), "id"))
    least, kind = least_matches(), reps.schema["id"].dataType.simpleString()

    def run(key, table):
        first, second = (np.flatnonzero(table["own"].to_numpy() == k.as_py()) for k in key[1:])
        c, n, ids = table["c"].to_numpy(), table["n"].to_numpy(), table["id"].to_numpy()
        sig, out = _bytes(table["sig"], HASHES), []
        for x in first:
            y = second[(c[second] != c[x]) & (ids[second] > ids[x] if key[1] == key[2] else True) & sized(n[second], n[x])]
            left, _ = surviving(np.broadcast_to(sig[x], (len(y), HASHES)), sig[y], least)
            out += [(ids[x], ids[k]) for k in y[left]]
        return pa.table({"a": pa.array([max(p) for p in out], pa.int64()), "b": pa.array([min(p) for p in out], pa.int64())})

    return placed.groupBy("key", "i", "j").applyInArrow(run, f"a {kind}, b {kind}").distinct()


def beside_large(rows: DataFrame, labels: DataFrame, reps: DataFrame, docs: DataFrame) -> DataFrame:
    """Confirmed links (a, b) between components of more than ``BLOCK`` members and the others that
    share a bucket with them, the smaller side's documents against all members of the larger.

    Both sides are dealt into blocks, and a pair of blocks is one group: signatures are compared
    there, then the texts of those that survive come together in the same blocks and are
    confirmed there. What leaves a block is one link for each document at most, which is all that
    its component needs, so a document beside a large group never becomes as many rows as the
    group has members.
    """
    kind = reps.schema["id"].dataType.simpleString()
    large = labels.filter(f"size > {BLOCK}")
    named = rows.join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("c"), F.coalesce("size", F.lit(1)).alias("size"))
    here = named.filter(f"size > {BLOCK}").select("key", F.col("c").alias("g"), F.col("size").alias("g_size")).distinct()
    beside = saved(named.join(here, "key").filter("g <> c AND (g_size > size OR g_size = size AND g > c)").select("id", "g", "g_size").distinct(), "beside")
    if beside.isEmpty():
        return beside.select(F.col("id").alias("a"), F.col("id").alias("b"))
    counts = saved(beside.groupBy("g", "g_size").agg(F.count(F.lit(1)).alias("others")).select(
        "g", F.ceil(F.col("g_size") / BLOCK).cast("int").alias("js"), F.ceil(F.col("others") / BLOCK).cast("int").alias("is")), "beside")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n).cast("long")).cast("int")
    x = beside.join(counts, "g").select("g", own("is").alias("i"), every("js").alias("j"), "id", F.lit(True).alias("beside"))
    y = large.join(counts, large["component"] == counts["g"]).select("g", every("is").alias("i"), own("js").alias("j"), "id", F.lit(False).alias("beside"))
    placed = saved(x.unionByName(y), "blocks")
    least = least_matches()

    def candidates(key, table):
        side, n, ids = table["beside"].to_numpy(zero_copy_only=False), table["n"].to_numpy(), table["id"].to_numpy()
        sig, members = _bytes(table["sig"], HASHES), np.flatnonzero(~side)
        found, used = [], set()
        for k in np.flatnonzero(side):
            fit = members[sized(n[members], n[k])]
            left, _ = surviving(np.broadcast_to(sig[k], (len(fit), HASHES)), sig[fit], least)
            if len(left):
                found.append((ids[k], ids[fit[left]].tolist()))
                used.update(found[-1][1])
        found += [(i, None) for i in sorted(used)]
        return pa.table({"g": pa.array([key[0].as_py()] * len(found), pa.int64()), "i": pa.array([key[1].as_py()] * len(found), pa.int32()),
                         "j": pa.array([key[2].as_py()] * len(found), pa.int32()), "id": pa.array([f[0] for f in found], pa.int64()),
                         "partners": pa.array([f[1] for f in found], pa.list_(pa.int64()))})

    def links(key, table):
        own = dict(zip(table["id"].to_pylist(), table["text"].to_pylist(), strict=True))
        sets, out = {}, []
        for i, partners in zip(table["id"].to_pylist(), table["partners"].to_pylist(), strict=True):
            for p in partners or []:
                for k in (i, p):
                    if k not in sets:
                        sets[k] = shingles(own.get(k))
                if similar(sets[i], sets[p]):
                    out.append((i, p))
                    break
        return pa.table({"a": pa.array([p[0] for p in out], pa.int64()), "b": pa.array([p[1] for p in out], pa.int64())})

    found = saved(placed.join(reps.select("id", "n", "sig"), "id").groupBy("g", "i", "j").applyInArrow(
        candidates, f"g {kind}, i int, j int, id {kind}, partners array<{kind}>"), "candidates")
    texts = saved(only(docs, "id", found).dropDuplicates(["id"]), "texts")
    return found.join(texts, "id").groupBy("g", "i", "j").applyInArrow(links, f"a {kind}, b {kind}")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept.

    Linked are documents whose sets of 5-word shingles have a similarity of at least 0.75; a text
    of fewer words is one shingle. Null and empty texts, texts of white space, and rows with a
    null id have no links. Rows repeated with one id are one document; of texts under one id that have
    different sets the least (by UTF-8 bytes; null last) counts, for all its rows. Ids are whole numbers. Other
    columns are not read, texts are read whole, and an empty table gives no rows.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    feats = saved(features(own), "features")
    mark = F.xxhash64("digest")
    odd = saved(feats.filter("id IS NOT NULL").groupBy("id").agg(F.min(mark).alias("lo"), F.max(mark).alias("hi")).filter("lo <> hi").select("id"), "odd")
    if not odd.isEmpty():
        least = saved(only(own, "id", odd).groupBy("id").agg(F.min("text").alias("text")), "least")
        own = without(own, "id", odd).unionByName(least)
        again = only(feats.select("id"), "id", odd).join(features(least), "id")
        feats = saved(without(feats, "id", odd).unionByName(again), "features")
    linkable = feats.filter("id IS NOT NULL AND n > 0")
    # equal sets, by SHA-256 of all their shingles: one representative; a hot set is a skewed join with a written table, which AQE splits
    twins = saved(linkable.groupBy("digest").agg(F.min("id").alias("rep"), F.max("id").alias("last")).filter("rep <> last").select("digest", "rep"), "twins")
    reps = saved(linkable.join(twins, "digest", "left").filter("rep IS NULL OR rep = id").select("id", "n", "bands", "sig"), "representatives")

    each = reps.select("id", F.explode("bands").alias("key"))
    shared = saved(each.groupBy("key").agg(F.min("id").alias("center"), F.max("id").alias("last")).filter("center <> last").select("key", "center"), "bands")
    rows = saved(only(each, "key", shared).join(shared, "key"), "buckets")
    pairs = rows.filter("id <> center").select(F.col("id").alias("a"), F.col("center").alias("b")).distinct()
    stars = saved(judged(pairs, reps), "stars")
    texts = texts_of(stars, own)
    # one pair for each document first: most others then lie within a component
    best = F.row_number().over(Window.partitionBy("a").orderBy(F.col("matched").desc(), "b")) == 1  # at most BANDS rows
    ranked = saved(stars.withColumn("best", best), "ranked")
    links = saved(confirmed(ranked.filter("best"), texts), "links")
    labels = components(links)
    rest = saved(_apart(ranked.filter("NOT best"), labels), "rest")
    links = saved(links.unionByName(confirmed(rest, texts)), "links")
    labels = components(links)
    sizes = saved(labels.groupBy("component").agg(F.count(F.lit(1)).alias("size")), "sizes")
    sized_labels = saved(labels.join(sizes, "component"), "components")
    tried = stars.select("a", "b")
    more = saved(across(rows.select("key", "id"), sized_labels, reps).join(tried, ["a", "b"], "left_anti"), "across")
    found = confirmed(more, texts_of(more, own)).unionByName(beside_large(rows.select("key", "id"), sized_labels, reps, own))
    links = saved(links.unionByName(found), "links")
    labels = saved(components(links), "components")

    member = feats.join(twins, "digest", "left").select("id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("rep")).alias("rep"))
    member = member.withColumn("rep", F.coalesce("rep", "id"))
    out = member.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left")
    component = F.coalesce("component", "rep")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """``pairs`` (a, b) that do not lie within one component."""
    side = lambda k: labels.select(F.col("id").alias(k), F.col("component").alias(f"c_{k}"))
    return (pairs.select("a", "b").join(side("a"), "a", "left").join(side("b"), "b", "left")
            .filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b"))


def brute(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """id -> (n_shingles, component) by all pairs: what tests compare with."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            if similar(sets[i], sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(len(w) - 4, 1) + 1)]) AS s
  FROM w WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * p.n >= 75 * (x.n + y.n - p.n)
), r AS (
  SELECT doc_id AS id, doc_id AS c FROM w UNION SELECT r.id, l.b FROM r JOIN l ON r.c = l.a
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, w.doc_id = m.c AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON m.id = w.doc_id
"""
