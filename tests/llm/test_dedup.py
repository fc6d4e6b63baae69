"""Exact dedup, MinHash near-dedup, embedding near-dedup, components."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from docket.llm import embedding_dedup, exact_dedup, minhash_dedup
from docket.llm.components import components

TEXT = "doc_id long, text string, _text string, kept boolean"  # two names that the operators use themselves


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def frame(spark, rows, schema=TEXT):
    return spark.createDataFrame([(*r, "x", True) for r in rows], schema).repartition(3)


# exact dedup ---------------------------------------------------------------------------------

def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate({ord(c): None for c in " \t\n\x0b\x0c\r"}), []).append((-len(t or ""), i is not None, i or 0, i))
    out = []
    for i, t in rows:
        n = (t or "").translate({ord(c): None for c in " \t\n\x0b\x0c\r"})
        keep = min(groups[n])[3]
        out.append((i, keep, len(groups[n]), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


def exact_rows():
    rng = random.Random(3)
    base = [sentence(rng, n) for n in (1, 3, 40, 400, 3000)]
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(10, base[2].replace(" ", "  ")), (11, base[2].replace(" ", "\n")), (12, base[3]), (13, base[3] + "x"), (14, "A b"), (15, "ab"),
             (16, None), (17, ""), (18, " \t\n\x0b\x0c\r"), (19, "a\u00a0b"), (20, "日本" * 5000), (21, "日 本" * 5000), (22, "é" * 9000),
             (23, "é" * 8999), (None, base[4]), (24, base[4]), (25, "twice"), (25, "twice"), (26, base[3] + " " + base[4])]
    return rows


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_groups_are_those_of_whole_texts(spark, bits):
    rows = exact_rows()
    got = exact_dedup.exact_groups(frame(spark, rows), hash_bits=bits).collect()  # 3 bits: nearly all chunk hashes collide
    assert sorted((tuple(r) for r in got), key=str) == brute_exact(rows)


def test_chunks_join_to_the_text_and_recur(spark):
    rng = random.Random(5)
    prose = lambda n: " ".join("".join(rng.choice("etaoinshrdlucmfwypvbgkjqxz") for _ in range(rng.randrange(1, 9))) for _ in range(n))
    shared = prose(4000)
    rows = [(1, shared), (2, prose(37) + " " + shared), (3, "q" * 10_000)]
    got = {r.doc_id: r.c for r in frame(spark, rows).select("doc_id", exact_dedup.chunks(exact_dedup.normalised(F.col("text"))).alias("c")).collect()}
    for i, t in rows:
        assert "".join(got[i]) == t.replace(" ", "")
        assert max(map(len, got[i])) <= exact_dedup.MAX_CHUNK
    assert len(set(got[1]) & set(got[2])) > 0.6 * len(got[1])  # the cuts follow the content, not the position


def test_exact_groups_of_nothing(spark):
    assert exact_dedup.exact_groups(frame(spark, [])).collect() == []


# near dedup ----------------------------------------------------------------------------------

def near_rows():
    rng = random.Random(11)
    passage = sentence(rng, 60)
    rows, i = [], 0
    for _ in range(25):  # families with more and more words changed
        words = sentence(rng, rng.randrange(30, 260)).split()
        for edits in (0, 1, 2, 4, 7, 12):
            w = list(words)
            for _ in range(edits):
                w[rng.randrange(len(w))] = f"e{rng.randrange(10_000)}"
            rows.append((i := i + 1, " ".join(w)))
    rows += [((i := i + 1), sentence(rng, rng.randrange(20, 90)) + " " + passage) for _ in range(40)]
    rows += [(i + 1, None), (i + 2, ""), (i + 3, " \n"), (i + 4, "one two"), (i + 5, "ONE\ttwo"), (i + 6, "one two three"), (i + 7, "a b c d e"),
             (i + 8, "a b c d e"), (i + 9, rows[0][1].upper()), (i + 10, rows[3][1] + " " + rows[3][1]), (i + 11, sentence(rng, 20_000, 5000))]
    rows.append((i + 12, rows[-1][1] + " end"))
    return rows


def test_near_groups_are_those_of_all_pairs(spark):
    rows = near_rows()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_groups(frame(spark, rows)).collect()}
    assert got == minhash_dedup.brute(rows)


def test_near_groups_with_null_and_repeated_ids(spark):
    t = "a b c d e f g h"
    got = minhash_dedup.near_groups(frame(spark, [(None, t), (1, t), (1, t), (2, t), (3, None)])).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=str) == [
        (1, 4, 1, True), (1, 4, 1, True), (2, 4, 1, False), (3, 0, 3, True), (None, 4, None, True)]
    assert minhash_dedup.near_groups(frame(spark, [])).collect() == []


def test_near_groups_with_two_texts_under_an_id(spark):
    a, b = "a b c d e f g h", "q r s t u v"
    got = minhash_dedup.near_groups(frame(spark, [(1, b), (1, a), (1, None), (1, a), (2, b), (3, a), (4, None), (4, ""), (5, "A b c d e f g h"), (5, a)])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [  # the least text of 1 is a
        *[(1, 4, 1)] * 4, (2, 2, 2), (3, 4, 1), (4, 0, 4), (4, 0, 4), (5, 4, 1), (5, 4, 1)]


def test_set_digest_tells_sets_apart():
    hashes = minhash_dedup.WordHashes()

    def digest(text):
        ws = minhash_dedup.words(text)
        return minhash_dedup.set_digest(ws, minhash_dedup._hashed(ws, hashes)[1])

    rng = random.Random(1)
    texts = [sentence(rng, n, 3) for n in range(12) for _ in range(30)] + ["a b c d e a b c d e a b c d e", "b c d e a b c d e a b", "ab c", "a bc", "x " * 30_000]
    digests = {t: digest(t) for t in texts}
    for t in texts:
        assert all((digests[t] == digests[u]) == (minhash_dedup.shingles(t) == minhash_dedup.shingles(u)) for u in texts)


def test_across_blocks_of_a_large_bucket(spark, monkeypatch):
    """Members of one bucket that lie in several components, in blocks of three: every near pair is found."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 3)
    rng = random.Random(2)
    words = sentence(rng, 200).split()
    rows = [(k, " ".join([*words[:-1], f"x{k}"]) if k < 7 else sentence(rng, 150)) for k in range(12)]
    reps = minhash_dedup.features(frame(spark, rows).select(F.col("doc_id").alias("id"), "text")).select("id", "n", "sig").cache()
    bucket = spark.range(12).select(F.lit(1).cast("long").alias("key"), "id")
    labels = spark.createDataFrame([(0, 0, 3), (1, 0, 3), (2, 0, 3)], "id long, component long, size long")
    got = {(r.a, r.b) for r in minhash_dedup.across(bucket, labels, reps).collect()}
    assert got == {(a, b) for a in range(7) for b in range(a) if not (a < 3 and b < 3)}
    large = spark.createDataFrame([(k, 0, 5) for k in range(5)], "id long, component long, size long")
    docs = frame(spark, rows).select(F.col("doc_id").alias("id"), "text")
    got = [(r.a, r.b) for r in minhash_dedup.beside_large(bucket, large, reps, docs).collect()]
    assert {a for a, _ in got} == {5, 6} and all(b < 5 for _, b in got)  # 7 to 11 are like nothing
    assert {(r.a, r.b) for r in minhash_dedup.across(bucket, large, reps).collect()} == {(6, 5)}
    small = spark.createDataFrame([(0, 0, 2), (1, 0, 2)], "id long, component long, size long")
    assert minhash_dedup.beside_large(bucket, small, reps, docs).collect() == []


def test_a_chain_beside_large_groups_is_joined(spark, monkeypatch):
    """Groups of near copies whose edits drift: what a bucket's smallest member does not reach, its blocks do."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 4)
    rng = random.Random(21)
    rows = []
    for g in range(6):
        words = sentence(rng, 120).split()
        for k in range(18):
            words = list(words)
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = f"d{rng.randrange(10_000)}"
            rows.append((100 * g + (k * 7) % 18, " ".join(words)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash_dedup.near_groups(frame(spark, rows)).collect()}
    assert got == minhash_dedup.brute(rows)


def test_signatures_estimate_similarity_and_pruning_spares_near_pairs():
    rng = np.random.default_rng(0)
    least = minhash_dedup.least_matches()
    assert (np.diff(least) >= 0).all() and least[-1] > minhash_dedup.HASHES // 2
    kept, far = 0, 0
    for _ in range(200):
        common, rest = rng.integers(0, 1 << 63, 600, dtype=np.uint64), rng.integers(0, 1 << 63, (2, 100), dtype=np.uint64)
        a, b = (minhash_dedup.signature(np.concatenate([common, r])) for r in rest)  # similarity 600 / 800
        assert abs((a == b).mean() - 0.75) < 0.17
        low = lambda s: (s & 255).astype(np.uint8)[None]
        kept += len(minhash_dedup.surviving(low(a), low(b), least)[0])
        c = minhash_dedup.signature(np.concatenate([common[:250], rest[1], rest[0], rng.integers(0, 1 << 63, 400, dtype=np.uint64)]))
        far += len(minhash_dedup.surviving(low(a), low(c), least)[0])
    assert kept == 200 and far == 0


# embeddings ----------------------------------------------------------------------------------

def brute_vectors(rows):
    fine = [(k, l, np.array(v, float)) for k, (_, l, v) in enumerate(rows) if l is not None and v and None not in v
            and np.isfinite(v).all() and any(v)]
    root, links = {k: k for k in range(len(rows))}, dict.fromkeys(range(len(rows)), 0)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for x, (k, lab, v) in enumerate(fine):
        for m, other, w in fine[x + 1:]:
            if lab == other and len(v) == len(w) and v @ w / math.sqrt((v @ v) * (w @ w)) >= 0.93:
                links[k], links[m] = links[k] + 1, links[m] + 1
                root[find(k)] = find(m)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, links[k], least.get(find(k)), i == least.get(find(k))) for k, (i, *_) in enumerate(rows)), key=str)


@pytest.mark.parametrize("k", [1, 3])
def test_near_vectors_are_those_of_all_pairs(spark, monkeypatch, k):
    rng = np.random.default_rng(4)
    rows, i = [], 0
    for _ in range(20):
        c = rng.normal(size=48)
        for far in (0, 0, 0.1, 0.3, 0.36, 0.41, 0.5):
            x = c + far * np.linalg.norm(c) * (lambda p: p / np.linalg.norm(p))(rng.normal(size=48))
            rows.append(((i := i + 1), int(rng.integers(0, 2)), [float(np.float32(y)) for y in x * rng.uniform(0.1, 9) if True] if far else [float(np.float32(y)) for y in c]))
    v = rows[0][2]
    rows += [(500, None, v), (501, 0, None), (502, 0, []), (503, 0, [0.0] * 48), (504, 0, [None, *v[1:]]), (505, 0, [float("nan"), *v[1:]]),
             (506, 0, [float("inf"), *v[1:]]), (None, 0, v), (507, 0, v), (508, 1, v), (509, 0, [-x for x in v]), (510, 0, v[:20]), (511, 0, v[:20]),
             (512, 0, [3.0]), (513, 0, [5.0]), (514, 0, [-5.0]), (507, 0, v),
             (None, 0, [0.5, 0.1]), (None, 0, [0.5, 0.1]), (None, 0, [1.0, 0.21]), (None, 1, [0.5, 0.1]), (None, None, v), (None, 0, None), (520, 1, [1.0, 0.21])]
    monkeypatch.setattr(embedding_dedup, "rotations", lambda most, dim: k)
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, label int, embedding array<float>, component long").repartition(4)
    got = sorted((tuple(r) for r in embedding_dedup.near_vectors(df).collect()), key=str)
    assert got == brute_vectors([(i, l, v and [None if x is None else float(np.float32(x)) for x in v]) for i, l, v in rows])
    assert embedding_dedup.near_vectors(df.filter("false")).collect() == []


def test_recall_of_pairs_at_the_threshold():
    rng = np.random.default_rng(9)
    a = rng.normal(size=(3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    p = rng.normal(size=a.shape)
    p -= (p * a).sum(axis=1, keepdims=True) * a
    b = 0.93 * a + math.sqrt(1 - 0.93**2) * p / np.linalg.norm(p, axis=1, keepdims=True)
    for k in embedding_dedup.PLANS:
        x, y = embedding_dedup.buckets(a[:1000], k), embedding_dedup.buckets(b[:1000], k)
        assert ((x == y[:, :, :1]) | (y == x[:, :, :1])).any(axis=(1, 2)).mean() >= 0.999
    assert [embedding_dedup.rotations(n, 64) for n in (0, 128, 129, 16_384, 10**5, 10**8, 10**12)] == [1, 1, 2, 2, 3, 4, 4]
    assert np.allclose(embedding_dedup.hadamard(embedding_dedup.hadamard(a)), a)


@pytest.mark.parametrize("dim", [128, 1024])
def test_longer_vectors_get_more_tables(dim):
    rng = np.random.default_rng(dim)
    a = rng.normal(size=(150, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    p = rng.normal(size=a.shape)
    p -= (p * a).sum(axis=1, keepdims=True) * a
    b = 0.93 * a + math.sqrt(1 - 0.93**2) * p / np.linalg.norm(p, axis=1, keepdims=True)
    for k in embedding_dedup.PLANS:
        x, y = embedding_dedup.buckets(a, k), embedding_dedup.buckets(b, k)
        found = ((x == y[:, :, :1]) | (y == x[:, :, :1])).any(axis=2)
        assert (1 - found.mean()) ** found.shape[1] < 3e-5  # tables miss independently


# components ----------------------------------------------------------------------------------

def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(100, 160)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    edges += [(9, k) for k in range(10, 60)] + [(5, 5), (None, 3), (1000, 999), (999, 1000)]
    near = {}
    for a, b in edges:
        if a is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for i in sorted(near):
        todo = [i] if i not in want else []
        while todo:
            k = todo.pop()
            if k not in want:
                want[k] = i
                todo += near[k]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


# joins by slots ------------------------------------------------------------------------------

@pytest.mark.parametrize("slots", [1 << 22, 8])
def test_slot_joins_are_semi_and_anti_joins(spark, monkeypatch, slots):
    from docket.llm import common
    monkeypatch.setattr(common, "SLOTS", slots)  # 8 slots: nearly every row passes the first sieve
    df = spark.createDataFrame([(k % 40 if k % 9 else None, k, "x") for k in range(200)], "id long, k long, __id string")
    ids = spark.createDataFrame([(i,) for i in (*range(0, 40, 3), 99, None)], "id long")
    assert sorted(common.only(df, "id", ids).select("k").collect()) == sorted(df.join(ids, "id", "left_semi").select("k").collect())
    got = common.without(df, "id", ids)
    assert got.columns == df.columns
    assert sorted(got.select("k").collect()) == sorted(df.join(ids, "id", "left_anti").select("k").collect())
    assert common.only(df, "id", ids.filter("false")).count() == 0 and common.without(df, "id", ids.filter("false")).count() == 200
