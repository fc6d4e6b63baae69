"""URL models, language-model scoring, toxicity, mixing, quality."""

import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from docket.llm import lm_scoring, mixing, quality, toxicity, urls
from docket.llm.common import held_out, words

DOCS = "doc_id long, text string, row string, score string, id string, n string"  # names that the operators use themselves


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], DOCS).repartition(3)


# URL filter ----------------------------------------------------------------------------------

def test_host_path_and_rules(spark):
    cases = {  # url: host, path, rule, given verdict
        "http://a.Example.NET/en/x?y#z": ("a.example.net", "/en/x", "example.net/en/", "allow"),
        "https://example.net/de/": ("example.net", "/de/", "net/", "block"),
        "http://notexample.net/en/": ("notexample.net", "/en/", "net/", "block"),
        "http://net": ("net", "", None, None), "http://x.net?q=/": ("x.net", "", None, None), "http://x.net#/": ("x.net", "", None, None),
        "HTTP://WWW.ORG/fr/1": ("www.org", "/fr/1", "org/fr/", "allow"), "x.org/fr/": ("", "", None, None), None: ("", "", None, None), "": ("", "", None, None),
        "a://b://c.net/": ("b:", "//c.net/", None, None), "ftp://ÄB.net/EN/\n/x": ("Äb.net", "/EN/\n/x", "net/", "block"),
        "http://example.com/de": ("example.com", "/de", None, None), "http://s.example.com/de/a": ("s.example.com", "/de/a", "example.com/de/", "block"),
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    host, path = urls.host_path(F.col("url"))
    rule, verdict = urls.fitting_rule(F.col("h"), F.col("p"))
    got = df.select("url", host.alias("h"), path.alias("p")).select("url", "h", "p", rule, verdict).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == cases


def plain_ratio(known, url):
    """Witten-Bell by dictionaries instead of hash slots."""
    def text(u):
        return [2] * urls.ORDER + [ord(c) for c in ((u or "").partition("://")[2] or u or "")] + [3]

    events = [{}, {}]
    for u, c in known:
        x = text(u)
        for i in range(urls.ORDER, len(x)):
            for k in range(urls.ORDER + 1):
                events[c].setdefault(tuple(x[i - k:i]), Counter())[x[i]] += 1
    x, total = text(url), 0.0
    for i in range(urls.ORDER, len(x)):
        for c, sign in ((1, 1), (0, -1)):
            p = 1 / urls.ALPHABET
            for k in range(urls.ORDER + 1):
                seen = events[c].get(tuple(x[i - k:i]))
                if seen:
                    n = seen.total()
                    p = (seen[x[i]] + len(seen) * p) / (n + len(seen))
            total += sign * math.log(p)
    return total / (len(x) - urls.ORDER)


def test_url_models_are_the_plain_ones(spark):
    rng = random.Random(0)
    known = [(f"http://{rng.choice(['good', 'fine'])}{rng.randrange(99)}.org/fr/{k}", 1) for k in range(60)]
    known += [(f"http://{rng.choice(['spam', 'pills'])}-{rng.randrange(99)}.net/{k}", 0) for k in range(70)]
    model = urls.train(spark.createDataFrame(known, "url string, cls int").repartition(3))
    asked = [None, "", "http://good7.org/en/", "http://pills-3.com", "é😀" * 300, *[u for u, _ in known[:5]]]
    assert np.allclose(model.ratio(asked), [plain_ratio(known, u) for u in asked], atol=1e-5)


def test_url_filter_learns_from_rules(spark):
    rng = random.Random(1)
    rows = [(k, f"http://{rng.choice(['cheap-pills', 'free-bets'])}{k}.net/x{k}") for k in range(120)]
    rows += [(200 + k, f"http://{rng.choice(['garden', 'history'])}{k}.org/fr/x{k}") for k in range(120)]
    rows += [(900, "http://cheap-pills9.com/x7"), (901, "http://garden5.com/fr/x7"), (902, None), (902, None), (None, "http://history.com/fr/")]
    got = urls.filter_urls(spark.createDataFrame([(*r, "z", "z") for r in rows], "page_id long, url string, verdict string, ratio string").repartition(2)).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and by[0].rule == "net/" and by[0].verdict == "block" and by[200].verdict == "allow"
    assert by[900].verdict == "block" and by[901].verdict == "allow" and by[None].verdict == "allow" and by[902].rule is None
    only = urls.filter_urls(spark.createDataFrame([(1, "http://a.net/"), (2, "http://b.com/")], "page_id long, url string")).collect()
    assert {r.page_id: r.verdict for r in only} == {1: "block", 2: "allow"}  # nothing accepted to learn from
    assert urls.filter_urls(spark.createDataFrame([], "page_id long, url string")).collect() == []


# language model ------------------------------------------------------------------------------

def test_scores_and_counts(spark):
    rng = random.Random(2)
    names = [f"w{k}" for k in range(30)]
    rows = []
    for i in range(150):  # each word tells the next one
        k, t = rng.randrange(30), []
        for _ in range(rng.randrange(0, 120)):
            t.append(names[k])
            k = (7 * k + 3) % 30 if rng.random() < 0.9 else rng.randrange(30)
        rows.append((i, " ".join(t)))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "UNSEEN W1\tw2"), (503, "UNSEEN W1\tw2"), (None, "w1 w2"), (504, "w1 " * 30_000)]
    back = held_out(F.col("doc_id"), 10, 0)
    got = lm_scoring.score_texts(docs_of(spark, rows), ~back).collect()
    assert len(got) == len(rows)
    out = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 10 == 0
    tokens = {i: [*words(t), b""] for i, t in rows}
    c = Counter(w for i, t in rows if not out(i) for w in [*words(t), b""])
    n, v = c.total(), len(c)
    for r in got:
        t = tokens[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), rel_tol=1e-9)
        assert math.isfinite(r.score) and r.score < 0
    held = [r for r in got if out(r.doc_id) and r.doc_id is not None and r.doc_id < 200]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)  # the context tells much
    assert lm_scoring.score_texts(docs_of(spark, []), ~back).collect() == []
    none = lm_scoring.score_texts(docs_of(spark, [(1, "a b")]), F.lit(False)).collect()[0]
    assert none.n_known == 0 and none.train_tokens == 0 and math.isfinite(none.score)


def test_probabilities_of_all_slots_and_words_sum_to_one():
    rng = np.random.default_rng(0)
    slots = lm_scoring.CLASSES * lm_scoring.SLOTS
    counts = rng.integers(0, 50, slots)
    model = lm_scoring.Model(counts * 3, (counts > 0) * 3)
    model.class_w[:], model.slot_w[:] = rng.normal(size=model.class_w.shape), rng.normal(size=model.slot_w.shape)
    context = np.repeat(rng.integers(0, 1 << 63, (1, 4), dtype=np.uint64), slots, axis=0)
    assert math.isclose(np.exp(model.log_slots(context, np.arange(slots))).sum(), 1, rel_tol=1e-4)
    s = int(np.argmax(counts))  # three words seen so often each, and one share for those never seen
    assert math.isclose(np.exp(model.log_word(np.array([counts[s]] * 3 + [0]), np.array([s] * 4))).sum(), 1, rel_tol=1e-9)


def test_learning_follows_the_gradient():
    rng = np.random.default_rng(1)
    slots = lm_scoring.CLASSES * lm_scoring.SLOTS
    model = lm_scoring.Model(np.ones(slots), np.ones(slots))
    context, slot = rng.integers(0, 1 << 63, (64, 4), dtype=np.uint64), rng.integers(0, slots, 64)
    before = model.log_slots(context, slot).sum()
    for _ in range(20):
        model.learn(context, slot)
    assert model.log_slots(context, slot).sum() > before + 60


def test_size_of_the_softmax_layers_and_of_a_step():
    h = np.random.default_rng(2).integers(0, 1 << 32, 100_000, dtype=np.uint32)
    assert len(np.unique(lm_scoring.slot_of(h))) == 1024  # a context narrows a word to a 1024th of the words
    sizes = []

    class Counting(lm_scoring.Model):
        def layers(self, contexts, slot):
            sizes.append(len(slot))
            return super().layers(contexts, slot)

    n, slots = 10_000, lm_scoring.CLASSES * lm_scoring.SLOTS
    model = Counting(np.ones(slots), np.ones(slots))
    model.learn(np.ones((n, 4), np.uint64), lm_scoring.slot_of(h[:n]))
    assert sum(sizes) == n and max(sizes) <= 4096


def plain_layers(model, context, slot):
    """For each layer the rows, outcome and probabilities of one token, by plain loops."""
    cls, inner, mask = slot // 32, slot % 32, (1 << 64) - 1
    for w, bias, y, row in (
            (model.class_w, model.class_bias, cls, lambda h: h % len(model.class_w)),
            (model.slot_w, model.slot_bias[cls], inner,
             lambda h: ((h ^ (cls + 1) * 0x9E3779B97F4A7C15 & mask) * 0xC2B2AE3D27D4EB4F & mask) >> 50)):
        rows = [row(int(h)) for h in context]
        z = [float(bias[o]) + sum(float(w[r][o]) for r in rows) for o in range(32)]
        total = sum(math.exp(x) for x in z)
        yield rows, y, [math.exp(x) / total for x in z]


def test_scores_and_steps_are_the_plain_ones():
    rng = np.random.default_rng(4)
    slots = lm_scoring.CLASSES * lm_scoring.SLOTS
    model = lm_scoring.Model(rng.integers(0, 99, slots), rng.integers(1, 9, slots))
    context = rng.integers(0, 1 << 63, (40, 4), dtype=np.uint64)
    context[::2, 0] = context[0, 0]  # a frequent word: more uses than are added one by one
    context[5] = context[7]
    slot = rng.integers(0, slots, 40)
    for x in model.learnt():
        x[:] = rng.random(x.shape) / 4
    plain = [list(plain_layers(model, c, int(s))) for c, s in zip(context, slot, strict=True)]
    assert np.allclose(model.log_slots(context, slot), [sum(math.log(p[y]) for _, y, p in x) for x in plain], rtol=1e-4)
    want = [x.astype(float) for x in model.learnt()]
    for k in (0, 1):
        g = np.zeros_like(want[k])
        for x in plain:
            rows, y, p = x[k]
            for r in rows:
                g[r] += np.array(p) - (np.arange(32) == y)
        used = np.flatnonzero(np.abs(g).sum(axis=1))
        want[2 + k][used] += (g[used] ** 2).mean(axis=1)
        want[k][used] -= lm_scoring.STEP * g[used] / np.sqrt(want[2 + k][used] + 1e-6)[:, None]
    model.learn(context, slot)
    assert all(np.allclose(a, b, rtol=1e-3, atol=1e-5) for a, b in zip(model.learnt(), want, strict=True))


def test_scoring_leaves_the_session_as_it_is(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    rows = [(i, f"w{i % 3} w{i % 5} x") for i in range(40)]
    got = lm_scoring.score_texts(docs_of(spark, rows), F.col("doc_id") > 5)
    assert spark.conf.get(key) == before
    spark.conf.set(key, "7")
    try:
        small = sorted((r.doc_id, r.score) for r in got.collect())
    finally:
        spark.conf.set(key, before)
    assert small == sorted((r.doc_id, r.score) for r in got.collect())


# toxicity ------------------------------------------------------------------------------------

def toxic_corpus(n=500):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        t = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 200))]
        bad = rng.random() < 0.2
        for _ in range(rng.randrange(2, 6) * bad):
            t.insert(rng.randrange(len(t)), rng.choice(["scoundrel,", "Vermin", "dolt" + rng.choice(["ish", "en", "ard", "ery"])]))
        rows.append((i, " ".join(t)))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity(spark):
    rows, labels = toxic_corpus()
    truth = dict(labels)
    rows += [(900, None), (901, ""), (902, " "), (903, "scoundrel vermin"), (903, "scoundrel vermin"), (None, "w1 w2"), (904, "w3 w4 " * 40_000)]
    lab = spark.createDataFrame(labels + [(None, 1), (1, None), (5000, 1)], "doc_id long, toxic int")
    back = held_out(F.col("doc_id"), 4, 2)
    docs = docs_of(spark, rows)
    got = toxicity.with_score(docs, toxicity.fit(docs, lab, ~back)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.row.doc_id == r.id and r.row.n == "d" for r in got)
    held = [r for r in got if r.id in truth and zlib.crc32(str(r.id).encode()) % 4 == 2]
    assert sum((r.score >= 0.3) == bool(truth[r.id]) for r in held) >= 0.97 * len(held) and len(held) > 80
    by = {r.id: r.score for r in got}
    assert by[903] >= 0.3 and max(by[k] for k in (900, 901, 902, 904, None)) < 0.3
    nothing = toxicity.fit(docs, lab.filter("toxic = 0"), ~back)
    assert nothing is None and {r.score for r in toxicity.with_score(docs, nothing).collect()} == {0.0}
    assert toxicity.with_score(docs.filter("false"), nothing).collect() == []


def plain_kneser_ney(rows, labels, counted):
    """P_c(word) / shared probability by the formula, with dictionaries; and what all P_c sum to, the
    share of expressions never seen included."""
    truth, orders = dict(labels), len(toxicity.PREFIXES) + 1
    strip = lambda w: w.strip(toxicity.MARKS) or w
    form = lambda w, k: w if k == orders - 1 or len(w.decode()) <= toxicity.PREFIXES[k] else (w.decode()[:toxicity.PREFIXES[k]] + "*").encode()
    seen = set()
    for i, t in rows:
        ws = [strip(w) for w in words(t)] if i in counted else []
        seen |= {(truth[i], v, w) for v, w in zip([b""] + ws, ws)}
    vocabulary = {w for *_, w in seen}
    ratio, shared, rest = {b"": [1.0, 1.0]}, {b"": 1.0}, [0.0, 0.0]
    for k in range(orders):
        n = [Counter(f for f, _ in {(form(w, k), v) for y, v, w in seen if y == c}) for c in (0, 1)]
        parent = {form(w, k): form(w, k - 1) if k else b"" for w in vocabulary}
        off = []
        for c in (0, 1):
            levels = sorted(n[c].values())
            want, taken, d = toxicity.BACKOFF * sum(levels), 0.0, 0.0
            for at, x in enumerate(levels):  # taken(d) grows by the number of counts above d
                if taken + (x - d) * (len(levels) - at) >= want:
                    d += (want - taken) / (len(levels) - at)
                    break
                taken, d = taken + (x - d) * (len(levels) - at), x
            off.append(d)
        under = Counter()
        for f, g in parent.items():
            under[g] += n[0][f] + n[1][f]
        new, now = {}, {}
        for f, g in parent.items():
            now[f] = shared[g] * (n[0][f] + n[1][f] - toxicity.DISCOUNT) / under[g]
            new[f] = [max(n[c][f] - off[c], 0) / sum(n[c].values()) / now[f] + toxicity.BACKOFF * ratio[g][c] for c in (0, 1)]
        children = Counter(parent.values())
        rest = [toxicity.BACKOFF * (rest[c] + sum(ratio[g][c] * shared[g] * toxicity.DISCOUNT * m / under[g] for g, m in children.items())) for c in (0, 1)]
        ratio, shared = new, now
    return ratio, [sum(ratio[w][c] * shared[w] for w in ratio) + rest[c] for c in (0, 1)]


def test_toxicity_models_are_the_plain_ones(spark, monkeypatch):
    rows, labels = toxic_corpus(80)
    rows = [(i, f"{t} only{i} {t[:9]}") for i, t in rows]
    docs = docs_of(spark, rows)
    counted = {r.i for r in spark.range(80).selectExpr("id AS i").filter(F.pmod(F.xxhash64("i", F.lit("half")), F.lit(2)) == 0).collect()}
    ratio, total = plain_kneser_ney(rows, labels, counted)
    assert all(math.isclose(t, 1, abs_tol=1e-9) for t in total)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    ws = sorted(ratio)
    got = model.ratios(np.array([toxicity.chain(w) for w in ws], np.uint64))
    assert np.allclose(got.T, [ratio[w] for w in ws], rtol=1e-5)
    # the scorer gives the same, also past its memory and for words never seen (backoff all the way)
    monkeypatch.setattr(toxicity, "CACHED_WORDS", 50)
    each = [ws[:30], [], ws[20:45], [b"zzzzzzzz"]]
    scorer = toxicity.Scorer(model)
    parts = [scorer.log_ratio([e])[0] for e in each]
    for e, part in zip(each[:3], parts, strict=False):
        assert np.allclose(part, [math.log(ratio[w][1] / ratio[w][0]) for w in e], atol=1e-4)
    assert parts[3] == 0
    x = np.concatenate(parts[::2])
    assert np.allclose(scorer.features([" ".join(w.decode() for w in each[0])])[0, 1], parts[0].mean(), atol=1e-5) and len(x) == 55


# mixing --------------------------------------------------------------------------------------

def plain_rates(n, p, targets, volume):
    r, start = np.ones(len(n)), (n[:, None] * p).sum(axis=0)
    aim = volume * start.sum() * np.array(targets) / sum(targets)
    for _ in range(mixing.STEPS):
        g = ((n * r)[:, None] * p).sum(axis=0)
        g = np.where(start > 0, (g - aim) / np.maximum(start, 1e-9), 0)
        if np.abs(g).max() < mixing.CLOSE:
            break
        r = np.maximum(0, r - p @ g)
    return r


def test_rates_are_those_of_plain_projected_gradient(spark):
    rng = np.random.default_rng(5)
    n, p = rng.integers(0, 500, 400), rng.dirichlet([0.3, 0.2, 0.1], 400)
    table = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)], "n long, p array<double>")
    targets = {"a": 0.2, "b": 0.5, "c": 0.3}
    steps = mixing.fit_rates(table, targets, 1.5)
    got = table.select("n", "p", mixing.rate(F.col("p"), steps).alias("r")).collect()
    r = np.array([x.r for x in got])
    assert np.allclose(r, plain_rates(np.array([x.n for x in got]), np.array([x.p for x in got]), [0.2, 0.5, 0.3], 1.5), atol=1e-9) and (r >= 0).all()
    totals = sum(x.n * x.r * np.array(x.p) for x in got)
    assert np.allclose(totals, 1.5 * n.sum() * np.array([0.2, 0.5, 0.3]), rtol=0.01)


def test_rates_reach_targets_also_with_alike_posteriors(spark, caplog):
    rng = np.random.default_rng(6)
    n, p = rng.integers(1, 500, 400), np.clip(rng.normal(0.5, 0.05, 400), 0, 1)
    table = spark.createDataFrame([(int(a), [float(b), float(1 - b)]) for a, b in zip(n, p, strict=True)], "n long, p array<double>")

    def errors(a):
        got = table.select("n", "p", mixing.rate(F.col("p"), mixing.fit_rates(table, {"a": a, "b": 1 - a}, 1.0)).alias("r")).collect()
        assert all(x.r >= 0 for x in got)
        aim = n.sum() * np.array([a, 1 - a])
        return np.abs(sum(x.n * x.r * np.array(x.p) for x in got) / aim - 1).max()

    assert errors(0.53) < 2e-4 and not caplog.records
    assert errors(0.95) > 0.1 and "miss their targets" in caplog.text  # out of reach of any rates


def test_mixing(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        good = rng.random() < 0.7
        rows.append((i, " ".join((f"w{rng.randrange(200)}" if good else f"{rng.randrange(99)} | #") for _ in range(rng.randrange(5, 90)))))
        if i % 2:
            labels.append((i, int(good)))
    rows += [(900, None), (901, ""), (901, ""), (None, "w1 w2"), (902, "w5 " * 50_000)]
    docs, lab = docs_of(spark, rows), spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, quality int")
    out, names = mixing.mix(docs, lab)
    got = out.collect()
    assert names == ["good", "poor"] and len(got) == len(rows) and all(r.row.n == "d" for r in got)
    total = sum(r.n for r in got)
    for k, x in enumerate(names):
        assert math.isclose(sum(r.n * r.p[k] * r.rate for r in got), mixing.VOLUME * total * mixing.TARGETS[x], rel_tol=0.01)
    assert all(0 <= r.copies - math.floor(r.rate) <= 1 for r in got)
    assert {r.n for r in got if r.id in (900, 901)} == {0}
    narrow, _ = mixing.mix(docs, lab, with_rows=False)
    assert sorted(((r.id, r.n, r.copies) for r in narrow.collect()), key=str) == sorted(((r.id, r.n, r.copies) for r in got), key=str)
    same = spark.range(2000).select(F.lit(None).cast("long").alias("i"), F.concat(F.lit("t"), "id").alias("t"))
    drawn = same.select(mixing.copies(F.xxhash64("i", "t"), F.lit(1.5)).alias("c")).groupBy().avg("c").first()[0]
    assert abs(drawn - 1.5) < 0.06  # rows without an id are drawn apart
    out, _ = mixing.mix(docs.filter("false"), lab)
    assert out.collect() == []
    named = docs.withColumn("doc_id", F.format_string("%05d", "doc_id")), lab.withColumn("doc_id", F.format_string("%05d", "doc_id"))
    assert mixing.mix(*named)[0].count() == len(rows)
    out, _ = mixing.mix(docs, lab.filter("false"))
    assert {tuple(r.p) for r in out.collect()} == {(0.5, 0.5)}


# quality -------------------------------------------------------------------------------------

def test_quality(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(500):
        good = rng.random() < 0.8
        t = " ".join(f"word{rng.randrange(300)}" for _ in range(rng.randrange(30, 300)))
        if not good:  # one passage among clean ones
            at = rng.randrange(len(t))
            t = t[:at] + " ".join("BUY!! $$$" for _ in range(40)) + t[at:]
        rows.append((i, t))
        labels.append((i, int(good)))
    truth = dict(labels)
    rows += [(900, None), (901, ""), (902, " \n"), (903, "word1"), (903, "word1"), (None, "word1 word2"), (904, "word7 " * 50_000)]
    docs, lab = docs_of(spark, rows), spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, quality int")
    back = held_out(F.col("doc_id"), 4, 2)
    got = quality.score(docs, quality.fit(docs, lab, ~back)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.doc_id: r.n_passages for r in got}[904] == math.ceil(50_000 / quality.PASSAGE)
    held = [r for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert sum((r.score >= 0.7) == bool(truth[r.doc_id]) for r in held) >= 0.95 * len(held)
    assert quality.fit(docs, lab.filter("quality = 1"), ~back) is None
    named = docs.withColumn("doc_id", F.format_string("%05d", "doc_id")), lab.withColumn("doc_id", F.format_string("%05d", "doc_id"))
    assert quality.score(named[0], quality.fit(*named, F.lit(True))).count() == len(rows)
    assert {r.score for r in quality.score(docs, None).collect()} == {1.0}
    assert quality.score(docs.filter("false"), None).collect() == []


def test_attention_gradient_is_the_numeric_one():
    rng = np.random.default_rng(2)
    model = quality.Model(rng)
    x, starts, y = rng.normal(size=(9, quality.FEATURES)) * 0.3, np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0])

    def loss():
        s = model.forward(x, starts)[5]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    g = model.gradient(x, starts, y)
    for name, w in model.p.items():
        at = tuple(rng.integers(0, k) for k in w.shape)
        old = w[at]
        w[at] = old + 1e-5
        up = loss()
        w[at] = old - 1e-5
        down = loss()
        w[at] = old
        assert math.isclose(g[name][at], (up - down) / 2e-5, rel_tol=1e-3, abs_tol=1e-7), name


def test_sample_takes_whole_documents():
    assert quality.beyond([4, 3, 9, 2, 1, 1], 10) == [2, 5] and quality.beyond([], 1) == []


def test_fit_reads_all_passages(spark, monkeypatch):
    """The passages that the model is trained on are all that the labelled documents have."""
    rows = [(i, f"w{i} " * n) for i, n in enumerate([10, 64, 65, 20_000, 0, 700, 300])]
    docs, lab = docs_of(spark, rows), spark.createDataFrame([(i, i % 2) for i in range(7)], "doc_id long, quality int")
    bags = []
    monkeypatch.setattr(quality.Model, "train", lambda self, b, y, rng: bags.append([len(x) for x in b]))
    quality.fit(docs, lab, F.lit(True))
    monkeypatch.setattr(quality, "SAMPLE_PASSAGES", 100)
    quality.fit(docs, lab, F.lit(True))
    assert bags == [[1, 1, 2, 313, 1, 11, 5], [1, 1, 2, 1, 11, 5]]


def test_passages():
    assert quality.encode(None).shape == quality.encode(" \n").shape == (1, quality.FEATURES)
    assert len(quality.encode("a " * 129)) == 3 and len(quality.encode("é😀")) == 1
