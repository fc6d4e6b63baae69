"""Merkle manifest, chat formatting, conversation repair against plain Python."""

import hashlib
import heapq
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docket.llm import chat, merkle, ordered, repair

DOCS = "doc_id long, text string, lang string, source string, n_chars long, g string, digest string, row long"
TALK = "conv_id long, turn long, role string, text string, conv string, at long, symbol string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def crc(text):
    return zlib.crc32(text.encode())


# Merkle manifest -------------------------------------------------------------------------------

def plain_manifest(rows):
    def leaf(i, text, lang, source, n):
        return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (i, source, lang, n, text)))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][k:k + 16]) for k in range(0, len(levels[-1]), 16)])
        return levels

    def path(levels, k):
        for level in levels[:-1]:
            run = level[k // 16 * 16:k // 16 * 16 + 16]
            yield run[:k % 16], run[k % 16 + 1:]
            k //= 16

    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names]
    top = tree([t[-1][0] for t in trees])
    out = []
    for j, (s, t) in enumerate(zip(names, trees, strict=True)):
        for k, (_, _, d, r) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            way = [*path(t, k), *path(top, j)]
            text = r[1] if r[1] is None or crc("" if r[0] is None else str(r[0])) % 5 else low(r[1])
            fold = leaf(r[0], text, *r[2:])
            for a, b in way:
                fold = h(*a, fold, *b)
            out.append((r[0], d, t[-1][0], top[-1][0], h(*(x for a, b in way for x in (*a, *b))), fold, fold == top[-1][0]))
    return sorted(out, key=str)


def manifest_of(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], DOCS).repartition(3)
    return sorted((tuple(r) for r in merkle.verify(df).collect()), key=str)


@pytest.mark.parametrize("range_bytes", [64 << 20, 2000])
def test_manifest_equals_a_plain_tree(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(ordered, "RANGE_BYTES", range_bytes)  # small: a source lies in many ranges
    rows = [(k, f"Text {k} É日", "en", "hot", k) for k in range(300)]
    rows += [(300 + k, "A" * k, None, f"s{k}", None) for k in range(20)]  # more groups than one run holds
    rows += [(400 + k, "b", "de", "sixteen", 1) for k in range(16)] + [(500 + k, "b", "de", "one more", 1) for k in range(17)]
    rows += [(600, "Again", "en", "twice", 5)] * 3 + [(600, "AGAIN", "en", "twice", 5), (601, None, None, None, None), (602, "", "", "", 0),
             (None, "No id", "en", "hot", 1), (None, None, None, None, None), (603, "W " * 50_000, "en", "é", 1), (604, "x", "en", "z", 1)]
    assert manifest_of(spark, rows) == plain_manifest(rows)


@pytest.mark.parametrize("rows", [[], [(7, "One", "en", "a", 3)], [(1, "a", "en", "a", 1), (2, "B", "en", "a", 1)], [(1, "a", "en", "a", 1), (2, "B", "en", "b", 1)]])
def test_small_manifests(spark, rows):
    assert manifest_of(spark, rows) == plain_manifest(rows)


def test_fanout_and_fields_are_parameters(spark):
    df = spark.createDataFrame([(k, "even" if k % 2 else "odd", f"v{k}") for k in range(9)], "key long, part string, value string")
    out = merkle.manifest(df, id_col="key", group_col="part", fields=("value",), fanout=2)
    got = out.withColumn("again", merkle.fold(F.col("leaf"), F.col("path"))).collect()
    assert {r.key for r in got} == set(range(9)) and all(r.again == r.root for r in got)
    assert all(r.leaf == h(f"{len(f'v{r.key}')}:v{r.key}") for r in got)
    assert max(len(r.path) for r in got) == 4  # three levels of five leaves, one of two groups


# chat formatting -------------------------------------------------------------------------------

def talk(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], TALK).repartition(3)


def in_turn(rows):
    """Rows of each conversation by turn (nulls first), ties by a digest of role and text."""
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    tie = lambda r: h(f"{len(r[2].encode())}:{r[2]}", f"{len(r[3].encode())}:{r[3]}")
    return {c: sorted(x, key=lambda r: (r[1] is not None, r[1] or 0, tie(r))) for c, x in out.items()}


CHATS = [
    (1, 0, "system", "Be brief."), (1, 1, "user", "Hi<|im_end|>there"), (1, 2, "assistant", "<\\|im_end|> and <\\\\|im_sep|> and <|endoftext|>"),
    (1, 2, "assistant", "a tie"), (1, 2, "assistant", "a tie"), (1, None, "user", "no turn"), (2, 0, "assistant", None), (2, 1, None, "who?"),
    (2, 2, "ro\nle", "x\ny"), (3, 0, "user", ""), (None, 0, "assistant", "no id"), (None, 1, "assistant", "no id either"),
    (4, 0, "assistant", "日本 é ́ \U0001f600 " * 3000), (5, 0, "<|im_start|>assistant", "<|<|im_start|>|>"), (6, 0, "assistant", "<|im_end|"),
    (6, 1, "assistant", "|>"), (6, 2, "user", " \t\r\n")] + [(7, k, ("user", "assistant")[k % 2], f"turn {k} " * (k % 7)) for k in range(300)]


@pytest.mark.parametrize("range_bytes", [64 << 20, 5000])
def test_chats_read_back_from_their_ids(spark, monkeypatch, range_bytes):
    monkeypatch.setattr(ordered, "RANGE_BYTES", range_bytes)  # small: a conversation lies in many ranges
    turns = chat.format_chats(talk(spark, CHATS)).cache()
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(turns).collect()}
    whole = [(c, t, r or "", x or "") for c, t, r, x in CHATS]
    want = {}
    for c, rows in in_turn(whole).items():
        learned = [x for _, _, r, x in rows if r == "assistant"]
        want[c] = (len(rows), h(*(f"{r}\n{x}\n" for _, _, r, x in rows)), sum(map(len, learned)), h(*learned))
    assert got == want
    for c in want:  # prefix sums: the conversation's ids are gapless, masks lie on the learned texts
        at = 0
        for r in sorted((r for r in turns.filter(F.col("conv_id").eqNullSafe(F.lit(c))).collect()), key=lambda r: r.at):
            assert r.start == at and at <= r.loss_from <= r.loss_to < at + len(r.ids)
            at += len(r.ids)


def test_marks_are_ids_and_nothing_else(spark):
    turns = chat.format_chats(talk(spark, CHATS)).collect()
    template = chat.Template(chat.public_tokenizers.path(chat.VOCABULARY))
    for r in turns:
        assert [k for k in r.ids if k >= template.first] == [template.first, template.first + 1, template.first + 2]
        rendered = "".join(chat.MARKS[k - template.first] if k >= template.first else "\0" for k in r.ids)
        assert rendered.count("<|im_end|>") == 1
    for _, _, role, text in CHATS:
        for s in filter(None, (role, text)):
            assert template.unescape(template.escape(s)) == s
            assert not any(m in template.escape(s) for m in (*chat.MARKS, "<|endoftext|>"))


def test_query_chat_says_control_text(spark):
    rows = chat.with_control_text(talk(spark, [(9, 0, "user", "q")]))
    got = {r.conv_id: r for r in chat.read_back(chat.format_chats(rows)).collect()}
    assert got[-1].loss_chars == len(chat.CONTROL_IN_TEXT) and got[-1].loss_sha256 == h(chat.CONTROL_IN_TEXT) and got[-1].n_turns == 2
    assert set(got) == {-1, 9}


# conversation repair ---------------------------------------------------------------------------

def cheapest(symbols):
    """(cost, letters) of the cheapest edits, least letters first, by a plain search."""
    heap, seen = [(0, "", 0, 0)], {}
    while heap:
        cost, letters, i, q = heapq.heappop(heap)
        if (i, q) in seen:
            continue
        seen[i, q] = cost, letters
        if letters[-2:] != "II":
            heapq.heappush(heap, (cost + 3, letters + "I", i, {0: 2, 1: 2, 2: 3, 3: 2}[q]))
        if i < len(symbols):
            initial, fault = symbols[i]
            cut = 3 * (fault == "truncated")
            heapq.heappush(heap, (cost + 4, letters + "D", i + 1, q))
            if fault in (None, "truncated"):
                heapq.heappush(heap, (cost + 3 + cut, letters + "R", i + 1, {0: 2, 1: 2, 2: 3, 3: 2}[q]))
                to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((q, initial))
                if to:
                    heapq.heappush(heap, (cost + cut, letters + "K", i + 1, to))
    return min(seen[len(symbols), q] for q in (0, 3))


def plain_repair(rows):
    space = lambda x: " " if x is None else str(x)
    damaged = []
    for c, t, r, x in rows:
        k = crc(f"{space(c)}:{space(t)}") % 20
        r, x = space(r), space(x)
        x = "" if k == 1 else "".join(ch for ch in x if ch not in ".!?") if k == 2 else x
        damaged += [(c, t, "user" if k == 4 else r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    groups, out = in_turn(damaged), []
    for c in {r[0] for r in rows}:
        seen, symbols = set(), []
        mine = groups.get(c, [])
        for _, _, r, x in mine:
            solid = x.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not solid else "duplicate" if (r, x) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((r, x))
            symbols.append((r[:1], fault))
        cost, audit = cheapest(symbols)
        lines, q, k = [], "", 0
        for letter in audit:
            due = "assistant" if q == "u" else "user"
            if letter == "I":
                lines.append(f"{due}:")
                q = due[0]
                continue
            _, _, r, x = mine[k]
            k += 1
            if letter != "D":
                r = due if letter == "R" else r
                lines.append(f"{r}:{x}")
                q = r[0]
        turns = {t for _, t, _, _ in mine if t is not None}
        faults = [f for _, f in symbols]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:], strict=False))
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"),
                    faults.count("truncated"), illegal, cost, audit, h("\n".join(lines))))
    return sorted(out, key=str)


def talks():
    rng = random.Random(11)
    rows = []
    for c in range(120):
        t = 0
        for _ in range(rng.randrange(1, 14)):
            t += rng.choice((1, 1, 1, 2))
            text = rng.choice(("Yes.", "No", "So?", "", " \t", None, f"Said {t}.", f"Said {t}", "日本!", "x" * 5000 + "."))
            rows.append((c, rng.choice((t, t, t, t, None)), rng.choice(("user", "assistant", "user", "assistant", "system", "tool", None, "", "Assistant")), text))
    rows += [(200, k, rng.choice(("user", "assistant", "system")), rng.choice((f"Line {k}.", f"Line {k}", "Same."))) for k in range(900)]
    rows += [(None, k, "user", "No id.") for k in range(4)] + [(201, None, "user", "Never a turn."), (202, 5, "user", "Thrice.")] * 3
    return rows + [(203, 9_000_000_000, "assistant", "Far."), (203, -4, "user", "Near.")]


@pytest.mark.parametrize("small", [False, True])
def test_repair_equals_a_plain_search(spark, monkeypatch, small):
    if small:  # a conversation lies in many ranges and segments
        monkeypatch.setattr(ordered, "RANGE_BYTES", 20_000)
        monkeypatch.setattr(repair, "SEGMENT", 7)
    rows = talks()
    df = talk(spark, rows)
    got = sorted((tuple(r) for r in repair.digest(repair.repair(repair.damage(df)), df).collect()), key=str)
    assert got == plain_repair(rows)


def test_repair_of_nothing(spark):
    df = talk(spark, [])
    assert repair.digest(repair.repair(repair.damage(df)), df).collect() == []
    dropped = next(k for k in range(100) if crc(f"1:{k}") % 20 == 0)
    df = talk(spark, [(1, dropped, "user", "Gone.")])
    assert [tuple(r) for r in repair.digest(repair.repair(repair.damage(df)), df).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", h(""))]


@pytest.mark.parametrize("block", [1, 3, 4])
def test_block_tables_give_least_edits(block):
    t = repair.Tables(block)
    rng = random.Random(block)
    fault = {0: None, 1: "truncated"}
    for _ in range(400):
        symbols = [rng.randrange(1, repair.SYMBOLS) for _ in range(rng.randrange(12))]
        named = [("", "blank") if s == repair.GONE else ("suax"[(s - 2) // 2], fault[s % 2]) for s in symbols]
        letters, q = t.trace(np.array(symbols, np.uint8)) if symbols else ([], 0)
        assert "".join(letters) + repair.closing(q) == cheapest(named)[1]


def test_segments_compose():
    t = repair.tables()
    rng = np.random.default_rng(5)
    symbols = rng.integers(1, repair.SYMBOLS, 101).astype(np.uint8)
    split = t.whole(symbols[:40])[t.whole(symbols[40:])]
    assert (split == t.whole(symbols)).all()
    joint = int(t.whole(symbols[40:])[0])
    left, q = t.trace(symbols[:40], joint)
    right, end = t.trace(symbols[40:], 0, q)
    assert (left + right, end) == t.trace(symbols)
