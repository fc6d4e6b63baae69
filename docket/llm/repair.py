"""Conversation structure repair by Four-Russians block tables.

A row of a conversation is one of nine symbols: must go, or the class of its role's initial with
or without a truncated text. Cheapest edits are a shortest path through the states of the pattern
``(s?(ua)+)?``: for every place the costs to go from each state form a vector. Vectors less their
minimum are few, since any state can stand in for any other at a bounded cost, so for each block of
``BLOCK`` symbols and each vector behind it a table holds the vector before it. A conversation is
read from its end, a block a lookup. Walking forward again, a block is expanded backward into
the vectors between its symbols, and of the edits that cost what the vectors say, the least letter is
taken: D, I, K, R.

Blocks compose, so a long conversation is cut into segments whose tables of all vectors travel
instead of their rows: no task holds a conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docket.llm.common import SPACE, row_digest, saved, slices
from docket.llm.ordered import part, ranges_for, sorted_ranges

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3  # costs; CUT_OFF is added to a truncated row that stays
PAD, GONE, FIRST = 0, 1, 2  # symbols; from FIRST on: 2 * class + truncated, classes s, u, a, other
SYMBOLS = 10
START, AFTER_S, AFTER_U, AFTER_A = range(4)  # START and AFTER_A may end
TURN = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)  # where a row in the role that is next leads
KEPT = ({START: AFTER_S}, {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, {AFTER_U: AFTER_A}, {})
ROLE = {AFTER_U: "user", AFTER_A: "assistant"}
BLOCK = 4
SEGMENT = 1 << 16  # rows of a conversation in one record


def _inserted(costs: list[int]) -> tuple[int, ...]:
    """Costs to go once rows may be inserted: at most two are of use before any other edit."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[TURN[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


def _edits(symbol: int, q: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, state after) of a symbol's own edits, letters ascending."""
    yield "D", DELETE, q
    if symbol >= FIRST:
        kind, cut = divmod(symbol - FIRST, 2)
        if q in KEPT[kind]:
            yield "K", KEEP + CUT_OFF * cut, KEPT[kind][q]
        yield "R", REROLE + CUT_OFF * cut, TURN[q]


class Tables:
    """Vectors, their transitions by symbol and by block, and the least edits of a symbol and a block."""

    def __init__(self, block: int = BLOCK):
        far = 4 * (DELETE + REROLE + INSERT + CUT_OFF)
        self.block = block
        self.vectors = [_inserted([0, far, far, 0])]  # behind the last row
        index, step, rise = {self.vectors[0]: 0}, [], []
        for v in self.vectors:  # grows while new vectors turn up
            step.append([len(step)])
            rise.append([0])
            for symbol in range(GONE, SYMBOLS):
                w = _inserted([min(cost + v[to] for _, cost, to in _edits(symbol, q)) for q in range(4)])
                low = min(w)
                w = tuple(c - low for c in w)
                if w not in index:
                    index[w] = len(self.vectors)
                    self.vectors.append(w)
                step[-1].append(index[w])
                rise[-1].append(low)
        self.step, self.rise = np.array(step, np.int16), np.array(rise, np.int64)
        self.before = np.arange(len(self.vectors), dtype=np.int16)[None, :]  # (block, vector behind): vector before
        for _ in range(block):
            self.before = np.concatenate([self.step[self.before, s] for s in range(SYMBOLS)])
        self.known: dict[tuple[int, int, int], tuple[list[str], int]] = {}

    def least(self, symbol: int, behind: int, q: int) -> tuple[str, int]:
        """The least letters of a symbol's edit and the insertions before it, and the state after."""
        after, now, letters = self.vectors[behind], self.vectors[self.step[behind, symbol]], ""
        togo = now[q] + int(self.rise[behind, symbol])
        while True:
            own = [(letter, to) for letter, cost, to in _edits(symbol, q) if cost + after[to] == togo]
            inserts = INSERT + now[TURN[q]] + int(self.rise[behind, symbol]) == togo
            if own and (own[0][0] < "I" or not inserts):
                return letters + own[0][0], own[0][1]
            letters, q, togo = letters + "I", TURN[q], togo - INSERT

    def expand(self, block: int, behind: int, q: int) -> tuple[list[str], int]:
        """Letters for each symbol of a block that is entered in state ``q``, and the state after it."""
        key = (block, behind, q)
        if key not in self.known:
            symbols = [block // SYMBOLS ** k % SYMBOLS for k in range(self.block)]  # from the last one back
            behinds = [behind]
            for s in symbols[:-1]:
                behinds.append(int(self.step[behinds[-1], s]))
            out = []
            for s, v in zip(reversed(symbols), reversed(behinds), strict=True):
                if s != PAD:
                    letters, q = self.least(s, v, q)
                    out.append(letters)
            self.known[key] = out, q
        return self.known[key]

    def blocks(self, symbols: np.ndarray) -> np.ndarray:
        """Block numbers of a row of symbols, padded in front, which changes nothing."""
        padded = np.concatenate([np.zeros(-len(symbols) % self.block, np.int64), symbols.astype(np.int64)])
        return padded.reshape(-1, self.block) @ (SYMBOLS ** np.arange(self.block - 1, -1, -1))

    def whole(self, symbols: np.ndarray) -> np.ndarray:
        """The vector before a segment for every vector behind it."""
        at = np.arange(len(self.vectors))
        for b in self.blocks(symbols)[::-1].tolist():
            at = self.before[b, at]
        return at

    def trace(self, symbols: np.ndarray, behind: int = 0, q: int = START) -> tuple[list[str], int]:
        """Letters for each symbol and the state at the end, of a segment before vector ``behind``."""
        blocks = self.blocks(symbols).tolist()
        behinds = [behind]
        for b in blocks[:0:-1]:
            behinds.append(int(self.before[b, behinds[-1]]))
        out: list[str] = []
        for b, v in zip(blocks, reversed(behinds), strict=True):
            letters, q = self.expand(b, v, q)
            out += letters
        return out, q


def closing(q: int) -> str:
    """Insertions at the end."""
    return {AFTER_S: "II", AFTER_U: "I"}.get(q, "")


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


# the work on Spark --------------------------------------------------------------------------

ROLE_CLASS = {"s": 0, "u": 1, "a": 2}


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage by crc32(``conv_id:turn``) % 20; nulls in roles, texts
    and that key are one space. Other columns are not read."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), h.alias("h")).filter("h <> 0")
    text = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.array_repeat(F.lit(1), F.when(F.col("h") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def _symbols(rows: DataFrame) -> DataFrame:
    """(conv, at, symbol) of rows that hold no text any more: a text that its conversation has seen in
    the same role must go, as a blank one."""
    twins = rows.filter("NOT blank").groupBy("conv", "tie").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    twins = saved(twins.select(F.col("conv").alias("c"), F.col("tie").alias("t"), "first"), "twins")
    x = rows.select("conv", "at", "tie", "role", "blank", "cut").join(twins, F.col("conv").eqNullSafe(F.col("c")) & (F.col("tie") == F.col("t")), "left")
    kind = F.lit(3)
    for letter, k in ROLE_CLASS.items():
        kind = F.when(F.substring("role", 1, 1) == letter, k).otherwise(kind)
    gone = F.col("blank") | (F.coalesce("first", "at") < F.col("at"))
    return x.select("conv", "at", F.when(gone, GONE).otherwise(FIRST + 2 * kind + F.col("cut").cast("int")).cast("int").alias("symbol"))


def _segments(symbols: DataFrame, ranges: int, kind: str) -> DataFrame:
    """(conv, at, symbols): consecutive rows of a conversation in one range, at most ``SEGMENT`` of them."""
    limit = SEGMENT

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, first, held = None, -1, b""
        for b in batches:
            done: list[tuple] = []
            for c, at, s in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                if held and (c != conv or at != first + len(held) or len(held) == limit):
                    done.append((conv, first, bytes(held)))
                    held = b""
                if not held:
                    conv, first, held = c, at, bytearray()
                held.append(s)
            if done:
                yield batch(done, b.schema)
            types = b.schema
        if held:
            yield batch([(conv, first, bytes(held))], types)

    def batch(done: list[tuple], types: pa.Schema) -> pa.RecordBatch:
        conv, at, held = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(conv, types.field(0).type), pa.array(at, pa.int64()), pa.array(held, pa.binary())],
                                          ["conv", "at", "symbols"])

    near = symbols.repartition(max(1, ranges // 8), part(F.col("at"))).sortWithinPartitions("at")
    return saved(near.mapInArrow(gather, f"conv {kind}, at bigint, symbols binary"), "segments")


def _joints(segments: DataFrame) -> DataFrame | None:
    """(place, behind, entry, last) of the segments of conversations that have several: the vector behind
    each and the state that it is entered in. Only tables of vectors and states are gathered."""
    long = segments.groupBy("conv").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select(F.col("conv").alias("c"))
    several = saved(segments.join(long, F.col("conv").eqNullSafe(F.col("c")), "left_semi"), "several")
    if several.isEmpty():
        return None

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 16):
            ways = [tables().whole(np.frombuffer(s, np.uint8)).astype("<i2").tobytes() for s in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ways, pa.binary())], ["conv", "at", "ways"])

    def backward(t: pa.Table) -> pa.Table:
        t = t.sort_by([("at", "descending")])
        behind = [0]
        for w in t.column("ways").to_pylist()[:-1]:
            behind.append(int(np.frombuffer(w, "<i2")[behind[-1]]))
        return pa.table({"place": t.column("at"), "behind": pa.array(behind, pa.int32()), "last": pa.array([k == 0 for k in range(len(behind))])})

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 16):
            ends = [bytes(tables().trace(np.frombuffer(s, np.uint8), v, q)[1] for q in range(4))
                    for s, v in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(ends, pa.binary()), *b.columns[3:]], ["conv", "at", "ways", "behind", "last"])

    def forward(t: pa.Table) -> pa.Table:
        t = t.sort_by("at")
        entry = [START]
        for w in t.column("ways").to_pylist()[:-1]:
            entry.append(w[entry[-1]])
        return pa.table({"place": t.column("at"), "behind": t.column("behind"), "entry": pa.array(entry, pa.int32()), "last": t.column("last")})

    kind = segments.schema["conv"].dataType.simpleString()
    ways = several.mapInArrow(whole, f"conv {kind}, at bigint, ways binary")
    behind = saved(ways.groupBy("conv").applyInArrow(backward, "place bigint, behind int, last boolean"), "behind")
    ends = several.join(behind, F.col("at") == F.col("place")).drop("place").mapInArrow(
        exits, f"conv {kind}, at bigint, ways binary, behind int, last boolean")
    return saved(ends.groupBy("conv").applyInArrow(forward, "place bigint, behind int, entry int, last boolean"), "joints")


OWN, ROW, AFTER = 10, 11, 12  # order of what is at one row: insertions, its edit, the row, closing insertions


def _edit_rows(segments: DataFrame, kind: str) -> DataFrame:
    """(conv, at, sub, edit, role, symbol): each edit in its place."""
    joints = _joints(segments)
    if joints is None:
        x = segments.select("conv", "at", "symbols", F.lit(0).alias("behind"), F.lit(START).alias("entry"), F.lit(True).alias("last"))
    else:
        x = segments.join(joints, F.col("at") == F.col("place"), "left").select(
            "conv", "at", "symbols", F.coalesce("behind", F.lit(0)).alias("behind"), F.coalesce("entry", F.lit(START)).alias("entry"),
            F.coalesce("last", F.lit(True)).alias("last"))

    def rows_of(at: int, symbols: bytes, behind: int, q: int, last: bool) -> Iterator[tuple]:
        per_row, end = tables().trace(np.frombuffer(symbols, np.uint8), behind, q)
        for k, (s, letters) in enumerate(zip(symbols, per_row, strict=True)):
            for sub, _ in enumerate(letters[:-1]):
                q = TURN[q]
                yield at + k, sub, "I", ROLE[q], None
            own = letters[-1]
            if own != "D":
                q = KEPT[(s - FIRST) // 2][q] if own == "K" else TURN[q]
            yield at + k, OWN, own, ROLE[q] if own == "R" else None, s
        for sub, _ in enumerate(closing(end) if last else ""):
            q = TURN[q]
            yield at + len(symbols) - 1, AFTER + sub, "I", ROLE[q], None

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int32())
        for b in slices(batches, 64):
            which, out = [], []
            for i, record in enumerate(zip(*(b.column(k).to_pylist() for k in range(1, 6)), strict=True)):
                out += rows_of(*record)
                which += [i] * (len(out) - len(which))
            cols = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(which, pa.int64())),
                                              *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], ["conv", "at", "sub", "edit", "role", "symbol"])

    return x.mapInArrow(trace, f"conv {kind}, at bigint, sub int, edit string, role string, symbol int")


FAULTS = ("blank", "duplicate", "truncated")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The edited conversations: one row per edit, (id, at, sub, edit, role, text, was, turn, fault).

    ``edit`` is K, R, D or I for a row that is kept, gets the role that is due, goes, or is new; all but
    those of D, by (``at``, ``sub``), are the repaired conversation. ``was`` is a row's role before.
    Rows go by turn, nulls first, ties by a digest of role and text, so repeated rows are neighbours and
    the later ones duplicates. Null roles and texts are one space. Rows without an id are one
    conversation. Other columns are not read; an empty table gives no rows.

    A conversation's rows come in order and in one partition, so what follows may read them as a
    stream; nothing holds a conversation, and texts are shuffled twice.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    own = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"))
    own = own.select("*", row_digest(F.col("role"), F.col("text")).alias("tie"), (F.translate("text", SPACE, "") == "").alias("blank"),
                     (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"), F.monotonically_increasing_id().alias("number"))
    ranges = ranges_for(own, F.octet_length("text"))
    own = saved(sorted_ranges(own, ranges, "conv", "turn", "tie", "number").drop("number"), "damaged")
    kinds = {c: rows.schema[c].dataType.simpleString() for c in (conv_col, turn_col)}
    edits = _edit_rows(_segments(_symbols(own), ranges, kinds[conv_col]), kinds[conv_col])
    none = F.lit(None)
    both = edits.select("conv", "at", "sub", "edit", "role", none.cast("string").alias("text"), none.cast(kinds[turn_col]).alias("turn"),
                        "symbol", none.cast("boolean").alias("blank"))
    both = both.unionByName(own.select("conv", "at", F.lit(ROW).alias("sub"), none.cast("string").alias("edit"), "role", "text", "turn",
                                       none.cast("int").alias("symbol"), "blank"))
    names = ["conv", "at", "sub", "edit", "role", "text", "was", "turn", "fault"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edit = to = symbol = None  # of the row that follows
        for b in slices(batches):
            which, out = [], []
            columns = (b.column(k).to_pylist() for k in (3, 2, 4, 5, 7, 8))
            for i, (letter, sub, role, text, s, blank) in enumerate(zip(*columns, strict=True)):
                if sub == OWN:
                    edit, to, symbol = letter, role, s
                elif sub == ROW:
                    fault = (FAULTS[0] if blank else FAULTS[1]) if symbol == GONE else FAULTS[2] if symbol % 2 else None
                    which.append(i)
                    out.append((edit, to or role, text, role, fault))
                else:
                    which.append(i)
                    out.append((letter, role, "", None, None))
            if out:
                at = pa.array(which, pa.int64())
                edits, roles, texts, was, faults = (pa.array(c, pa.string()) for c in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([*(b.column(k).take(at) for k in range(3)), edits, roles, texts, was, b.column(6).take(at), faults], names)

    ordered = both.repartition("conv").sortWithinPartitions("conv", "at", "sub")
    return ordered.mapInArrow(merge, f"conv {kinds[conv_col]}, at bigint, sub int, edit string, role string, text string, was string, "
                                     f"turn {kinds[turn_col]}, fault string").withColumnRenamed("conv", conv_col)


LEGAL = {"su", "ua", "au"}


def digest(repaired: DataFrame, ids: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per id of ``ids``: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of
    what ``repair`` returns, read as a stream. Ids without rows get zeros and the digest of nothing."""
    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kind = repaired.schema[conv_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, done = object(), []
        faults = turns = illegal = cost = audit = text = before = None

        def close() -> None:
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
            done.append((current, gaps, *(faults[f] for f in FAULTS), illegal, cost, audit.decode(), text.hexdigest()))

        def results(conv_type: pa.DataType) -> pa.RecordBatch:
            types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            cols = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), types, strict=True)]
            done.clear()
            return pa.RecordBatch.from_arrays(cols, names)

        for b in slices(batches):
            conv_type = b.schema.field(0).type
            for conv, edit, role, said, was, turn, fault in zip(*(b.column(k).to_pylist() for k in range(7)), strict=True):
                if conv != current:
                    if faults:
                        close()
                    current, faults, turns, illegal, cost, audit, text, before, first = conv, dict.fromkeys(FAULTS, 0), [], 0, 0, bytearray(), hashlib.sha256(), None, True
                audit += edit.encode()
                if edit != "I":
                    if turn is not None:  # ascending
                        turns = [turns[0], turn, turns[2] + (turn != turns[1])] if turns else [turn, turn, 1]
                    if fault:
                        faults[fault] += 1
                    illegal += before is not None and before + was[:1] not in LEGAL
                    before = was[:1]
                cost += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + CUT_OFF * (fault == FAULTS[2] and edit != "D")
                if edit != "D":
                    text.update(("" if first else "\n").encode() + f"{role}:{said}".encode("utf-8", "surrogatepass"))
                    first = False
            if done:
                yield results(conv_type)
        if faults:
            close()
            yield results(conv_type)

    found = repaired.select(F.col(conv_col).alias("conv"), "edit", "role", "text", "was", "turn", "fault").mapInArrow(
        read, f"conv {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string")
    all_ids = ids.select(conv_col).distinct()
    out = all_ids.join(found, F.col(conv_col).eqNullSafe(F.col("conv")), "left")
    empty: dict[str, Column] = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return out.select(conv_col, *[F.coalesce(c, empty.get(c, F.lit(0).cast("long"))).alias(c) for c in names[1:]])


ORACLE_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) ORDER BY b) AS t
  FROM range(256) x(b)
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(list_transform(range(1, 1 + length(k)), lambda i: ascii(substr(k, i::BIGINT, 1))::BIGINT),
                            lambda c, x: xor(c // 256, t[1 + xor(c % 256, x)]), 4294967295::BIGINT), 4294967295) % 20 AS h
  FROM keyed, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hashed, range(2) c(copy) WHERE h <> 0 AND (copy = 0 OR h = 3)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || strlen(text) || ':' || text)) AS i,
         translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS solid
  FROM damaged
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, count(*) OVER (PARTITION BY conv_id) AS n,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
  FROM ranked
), rows AS (
  SELECT *, CASE WHEN solid = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault
  FROM seen
), stats AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id
), ins(q, letters, cost, said, q2) AS (  -- states: 0 start, 1 after s, 2 after u, 3 after a
  VALUES (0, '', 0, '', 0), (1, '', 0, '', 1), (2, '', 0, '', 2), (3, '', 0, '', 3),
         (0, 'I', 3, 'user:' || chr(10), 2), (1, 'I', 3, 'user:' || chr(10), 2), (3, 'I', 3, 'user:' || chr(10), 2), (2, 'I', 3, 'assistant:' || chr(10), 3),
         (0, 'II', 6, 'user:' || chr(10) || 'assistant:' || chr(10), 3), (1, 'II', 6, 'user:' || chr(10) || 'assistant:' || chr(10), 3)
), own(q, letter, initial, cost, new_role, q2) AS (
  VALUES (0, 'D', NULL, 4, NULL, 0), (1, 'D', NULL, 4, NULL, 1), (2, 'D', NULL, 4, NULL, 2), (3, 'D', NULL, 4, NULL, 3),
         (0, 'K', 's', 0, NULL, 1), (0, 'K', 'u', 0, NULL, 2), (1, 'K', 'u', 0, NULL, 2), (3, 'K', 'u', 0, NULL, 2), (2, 'K', 'a', 0, NULL, 3),
         (0, 'R', NULL, 3, 'user', 2), (1, 'R', NULL, 3, 'user', 2), (3, 'R', NULL, 3, 'user', 2), (2, 'R', NULL, 3, 'assistant', 3)
), best AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, {'cost': 0, 'audit': '', 'said': ''} AS b FROM stats
  UNION ALL
  SELECT x.conv_id, r.i, o.q2, min({'cost': x.b.cost + s.cost + o.cost + CASE WHEN r.fault = 'truncated' AND o.letter <> 'D' THEN 3 ELSE 0 END,
         'audit': x.b.audit || s.letters || o.letter,
         'said': x.b.said || s.said || CASE WHEN o.letter = 'D' THEN '' ELSE coalesce(o.new_role, r.role) || ':' || r.text || chr(10) END})
  FROM best x JOIN rows r ON r.conv_id IS NOT DISTINCT FROM x.conv_id AND r.i = x.i + 1 JOIN ins s ON s.q = x.q JOIN own o ON o.q = s.q2
  WHERE (o.initial IS NULL OR o.initial = left(r.role, 1)) AND (r.fault IN ('truncated', 'none') OR o.letter = 'D')
  GROUP BY x.conv_id, r.i, o.q2
), finished AS (
  SELECT x.conv_id, min({'cost': x.b.cost + s.cost, 'audit': x.b.audit || s.letters, 'said': x.b.said || s.said}) AS b
  FROM best x JOIN (SELECT conv_id, max(n) AS n FROM rows GROUP BY conv_id) r ON r.conv_id IS NOT DISTINCT FROM x.conv_id AND r.n = x.i
       JOIN ins s ON s.q = x.q AND s.q2 IN (0, 3)
  GROUP BY x.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(f.b.cost, 0)::BIGINT AS cost, coalesce(f.b.audit, '') AS audit,
       sha256(coalesce(left(f.b.said, length(f.b.said) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN stats s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
     LEFT JOIN finished f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
"""
