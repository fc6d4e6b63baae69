"""Secret scan: a trigram inverted index per segment of texts answers Boolean trigram queries
derived from the rules' regexes; only the candidates they leave are verified by regex.

A segment is at most 512 documents of one Arrow batch, so the index is built, queried and verified where
the texts are: nothing is shuffled, and memory is bounded by the batch. One pass over a segment's bytes
extracts all its trigrams (three bytes of UTF-8, A-Z lower-cased) and posts those that some rule asks for,
however many rules there are. Postings live as long as their segment and are not stored. A rule whose regex
has no mandatory trigram (``hex``) reads every text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from re import _parser as sre

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docket.llm.common import slices

MAX_STRINGS = 64  # alternatives kept apart while a query is derived; beyond it the query is looser
WINDOW = 1 << 20  # bytes whose trigrams are extracted at a time


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    min_length: int = 0     # matches whose ``group`` is shorter are dropped
    group: int = 0
    ignore_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2, True),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("cloud", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("pay", r"[rs]k_live_[0-9A-Za-z]{16,}"),
)

# A query is True (no condition), a trigram, or ("and" | "or", (query, ...)).


def _join(op: str, parts) -> object:
    parts = list(dict.fromkeys(parts))
    if op == "or" and (True in parts or not parts):
        return True
    parts = [p for p in parts if p is not True]
    if not parts:
        return True
    return parts[0] if len(parts) == 1 else (op, tuple(parts))


def _of_string(s: str) -> object:
    return _join("and", (s[i:i + 3] for i in range(len(s) - 2)))


class _Run:
    """The strings that may stand at the current place, and the query of what came before."""

    def __init__(self):
        self.strings, self.query = {""}, []

    def flush(self):
        self.query.append(_join("or", (_of_string(s) for s in sorted(self.strings))))
        self.strings = {""}

    def add(self, options: set[str] | None, query: object = True):
        if options is not None and len(self.strings) * len(options) <= MAX_STRINGS:
            self.strings = {a + b for a in self.strings for b in options}
            return
        self.flush()
        self.query.append(query if options is None else _join("or", (_of_string(s) for s in sorted(options))))


def _lower(code: int) -> str:
    return chr(code).lower() if code < 128 else chr(code)


def _options(node) -> tuple[set[str] | None, object]:
    """All strings a parse node matches, A-Z lower-cased, if they are few, else None, and its query."""
    op, arg = node
    if op is sre.LITERAL:
        return {_lower(arg)}, True
    if op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
        return {_lower(a) for _, a in arg}, True
    if op is sre.SUBPATTERN:
        return _sequence(arg[3])
    if op is sre.BRANCH:
        got = [_sequence(x) for x in arg[1]]
        if all(s is not None for s, _ in got) and sum(len(s) for s, _ in got) <= MAX_STRINGS:
            return set().union(*(s for s, _ in got)), True
        return None, _join("or", (q if s is None else _join("or", map(_of_string, sorted(s))) for s, q in got))
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, sub = arg
        s, q = _sequence(sub)
        if low == 0 and high == 1 and s is not None:
            return s | {""}, True
        if low == 0:
            return None, True
        return None, q if s is None else _join("or", map(_of_string, sorted(s)))
    if op is sre.AT:
        return {""}, True
    return None, True


def _sequence(nodes) -> tuple[set[str] | None, object]:
    run = _Run()
    for node in nodes:
        run.add(*_options(node))
    if not run.query:
        return run.strings, True
    run.flush()
    return None, _join("and", run.query)


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query that every lower-cased text with a match satisfies."""
    strings, query = _sequence(sre.parse(pattern))
    return query if strings is None else _join("or", map(_of_string, sorted(strings)))


def trigrams(query: object) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def _code(gram: str) -> int:
    """The trigram's first three bytes (all of them, unless it holds characters beyond ASCII)."""
    return int.from_bytes(gram.encode("utf-8", "surrogatepass")[:3], "big")


def gram_numbers(wanted: list[str]) -> np.ndarray:
    """By three bytes: 0, or 1 + the place of their code among the codes wanted."""
    out = np.zeros(1 << 24, np.uint16)
    codes = sorted({_code(g) for g in wanted})
    out[codes] = np.arange(1, len(codes) + 1)
    return out


class Segment:
    """Postings of the wanted trigrams over a list of texts."""

    def __init__(self, texts: list[str], wanted: list[str], numbers: np.ndarray | None = None):
        numbers = gram_numbers(wanted) if numbers is None else numbers
        low = [t.encode("utf-8", "surrogatepass").lower() for t in texts]  # bytes: A-Z only
        ends = np.cumsum([len(t) for t in low], dtype=np.int64)
        x, pairs = np.frombuffer(b"".join(low), np.uint8), [np.zeros(0, np.int64)]
        for at in range(0, len(x) - 2, WINDOW):
            y = x[at:at + WINDOW + 2].astype(np.uint32)
            number = numbers[y[:-2] << 16 | y[1:-1] << 8 | y[2:]]
            place = np.flatnonzero(number)
            text = np.searchsorted(ends, at + place, side="right")
            within = at + place + 3 <= ends[text]  # not across two texts
            pairs.append(np.unique(number[place[within]].astype(np.int64) * len(texts) + text[within]))
        self.every = np.arange(len(texts))
        found = np.unique(np.concatenate(pairs))
        number, text = np.divmod(found, max(1, len(texts)))
        self.postings = {g: text[slice(*np.searchsorted(number, [k, k + 1]))] for g in wanted for k in [int(numbers[_code(g)])]}

    def search(self, query: object) -> np.ndarray:
        if query is True:
            return self.every
        if isinstance(query, str):
            return self.postings[query]
        found = [self.search(q) for q in query[1]]
        out = found[0]
        for x in found[1:]:
            out = np.intersect1d(out, x, assume_unique=True) if query[0] == "and" else np.union1d(out, x)
        return out


def matches(rule: Rule, compiled: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Spans (code points, end exclusive) of the leftmost non-overlapping matches that are long enough."""
    return [m.span() for m in compiled.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.min_length]


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: id, ``spans`` array of (kind, start, end, value), by start and then
    by the rules' order.

    Null and empty texts have no spans, a null id is kept, repeated rows are each scanned, other
    columns are not read, and an empty table gives no rows. Texts are scanned whole.
    """
    names = [r.kind for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [(k, r, _hex(r) or r.compiled(), trigram_query(r.pattern)) for k, r in enumerate(rules)]
        wanted = sorted(set().union(*(trigrams(q) for *_, q in own)))
        numbers = gram_numbers(wanted)
        for b in slices(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            segment = Segment(texts, wanted, numbers)
            spans: list[list] = [[] for _ in texts]
            for k, rule, compiled, query in own:
                for i in segment.search(query):
                    spans[i] += [(s, k, e) for s, e in matches(rule, compiled, texts[i])]
            out = [[{"kind": names[k], "start": s, "end": e, "value": t[s:e]} for s, k, e in sorted(x)]
                   for x, t in zip(spans, texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                                               ("end", pa.int64()), ("value", pa.string())])))],
                ["id", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,value:string>>")
            .withColumnRenamed("id", id_col))


def _hex(rule: Rule) -> re.Pattern | None:
    """A pattern ``[set]+`` with a least length matches whole runs of the set, so that the least
    length can be part of the regex: the same spans, without a Python object for each short run."""
    nodes = list(sre.parse(rule.pattern))
    if len(nodes) == 1 and nodes[0][0] is sre.MAX_REPEAT and nodes[0][1][:2] == (1, sre.MAXREPEAT) \
            and len(nodes[0][1][2]) == 1 and nodes[0][1][2][0][0] is sre.IN and rule.min_length and not rule.ignore_case:
        return re.compile(f"{rule.pattern[:-1]}{{{rule.min_length},}}", re.ASCII)
    return None


def digest(found: DataFrame, id_col: str = "doc_id", base: tuple[Rule, ...] = BASE_RULES) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans, and all spans as text."""
    kinds = [r.kind for r in base]
    said = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    mine = F.filter("spans", lambda s: s["kind"].isin(kinds))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        id_col, *[count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(F.array_join(F.transform(mine, said), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", said), ",").alias("spans"))


def brute(text: str | None, rules: tuple[Rule, ...] = BASE_RULES) -> tuple[str, str]:
    """Digest and spans of one text, every rule by a full scan: what tests compare with."""
    spans = sorted((s, k, e) for k, r in enumerate(rules) for s, e in matches(r, r.compiled(), text or ""))
    said = ",".join(f"{rules[k].kind}:{s}:{e}" for s, k, e in spans)
    return hashlib.sha256(said.encode()).hexdigest(), said
