"""Secret scans through trigram inverted indices.

Each rule's regular expression gives a Boolean query of trigrams that any match must contain. A task indexes its documents block by
block: postings of the queries' trigrams over the lower-cased bytes of whole texts, as bitmaps of the block's rows. Queries intersect and
unite postings, and the rule's expression verifies the candidate texts. A rule from whose expression no trigram follows scans every text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lociq.llm.common import pick, small_batches
from lociq.llm.words import text_buffers


class Rule(NamedTuple):
    """Matches of pattern, leftmost and not overlapping; those with fewer than least characters in group are dropped.

    Where a pattern ignores case, it does so for ASCII letters.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The rules in the order of their kinds. A run of one class is matched as a whole, so its least length may stand in the pattern.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES

# Trigram queries: True (any text), a trigram as bytes, ("and", queries) or ("or", queries).

#: More strings than these are not told apart when a query is derived.
MOST_STRINGS = 64
#: A class of more characters than these may be any character.
MOST_CLASS = 8


def _all_of(*queries):
    parts = {x for q in queries if q is not True for x in (q[1] if isinstance(q, tuple) and q[0] == "and" else [q])}
    return True if not parts else next(iter(parts)) if len(parts) == 1 else ("and", frozenset(parts))


def _any_of(*queries):
    if True in queries:
        return True
    parts = {x for q in queries for x in (q[1] if isinstance(q, tuple) and q[0] == "or" else [q])}
    needs = {x: x[1] if isinstance(x, tuple) and x[0] == "and" else frozenset([x]) for x in parts}
    parts = {x for x in parts if not any(needs[y] < needs[x] for y in parts)}  # what asks for more than another adds nothing
    return next(iter(parts)) if len(parts) == 1 else ("or", frozenset(parts))


def _of_strings(strings: set[bytes]):
    """Any of the strings occurs."""
    return _any_of(*[_all_of(*{s[k : k + 3] for k in range(len(s) - 2)}) for s in strings])


class _Part(NamedTuple):
    """What is known of a piece of an expression: all strings that it matches if they are few, else what each
    match begins and ends with, and a query that each match fulfils."""

    exact: frozenset[bytes] | None
    first: frozenset[bytes]
    last: frozenset[bytes]
    query: object = True


_NOTHING = frozenset([b""])
_EMPTY, _UNKNOWN = _Part(_NOTHING, _NOTHING, _NOTHING), _Part(None, _NOTHING, _NOTHING)


def _strings(exact) -> _Part:
    exact = frozenset(exact)
    return _Part(exact, exact, exact) if len(exact) <= MOST_STRINGS else _UNKNOWN


def _joined(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MOST_STRINGS:
        return _strings(x + y for x, y in product(a.exact, b.exact))
    first = {x + y for x, y in product(a.exact, b.first)} if a.exact is not None else a.first
    last = {x + y for x, y in product(a.last, b.exact)} if b.exact is not None else b.last
    seam = {x[-2:] + y[:2] for x, y in product(a.last, b.first)}
    query = _all_of(_of_strings(a.last), _of_strings(b.first), _of_strings(seam), a.query, b.query)
    few = lambda s, cut: frozenset(s) if len(s) <= MOST_STRINGS else frozenset(map(cut, s)) if len(set(map(cut, s))) <= MOST_STRINGS else _NOTHING
    return _Part(None, few(first, lambda x: x[:2]), few(last, lambda x: x[-2:]), query)


def _either(parts: list[_Part]) -> _Part:
    if all(p.exact is not None for p in parts):
        return _strings(x for p in parts for x in p.exact)
    query = _any_of(*[_all_of(p.query, _of_strings(p.exact if p.exact is not None else p.first), _of_strings(p.last)) for p in parts])
    return _Part(None, frozenset(x for p in parts for x in p.first), frozenset(x for p in parts for x in p.last), query)


def _low(code: int) -> bytes:
    return (chr(code).lower() if code < 128 else chr(code)).encode()


def _class(items) -> _Part:
    found: set[bytes] = set()
    for op, value in items:
        codes = [value] if str(op) == "LITERAL" else range(value[0], value[1] + 1) if str(op) == "RANGE" else None
        if codes is None or len(codes) > 2 * MOST_CLASS:  # a negation or a wide class
            return _UNKNOWN
        found |= {_low(c) for c in codes}
    return _strings(found) if len(found) <= MOST_CLASS else _UNKNOWN


def _sequence(items) -> _Part:
    known = _EMPTY
    for op, value in items:
        known = _joined(known, _piece(str(op), value))
    return known


def _piece(op: str, value) -> _Part:
    if op == "LITERAL":
        return _strings([_low(value)])
    if op == "IN":
        return _class(value)
    if op == "SUBPATTERN":
        return _sequence(value[3])
    if op == "BRANCH":
        return _either([_sequence(b) for b in value[1]])
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, inner = value
        one, known = _sequence(inner), _EMPTY
        for _ in range(min(least, 4)):
            known = _joined(known, one)
        if most == least <= 4:
            return known
        if (least, most) == (0, 1):
            return _either([_EMPTY, one])
        return _joined(_joined(known, _UNKNOWN), one) if least else _UNKNOWN
    if op == "AT":
        return _EMPTY
    return _UNKNOWN  # any character, and what is not told apart here


def trigram_query(pattern: str):
    """What lower-cased trigrams (of UTF-8 bytes) a text that holds a match must contain; True if nothing follows from the pattern."""
    from re import _parser

    known = _sequence(_parser.parse(pattern))
    return _all_of(known.query, _of_strings(known.exact if known.exact is not None else known.first), _of_strings(known.last))


def trigrams_of(query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(trigrams_of, query[1]))


class Matcher:
    """Compiled rules, their queries, and the table from trigrams to the numbers of their postings."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = [(r, re.compile(r.pattern, re.ASCII), trigram_query(r.pattern)) for r in rules]
        self.number = {t: k for k, t in enumerate(sorted(set().union(*[trigrams_of(q) for _, _, q in self.rules])), 1)}
        self.table = np.zeros(1 << 24, np.uint16)
        for t, k in self.number.items():
            self.table[int.from_bytes(t, "big")] = k
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32

    def postings(self, data: np.ndarray, off: np.ndarray, step: int = 1 << 20) -> np.ndarray:
        """For each trigram (by number) which rows hold it; data is read in pieces of step bytes that overlap by two."""
        index = np.zeros((len(self.number) + 1, len(off) - 1), bool)
        for lo in range(0, max(len(data) - 2, 0), step):
            low = self.lower[data[lo : lo + step + 2]].astype(np.uint32)
            found = self.table[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
            place = np.flatnonzero(found)
            row = np.searchsorted(off, lo + place, side="right") - 1
            inside = lo + place + 3 <= off[row + 1]  # not over the end of a text
            index[found[place[inside]], row[inside]] = True
        return index

    def candidates(self, query, index: np.ndarray) -> np.ndarray:
        if query is True:
            return np.ones(index.shape[1], bool)
        if isinstance(query, bytes):
            return index[self.number[query]]
        rows = [self.candidates(q, index) for q in query[1]]
        return (np.logical_and if query[0] == "and" else np.logical_or).reduce(rows)

    def scan(self, column: pa.Array) -> tuple[list[list[tuple[int, int, int]]], int]:
        """(start, number of the rule, end) of each row's matches, sorted; how many texts were looked at by rules with a query."""
        data, off, _ = text_buffers(column)
        index, found, looked = self.postings(data, off), [[] for _ in range(len(off) - 1)], 0
        texts: dict[int, str] = {}
        for k, (rule, expression, query) in enumerate(self.rules):
            rows = np.flatnonzero(self.candidates(query, index) & (off[1:] > off[:-1])).tolist()
            looked += len(rows) * (query is not True)
            for row in rows:
                if row not in texts:
                    texts[row] = data[off[row] : off[row + 1]].tobytes().decode()
                found[row] += [(m.start(), k, m.end()) for m in expression.finditer(texts[row]) if m.end(rule.group) - m.start(rule.group) >= rule.least]
        return [sorted(f) for f in found], looked


@lru_cache(maxsize=2)
def matcher(rules: tuple[Rule, ...]) -> Matcher:
    return Matcher(rules)


def _spans(batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...]) -> Iterator[pa.RecordBatch]:
    work = matcher(rules)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        found, _ = work.scan(batch.column(1))
        rows = [[{"kind": rules[k].kind, "start": a, "end": z} for a, k, z in f] for f in found]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(span))], names=["doc_id", "found"])


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, found: list of (kind, start, end) of every row of docs, in code points of the whole text, end exclusive, by start and
    then by the order of rules. A null or empty text has none; repeated rows and null ids stay; other columns are ignored.

    A task reads its texts once; nothing is shuffled. The index holds a bit for each trigram of the rules and row of a block.
    """
    small_batches(docs.sparkSession)
    return pick(docs, doc_id="long", text="string").mapInArrow(partial(_spans, rules=rules), "doc_id long, found array<struct<kind:string,start:long,end:long>>")


def _digests(batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...], base: int) -> Iterator[pa.RecordBatch]:
    work = matcher(rules)
    for batch in batches:
        found, _ = work.scan(batch.column(1))
        line = lambda spans: ",".join(f"{rules[k].kind}:{a}:{z}" for a, k, z in spans)
        counts = [pa.array([sum(k == j for _, k, _ in f) for f in found], pa.int64()) for j in range(base)]
        digest = pa.array([hashlib.sha256(line([x for x in f if x[1] < base]).encode()).hexdigest() for f in found], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digest, pa.array(map(line, found), pa.string())], names=["doc_id", *(f"n_{r.kind}" for r in rules[:base]), "base_sha256", "spans"])


def secret_digests(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE_RULES)) -> DataFrame:
    """doc_id, counts of the first `base` rules, base_sha256 and spans (`kind:start:end`, comma-joined) of every row of docs; see secret_spans."""
    small_batches(docs.sparkSession)
    counts = ", ".join(f"n_{r.kind} long" for r in rules[:base])
    return pick(docs, doc_id="long", text="string").mapInArrow(partial(_digests, rules=rules, base=base), f"doc_id long, {counts}, base_sha256 string, spans string")


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with all their columns; in column text every match is replaced by `[kind]`, of overlapping ones the first. A null text stays null."""
    name = {c.lower(): c for c in docs.columns}["text"]
    small_batches(docs.sparkSession)
    return docs.mapInArrow(partial(_redacted, rules=rules, at=docs.columns.index(name)), docs.schema)


def _redacted(batches: Iterator[pa.RecordBatch], rules: tuple[Rule, ...], at: int) -> Iterator[pa.RecordBatch]:
    work = matcher(rules)
    for batch in batches:
        found, _ = work.scan(batch.column(at))
        texts = batch.column(at).to_pylist()
        for row, spans in enumerate(found):
            parts, done = [], 0
            for a, k, z in spans:
                if a >= done:
                    parts += [texts[row][done:a], f"[{rules[k].kind}]"]
                    done = z
            if parts:
                texts[row] = "".join(parts) + texts[row][done:]
        yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))


def _sql_rule(rule: Rule, k: int) -> str:
    """Spans of a rule: text up to each match and the match itself give its place by sums of lengths."""
    pattern = rule.pattern.replace("'", "''")
    value = f"[length(v) FOR v IN regexp_extract_all(t, '{pattern}', {rule.group})]" if rule.group else f"[{rule.least} FOR v IN m]"
    return f"""
r{k} AS (SELECT id, {k} AS k, '{rule.kind}' AS kind, unnest(p) AS p, unnest(m) AS m, unnest(n) AS n, generate_subscripts(p, 1) AS j FROM (
  SELECT id, [length(v) FOR v IN regexp_extract_all(t, '(?s)(.*?)(?:{pattern})', 1)] AS p, [length(v) FOR v IN regexp_extract_all(t, '{pattern}', 0)] AS m, {value} AS n
  FROM (SELECT id, t, regexp_extract_all(t, '{pattern}', 0) AS m FROM d)))"""


#: Every rule scans every text.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, COALESCE(text, '') AS t FROM documents),{','.join(_sql_rule(r, k) for k, r in enumerate(RULES))},
s AS (SELECT id, k, kind, n, CAST(sum(p + m) OVER (PARTITION BY id, k ORDER BY j) AS BIGINT) AS z, m FROM ({' UNION ALL '.join(f'SELECT * FROM r{k}' for k in range(len(RULES)))})),
f AS (SELECT *, z - m AS a, kind || ':' || (z - m) || ':' || z AS span FROM s WHERE n >= CASE k {' '.join(f'WHEN {k} THEN {r.least}' for k, r in enumerate(RULES))} END)
SELECT any_value(d.doc_id) AS doc_id, {', '.join(f'count(*) FILTER (k = {k}) AS n_{r.kind}' for k, r in enumerate(BASE_RULES))},
       sha256(COALESCE(string_agg(span, ',' ORDER BY a, k) FILTER (k < {len(BASE_RULES)}), '')) AS base_sha256, COALESCE(string_agg(span, ',' ORDER BY a, k), '') AS spans
FROM d LEFT JOIN f USING (id) GROUP BY id
"""
