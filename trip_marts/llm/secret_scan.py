"""Secrets in texts, found through an inverted index over trigrams.

Each rule is a regular expression. From its parse tree comes a Boolean query
over trigrams that every match must contain. A batch of documents is one segment
of the index: postings of the trigrams that rules mention, in row order. A rule's
query is answered by intersecting and uniting postings, and only the rows that are
left run the expression. A rule whose matches need no particular trigram scans
every row. Segments are independent, so nothing is shuffled and a lost task is
repeated alone.
"""

from __future__ import annotations

import hashlib
import itertools
import re
import re._constants as sre
import re._parser as parser
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from trip_marts.llm.shared import map_texts
from trip_marts.llm.textarrays import LOWER, joined

#: Alternative strings that are followed through a concatenation at most; beyond
#: that the strings so far become a query and a new run begins.
MOST_STRINGS = 48


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if `group` has `least` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The kinds of the contract, in its order.
BASE_RULES = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Public formats of further credentials.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE_RULES + MORE_RULES

# A query is True (every row may match), or ("and" | "or", parts), parts being
# trigrams (3 bytes, lower case) or queries.


def trigram_query(pattern: str):
    """Boolean query over trigrams that every match of `pattern` satisfies."""
    return _sequence(parser.parse(pattern))


def _both(parts: list):
    parts = [p for p in parts if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else ("and", parts)


def _of_strings(strings: set[str]):
    """One of the strings occurs: any of them, all trigrams of it."""
    options = []
    for s in sorted(strings):
        data = s.encode().translate(bytes(LOWER.tolist()))
        grams = sorted({data[i : i + 3] for i in range(len(data) - 2)})
        if not grams:
            return True
        options.append(("and", grams))
    return ("or", options) if len(options) > 1 else options[0]


def _exact(node) -> set[str] | None:
    """All strings that a node matches, case folded, if they are few."""
    op, arg = node
    if op is sre.LITERAL:
        return {chr(arg).lower() if arg < 128 else chr(arg)}
    if op is sre.IN:
        found: set[str] = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                found |= _exact((kind, value))
            elif kind is sre.RANGE and value[1] - value[0] < 8:
                found |= {c for x in range(value[0], value[1] + 1) for c in _exact((sre.LITERAL, x))}
            else:
                return None
        return found if len(found) <= 8 else None
    if op is sre.SUBPATTERN:
        return _exact_all(arg[-1])
    if op is sre.BRANCH:
        parts = [_exact_all(p) for p in arg[1]]
        return None if None in parts else set().union(*parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[1] <= 2:
        one = _exact_all(arg[2])
        if one is not None and len(one) <= 8:
            return {"".join(x) for n in range(arg[0], arg[1] + 1) for x in itertools.product(one, repeat=n)}
    return {""} if op is sre.AT else None


def _exact_all(nodes) -> set[str] | None:
    strings = {""}
    for node in nodes:
        own = _exact(node)
        if own is None or len(own) * len(strings) > MOST_STRINGS:
            return None
        strings = {a + b for a in strings for b in own}
    return strings


def _inner(node):
    op, arg = node
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])
    if op is sre.BRANCH:
        parts = [_sequence(p) for p in arg[1]]
        return True if True in parts else ("or", parts)
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
        return _sequence(arg[2])
    return True


def _sequence(nodes):
    found, run = [], {""}
    for node in nodes:
        own = _exact(node)
        if own is not None and len(own) * len(run) <= MOST_STRINGS:
            run = {a + b for a in run for b in own}
            continue
        found += [_of_strings(run), _inner(node) if own is None else True]
        run = {""} if own is None else own
    return _both([*found, _of_strings(run)])


def _grams(query) -> Iterator[bytes]:
    if query is not True:
        for part in query[1]:
            yield from [part] if isinstance(part, bytes) else _grams(part)


class Index:
    """Rules compiled for scanning segments; made once per task."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        self.compiled = [re.compile(r.pattern) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        grams = sorted({g for q in self.queries for g in _grams(q)})
        self.number = {g: i for i, g in enumerate(grams)}
        self.slot = np.zeros(1 << 24, np.uint16)
        for g, i in self.number.items():
            self.slot[g[0] | g[1] << 8 | g[2] << 16] = i + 1

    def postings(self, texts: list[str]) -> list[np.ndarray]:
        """Rows that hold each trigram of the rules, ascending."""
        data, starts = joined(texts)
        low = LOWER[data].astype(np.uint32)
        codes = self.slot[low[:-2] | low[1:-1] << 8 | low[2:] << 16] if len(low) > 2 else np.zeros(0, np.uint16)
        places = np.flatnonzero(codes)
        rows = np.searchsorted(starts, places, "right") - 1
        pairs = np.unique((codes[places].astype(np.int64) - 1) * len(texts) + rows)
        edges = np.searchsorted(pairs, np.arange(len(self.number) + 1) * len(texts))
        return [pairs[a:b] - i * len(texts) for i, (a, b) in enumerate(itertools.pairwise(edges))]

    def rows(self, query, postings: list[np.ndarray], n: int) -> np.ndarray:
        """Rows that satisfy a query."""
        if query is True:
            return np.arange(n)
        kind, parts = query
        lists = [postings[self.number[p]] if isinstance(p, bytes) else self.rows(p, postings, n) for p in parts]
        found = lists[0]
        for other in sorted(lists[1:], key=len):
            found = np.intersect1d(found, other, assume_unique=True) if kind == "and" else np.union1d(found, other)
        return found

    def spans(self, texts: list[str]) -> list[list[tuple[int, int, int]]]:
        """(start, rule number, end) of every match in every text, by start and rule."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        postings = self.postings(texts)
        for k, (rule, compiled, query) in enumerate(zip(self.rules, self.compiled, self.queries)):
            for row in self.rows(query, postings, len(texts)):
                for m in compiled.finditer(texts[row]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[row].append((m.start(), k, m.end()))
        for spans in found:
            spans.sort()
        return found


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Secrets of every row of `docs` (`doc_id`, `text`), one row for each row.

    `starts`, `ends` (code points, end exclusive) and `kinds` are parallel arrays
    in order of start, then of the rules. Null or empty text has none; rows that
    repeat are scanned each; other columns are ignored; an empty table gives no rows.
    """
    held: list[Index] = []

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        if not held:
            held.append(Index(rules))
        spans = held[0].spans(texts)
        return {
            "doc_id": batch.column(0),
            "starts": [[s for s, _, _ in x] for x in spans],
            "ends": [[e for _, _, e in x] for x in spans],
            "kinds": [[rules[k].kind for _, k, _ in x] for x in spans],
        }

    schema = "doc_id long, starts array<long>, ends array<long>, kinds array<string>"
    return map_texts(docs.select("doc_id", "text"), schema, each)


def digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, hash of their spans, and all spans, for each row."""
    held: list[Index] = []
    base = len(BASE_RULES)

    def line(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{RULES[k].kind}:{s}:{e}" for s, k, e in spans)

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        if not held:
            held.append(Index())
        spans = held[0].spans(texts)
        own = [[x for x in s if x[1] < base] for s in spans]
        counts = {f"n_{r.kind}": [sum(x[1] == k for x in s) for s in own] for k, r in enumerate(BASE_RULES)}
        return counts | {
            "doc_id": batch.column(0),
            "base_sha256": [hashlib.sha256(line(s).encode()).hexdigest() for s in own],
            "spans": [line(s) for s in spans],
        }

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return map_texts(docs.select("doc_id", "text"), schema, each)


def redact(docs: DataFrame, mark: str = "[REDACTED]") -> DataFrame:
    """`documents` with every secret replaced by `mark` and `n_chars` counted anew.

    Overlapping spans are replaced as one. Rows without secrets stay as they are,
    a null text and its `n_chars` included.
    """
    held: list[Index] = []

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        if not held:
            held.append(Index())
        raw, counts = batch.column("text").to_pylist(), batch.column("n_chars").to_pylist()
        for i, spans in enumerate(held[0].spans(texts)):
            if spans:
                parts, at = [], 0
                for s, _, e in spans:
                    if s >= at:
                        parts += [texts[i][at:s], mark]
                    at = max(at, e)
                raw[i] = "".join(parts) + texts[i][at:]
                counts[i] = len(raw[i])
        return {"doc_id": batch.column("doc_id"), "text": raw, "lang": batch.column("lang"), "source": batch.column("source"), "n_chars": counts}

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return map_texts(docs.select("doc_id", "text", "lang", "source", "n_chars"), schema, each)
