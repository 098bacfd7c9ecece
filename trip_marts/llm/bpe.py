"""Byte-level BPE over arrays: pre-tokenisation by scans, merging of unique slices.

Text becomes one array of symbol classes. Reading a symbol is a function from
states to states; functions compose associatively, so the state before every
code point comes from a prefix scan over blocks, in which each step composes a
whole column of blocks at once. States and classes give the slice boundaries; no
regular expression runs over text. Slices that occur several times are merged
once, all of a batch together, and a bounded cache keeps those already merged.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from trip_marts.llm.shared import map_texts
from trip_marts.llm.textarrays import code_points, distinct_slices, ranges

# Symbol classes. A contraction is an apostrophe with s, t, m, d or re, ve, ll behind it.
LETTER, NUMBER, OTHER, BLANK, SPACE, SHORT, LONG, RESET = range(8)
# States: what was read last; WITHIN1 and WITHIN2 are left by one, two more letters.
AT_START, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_BLANKS, AFTER_SPACE, WITHIN1, WITHIN2 = range(8)
_PLAIN = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER, BLANK: IN_BLANKS, SPACE: AFTER_SPACE}
_BLOCK = 64
#: Slices of at most so many bytes are merged together; longer ones with a heap.
_TOGETHER = 96
#: Merged slices that a worker keeps.
_CACHED = 200_000


def _moves() -> list[tuple[int, ...]]:
    """For each symbol class, the next state of every state."""
    moves = []
    for symbol in range(8):
        row = []
        for state in range(8):
            if symbol == RESET:
                row.append(AT_START)
            elif state == WITHIN2:
                row.append(WITHIN1)
            elif state == WITHIN1:
                row.append(AT_START)
            elif symbol in (SHORT, LONG):
                opens = state not in (IN_OTHER, AFTER_SPACE)
                row.append((WITHIN1 if symbol == SHORT else WITHIN2) if opens else IN_OTHER)
            else:
                row.append(_PLAIN[symbol])
        moves.append(tuple(row))
    return moves


def _monoid() -> tuple[np.ndarray, np.ndarray]:
    """All functions that sequences of symbols make: table of compositions, and values.

    Number s < 8 is the function of symbol s. `compose[f, g]` is f, then g.
    """
    functions = list(_moves())
    number = {f: i for i, f in reversed(list(enumerate(functions)))}
    for f in functions:
        for g in _moves():
            h = tuple(g[x] for x in f)
            if h not in number:
                number[h] = len(functions)
                functions.append(h)
    compose = np.array([[number[tuple(g[x] for x in f)] for g in functions] for f in functions], np.uint16)
    return compose, np.array(functions, np.uint8)


def _scan(values: np.ndarray, compose: np.ndarray) -> np.ndarray:
    """Inclusive prefix compositions of function numbers."""
    n = len(values)
    if n <= _BLOCK:
        return np.fromiter(itertools.accumulate(values.tolist(), lambda f, g: int(compose[f, g])), np.uint16, n)
    whole = -(-n // _BLOCK)
    table = np.full(whole * _BLOCK, RESET, np.uint16)
    table[:n] = values
    table = np.ascontiguousarray(table.reshape(whole, _BLOCK).T)
    for i in range(1, _BLOCK):
        table[i] = compose[table[i - 1], table[i]]
    before = _scan(table[-1], compose)[:-1]
    table[:, 1:] = compose[before[None, :], table[:, 1:]]
    return table.T.reshape(-1)[:n]


class PreTokenizer:
    """Slices of texts, equal to the matches of the public pattern."""

    def __init__(self) -> None:
        every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        self.kind = np.full(0x110000, OTHER, np.uint8)
        for name, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", BLANK)):
            for m in regex.finditer(name, every):
                lo, hi = ord(m[0][0]), ord(m[0][-1])
                self.kind[lo : hi + 1] = kind  # the surrogates that a run spans never occur
        self.kind[0x20] = SPACE
        self.compose, self.values = _monoid()

    def starts(self, points: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mask of code points that begin a slice, and of those between the texts."""
        symbols = self.kind[points]
        n = len(points)
        between = np.zeros(n, bool)
        between[text_starts[1:] - 1] = True
        between[-1] = True
        marks = np.flatnonzero(points[: n - 1] == 0x27)
        marks = marks[~between[marks]]
        first = points[marks + 1]
        second = points[np.minimum(marks + 2, n - 1)]
        inside = ~between[marks + 1]
        symbols[marks[inside & np.isin(first, [ord(c) for c in "stmd"])]] = SHORT
        pair = first.astype(np.uint64) << np.uint64(32) | second
        pair_ok = inside & ~between[np.minimum(marks + 2, n - 1)]
        longs = [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")]
        symbols[marks[pair_ok & np.isin(pair, np.array(longs, np.uint64))]] = LONG
        symbols[between] = RESET
        after = self.values[_scan(symbols.astype(np.uint16), self.compose), AT_START]
        state = np.empty(n, np.uint8)
        state[0], state[1:] = AT_START, after[:-1]

        blank = (symbols == BLANK) | (symbols == SPACE)
        was_blank = (state == IN_BLANKS) | (state == AFTER_SPACE)
        ends_blank = np.zeros(n, bool)  # the last of its run, with something behind it
        ends_blank[:-1] = blank[:-1] & ~blank[1:] & (symbols[1:] != RESET)
        own = np.array([IN_LETTERS, IN_NUMBERS, IN_OTHER, 255, 255, IN_OTHER, IN_OTHER, 255], np.uint8)[symbols]
        within = (state == WITHIN1) | (state == WITHIN2)
        start = np.where(blank, ~was_blank | ends_blank, (state != own) & (state != AFTER_SPACE) & ~within)
        return start & ~between, between


class Codec:
    """A vocabulary of ranks with encoding and decoding of batches."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.split = PreTokenizer()
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, made = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    made.append(rank)
        order = np.argsort(keys)
        self.keys, self.made = np.array(keys, np.int64)[order], np.array(made, np.int64)[order]
        self.pairs: dict[int, int] = {}  # filled when a long slice comes
        by_id = sorted((i, t) for t, i in ranks.items())
        size = by_id[-1][0] + 1
        lengths = np.zeros(size, np.int64)
        lengths[[i for i, _ in by_id]] = [len(t) for _, t in by_id]
        self.token_start = np.concatenate([[0], np.cumsum(lengths)])
        self.token_bytes = np.frombuffer(b"".join(t for _, t in by_id), np.uint8)
        self.cached = (np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int64))

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """What each pair merges to, or a value above all ranks."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], 1 << 40)

    def _merge_together(self, ids: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge many slices at once: every round, the first of each slice's lowest pairs."""
        done_ids, done_owner = [], []
        while True:
            same = owner[:-1] == owner[1:]
            rank = np.full(len(ids), 1 << 40, np.int64)
            rank[:-1][same] = self._rank(ids[:-1][same], ids[1:][same])
            begins = np.flatnonzero(np.concatenate([[True], ~same]))
            least = np.minimum.reduceat(rank, begins)
            open_ = least < 1 << 40
            sizes = np.diff(np.append(begins, len(ids)))
            stay = np.repeat(open_, sizes)
            done_ids.append(ids[~stay])
            done_owner.append(owner[~stay])
            if not open_.any():
                break
            at = np.flatnonzero(stay & (rank == np.repeat(least, sizes)))
            at = at[np.unique(owner[at], return_index=True)[1]]  # leftmost; owners ascend
            ids = ids.copy()
            ids[at] = rank[at]
            stay[at + 1] = False
            ids, owner = ids[stay], owner[stay]
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return ids[order], owner[order]

    def _merge_long(self, data: bytes) -> list[int]:
        """Merge one long slice with a heap of its pairs."""
        if not self.pairs:
            self.pairs = dict(zip(self.keys.tolist(), self.made.tolist()))
        ids: list[int | None] = self.byte_id[np.frombuffer(data, np.uint8)].tolist()
        before, after = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(itertools.pairwise(ids)) if (r := self.pairs.get(a << 32 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] is not None else len(ids)
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = rank, None
            after[i] = after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else len(ids)
                if left >= 0 and right < len(ids) and (r := self.pairs.get(ids[left] << 32 | ids[right])) is not None:
                    heapq.heappush(heap, (r, left, ids[left], ids[right]))
        return [i for i in ids if i is not None]

    def _merged(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of unique slices in order, and where each slice's begin."""
        known, known_at, known_ids = self.cached
        place = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
        hit = known[place] == hashes if len(known) else np.zeros(len(hashes), bool)
        counts = np.zeros(len(hashes), np.int64)
        counts[hit] = (known_at[1:] - known_at[:-1])[place[hit]]
        miss = np.flatnonzero(~hit)
        lengths = ends[miss] - starts[miss]
        short, long_ = miss[lengths <= _TOGETHER], miss[lengths > _TOGETHER]
        ids = owner = np.zeros(0, np.int64)
        if len(short):
            owner = np.repeat(short, ends[short] - starts[short])
            ids, owner = self._merge_together(self.byte_id[data[ranges(starts[short], ends[short])]], owner, len(hashes))
            counts += np.bincount(owner, minlength=len(hashes))
        slow = {int(i): self._merge_long(data[starts[i] : ends[i]].tobytes()) for i in long_}
        for i, own in slow.items():
            counts[i] = len(own)
        at = np.concatenate([[0], np.cumsum(counts)])
        out = np.zeros(at[-1], np.int64)
        out[ranges(at[:-1][hit], at[1:][hit])] = known_ids[ranges(known_at[place[hit]], known_at[place[hit] + 1])]
        if len(short):
            out[ranges(at[short], at[short + 1])] = ids
        for i, own in slow.items():
            out[at[i] : at[i + 1]] = own
        if len(known) < _CACHED and len(short):
            # hashes are in ascending order, and so is the cache
            both = np.concatenate([known, hashes[short]])
            sizes = np.concatenate([np.diff(known_at), counts[short]])
            begin = np.concatenate([known_at[:-1], len(known_ids) + np.concatenate([[0], np.cumsum(counts[short])[:-1]])])
            order = np.argsort(both)
            arena = np.concatenate([known_ids, ids])[ranges(begin[order], begin[order] + sizes[order])]
            self.cached = (both[order], np.concatenate([[0], np.cumsum(sizes[order])]), arena)
        return out, at

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and where each text's begin (n + 1 places)."""
        points, text_starts = code_points(texts)
        start, between = self.split.starts(points, text_starts)
        begins = np.flatnonzero(start)
        if len(begins) == 0:
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        offset = np.concatenate([[0], np.cumsum(width)])
        data = np.frombuffer(("\n".join(texts) + "\n").encode(), np.uint8)
        stops = np.flatnonzero(start | between)
        ends = stops[np.searchsorted(stops, begins, "right")]
        lo, hi = offset[begins], offset[ends]
        which, unique = distinct_slices(data, lo, hi)
        order = np.argsort(unique)
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        which = rank[which]
        sample = np.empty(len(unique), np.int64)
        sample[which[::-1]] = np.arange(len(which))[::-1]
        ids, at = self._merged(unique[order], lo[sample], hi[sample], data)
        out = ids[ranges(at[which], at[which + 1])]
        counts = np.concatenate([[0], np.cumsum(at[which + 1] - at[which])])
        first = np.searchsorted(begins, np.append(text_starts, len(points)))
        return out, counts[first]

    def decode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bytes of the ids, and the byte at which every id begins."""
        lo, hi = self.token_start[ids], self.token_start[ids + 1]
        return self.token_bytes[ranges(lo, hi)].tobytes(), np.concatenate([[0], np.cumsum(hi - lo)])


def default_ranks() -> str:
    """The public vocabulary of the registered query."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode(docs: DataFrame, ranks: str) -> DataFrame:
    """`doc_id`, `ids` (little-endian unsigned 32-bit) and `n_tokens` of every row.

    Null or empty text has no ids; rows that repeat are encoded each; other columns
    are ignored. Memory follows the longest single text.
    """
    held: list[Codec] = []

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        if not held:
            held.append(Codec(ranks))
        ids, at = held[0].encode(texts)
        raw = [ids[a:b].astype("<u4").tobytes() for a, b in itertools.pairwise(at)]
        return {"doc_id": batch.column(0), "ids": raw, "n_tokens": np.diff(at)}

    return map_texts(docs.select("doc_id", "text"), "doc_id long, ids binary, n_tokens long", each)


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """`doc_id`, `text` bytes and the byte `offsets` of the ids, from `encode` rows."""
    held: list[Codec] = []

    def run(batches):
        for batch in batches:
            if not held:
                held.append(Codec(ranks))
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column(1)[i].as_py() or b"", "<u4")
                data, offsets = held[0].decode(ids)
                yield pa.record_batch(
                    [batch.column(0).slice(i, 1), pa.array([data]), pa.array([offsets.tolist()], pa.list_(pa.int64()))],
                    names=["doc_id", "text", "offsets"],
                )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text binary, offsets array<long>")


def digest(docs: DataFrame, ranks: str) -> DataFrame:
    """Token count, hash of the ids and hash of the decoded bytes of every row."""
    held: list[Codec] = []

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        if not held:
            held.append(Codec(ranks))
        ids, at = held[0].encode(texts)
        data, offsets = held[0].decode(ids)
        edges = offsets[at]
        return {
            "doc_id": batch.column(0),
            "n_tokens": np.diff(at),
            "ids_sha256": [hashlib.sha256(ids[a:b].astype("<u4").tobytes()).hexdigest() for a, b in itertools.pairwise(at)],
            "decoded_sha256": [hashlib.sha256(data[a:b]).hexdigest() for a, b in itertools.pairwise(edges)],
        }

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(docs.select("doc_id", "text"), schema, each)
