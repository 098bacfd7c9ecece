"""Toxicity scores of texts whose spelling is restored first.

Writing is seen as a noisy channel: what was meant passes through leetspeak, spacing
between letters and repetition. Each suspicious stretch of a text spans a lattice
of what its characters may stand for, and Viterbi decoding picks the path that is
likeliest under a character trigram model counted over all documents and the costs
of the channel. The rest of a text has one path only and stays as it is.

Restored words and their character n-grams are then scored: a logistic model over
those n-grams that mark toxic documents among the labelled ones.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_marts.llm.grams import bucket_of
from trip_marts.llm.quality import fold, labelled_sample
from trip_marts.llm.shared import drop_saved, map_texts, saved
from trip_marts.llm.textarrays import code_points, prefix_sums, slice_hashes

#: What a character of leetspeak may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¥": "y", "#": "h",
}
_SYMBOLS = "".join(map(re.escape, LEET))
#: Signs that may end a word; `!`, `|` and `(` behind a word are punctuation.
ENDINGS = "0123456789@$+#€£¥"
_LETTER = rf"(?:[^\W\d_]|[{_SYMBOLS}])"
_SPACED = rf"{_LETTER}(?:[ .\-_*]{{1,3}}{_LETTER}){{2,}}"
#: Costs in nats of leaving the plain path.
LEET_COST, REPEAT_COST, GAP_COST, KEEP_COST = 1.0, 0.5, 0.3, 6.0
#: Letters between up to three stray separators, letters mixed with leetspeak or before it, letters repeated.
SUSPICIOUS = re.compile(
    rf"(?<!\w){_SPACED}(?!\w)"
    rf"|[^\W_]*(?:[^\W\d_][{_SYMBOLS}]+|[{_SYMBOLS}]+)[^\W\d_](?:\w|[{_SYMBOLS}](?=[{_SYMBOLS}]*\w))*[{re.escape(ENDINGS)}]*"
    rf"|[^\W_]*[^\W\d_][{re.escape(ENDINGS)}]+(?!\w)"
    r"|\w*([^\W\d_])\1{2,}\w*"
)
_ALL_SPACED = re.compile(_SPACED)
#: Readings of stretches up to this length are kept for the next time.
REMEMBERED = 64
BUCKETS = 1 << 20
GRAMS = (3, 4, 5)
_GAPS = " .-_*"
_SIZE = 64


def symbol(points: np.ndarray) -> np.ndarray:
    """Class of code points in the language model: letters, others as one, blank."""
    low = np.where((points >= 65) & (points <= 90), points + 32, points).astype(np.int64)
    low = np.where((low >= 0xC0) & (low <= 0xDE), low + 32, low)
    out = np.ones(len(low), np.int64)
    out[(low >= 97) & (low <= 122)] = low[(low >= 97) & (low <= 122)] - 97 + 2
    accented = (low >= 0xDF) & (low <= 0xFF)
    out[accented] = low[accented] - 0xDF + 28
    out[(low == 32) | ((low >= 9) & (low <= 13))] = 0
    return out


@functools.lru_cache(4096)
def _symbol_of(c: str) -> int:
    return int(symbol(np.array([ord(c)], np.int64))[0])


@dataclass
class Language:
    """Negative log probabilities of a symbol after two others."""

    costs: np.ndarray

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Language:
        table = counts.reshape(_SIZE, _SIZE, _SIZE).astype(float)
        pairs = table.sum(axis=0)
        single = pairs.sum(axis=0)
        low = (single + 0.5) / (single.sum() + 0.5 * _SIZE)
        mid = (pairs + 4 * low) / (pairs.sum(axis=1, keepdims=True) + 4)
        return cls(-np.log((table + 4 * mid[None]) / (table.sum(axis=2, keepdims=True) + 4)).astype(np.float32))


def count_language(docs: DataFrame) -> Language:
    """Trigram counts over all documents; at most `_SIZE` cubed numbers reach the driver."""

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        s = symbol(code_points(texts)[0])
        counts = np.bincount((s[:-2] * _SIZE + s[1:-1]) * _SIZE + s[2:], minlength=1)
        used = np.flatnonzero(counts)
        return {"gram": used, "n": counts[used]}

    rows = map_texts(docs.select("text"), "gram long, n long", each).groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(_SIZE**3, np.int64)
    for r in rows:
        counts[r.gram] = r.n
    return Language.of_counts(counts)


class Restorer:
    """Viterbi decoding of suspicious stretches; keeps what it has decoded."""

    def __init__(self, language: Language) -> None:
        self.costs = language.costs
        self.known: dict[str, str] = {}

    def options(self, text: str, i: int, gaps: bool) -> list[tuple[str, float]]:
        """What the character at `i` may stand for, and the cost of each."""
        c = text[i]
        plain = c.isalpha() or (c in _GAPS)
        again = i > 0 and c == text[i - 1]
        # a row of one sign is kept as a whole
        found = [(c, 0.0 if plain else REPEAT_COST if again and not c.isalnum() else KEEP_COST)]
        found += [(x, LEET_COST) for x in LEET.get(c, "")]
        if again and (c.isalpha() or c in LEET):
            found.append(("", REPEAT_COST))
        if gaps and c in _GAPS:
            found.append(("", GAP_COST))
        return found

    def decode(self, text: str) -> str:
        """The likeliest reading of one stretch of any length, blanks around it assumed.

        Steps point back to the step before, so that time grows with the length only.
        """
        gaps = _ALL_SPACED.fullmatch(text) is not None
        # state: the last two symbols; value: cost, and the reading's last character with what came before
        beam: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for i in range(len(text)):
            following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for out, channel in self.options(text, i, gaps):
                s = _symbol_of(out) if out else -1
                for (a, b), (cost, reading) in beam.items():
                    state = (b, s) if out else (a, b)
                    total = cost + channel + (float(self.costs[a, b, s]) if out else 0.0)
                    if state not in following or total < following[state][0]:
                        following[state] = (total, (reading, out) if out else reading)
            beam = following
        return min((cost + float(self.costs[a, b, 0]), _spelled(reading)) for (a, b), (cost, reading) in beam.items())[1]

    def _replaced(self, m: re.Match) -> str:
        found = m[0].lower()
        if not any(c.isalpha() for c in found):
            return found  # rows of numbers
        if len(found) > REMEMBERED:
            return self.decode(found)
        if found not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[found] = self.decode(found)
        return self.known[found]

    def restore(self, texts: list[str]) -> list[str]:
        """The texts with every suspicious stretch replaced by its likeliest reading.

        Arrays find the few places that may belong to one; only the words around
        those are matched and decoded.
        """
        points, starts = code_points(texts)
        begins, ends = _suspicious(points)
        out = list(texts)
        owner = np.searchsorted(starts, begins, "right") - 1
        for i in np.unique(owner):
            parts, at = [], 0
            own = owner == i
            for lo, hi in zip(begins[own] - starts[i], ends[own] - starts[i]):
                if lo >= at:
                    parts += [texts[i][at:lo], SUSPICIOUS.sub(self._replaced, texts[i][lo:hi])]
                    at = hi
            out[i] = "".join(parts) + texts[i][at:]
        return out


def _spelled(reading: tuple | None) -> str:
    """The characters of a chain of steps, first to last."""
    out = []
    while reading:
        reading, c = reading
        out.append(c)
    return "".join(reversed(out))


def _suspicious(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint stretches, cut at white space, in which the pattern can match."""
    s = symbol(points)
    letter = (s > 1) | (points > 0xFF)
    leet = np.isin(points, [ord(c) for c in LEET])
    either = letter | leet
    gap = np.isin(points, [ord(c) for c in _GAPS])
    hit = np.zeros(len(points), bool)
    hit[:-1] |= leet[:-1] & letter[1:]
    hit[1:] |= np.isin(points[1:], [ord(c) for c in ENDINGS]) & letter[:-1]
    hit[:-2] |= letter[:-2] & (s[:-2] == s[1:-1]) & (s[1:-1] == s[2:])
    # letters that stand alone, and of these the neighbours with one to three separators between them
    within = letter | ((points >= 48) & (points <= 57))
    single = np.flatnonzero(either & ~np.append(False, within[:-1]) & ~np.append(within[1:], False))
    apart = np.cumsum(~gap)
    near = (np.diff(single) > 1) & (np.diff(single) <= 4) & (apart[single[1:] - 1] == apart[single[:-1]]) if len(single) else np.zeros(0, bool)
    hit[single[1:-1][near[:-1] & near[1:]]] = True
    places = np.flatnonzero(hit)
    if not len(places):
        return places, places
    bound = s == 0
    for step in (1, 2, 3):
        inside = single[:-1][near] + step
        bound[inside[inside < single[1:][near]]] = False
    blank = np.flatnonzero(bound)
    k = np.searchsorted(blank, places)
    begin = np.where(k > 0, blank[np.maximum(k - 1, 0)] + 1, 0)
    end = np.where(k < len(blank), blank[np.minimum(k, len(blank) - 1)], len(points) - 1)
    return np.unique(begin), np.unique(end)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of words, and of n-grams inside words with their edges."""
    points, starts = code_points([f" {t.lower()} " for t in texts])
    letters = (symbol(points) > 1) | (points > 0xFF)
    sums = prefix_sums(np.where(letters, points, 32).astype(np.uint32))
    edge = np.diff(letters.astype(np.int8), prepend=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    found = [bucket_of(slice_hashes(sums, begin, end), BUCKETS, 99)]
    places = [begin]
    rest = np.zeros(len(points), np.int32)  # letters from here to the end of the word
    inside = np.flatnonzero(letters)
    rest[inside] = np.repeat(end, end - begin) - inside
    rest[begin - 1] = end - begin + 1  # the edge before a word counts
    for n in GRAMS:
        at = np.flatnonzero(rest >= n - 1)
        at = at[at + n <= len(points)]
        found.append(bucket_of(slice_hashes(sums, at, at + n), BUCKETS, n))
        places.append(at)
    return np.searchsorted(starts, np.concatenate(places), "right") - 1, np.concatenate(found)


def distinct(owner: np.ndarray, found: np.ndarray, n: int) -> list[np.ndarray]:
    """Distinct buckets of each text."""
    pairs = np.unique(owner * BUCKETS + found)
    edges = np.searchsorted(pairs, np.arange(n + 1) * BUCKETS)
    return [pairs[a:b] - i * BUCKETS for i, (a, b) in enumerate(zip(edges[:-1], edges[1:]))]


@dataclass(frozen=True)
class Training:
    """`sample`: labelled documents of each class that are used at most, by hash."""

    sample: int = 3000
    kept: int = 4000
    least: int = 3


@dataclass
class Model:
    """Weights of the buckets that mark toxic documents, and a bias."""

    language: Language
    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def marks(self, texts: list[str]) -> list[np.ndarray]:
        """Distinct marking buckets of each text."""
        marking = np.zeros(BUCKETS, bool)
        marking[self.buckets] = True
        owner, found = grams(texts)
        hit = np.flatnonzero(marking[found])
        return distinct(owner[hit], found[hit], len(texts))

    def scores(self, restorer: Restorer, texts: list[str]) -> np.ndarray:
        """Scores of texts as they are; their spelling is restored first."""
        own = self.marks(restorer.restore(texts))
        logits = [self.bias + self.weights[np.searchsorted(self.buckets, b)].sum() for b in own]
        return 1 / (1 + np.exp(-np.clip(np.array(logits), -50, 50)))


def _fit(model: Model, marks: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> None:
    """Logistic regression over the marking buckets, rows weighted; Adam on all rows."""
    x = np.zeros((len(marks), len(model.buckets)), np.float32)
    for i, own in enumerate(marks):
        x[i, np.searchsorted(model.buckets, own)] = 1
    weight = (weight / weight.sum()).astype(np.float32)
    theta, first, second = (np.zeros(len(model.buckets) + 1, np.float32) for _ in range(3))
    for step in range(1, 301):
        gap = weight * (1 / (1 + np.exp(-np.clip(x @ theta[:-1] + theta[-1], -50, 50))) - y)
        slope = np.append(x.T @ gap + 3e-5 * theta[:-1], gap.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
        theta -= 0.05 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step) * first / (np.sqrt(second) + 1e-8)
    model.weights, model.bias = theta[:-1].astype(float), float(theta[-1])


def _marking(sample: DataFrame, n: dict[int, int], how: Training) -> np.ndarray:
    """Buckets that are far more frequent in toxic documents, by their lead over chance."""

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        y = batch.column(1).to_numpy()
        own = distinct(*grams(texts), len(texts))
        counts = [np.bincount(np.concatenate([*(b for b, t in zip(own, y) if t == c), np.zeros(0, np.int64)]).astype(np.int64), minlength=BUCKETS) for c in (1, 0)]
        used = np.flatnonzero(counts[0])
        return {"bucket": used, "toxic": counts[0][used], "clean": counts[1][used]} if len(used) else {"bucket": [], "toxic": [], "clean": []}

    def others(batch: pa.RecordBatch, texts: list[str]) -> dict:
        own = distinct(*grams(texts), len(texts))
        used, counts = np.unique(np.concatenate(own), return_counts=True)
        return {"bucket": used, "toxic": np.zeros(len(used), np.int64), "clean": counts}

    schema = "bucket long, toxic long, clean long"
    rows = sample.select("text", "y")
    parts = map_texts(rows.where("y = 1"), schema, each).unionByName(map_texts(rows.where("y = 0"), schema, others))
    counts = parts.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    rate = (F.col("toxic") + 0.1) / (n[1] + 0.2)
    other = (F.col("clean") + 0.1) / (n[0] + 0.2)
    both = (F.col("toxic") + F.col("clean")) / (n[1] + n[0])
    lead = (rate - other) / F.sqrt(both * (1 - both) + 1e-9)
    found = counts.where((F.col("toxic") >= how.least) & (rate > 6 * other)).orderBy(F.desc(lead), "bucket").limit(how.kept)
    return np.sort(np.array([r.bucket for r in found.select("bucket").collect()], np.int64))


def train(docs: DataFrame, labels: DataFrame, how: Training = Training(), modulus: int = 4, held_out: int = 2) -> Model:
    """A model for `labels.toxic`; the held-out fold's labels are never read.

    The language model is counted over the texts of all documents. At most
    `how.sample` documents of each class are read, and weighted so that the classes
    have their shares among all labelled ones. Without labels every score is one
    half; with one class only the scores lean to it.
    """
    language = count_language(docs)
    model = Model(language, np.zeros(0, np.int64), np.zeros(0), 0.0)
    held = docs.sparkSession.sparkContext.broadcast(language)

    def restored(batch: pa.RecordBatch, texts: list[str]) -> dict:
        return {"text": Restorer(held.value).restore(texts), "y": batch.column(1)}

    classes = [labelled_sample(docs, labels.where(F.col("toxic") == c), "toxic", modulus, held_out, how.sample) for c in (0, 1)]
    sample = saved(map_texts(classes[0].unionByName(classes[1]).select("text", "y"), "text string, y int", restored), "toxicity-sample")
    n = {0: 0, 1: 0} | {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    seen = labels.where(fold(modulus) != held_out).groupBy("toxic").agg(F.count("*").alias("n"))
    every = {r.toxic: r.n for r in seen.where("toxic is not null").collect()}
    if 0 in n.values():
        model.bias = 2.0 if n[1] else -2.0 if n[0] else 0.0
        return model
    model.buckets = _marking(sample, n, how)

    def marks(batch: pa.RecordBatch, texts: list[str]) -> dict:
        return {"y": batch.column(1), "marks": model.marks(texts)}

    rows = map_texts(sample.select("text", "y"), "y int, marks array<long>", marks).collect()
    rows = sorted(rows, key=lambda r: (r.y, r.marks))
    y = np.array([r.y for r in rows], np.float32)
    weight = np.where(y == 1, every[1] / n[1], every[0] / n[0])
    _fit(model, [np.array(r.marks, np.int64) for r in rows], y, weight)
    drop_saved(sample)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id` and `score` (0 to 1, higher is more toxic) of every row.

    A null or empty text has the score of the bias. Rows that repeat get equal
    scores; other columns are ignored; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    restorers: list[Restorer] = []

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        if not restorers:
            restorers.append(Restorer(held.value.language))
        return {"doc_id": batch.column(0), "score": held.value.scores(restorers[0], texts)}

    return map_texts(docs.select("doc_id", "text"), "doc_id long, score double", each)
