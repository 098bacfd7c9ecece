"""Quality classifier on averaged subword vectors.

Words, pairs of equal neighbours and character n-grams are hashed to rows of a
table of learned vectors; a document is the mean of its vectors, a softmax on top
gives the class. Vectors and softmax are trained together by stochastic gradient
descent in numpy on a bounded sample of labelled documents. For scoring, the table
is multiplied by the difference of the output rows first: what is left is one
number for each bucket, so scoring a text is a gather and a mean.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_marts.llm.grams import bucket_of, char_grams
from trip_marts.llm.shared import map_texts
from trip_marts.llm.textarrays import bounds, words

BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
_TWICE = np.array([0x7477696365], np.uint64)


@dataclass(frozen=True)
class Training:
    """`sample`: labelled documents that are used at most, chosen by hash."""

    sample: int = 2000
    size: int = 8
    epochs: int = 12
    rate: float = 0.4
    seed: int = 5


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every word, repeated neighbour and n-gram."""
    owner, hashes = words(texts)
    again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])) + 1
    gram_owner, grams = char_grams(texts, GRAMS, BUCKETS)
    parts = [bucket_of(hashes, BUCKETS), np.repeat(bucket_of(_TWICE, BUCKETS), len(again)), grams]
    return np.concatenate([owner, owner[again], gram_owner]), np.concatenate(parts)


@dataclass
class Model:
    """One weight for each bucket and a bias, both of the difference of the classes."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        owner, found = features(texts)
        sums = np.bincount(owner, self.weights[found], len(texts))
        counts = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        return 1 / (1 + np.exp(-np.clip(sums / counts + self.bias, -50, 50)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, most: int) -> DataFrame:
    """`doc_id`, `text`, `y` of labelled documents outside of the held-out fold.

    At most `most` documents, by hash of the id, so the choice spreads over the
    table and stays the same from run to run.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(fold(modulus) != held_out)
    chosen = chosen.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)  # the size bound of the broadcast
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def fold(modulus: int):
    """The fold of a document: CRC-32 of its id as text."""
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def _fit(rows: list[tuple[np.ndarray, np.ndarray, int]], how: Training) -> Model:
    """Stochastic gradient descent over documents given as buckets and their shares.

    A step is divided by the squared length of the shares, so that it moves the
    mean vector of a long document as far as that of a short one.
    """
    if not rows:
        return Model(np.zeros(BUCKETS), 0.0)
    random = np.random.default_rng(how.seed)
    table = random.uniform(-1 / how.size, 1 / how.size, (BUCKETS, how.size)).astype(np.float32)
    out, bias = random.normal(0, 0.5, (how.size, 2)).astype(np.float32), np.zeros(2, np.float32)
    steps, total = 0, how.epochs * len(rows)
    for _ in range(how.epochs):
        for i in random.permutation(len(rows)):
            found, share, y = rows[i]
            rate = how.rate * (1 - steps / total)
            steps += 1
            mean = share @ table[found]
            logits = mean @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= rate * 0.1 * p
            length = float(share @ share)
            table[found] -= np.outer(share, (rate / length if length else 0) * back)
    return Model(table @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, how: Training = Training(), modulus: int = 5, held_out: int = 0) -> Model:
    """A model for `labels.quality`; the held-out fold is never read.

    Without labelled documents every score is one half; with one class only the
    scores lean to it.
    """

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        owner, found = features(texts)
        keys, counts = np.unique(owner * BUCKETS + found, return_counts=True)
        edges, own = bounds(keys // BUCKETS, len(texts)), (keys % BUCKETS).astype(np.int32)
        buckets, shares = [], []
        for a, b in zip(edges[:-1], edges[1:]):
            buckets.append(own[a:b].tobytes())
            shares.append((counts[a:b] / max(counts[a:b].sum(), 1)).astype(np.float32).tobytes())
        return {"y": batch.column(2), "buckets": buckets, "shares": shares}

    sample = labelled_sample(docs, labels, "quality", modulus, held_out, how.sample)
    found = map_texts(sample.select("doc_id", "text", "y"), "y int, buckets binary, shares binary", each).collect()
    rows = [(np.frombuffer(r.buckets, np.int32), np.frombuffer(r.shares, np.float32), int(r.y)) for r in found]
    return _fit(sorted(rows, key=lambda r: (r[2], r[0].tobytes())), how)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id` and `score` (0 to 1, higher is better) of every row.

    A null or empty text has the score of the bias. Rows that repeat get equal
    scores; other columns are ignored; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        return {"doc_id": batch.column(0), "score": held.value.scores(texts)}

    return map_texts(docs.select("doc_id", "text"), "doc_id long, score double", each)


def accepted(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """The rows of `docs` whose score is `least` or more, unchanged."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        from trip_marts.llm.shared import pieces

        for batch in batches:
            for piece, texts in pieces(batch):
                yield piece.filter(pa.array(held.value.scores(texts) >= least))

    return docs.mapInArrow(keep, docs.schema)
