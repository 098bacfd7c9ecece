"""Mixing documents to target weights of soft domains.

A softmax classifier trained on documents with a domain label gives every document
probabilities of the domains. Each document's rate says how often it is expected
in the mixture. Rates start at 1 and take steps of projected gradient on a least-squares problem: the
squared differences between the expected token shares of the domains and their targets. A
step moves every rate against its gradient, the document's probabilities times the weighted
differences, and projects it onto the numbers from 0. The weights and the step come from
the curvature of the documents whose rate is positive, and a line search picks the length.

A rate follows from the document's own row and the steps so far, a few numbers each. So no
state is kept in between: each round is one pass over a compact table that adds up a few
numbers for all lengths of the line search, and a lost task is repeated.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_marts.llm.grams import char_grams
from trip_marts.llm.shared import drop_saved, map_texts, pieces, saved

BUCKETS = 1 << 12
GRAMS = (2, 3)
#: Shares of the tokens that the registered query and the pipeline aim at.
TARGETS = {"en": 0.5, "de": 0.2, "fr": 0.16, "es": 0.14}


@dataclass(frozen=True)
class Mixing:
    """`sample`: labelled documents that train the classifier, by hash.

    Every domain gives as many, `sample` divided by the number of domains but `least`
    at least, or all of its documents. `rounds` only ends what doesn't converge; where no step of the line search
    lowers the differences any more, targets cannot be met any better.
    """

    domain: str = "lang"
    targets: dict[str, float] = field(default_factory=lambda: dict(TARGETS))
    sample: int = 2000
    least: int = 50
    rounds: int = 200
    tolerance: float = 1e-3


@dataclass
class Classifier:
    """Softmax over relative frequencies of hashed n-grams."""

    domains: list[str]
    weights: np.ndarray
    bias: np.ndarray

    def posteriors(self, texts: list[str]) -> np.ndarray:
        return _softmax(_frequencies(texts) @ self.weights + self.bias)


def _frequencies(texts: list[str]) -> np.ndarray:
    owner, found = char_grams([t.lower() for t in texts], GRAMS, BUCKETS)
    counts = np.bincount(owner * BUCKETS + found, minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(docs: DataFrame, how: Mixing) -> Classifier:
    """A classifier of the domain column, from text alone.

    All rows with a label and a text that is not blank decide which domains there are.
    The same number of documents of each trains the weights; then biases make the mean
    probabilities those of all such rows. Without one there is a single unnamed domain.
    """
    labelled = docs.select("text", F.col(how.domain).cast("string").alias("domain"), F.xxhash64("doc_id", "text").alias("h"))
    labelled = labelled.where(F.col("domain").isNotNull() & F.col("text").rlike("\\S"))
    sizes = {r.domain: r.n for r in labelled.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Classifier([""], np.zeros((BUCKETS, 1)), np.zeros(1))
    domains = sorted(sizes)
    wanted = max(how.least, how.sample // len(domains))
    limits = _limits(labelled.select("domain", "h"), sizes, wanted)

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        return {"domain": batch.column(1), "x": [x.astype(np.float32).tobytes() for x in _frequencies(texts)]}

    chosen = _below(labelled, limits).groupBy("domain", "h").agg(F.first("text").alias("text"))
    rows = map_texts(chosen.select("text", "domain"), "domain string, x binary", each).collect()
    x = np.stack([np.frombuffer(r.x, np.float32) for r in rows]).astype(np.float64)
    own = np.array([domains.index(r.domain) for r in rows])
    y = np.eye(len(domains))[own]
    weights, bias = np.zeros((BUCKETS, len(domains))), np.zeros(len(domains))
    for step in range(300):
        gap = (_softmax(x @ weights + bias) - y) / len(rows)
        weights -= 20 * (x.T @ gap + 1e-5 * weights)
        bias -= 2 * gap.sum(axis=0)
    share = np.array([sizes[d] for d in domains]) / sum(sizes.values())
    each_of = share[own] / y.sum(axis=0)[own]  # what a row of the sample stands for
    logits = x @ weights
    for step in range(1000):
        mean = each_of @ _softmax(logits + bias)
        if np.abs(np.log(mean / share)).max() < 1e-6:
            break
        bias += np.log(share / mean)
    return Classifier(domains, weights, bias)


def _below(rows: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows whose `h` is at most the limit of their `domain`."""
    table = rows.sparkSession.createDataFrame(list(limits.items()), "domain string, most long")
    return rows.join(F.broadcast(table), "domain").where("h <= most").drop("most")


def _limits(keys: DataFrame, sizes: dict[str, int], wanted: int) -> dict[str, int]:
    """For each domain the `wanted`-th smallest distinct `h`, or the largest.

    Only about twice as many hashes as are wanted reach the driver; where copies leave
    too few below the limit guessed from the number of rows, it goes up.
    """
    low, high = -(1 << 63), (1 << 63) - 1
    open_, found, factor = dict(sizes), {}, 1
    while open_:
        guess = {d: min(high, low + int((1 << 64) * min(1.0, factor * (1.5 * wanted + 50) / n))) for d, n in open_.items()}
        rows: dict[str, list[int]] = {d: [] for d in open_}
        for r in _below(keys, guess).distinct().collect():
            rows[r.domain].append(r.h)
        for d, hashes in rows.items():
            if len(hashes) >= wanted or guess[d] == high:
                found[d] = sorted(hashes)[:wanted][-1]
                del open_[d]
        factor *= 4
    return found


@dataclass
class Plan:
    """What gives every document its rate: classifier and steps of projected gradient.

    `residual` is the largest difference between a share of the expected tokens and
    its target; `met` says whether it is within the tolerance.
    """

    classifier: Classifier
    steps: list[np.ndarray]
    shares: np.ndarray
    targets: np.ndarray
    residual: float = 0.0
    met: bool = True

    def rates(self, tokens: np.ndarray, posteriors: np.ndarray) -> np.ndarray:
        return np.where(tokens > 0, stepped(posteriors, self.steps), 1.0)


def stepped(posteriors: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """Rates after some steps, from 1 on."""
    rate = np.ones(len(posteriors))
    for step in steps:
        rate = np.maximum(0, rate - posteriors @ step)
    return rate


#: Step lengths that one pass tries.
STEPS = np.append([4.0, 2.0, 1.5], 0.5 ** np.arange(7))
#: Parts of the largest curvature that are added for directions between the scaled gradient and the plain one.
DAMPING = (0.0, 0.01, 0.1)
FEW_STEPS = STEPS[::3]


def token_counts(texts: list[str]) -> np.ndarray:
    """White-space separated tokens of each text."""
    return np.array([len(t.split()) for t in texts], np.int64)


def memberships(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """`doc_id`, `u` (a hash in [0, 1)), `n_tokens` and `posteriors` of every row."""
    held = docs.sparkSession.sparkContext.broadcast(classifier)

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        soft = held.value.posteriors(texts)
        return {"doc_id": batch.column(0), "u": batch.column(2), "n_tokens": token_counts(texts), "posteriors": soft.tolist()}

    schema = "doc_id long, u double, n_tokens long, posteriors array<double>"
    return map_texts(docs.select("doc_id", "text", _draw().alias("u")), schema, each)


def _draw():
    return F.pmod(F.xxhash64("doc_id", "text", F.lit(17)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    tokens = batch.column("n_tokens").to_numpy()
    soft = batch.column("posteriors").flatten().to_numpy().reshape(len(tokens), -1)
    return tokens, soft


def fit(rows: DataFrame, classifier: Classifier, how: Mixing) -> Plan:
    """Steps that bring the expected token totals of `rows` to the targets.

    Domains without a target keep their share; targets of absent domains are left
    out and the rest is scaled to the present number of tokens. Targets that cannot
    be met within the tolerance are met as nearly as possible by squared differences, and a
    warning and the plan give the residual.
    """
    k = len(classifier.domains)
    total = rows.agg(F.sum("n_tokens")).collect()[0][0]
    if not total:
        return Plan(classifier, [], np.zeros(k), np.zeros(k))
    steps: list[np.ndarray] = []

    def added(tried: np.ndarray) -> np.ndarray:
        """For each further step in `tried`: expected shares, and curvature at the rates it leads to."""

        def run(batches):
            sums = np.zeros((len(tried), k + k * k))
            for batch in batches:
                tokens, soft = _columns(batch)
                weight = tokens / total
                before = stepped(soft, steps)
                for at, step in zip(sums, tried):
                    rate = np.maximum(0, before - soft @ step)
                    active = soft * (weight * (rate > 0))[:, None]
                    at += np.concatenate([(weight * rate) @ soft, (soft.T @ active).ravel()])
            yield pa.record_batch([pa.array(np.arange(sums.size)), pa.array(sums.ravel())], names=["i", "x"])

        sums = rows.select("n_tokens", "posteriors").mapInArrow(run, "i long, x double").groupBy("i").agg(F.sum("x").alias("x"))
        return np.array([r.x for r in sorted(sums.collect(), key=lambda r: r.i)]).reshape(len(tried), -1)

    found = added(np.zeros((1, k)))[0]
    shares = found[:k]
    wanted = np.array([how.targets.get(d, s) for d, s in zip(classifier.domains, shares)])
    wanted = wanted / wanted.sum() if wanted.sum() else shares
    for _ in range(how.rounds):
        apart = found[:k] - wanted
        if np.abs(apart).max() <= how.tolerance * wanted.max() / 10:
            break
        curvature = found[k:].reshape(k, k) + 1e-9 * np.eye(k)
        # the gradient of a rate is its probabilities times `apart`; along the scaled direction a step
        # of 1 would be exact without the projection, along the plain one a short step always gains
        most = np.linalg.norm(curvature, 2)
        scaled = [np.linalg.solve(curvature + share * most * np.eye(k), apart) for share in DAMPING]
        tried = np.concatenate([STEPS[:, None] * scaled[0], *(FEW_STEPS[:, None] * d for d in (*scaled[1:], apart / most))])
        sums = added(tried)
        values = ((sums[:, :k] - wanted) ** 2).sum(axis=1)
        best = int(np.argmin(values))
        if values[best] >= apart @ apart * (1 - 1e-6):
            break  # no step brings the totals nearer
        steps.append(tried[best])
        found = sums[best]
    residual = float(np.abs(found[:k] - wanted).max())
    met = residual <= how.tolerance * wanted.max()
    if not met:
        shown = ", ".join(f"{d} {e:.4f} for {w:.4f}" for d, e, w in zip(classifier.domains, found, wanted))
        warnings.warn(f"targets cannot be met, the largest difference is {residual:.4f}: {shown}", stacklevel=2)
    return Plan(classifier, steps, shares, wanted, residual, met)


def rates(docs: DataFrame, how: Mixing = Mixing()) -> DataFrame:
    """The rate of every row of `docs`: `doc_id`, `n_tokens`, `posteriors`, `rate`, `copies`.

    `posteriors` follow the sorted domain names. `copies` is the rate rounded down or
    up by a hash of id and text, so that it is the rate on average. A null or empty
    text has no tokens and rate 1. Rows that repeat get equal rates; other columns
    are ignored; an empty table gives no rows.
    """
    classifier = train(docs, how)
    rows = saved(memberships(docs, classifier), "memberships")
    plan = fit(rows, classifier, how)

    def run(batches):
        for batch in batches:
            tokens, soft = _columns(batch)
            rate = plan.rates(tokens, soft)
            copies = _copies(rate, batch.column("u").to_numpy())
            columns = [batch.column("doc_id"), batch.column("n_tokens"), batch.column("posteriors"), pa.array(rate), pa.array(copies)]
            yield pa.record_batch(columns, names=["doc_id", "n_tokens", "posteriors", "rate", "copies"])

    return rows.mapInArrow(run, "doc_id long, n_tokens long, posteriors array<double>, rate double, copies long")


def _copies(rate: np.ndarray, u: np.ndarray) -> np.ndarray:
    return np.floor(rate).astype(np.int64) + (u < rate - np.floor(rate))


def mixed(docs: DataFrame, how: Mixing = Mixing()) -> DataFrame:
    """`docs` with every row as often as its `copies` say.

    Rates are worked out again from the text in the same scan, which costs less than
    shuffling all texts to meet them.
    """
    classifier = train(docs, how)
    rows = saved(memberships(docs, classifier), "memberships")
    plan = fit(rows, classifier, how)
    drop_saved(rows)
    held = docs.sparkSession.sparkContext.broadcast(plan)
    names = docs.columns

    def run(batches):
        for batch in batches:
            for piece, texts in pieces(batch):
                rate = held.value.rates(token_counts(texts), held.value.classifier.posteriors(texts))
                copies = _copies(rate, piece.column("_u").to_numpy())
                yield piece.select(names).take(pa.array(np.repeat(np.arange(len(texts)), copies)))

    return docs.withColumn("_u", _draw()).mapInArrow(run, docs.schema)
