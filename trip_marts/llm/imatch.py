"""I-Match fingerprints: hashes of sorted terms inside randomised lexicons.

Terms whose inverse document frequency lies in a band make up the lexicon. Its
randomised subsets come in levels: at level l each of `SUBSETS` subsets keeps a
term with probability 2**-l, by a hash of the term. A document uses the three levels at
which a subset holds about half a term to four of its terms, so that a signature, the hash
of the sorted distinct terms of one subset, covers few terms whatever the length,
and an edit leaves the signatures of the subsets that it doesn't touch.

The common end of the band is decided exactly over distinct texts, so that copies of a
text don't make its terms common: terms in more than `share` of the distinct texts are at
most (mean distinct terms of a text) / `share` many, which bounds what is broadcast.

At the rare end, terms of a single distinct text, such as typos and numbers, are left out. Terms
of several texts are told from those by a filter of at most `MAX_BITS` bits, so no table of
all terms is needed; a false positive keeps a rare term, for every text alike, and beyond some
sixteen million terms ever more rare ones stay in. A text with less than half of its terms
inside the band also has signatures of all its terms, on levels of their own, so that only
blank texts have none and its edits stay comparable.
"""

from __future__ import annotations

import bisect
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_marts.llm.shared import drop_saved, map_texts, pieces, saved
from trip_marts.llm.textarrays import bounds, mix, words

SUBSETS = 32
#: Bits of the filter of repeated terms for each of them, and the most it has: 32 MB.
BITS_A_TERM = 16
MAX_BITS = 1 << 28
LEAST_BITS = 1 << 12
_U = np.uint64


@dataclass(frozen=True)
class Band:
    """Terms in more than `share` of the distinct texts, or in one only, are left out."""

    share: float = 0.05


@dataclass(frozen=True)
class Lexicon:
    """Terms inside the band: `common`, sorted, are above it, those not in `repeated` below.

    `repeated` is a filter in words of 64 bits, a power of two many.
    """

    common: np.ndarray
    repeated: np.ndarray

    def inside(self, own: np.ndarray) -> np.ndarray:
        """Which of the terms the band holds."""
        found = np.ones(len(own), bool)
        for place in filter_places(own, 64 * len(self.repeated)):
            found &= (self.repeated[place >> _U(6)] >> (place & _U(63))) & _U(1) == 1
        if len(self.common):
            at = np.minimum(np.searchsorted(self.common, own), len(self.common) - 1)
            found &= self.common[at] != own
        return found


def terms(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct word hashes of every text."""
    owner, hashes = words(texts)
    edges = bounds(owner, len(texts))
    return [np.unique(hashes[a:b]) for a, b in zip(edges[:-1], edges[1:])]


def filter_places(own: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a filter that each term falls on."""
    drawn = mix(own + _U(0x2545F4914F6CDD1D))
    return (drawn >> _U(32)) & _U(bits - 1), drawn & _U(bits - 1)


def filter_of(repeated: DataFrame) -> np.ndarray:
    """The filter of the terms in column `term`.

    Spark gathers its bits; what comes to the driver is bounded by `MAX_BITS` / 64 words.
    """
    n = repeated.count()
    bits = min(MAX_BITS, max(LEAST_BITS, 1 << (BITS_A_TERM * max(n, 1) - 1).bit_length()))

    def places(batches):
        for batch in batches:
            at = np.concatenate(filter_places(batch.column(0).to_numpy().view(_U), bits))
            one = np.left_shift(_U(1), at & _U(63)).view(np.int64)
            yield pa.record_batch([pa.array((at >> _U(6)).astype(np.int64)), pa.array(one)], names=["word", "bits"])

    placed = repeated.select("term").mapInArrow(places, "word long, bits long")
    found = placed.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(bits // 64, _U)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(_U)
    return out


def lexicon(docs: DataFrame, band: Band = Band()) -> Lexicon:
    """What decides whether a term is inside the band, from all rows; null counts as empty.

    One pass counts the terms, with the least and the greatest hash of the texts that hold each:
    where they differ, a term is in several distinct texts, however many copies those have.
    """
    hashed = docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    limit = band.share * hashed.select("h").distinct().count()
    ends = np.iinfo(np.int64)

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        once = dict(zip(texts, batch.column(1).to_pylist()))
        own = terms(list(once))
        every, at, n = np.unique(np.concatenate(own), return_index=True, return_counts=True)
        h = np.repeat(np.array(list(once.values()), np.int64), [len(o) for o in own])[at]
        several = n > 1
        return {"term": every.view(np.int64), "n": n, "lo": np.where(several, ends.min, h), "hi": np.where(several, ends.max, h)}

    counts = map_texts(hashed, "term long, n long, lo long, hi long", each).groupBy("term")
    counts = counts.agg(F.sum("n").alias("n"), (F.min("lo") < F.max("hi")).alias("several"))
    kept = saved(counts.where((F.col("n") > limit) | F.col("several")), "terms")
    made = Lexicon(_common(hashed, kept, limit), filter_of(kept.where("several")))
    drop_saved(kept)
    return made


def _common(hashed: DataFrame, counts: DataFrame, limit: float) -> np.ndarray:
    """Hashes of the terms in more than `limit` distinct texts, sorted.

    Counts in which only copies within one piece are taken together bound frequencies
    from above and give the candidates. Then every row says as bits which candidates
    it holds, and each text counts once. The number of distinct terms in a mean text
    divided by the share, times the mean number of copies, bounds the candidates.
    """
    found = counts.where(F.col("n") > limit).select("term").collect()
    candidates = np.sort(np.array([r.term for r in found], np.int64).view(_U))
    if not len(candidates):
        return candidates
    held = hashed.sparkSession.sparkContext.broadcast(candidates)

    def marks(batch: pa.RecordBatch, texts: list[str]) -> dict:
        once = dict(zip(batch.column(1).to_pylist(), texts))
        bits = []
        for own in terms(list(once.values())):
            at = np.minimum(np.searchsorted(own, held.value), max(len(own) - 1, 0))
            found = own[at] == held.value if len(own) else np.zeros(len(held.value), bool)
            bits.append(np.packbits(found).tobytes())
        return {"h": list(once), "bits": bits}

    def added(batches):
        sums = np.zeros(len(held.value), np.int64)
        for batch in batches:
            for bits in batch.column(0).to_pylist():
                sums += np.unpackbits(np.frombuffer(bits, np.uint8), count=len(sums))
        yield pa.record_batch([pa.array(np.flatnonzero(sums)), pa.array(sums[sums > 0])], names=["i", "n"])

    once = map_texts(hashed, "h long, bits binary", marks).distinct()  # equal texts, equal bits
    total = once.select("bits").mapInArrow(added, "i long, n long").groupBy("i").agg(F.sum("n").alias("n"))
    return candidates[sorted(r.i for r in total.where(F.col("n") > limit).collect())]


_SALTS = mix(np.arange(1, SUBSETS + 1, dtype=_U) * _U(0x5851F42D4C957F2D))


def fingerprint(own: np.ndarray) -> dict[tuple[int, int], int]:
    """Signatures by level and subset, of sorted terms."""
    if len(own) == 0:
        return {}
    level = max(0, len(own).bit_length() - 2)
    drawn = mix(own[None, :] + _SALTS[:, None])
    signatures = {}
    for lvl in (level, level + 1, level + 2):
        inside = drawn < _U((1 << 64) - 1 >> lvl) if lvl else np.ones_like(drawn, bool)
        for k in np.flatnonzero(inside.any(axis=1)):
            data = own[inside[k]].tobytes()
            signatures[lvl, int(k)] = int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")
    return signatures


def likeness(a: dict[tuple[int, int], int], b: dict[tuple[int, int], int]) -> float:
    """Best share of equal signatures over the levels that both have; 0 to 1.

    Two blank texts are alike, a blank text is like no other.
    """
    if not a or not b:
        return float(not a and not b)
    best = 0.0
    for lvl in {k[0] for k in a} & {k[0] for k in b}:
        mine, other = {k for k in a if k[0] == lvl}, {k for k in b if k[0] == lvl}
        same = sum(a[k] == b[k] for k in mine & other)
        best = max(best, same / len(mine | other))
    return best


def as_text(signatures: dict[tuple[int, int], int]) -> str:
    """Hexadecimal form: level, subset and signature of each, sorted."""
    return " ".join(f"{lvl:02x}{k:02x}{s:016x}" for (lvl, k), s in sorted(signatures.items()))


#: Added to the levels of signatures that cover all terms of a text.
ALL_TERMS = 0x40


class Printer:
    """Fingerprints of texts by the terms of a lexicon."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon

    def prints(self, texts: list[str]) -> list[dict[tuple[int, int], int]]:
        made = []
        for own in terms(texts):
            inside = self.lexicon.inside(own)
            found = fingerprint(own[inside])
            if 2 * inside.sum() < len(own):
                found |= {(lvl | ALL_TERMS, k): s for (lvl, k), s in fingerprint(own).items()}
            made.append(found)
        return made


def fingerprints(docs: DataFrame, band: Band = Band()) -> DataFrame:
    """`doc_id` and `fingerprint` of every row of `docs`.

    Null or blank texts, and no others, have an empty fingerprint; equal texts have
    equal ones; rows that repeat are done each; other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(lexicon(docs, band))

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        return {"doc_id": batch.column(0), "fingerprint": [as_text(p) for p in Printer(held.value).prints(texts)]}

    return map_texts(docs.select("doc_id", "text"), "doc_id long, fingerprint string", each)


def edited(text: str, following: str) -> str:
    """`text` with its last quarter replaced by as much of the start of `following`."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def with_following(docs: DataFrame, ranges: int) -> DataFrame:
    """`doc_id`, `packed`, `first`: compressed texts in runs of ascending `doc_id`.

    Ranges of ids meet in one partition each, in order; the first text of each range
    is also sent to the range before, with `first` set, behind that range's rows. Only
    the limits of the ranges reach the driver. Ids that are null come first, equal
    ids are ordered by their texts' hashes.
    """
    limits = []
    if ranges > 1:
        steps = [i / ranges for i in range(1, ranges)]
        limits = sorted({int(x) for x in docs.select("doc_id").dropna().approxQuantile("doc_id", steps, 0.1 / ranges)})

    def range_of(ids: list[int | None]) -> list[int]:
        return [0 if i is None else bisect.bisect_left(limits, i) for i in ids]

    def heads(batches):
        least: dict[int, tuple] = {}
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for row in zip(range_of(ids), ids, batch.column("tie").to_pylist()):
                if row[0] not in least or _order(row) < _order(least[row[0]]):
                    least[row[0]] = row
        columns = list(zip(*least.values())) or [(), (), ()]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()))], names=["bucket", "doc_id", "tie"])

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    own = keyed.select("doc_id", "tie").mapInArrow(heads, "bucket int, doc_id long, tie long")
    own = own.groupBy("bucket").agg(F.min(F.struct("doc_id", "tie")).alias("least"))  # nulls first
    first = {r.bucket: (r.least.doc_id, r.least.tie) for r in own.collect()}  # one for each range
    present = sorted(first)
    before = {b: present[i - 1] for i, b in enumerate(present)}  # the first range follows the last

    def pack(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for piece, texts in pieces(batch):
                rows = []
                for i, tie, text in zip(piece.column("doc_id").to_pylist(), piece.column("tie").to_pylist(), texts):
                    at = range_of([i])[0]
                    data = packer.compress(text.encode())
                    rows.append((i, tie, data, at, False))
                    if first[at] == (i, tie):
                        rows.append((i, tie, data, before[at], True))
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.bool_())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "tie", "packed", "bucket", "first"])

    rows = keyed.mapInArrow(pack, "doc_id long, tie long, packed binary, bucket int, first boolean")
    return rows.repartitionById(ranges, F.col("bucket")).sortWithinPartitions("bucket", "first", "doc_id", "tie")


def _order(row: tuple) -> tuple:
    return (row[1] is not None, row[1] or 0, row[2])


def edit_digest(docs: DataFrame, band: Band = Band()) -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likeness.

    The edited text takes the start of the next document; see `with_following` for
    the order. After the last document comes the first.
    """
    held = docs.sparkSession.sparkContext.broadcast(lexicon(docs, band))
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        printer, reader = Printer(held.value), zstandard.ZstdDecompressor()
        waiting: tuple[int | None, str, int] | None = None
        ready: list[tuple[int | None, str, str]] = []
        copied: int | None = None

        def flush():
            size = 0
            at = 0
            for i, (_, text, following) in enumerate(ready):
                size += len(text) + len(following)
                if size > 1 << 19 or i - at >= 512 or i == len(ready) - 1:
                    yield _digest(printer, ready[at : i + 1])
                    at, size = i + 1, 0

        for batch in batches:
            columns = (batch.column("doc_id").to_pylist(), batch.column("packed").to_pylist(), batch.column("bucket").to_pylist(), batch.column("first").to_pylist())
            for doc_id, packed, bucket, first in zip(*columns):
                text = reader.decompress(packed).decode()
                if first and copied == bucket:
                    continue  # repeated rows at the head of a range
                if waiting:
                    ready.append((waiting[0], waiting[1], text))
                waiting = None if first else (doc_id, text, bucket)
                copied = bucket if first else None
            yield from flush()
            ready = []

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_following(docs.select("doc_id", "text"), ranges).mapInArrow(run, schema)


def _digest(printer: Printer, rows: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
    texts = [t for _, t, _ in rows]
    changed = [edited(t, f) for _, t, f in rows]
    following = [f for _, _, f in rows]
    own, other = printer.prints(texts), printer.prints(changed)
    after = [own[i + 1] if i + 1 < len(rows) and f is texts[i + 1] else printer.prints([f])[0] for i, f in enumerate(following)]
    columns = {
        "doc_id": pa.array([i for i, _, _ in rows], pa.int64()),
        "n_chars": pa.array([len(t) for t in texts], pa.int64()),
        "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        "fingerprint": [as_text(p) for p in own],
        "edited_fingerprint": [as_text(p) for p in other],
        "near_edited": pa.array([likeness(a, b) for a, b in zip(own, other)], pa.float64()),
        "near_next": pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64()),
    }
    return pa.record_batch([x if isinstance(x, pa.Array) else pa.array(x, pa.string()) for x in columns.values()], names=list(columns))
