"""Token ids in files: static range asymmetric numeral system over shared tables.

One table of symbol frequencies, counted over all documents, serves every block. A
block holds whole consecutive documents, about `BLOCK_TOKENS` ids, coded by `LANES`
interleaved coders that share one stream of 32-bit words; it can be decoded without
any other block. Inside a block, checkpoints give the coders' states and the place
in the stream every `CHECK_STEPS` steps, so parts of it can be decoded side by side.
Every block has a CRC-32 of its words and one of its ids.

A file is Parquet with one row for each block, written by Spark, which also takes
care of lost and repeated tasks; the table lies beside them with a checksum. Files are in ascending order of `doc_id`: `part`
numbers ranges of ids, `block` the blocks in a range, `before` counts the range's
ids before a block.
"""

from __future__ import annotations

import itertools
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_marts.llm.shared import drop_saved, map_texts, saved, shared_root
from trip_marts.llm.textarrays import LOWER, byte_hashes, distinct_slices, joined, ranges, word_places

LANES = 1024
BLOCK_TOKENS = 1 << 18
CHECK_STEPS = 64
SCALE = 20
_LOW = np.uint64(1 << 31)
_U = np.uint64
FILE_SCHEMA = (
    "part int, block int, before long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, words binary,"
    " states binary, check_words array<long>, words_crc long, ids_crc long"
)

#: New words given to the library at once.
ASKED = 1024
TABLE_SCHEMA = "id long, part long, crc long"


@dataclass
class Frequencies:
    """Share of every symbol in `1 << SCALE`, at least 1 for each that occurs."""

    parts: np.ndarray

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Frequencies:
        if (counts > 0).sum() > 1 << SCALE:
            raise ValueError("more symbols than the tables have room for")
        parts = np.where(counts > 0, np.maximum(1, counts * float(1 << SCALE) // max(counts.sum(), 1)), 0).astype(np.int64)
        over = int(parts.sum()) - (1 << SCALE)
        for i in np.argsort(-parts, kind="stable"):  # the largest give or take what is left
            if over == 0 or not parts.any():
                break
            change = min(over, int(parts[i]) - 1) if over > 0 else over
            parts[i] -= change
            over -= change
        return cls(parts)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts = np.concatenate([[0], np.cumsum(self.parts)[:-1]])
        return self.parts.astype(_U), starts.astype(_U), np.repeat(np.arange(len(self.parts)), self.parts)


class Coder:
    """Encodes and decodes blocks of ids with one frequency table."""

    def __init__(self, frequencies: Frequencies) -> None:
        self.parts, self.starts, self.symbols = frequencies.tables()

    def encode(self, ids: np.ndarray) -> tuple[bytes, bytes, list[int]]:
        """Words, states at the checkpoints, and how many words precede each."""
        steps = -(-len(ids) // LANES)
        state = np.full(LANES, _LOW, _U)
        chunks: list[np.ndarray] = []
        states: list[np.ndarray] = []
        for step in range(steps - 1, -1, -1):
            own = ids[step * LANES : (step + 1) * LANES]
            x, part = state[: len(own)], self.parts[own]
            full = x >= part << _U(63 - SCALE)
            chunks.append((x[full] & _U(0xFFFFFFFF)).astype("<u4"))
            x = np.where(full, x >> _U(32), x)
            whole = x // part
            state[: len(own)] = (whole << _U(SCALE)) + (x - whole * part) + self.starts[own]
            if step % CHECK_STEPS == 0:
                states.append(state.copy())
        sizes = np.concatenate([[0], np.cumsum([len(c) for c in reversed(chunks)])])
        words = np.concatenate(chunks[::-1]) if chunks else np.zeros(0, "<u4")
        marks = [int(sizes[s]) for s in range(0, steps, CHECK_STEPS)]
        return words.tobytes(), b"".join(s.astype("<u8").tobytes() for s in states[::-1]), marks

    def decode(self, words: bytes, states: bytes, marks: list[int], n: int, first: int = 0, last: int | None = None) -> np.ndarray:
        """Ids from checkpoint `first` up to checkpoint `last` (to the end if None)."""
        stream = np.frombuffer(words, "<u4")
        saved_states = np.frombuffer(states, "<u8").reshape(-1, LANES)
        steps = -(-n // LANES)
        begin = first * CHECK_STEPS
        end = steps if last is None else min(steps, last * CHECK_STEPS)
        out = np.empty(max(0, min(n, end * LANES) - begin * LANES), np.int64)
        if not len(out):
            return out
        state, at, done = saved_states[first].astype(_U), marks[first], 0
        for step in range(begin, end):
            size = min(LANES, n - step * LANES)
            x = state[:size]
            slot = x & _U((1 << SCALE) - 1)
            own = self.symbols[slot.astype(np.int64)]
            out[done : done + size] = own
            x = self.parts[own] * (x >> _U(SCALE)) + slot - self.starts[own]
            low = np.flatnonzero(x < _LOW)
            x[low] = (x[low] << _U(32)) | stream[at : at + len(low)]
            at += len(low)
            state[:size] = x
            done += size
        return out


class KnownWords:
    """Ids of words by their hashes, as sorted arrays of some 40 bytes a word."""

    def __init__(self, hashes: np.ndarray, checks: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, np.int64)
        order = np.argsort(hashes)
        self.hashes, self.checks, self.sizes, self.begins, self.ids = hashes[order], checks[order], sizes[order], begins[order], ids
        self.used = np.zeros(len(order), bool)

    @classmethod
    def none(cls) -> KnownWords:
        return cls(np.zeros(0, _U), np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, "<u4"))

    def find(self, hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of every word, and whether it is known at all."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, (self.hashes[at] == hashes) & (self.checks[at] == checks)

    def ids_at(self, at: np.ndarray) -> np.ndarray:
        return self.ids[ranges(self.begins[at], self.begins[at] + self.sizes[at])]

    def still_used(self) -> KnownWords:
        """The words that were found since these arrays were made."""
        at = np.flatnonzero(self.used)
        return KnownWords(self.hashes[at], self.checks[at], self.sizes[at], self.ids_at(at))

    def joined(self, other: KnownWords) -> KnownWords:
        """Both; a word is in one of them only."""
        pairs = [(getattr(self, n), getattr(other, n)) for n in ("hashes", "checks", "sizes")]
        every = [self.ids_at(np.arange(len(self.hashes))), other.ids_at(np.arange(len(other.hashes)))]
        return KnownWords(*[np.concatenate(p) for p in pairs], np.concatenate(every))


class WordTokenizer:
    """A tokenizer of the tokenizers library that encodes every distinct word once.

    For a vocabulary whose pre-tokenizer drops white space, no token, and nothing that
    decides on one, reaches across white space. So texts are cut there, A-Z are folded, which
    the vocabulary's own normaliser does too, and ids of words are kept in a bounded cache. A full
    stop or comma that ends a word behind a letter a-z is a token of its own. Words with `<`,
    which may hold the text of a special token, are left as they are.
    """

    def __init__(self, path: str, most: int = 3 << 18) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.most = most
        self.known, self.recent = KnownWords.none(), KnownWords.none()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and where each text's begin (n + 1 places)."""
        data, text_starts = joined(texts)
        lo, hi = _pieces(data)
        folded = LOWER[data]
        for i in _holding(lo, hi, np.flatnonzero(data == 0x3C)):
            folded[lo[i] : hi[i]] = data[lo[i] : hi[i]]
        if not len(lo):
            return np.zeros(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        which, hashes = distinct_slices(folded, lo, hi)
        sample = np.empty(len(hashes), np.int64)
        sample[which[::-1]] = np.arange(len(which))[::-1]
        own, at = self._ids(hashes, folded, lo[sample], hi[sample])
        out = own[ranges(at[which], at[which + 1])]
        counts = np.concatenate([[0], np.cumsum(at[which + 1] - at[which])])
        return out, counts[np.searchsorted(lo, np.append(text_starts, len(data)))]

    def _ids(self, hashes: np.ndarray, data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words in order, and where each word's begin."""
        checks = byte_hashes(data, np.maximum(lo, hi - 8), hi) ^ (hi - lo).astype(_U)
        places = [known.find(hashes, checks) for known in (self.known, self.recent)]
        sizes = np.zeros(len(hashes), np.int64)
        for known, (at, hit) in zip((self.known, self.recent), places):
            sizes[hit] = known.sizes[at[hit]]
            known.used[at[hit]] = True
        miss = np.flatnonzero(~places[0][1] & ~places[1][1])
        raw, found = data.tobytes(), []
        for some in itertools.batched(miss.tolist(), ASKED):
            asked = self.library.encode_batch_fast([raw[lo[i] : hi[i]].decode() for i in some], add_special_tokens=False)
            found += [e.ids for e in asked]
        sizes[miss] = [len(f) for f in found]
        begin = np.concatenate([[0], np.cumsum(sizes)])
        out = np.zeros(begin[-1], "<u4")
        for known, (at, hit) in zip((self.known, self.recent), places):
            out[ranges(begin[:-1][hit], begin[1:][hit])] = known.ids_at(at[hit])
        new = np.array(list(itertools.chain.from_iterable(found)), "<u4")
        out[ranges(begin[miss], begin[miss + 1])] = new
        self._keep(KnownWords(hashes[miss], checks[miss], sizes[miss], new))
        return out, begin

    def _keep(self, new: KnownWords) -> None:
        """Add words; the large sorted arrays are merged with an eighth of their size at once."""
        self.recent = self.recent.joined(new)
        if len(self.recent.hashes) * 8 < len(self.known.hashes) + (1 << 16):
            return
        if len(self.known.hashes) + len(self.recent.hashes) > self.most:
            self.known = self.known.still_used()
        if len(self.known.hashes) + len(self.recent.hashes) > self.most:
            self.known = KnownWords.none()
        self.known, self.recent = self.known.joined(self.recent), KnownWords.none()


def _pieces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words, full stops and commas cut off behind a-z."""
    lo, hi = word_places(data)
    last = data[hi - 1]
    before = LOWER[data[np.maximum(hi - 2, lo)]]
    cut = ((last == 0x2E) | (last == 0x2C)) & (hi - lo > 1) & (before >= 0x61) & (before <= 0x7A)
    cut[_holding(lo, hi, np.flatnonzero(data == 0x3C))] = False
    second = np.repeat(cut, cut + 1)
    second[np.flatnonzero(second)[::2]] = False  # of the two halves of a cut word, the second
    first = np.repeat(cut, cut + 1) & ~second
    lo, hi = np.repeat(lo, cut + 1), np.repeat(hi, cut + 1)
    return np.where(second, hi - 1, lo), np.where(first, hi - 1, hi)


def _holding(lo: np.ndarray, hi: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers of the slices that hold at least one of the places."""
    at = np.searchsorted(lo, places, "right") - 1
    return np.unique(at[(at >= 0) & (places < hi[np.maximum(at, 0)])])


_tokenizers: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for all tasks of a worker, with what it knows."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def tokenize(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """`doc_id` and `ids` (little-endian unsigned 32-bit, `end_id` last) of every row.

    `ids` are packed, see `unpacked`.
    """

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        packer = zstandard.ZstdCompressor(level=1)
        ids, at = _tokenizer(tokenizer).encode(texts)
        raw = [np.append(ids[a:b], np.uint32(end_id)) for a, b in itertools.pairwise(at)]
        return {"doc_id": batch.column(0), "ids": [packed(own, packer) for own in raw]}

    return map_texts(docs.select("doc_id", "text"), "doc_id long, ids binary", each)


def packed(ids: np.ndarray, packer: zstandard.ZstdCompressor) -> bytes:
    """Ids with all low bytes first, then all second bytes and so on, compressed."""
    return packer.compress(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpacked(data: bytes, reader: zstandard.ZstdDecompressor) -> np.ndarray:
    """Ids from `packed` bytes."""
    return np.ascontiguousarray(np.frombuffer(reader.decompress(data), np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def frequencies(encoded: DataFrame) -> Frequencies:
    """Symbol counts over all rows; one number for each symbol reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, reader = np.zeros(1, np.int64), zstandard.ZstdDecompressor()
        for batch in batches:
            for ids in batch.column(0):
                own = np.bincount(unpacked(ids.as_py(), reader))
                if len(own) > len(total):
                    own[: len(total)] += total
                    total = own
                else:
                    total[: len(own)] += own
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["id", "n"])

    rows = encoded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.id for r in rows), default=0) + 1, np.int64)
    for r in rows:
        counts[r.id] = r.n
    return Frequencies.of_counts(counts)


def blocks(encoded: DataFrame, table: Frequencies, tasks: int) -> DataFrame:
    """Rows of the files: encoded blocks in ascending order of `doc_id`.

    Ids are ordered by range partitions, nulls first; equal ids by a hash of their tokens.
    """
    held = encoded.sparkSession.sparkContext.broadcast(table)  # one number for each symbol

    def block(coder: Coder, part: int, number: int, before: int, docs: list[tuple[int | None, np.ndarray]]) -> dict:
        ids = np.concatenate([d for _, d in docs]).astype(np.int64)
        words, states, marks = coder.encode(ids)
        return {
            "part": part, "block": number, "before": before, "n_tokens": len(ids), "doc_ids": [i for i, _ in docs],
            "doc_tokens": [len(d) for _, d in docs], "words": words, "states": states, "check_words": marks,
            "words_crc": zlib.crc32(words), "ids_crc": zlib.crc32(ids.astype("<u4").tobytes()),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from trip_marts.llm.shared import DataFrameSchema

        schema = DataFrameSchema(FILE_SCHEMA).arrow()
        coder, reader = Coder(held.value), zstandard.ZstdDecompressor()
        docs: list[tuple[int | None, np.ndarray]] = []
        size, number, part, before = 0, 0, 0, 0
        for batch in batches:
            for i, ids, p in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), batch.column("part").to_pylist()):
                own = unpacked(ids.as_py(), reader)
                docs.append((i, own))
                size, part = size + len(own), p
                if size >= BLOCK_TOKENS:
                    yield pa.RecordBatch.from_pylist([block(coder, part, number, before, docs)], schema)
                    docs, size, number, before = [], 0, number + 1, before + size
        if docs:
            yield pa.RecordBatch.from_pylist([block(coder, part, number, before, docs)], schema)

    # ranges are sampled at the driver, so they go by a hash of the ids and not the ids themselves
    keys = ["doc_id", F.xxhash64("ids")]
    ordered = encoded.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    return ordered.withColumn("part", F.spark_partition_id()).mapInArrow(run, FILE_SCHEMA)


def _block_ids(coder: Coder, row: dict, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of a block from checkpoint `first` up to `last`; a block whose checksums don't fit raises."""
    if zlib.crc32(row["words"]) != row["words_crc"]:
        raise ValueError(f"damaged words in part {row['part']}, block {row['block']}")
    ids = coder.decode(row["words"], row["states"], row["check_words"], row["n_tokens"], first, last).astype("<u4")
    if (first, last) == (0, None) and zlib.crc32(ids.tobytes()) != row["ids_crc"]:
        raise ValueError(f"wrong ids in part {row['part']}, block {row['block']}")
    return ids


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """Every document of the files below `path`: `doc_id`, `start`, `n_tokens`, `ids`.

    The files are all that is needed. A block whose checksums don't fit ends the job.
    """
    held = spark.sparkContext.broadcast(read_table(spark, path))
    files = spark.read.schema(FILE_SCHEMA).parquet(f"{path}/blocks")
    totals = {r.part: r.n for r in files.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    before = dict(zip(sorted(totals), itertools.accumulate([totals[p] for p in sorted(totals)][:-1], initial=0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(held.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = _block_ids(coder, row)
                edges = np.concatenate([[0], np.cumsum(row["doc_tokens"])])
                start = before[row["part"]] + row["before"] + edges[:-1]
                own = [ids[a:b].tobytes() for a, b in itertools.pairwise(edges)]
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(start), pa.array(np.diff(edges)), pa.array(own)]
                yield pa.record_batch(columns, names=["doc_id", "start", "n_tokens", "ids"])

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def read_some(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """`doc_id` and `ids` of some documents, decoding from the checkpoint before each of them.

    Blocks without any of them are not decoded. Ids that no document has give no row.
    """
    held = spark.sparkContext.broadcast((read_table(spark, path), frozenset(doc_ids)))
    wanted = F.arrays_overlap("doc_ids", F.array(*[F.lit(i).cast("long") for i in doc_ids]).cast("array<long>"))
    files = spark.read.schema(FILE_SCHEMA).parquet(f"{path}/blocks").where(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, sought, size = Coder(held.value[0]), held.value[1], CHECK_STEPS * LANES
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                edges = np.concatenate([[0], np.cumsum(row["doc_tokens"])]).tolist()
                for doc, lo, hi in zip(row["doc_ids"], edges, edges[1:]):
                    if doc in sought:
                        first = lo // size
                        ids = _block_ids(coder, row, first, -(-hi // size))
                        own = ids[lo - first * size : hi - first * size].tobytes()
                        yield pa.record_batch([pa.array([doc], pa.int64()), pa.array([own])], names=["doc_id", "ids"])

    return files.mapInArrow(run, "doc_id long, ids binary")


def _table_crc(table: Frequencies) -> int:
    return zlib.crc32(table.parts.astype("<i8").tobytes())


def read_table(spark: SparkSession, path: str) -> Frequencies:
    """The frequency table that lies beside the blocks; its checksum must fit."""
    rows = spark.read.schema(TABLE_SCHEMA).parquet(f"{path}/table").collect()  # one row for each symbol
    parts = np.zeros(max((r.id for r in rows), default=0) + 1, np.int64)
    for r in rows:
        parts[r.id] = r.part
    table = Frequencies(parts)
    if any(r.crc != _table_crc(table) for r in rows):
        raise ValueError(f"damaged frequency table below {path}")
    return table


def write_files(docs: DataFrame, tokenizer: str, end_id: int = 1) -> str:
    """Files of all documents below the shared folder; returns their path.

    `blocks` has the coded ids, `table` the frequencies they are decoded with. Null or empty
    texts have the end id only; rows that repeat are written each; other columns are
    ignored; an empty table gives no blocks.
    """
    spark = docs.sparkSession
    path = f"{shared_root(spark)}/token-files-{uuid.uuid4().hex}"
    encoded = saved(tokenize(docs, tokenizer, end_id), "ids")
    table = frequencies(encoded)
    used = np.flatnonzero(table.parts)
    crc = _table_crc(Frequencies(table.parts[: used[-1] + 1 if len(used) else 1]))
    rows = [(int(i), int(table.parts[i]), crc) for i in used]
    spark.createDataFrame(rows, TABLE_SCHEMA).coalesce(1).write.parquet(f"{path}/table")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks(encoded, table, tasks).write.parquet(f"{path}/blocks")
    drop_saved(encoded)
    return path


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Digest of what is read back from the files: one row for each document.

    Odd rows are written as in `write_files` and come back as they were written.
    """
    path = write_files(docs, tokenizer, end_id)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = [zlib.crc32(x.as_buffer()) for x in batch.column("ids")]
            yield pa.record_batch([*batch.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_back(docs.sparkSession, path).mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_tokenizer() -> str:
    """The public vocabulary of the registered query."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
