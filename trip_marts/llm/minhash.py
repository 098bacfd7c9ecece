"""Near-duplicate documents by fast similarity sketching, banding and exact checks.

A sketch fills its coordinates in rounds. In each of the first `COORDINATES`
rounds every shingle falls into a hashed bin with a hashed value, earlier rounds
counting as smaller, until no bin is empty; the last rounds send all shingles to
one bin each, so that every coordinate is filled, and the share of equal
coordinates is as concentrated around the similarity as with independent hashes.
Documents with an equal band of a sketch are candidates and are checked on whole
shingle sets.

Equal sets form one class first, so a text copied any number of times is one row
from there on. In a bucket only links to two hubs are checked one by one. That
leaves the buckets whose members are still in different components; their members
are compared in blocks of bounded size, in which only links that join components
are emitted. No step emits all pairs of a group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trip_marts.llm.components import components
from trip_marts.llm.shared import drop_saved, map_texts, saved
from trip_marts.llm.textarrays import bounds, mix, words

COORDINATES = 128
BANDS = 32
#: Members of a bucket that are compared in one task, on either side.
BLOCK = 512
#: Bits of the filter of documents whose sets are needed; its size is fixed.
FILTER_BITS = 1 << 24
_U = np.uint64
_EMPTY = _U(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of `width` words.

    A text with fewer words has its whole sequence as its only shingle; one
    without words has none.
    """
    owner, hashes = words(texts)
    edges = bounds(owner, len(texts))
    sets = []
    for a, b in zip(edges[:-1], edges[1:]):
        own = hashes[a:b]
        take = min(width, len(own))
        if take == 0:
            sets.append(own)
            continue
        rolled = np.full(len(own) - take + 1, take, _U)
        for k in range(take):
            rolled = mix(rolled * _U(0x9E3779B97F4A7C15) + own[k : len(own) - take + 1 + k])
        sets.append(np.unique(rolled))
    return sets


def sketch(sets: list[np.ndarray], t: int = COORDINATES) -> np.ndarray:
    """One row of `t` filled coordinates for each non-empty set."""
    out = np.full((len(sets), t), _EMPTY, _U)
    shift = _U(65 - t.bit_length())
    todo = np.array([i for i, s in enumerate(sets) if len(s)], np.int64)
    for r in range(t):
        if len(todo) == 0:
            return out
        owner = np.repeat(todo, [len(sets[i]) for i in todo])
        h = mix(np.concatenate([sets[i] for i in todo]) + mix(np.array([r + 1], _U)))
        place = owner * t + (h >> shift).astype(np.int64)
        value = (_U(r) << _U(56)) | (mix(h) >> _U(8))
        np.minimum.at(out.reshape(-1), place, value)
        todo = todo[(out[todo] == _EMPTY).any(axis=1)]
    for i in todo:
        for b in np.flatnonzero(out[i] == _EMPTY):
            h = mix(sets[i] + mix(np.array([t + b + 1], _U)))
            out[i, b] = (_U(t) << _U(56)) | (h.min() >> _U(8))
    return out


def band_keys(rows: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """A 64-bit key of every band of every sketch; bands never share keys."""
    per = rows.shape[1] // bands
    keys = np.tile(mix(np.arange(1, bands + 1, dtype=_U)), (len(rows), 1))
    for k in range(per):
        keys = mix(keys + mix(rows[:, k::per][:, :bands]))
    return keys.view(np.int64)


def _key_of(s: np.ndarray) -> tuple[int | None, int | None]:
    """128 bits that tell sets apart; none for an empty set."""
    if len(s) == 0:
        return None, None
    digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _sketches(docs: DataFrame, width: int) -> DataFrame:
    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        sets = shingle_sets(texts, width)
        bands, keys = band_keys(sketch(sets)), [_key_of(s) for s in sets]
        return {
            "doc_id": batch.column(0),
            "text_key": batch.column(2),
            "n_shingles": [len(s) for s in sets],
            "k1": [k for k, _ in keys],
            "k2": [k for _, k in keys],
            "bands": [k if len(s) else None for k, s in zip(bands, sets)],
        }

    schema = "doc_id long, text_key long, n_shingles long, k1 long, k2 long, bands array<long>"
    return map_texts(docs.select("doc_id", "text", text_key().alias("text_key")), schema, each)


def text_key(column: str = "text") -> Column:
    """Tells rows with one id but different texts apart."""
    return F.xxhash64(column)


def _bit_of() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))


def _needed_sets(docs: DataFrame, members: DataFrame, classes: DataFrame, width: int) -> DataFrame:
    """`(cls, items)` of the classes in `members`; a few others may be there too.

    Documents are picked in the scan by a bit filter of fixed size, so their texts
    are not shuffled.
    """
    marked = members.select("doc_id").distinct().select(_bit_of().alias("bit"))
    lines = marked.groupBy(F.shiftright("bit", 6).alias("line")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")
    )
    found = lines.toPandas()  # at most FILTER_BITS / 64 rows
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[found["line"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    held = docs.sparkSession.sparkContext.broadcast(bits.view(np.uint8))

    def pick(batches):
        mask = np.unpackbits(held.value, bitorder="little").astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(mask[batch.column(1).to_numpy()]))

    def each(batch: pa.RecordBatch, texts: list[str]) -> dict:
        sets = [s for s in shingle_sets(texts, width) if len(s)]
        keys = [_key_of(s) for s in sets]
        return {"k1": [k for k, _ in keys], "k2": [k for _, k in keys], "items": [s.tobytes() for s in sets]}

    picked = docs.select("text", _bit_of().alias("bit")).mapInArrow(pick, "text string, bit long")
    found = map_texts(picked, "k1 long, k2 long, items binary", each).dropDuplicates(["k1", "k2"])
    return found.join(classes.select("k1", "k2", "cls"), ["k1", "k2"]).select("cls", "items")


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs `(u, v)` whose whole sets are similar enough."""
    left = sets.select(F.col("cls").alias("u"), F.col("items").alias("left"))
    right = sets.select(F.col("cls").alias("v"), F.col("items").alias("right"))

    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("left"), batch.column("right")):
                x, y = np.frombuffer(a.as_buffer(), _U), np.frombuffer(b.as_buffer(), _U)
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * same >= percent * (len(x) + len(y) - same))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "u").join(right, "v").select("u", "v", "left", "right").mapInArrow(run, "u long, v long")


def _similar_size(a: str, b: str, percent: int) -> Column:
    """Sets of too different sizes can't be similar."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def joining_links(names: np.ndarray, parts: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join the components `parts`, between the sides or on one side.

    Side 0 is compared with side 1, or with itself if no row is on side 1.
    """
    root = {p: p for p in parts.tolist()}

    def find(p: int) -> int:
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    left = np.flatnonzero(sides == 0)
    right = np.flatnonzero(sides == 1) if (sides == 1).any() else left
    sizes = np.array([len(s) for s in sets])
    if not len(left):
        return []
    items = np.concatenate([sets[i] for i in left])
    order = np.argsort(items, kind="stable")
    items, holder = items[order], np.repeat(left, sizes[left])[order]
    links = []
    for y in right:
        lo, hi = np.searchsorted(items, sets[y], "left"), np.searchsorted(items, sets[y], "right")
        hits = [holder[a:b] for a, b in zip(lo, hi) if b > a]
        if not hits:
            continue
        same = np.bincount(np.concatenate(hits), minlength=len(sets))
        for x in np.flatnonzero(100 * same >= percent * (sizes + sizes[y] - same)):
            a, b = find(int(parts[x])), find(int(parts[y]))
            if same[x] and a != b:
                root[a] = b
                links.append((int(names[x]), int(names[y])))
    return links


def _left_over(members: DataFrame, parts: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links inside buckets whose members are not in one component yet.

    Members of a bucket's largest component are compared with all others, not among
    themselves, where a link would join nothing.
    """
    known = members.where("size > 3").select("bucket", "cls", "size")  # links of three are all checked
    known = known.join(parts.select(F.col("id").alias("cls"), "component"), "cls", "left")
    known = known.withColumn("component", F.coalesce("component", "cls"))
    held_by = known.groupBy("bucket", "component").agg(F.count("*").alias("k"), F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("who"), F.max("size").alias("size"))
    open_ = held_by.groupBy("bucket").agg(F.count("*").alias("parts"), F.sum("who").alias("who"), F.max("size").alias("size"), F.max(F.struct("k", "component")).alias("main"))
    open_ = open_.where("parts > 1").groupBy("who", "size").agg(F.min(F.struct("bucket", "main")).alias("one"))  # equal buckets once
    open_ = open_.select("one.bucket", F.col("one.main.component").alias("main"), _blocks(F.col("one.main.k")).alias("main_blocks"), (F.col("size") - F.col("one.main.k")).alias("others"))
    rows = known.join(open_, "bucket").withColumn("other_blocks", _blocks(F.col("others")))
    rows = rows.withColumn("inside", F.col("component") == F.col("main"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("cls", F.lit(7)), F.when(F.col("inside"), F.col("main_blocks")).otherwise(F.col("other_blocks"))).cast("int"))
    rows = rows.withColumn("meets", F.explode(_meetings())).select("bucket", "meets.*", "cls", "component")
    rows = rows.join(sets, "cls")

    def block(table: pa.Table) -> pa.Table:
        held = [np.frombuffer(x.as_buffer(), _U) for x in table["items"]]  # in place
        names, parts, sides = (table[c].to_numpy() for c in ("cls", "component", "side"))
        links = joining_links(names, parts, sides, held, percent)
        u, v = [a for a, _ in links], [b for _, b in links]
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return rows.groupBy("bucket", "among", "i", "j").applyInArrow(block, "u long, v long")


def _blocks(members: Column) -> Column:
    return F.ceil(members / BLOCK).cast("int")


def _meetings() -> Column:
    """The comparisons a member takes part in: `(among, i, j, side)`.

    Blocks `i` of the largest component (side 1) meet all blocks `j` of the others;
    `among` tells pairs of blocks of the others.
    """

    def meeting(among: Column, i: Column, j: Column, side: Column) -> Column:
        return F.struct(among.alias("among"), i.alias("i"), j.alias("j"), side.alias("side"))

    def numbers(blocks: str) -> Column:
        return F.sequence(F.lit(0), F.col(blocks) - 1)

    own, yes, no = F.col("own"), F.lit(True), F.lit(False)
    as_main = F.transform(numbers("other_blocks"), lambda j: meeting(no, own, j, F.lit(1)))
    with_main = F.transform(numbers("main_blocks"), lambda i: meeting(no, i, own, F.lit(0)))
    with_others = F.transform(numbers("other_blocks"), lambda j: meeting(yes, F.least(own, j), F.greatest(own, j), (own > j).cast("int")))
    as_other = F.when(F.col("others") > 1, F.concat(with_main, with_others)).otherwise(with_main)
    return F.when(F.col("inside"), as_main).otherwise(as_other)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents whose shingle sets are linked, one row for each row.

    Two documents are linked if 100 * common >= `percent` * united, on sets of
    shingles of `width` words. Columns: `doc_id`, `text_key` (hash of the text),
    `n_shingles`, `component_id` (smallest id that links reach) and `kept`.
    Null or blank texts have no shingles and no links, their own id as component and
    are kept. Repeated rows share a component. Rows with one id but different texts
    are different documents. A null id is smaller than none: the component's id is the
    smallest that is not null. Other columns are ignored; an empty table gives no rows.
    """
    rows = saved(_sketches(docs, width).withColumn("row", F.monotonically_increasing_id()), "sketches")
    # a class is known by the number of its first row
    classes = rows.where("k1 is not null").groupBy("k1", "k2").agg(
        F.min("row").alias("cls"), F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    classes = saved(classes, "classes")
    banded = classes.select("cls", "doc_id", "n", F.explode("bands").alias("bucket"))
    hubs = banded.groupBy("bucket").agg(F.count("*").alias("size"), F.min(F.struct("cls", "n")).alias("low"), F.max(F.struct("cls", "n")).alias("high"))
    members = saved(banded.join(hubs.where("size > 1"), "bucket"), "members")
    sets = saved(_needed_sets(docs, members, classes, width), "sets")
    hub = F.explode(F.array("low", "high")).alias("hub")
    stars = members.select("cls", "n", hub).select(F.least("cls", "hub.cls").alias("u"), F.greatest("cls", "hub.cls").alias("v"), "n", F.col("hub.n").alias("hub_n"))
    stars = stars.where(F.col("u") != F.col("v")).where(_similar_size("n", "hub_n", percent)).select("u", "v").distinct()
    first = components(_checked(stars, sets, percent))
    more = _left_over(members, first, sets, percent)
    label = first.select(F.col("id"), F.col("component").alias("part"))
    moved = more.join(label.withColumnsRenamed({"id": "u", "part": "pu"}), "u", "left")
    moved = moved.join(label.withColumnsRenamed({"id": "v", "part": "pv"}), "v", "left")
    second = components(moved.select(F.coalesce("pu", "u").alias("u"), F.coalesce("pv", "v").alias("v")))
    drop_saved(members)
    drop_saved(sets)

    label = classes.select("k1", "k2", "cls", "doc_id")
    label = label.join(first.select(F.col("id").alias("cls"), "component"), "cls", "full")
    label = label.withColumn("component", F.coalesce("component", "cls"))
    label = label.join(second.select(F.col("id").alias("component"), F.col("component").alias("last")), "component", "full")
    label = label.where("cls is not null or last is not null")
    label = label.select("k1", "k2", "doc_id", F.coalesce("last", "component").alias("component"))
    least = label.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    label = label.join(least, "component").select("k1", "k2", "component_id")
    found = rows.drop("bands", "row").join(label, ["k1", "k2"], "left")
    component = F.when(F.col("k1").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def without_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with the columns of `docs`; repeated rows once."""
    found = near_duplicates(docs, width, percent).where("kept")
    keep = found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"))
    mine = docs.withColumn("_own", text_key())
    joined = mine.join(keep, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_key")), "left_semi")
    return joined.dropDuplicates(["doc_id", "text"]).select(docs.columns)
