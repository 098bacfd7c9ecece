"""Vectors of nearly equal direction, by a subspace pigeonhole join.

Unit vectors are rotated and cut into blocks. Two of them with cosine c lie at squared
distance 2 - 2c, so in at least one block their squared distance is within the
block's share of it, in proportion to the block's dimensions. Each block is
range-joined alone: its first coordinate falls into ranges as wide as the block's
distance, and a vector meets its own range and the next one. A pair belongs to the
first block that finds it, so the union of candidates needs no second shuffle, and
each is checked in double precision.

Equal vectors are one row from the start. A range with many rows is cut into chunks
that meet pair by pair. Tasks give counts of links and links that join components,
never pairs of a group.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from trip_marts.llm.components import components
from trip_marts.llm.shared import saved

#: Rows of a range that meet in one task, on either side.
CHUNK = 16384
_TILE = 1024


@dataclass(frozen=True)
class Join:
    """`cosine`: least cosine of a link; `blocks`: parts of the rotated vectors."""

    cosine: float = 0.9
    blocks: int = 4
    seed: int = 11

    @property
    def reach(self) -> float:
        """Squared distance of unit vectors at that cosine."""
        return 2 - 2 * self.cosine

    def rotation(self, size: int) -> np.ndarray:
        """Orthogonal matrix of a dimension, the same in every task."""
        return np.linalg.qr(np.random.default_rng(self.seed).standard_normal((size, size)))[0]

    def edges(self, size: int) -> np.ndarray:
        """Where the blocks of a dimension begin and end."""
        return np.linspace(0, size, min(self.blocks, size) + 1).round().astype(int)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, whatever their magnitude."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _usable(column: str):
    """Not null nor zero, all components finite."""
    inside = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(column).isNotNull() & (F.size(column) > 0) & F.coalesce(inside, F.lit(False)) & F.exists(column, lambda x: x != 0)


def _placed(classes: DataFrame, join: Join) -> DataFrame:
    """Every class in every block: its range, and a copy for the range before."""

    def run(batches):
        for batch in batches:
            ids = batch.column("rep").to_numpy()
            sizes = pd.Series([len(v) for v in batch.column("embedding")])
            for size in sizes.unique():
                at = np.flatnonzero(sizes == size)
                taken = batch.take(pa.array(at))
                vectors = taken.column("embedding").flatten().to_numpy().reshape(len(at), size)
                edges = join.edges(size)
                turned = unit(vectors) @ join.rotation(size)[:, edges[:-1]]
                for b in range(len(edges) - 1):
                    width = np.sqrt(join.reach * (edges[b + 1] - edges[b]) / size) * (1 + 1e-9) + 1e-12
                    place = np.floor(turned[:, b] / width).astype(np.int64)
                    for visits in (0, 1):
                        keys = [np.full(len(at), size), np.full(len(at), b), place - visits, ids[at], np.full(len(at), bool(visits))]
                        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
                        columns = [pa.array(k, t) for k, t in zip(keys, kinds)] + [taken.column("n"), taken.column("embedding")]
                        yield pa.record_batch(columns, names=["size", "b", "place", "rep", "visits", "n", "embedding"])

    # entries keep their precision, as the exact check needs it
    kind = "array<float>" if classes.schema["embedding"].dataType.elementType == FloatType() else "array<double>"
    schema = f"size int, b int, place long, rep long, visits boolean, n long, embedding {kind}"
    return classes.select("rep", "n", F.col("embedding").cast(kind)).mapInArrow(run, schema)


def linked(ids: np.ndarray, vectors: np.ndarray, counts: np.ndarray, home: np.ndarray, left: np.ndarray, right: np.ndarray, b: int, join: Join) -> pd.DataFrame:
    """Links of one chunk pair: added counts, and one smaller partner to join with.

    Rows `left` meet rows `right`; a pair of two rows at home is taken once, a row at
    home meets visitors, and visitors don't meet.
    """
    size = vectors.shape[1]
    units = unit(vectors)
    edges, turned = join.edges(size), units @ join.rotation(size)
    budget = join.reach * np.diff(edges) / size + 1e-9
    own = turned[:, edges[b] : edges[b + 1]].astype(np.float32)
    norms, ones = (own**2).sum(axis=1), np.ones(len(own), np.float32)
    # one product gives squared distances; its rounding is far below the margin
    here, there = np.column_stack([-2 * own, norms, ones]), np.column_stack([own, ones, norms]).T
    most = np.float32(budget[b] + 1e-4)
    added = np.zeros(len(ids), np.int64)
    root = np.arange(len(ids))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    order = own[:, 0]
    left = left[np.argsort(order[left], kind="stable")]
    right = right[np.argsort(order[right], kind="stable")]
    width = np.sqrt(budget[b]) + 1e-6
    alone = len(left) == len(right) and bool((left == right).all())
    for i in range(0, len(left), _TILE):
        x = left[i : i + _TILE]
        lo = np.searchsorted(order[right], order[x[0]] - width)
        hi = np.searchsorted(order[right], order[x[-1]] + width, "right")
        for j in range(lo, hi, _TILE):
            y = right[j : min(j + _TILE, hi)]
            p, q = np.divmod(np.flatnonzero(here[x] @ there[:, y] <= most), len(y))
            p, q = x[p], y[q]
            fit = home[p] & (~home[q] | (ids[p] < ids[q])) if alone else home[p] | home[q]
            p, q = p[fit], q[fit]
            for k in range(0, len(p), 1 << 15):
                u, v = p[k : k + (1 << 15)], q[k : k + (1 << 15)]
                apart = np.add.reduceat((turned[u] - turned[v]) ** 2, edges[:-1], axis=1)
                first = np.argmax(apart <= budget, axis=1)
                mine = (apart[:, b] <= budget[b]) & (first == b)
                u, v = u[mine], v[mine]
                close = np.einsum("ij,ij->i", units[u], units[v]) >= join.cosine
                u, v = u[close], v[close]
                np.add.at(added, u, counts[v])
                np.add.at(added, v, counts[u])
                for s, t in zip(u.tolist(), v.tolist()):
                    s, t = find(s), find(t)
                    if s != t:
                        root[max(s, t)] = min(s, t)
    used = np.flatnonzero(added)
    least = {i: find(i) for i in used.tolist()}
    partner = [ids[least[i]] for i in used.tolist()]
    return pd.DataFrame({"rep": ids[used], "added": added[used], "partner": np.array(partner, np.int64)})


def _meetings(placed: DataFrame, join: Join) -> DataFrame:
    """Link counts and joining links of every range of every block."""
    key = ["size", "b", "place"]
    chunks = placed.groupBy(*key).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"), F.count_if(~F.col("visits")).alias("homes"))
    rows = placed.join(chunks.where("homes > 0"), key)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select(*key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "visits", "n", "embedding")

    def meet(keys: tuple, table: pa.Table) -> pa.Table:
        _, b, _, i, j = (k.as_py() for k in keys)
        table = table.combine_chunks()
        ids, counts = table.column("rep").to_numpy(), table.column("n").to_numpy()
        home = ~table.column("visits").to_numpy(zero_copy_only=False)
        side = table.column("own").to_numpy()
        vectors = table.column("embedding").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        left = np.flatnonzero(side == i)
        found = linked(ids, vectors, counts, home, left, left if i == j else np.flatnonzero(side == j), b, join)
        return pa.Table.from_pandas(found, schema=pa.schema([("rep", pa.int64()), ("added", pa.int64()), ("partner", pa.int64())]), preserve_index=False)

    return rows.groupBy(*key, "i", "j").applyInArrow(meet, "rep long, added long, partner long")


def near_vectors(vectors: DataFrame, join: Join = Join()) -> DataFrame:
    """`vec_id`, `n_links`, `component_id` and `kept` of every row of `vectors`.

    Vectors of different lengths have no links, nor have those that are null, empty,
    zero or hold a component that is null or not finite. Rows of one id are separate
    vectors with links of their own; a null id is smaller than none, so it is a
    component's id only where there is no other. Other columns are ignored; an
    empty table gives no rows.
    """
    rows = vectors.select("vec_id", "embedding").withColumn("usable", _usable("embedding"))
    fit = rows.where("usable").groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    classes = saved(fit.withColumn("rep", F.monotonically_increasing_id()), "vectors")
    met = saved(_meetings(_placed(classes, join), join), "meetings")
    degree = met.groupBy("rep").agg(F.sum("added").alias("others"))
    label = components(met.select(F.col("rep").alias("u"), F.col("partner").alias("v")))
    named = classes.select("rep", "least", "n", "embedding").join(degree, "rep", "left")
    named = named.join(label.select(F.col("id").alias("rep"), "component"), "rep", "left")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(smallest, "component").select(
        "embedding", "component_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    good = rows.where("usable").join(named, "embedding", "left")
    bad = rows.where("not usable").select("vec_id", F.col("vec_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    every = good.select("vec_id", "component_id", "n_links").unionByName(bad)
    return every.select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))
