"""Operator 7: embedding near-duplicates by collision-counting projections.

Unit vectors are projected on many random lines. Two vectors of cosine c lie
``N(0, 2 - 2c)`` apart on each line, so a *collision* (one lies in the window of half-width
``WINDOW`` standard deviations around the other) is likely on every line for a pair at the
threshold and a coin flip for others. The pair's collisions over ``LINES`` lines are counted, and
pairs that pass a count which a pair at the threshold reaches with ``RECALL`` are verified by their
cosine in double precision.

Windows of a line alone hold a fixed share of all vectors, so lines are also cut where they are
sorted: a table orders the vectors by the halves of some further lines, as many as give cells of
about ``CELL`` vectors, and windows are looked up inside cells. Tables are repeated until a pair
at the threshold shares a cell with ``RECALL``. A pair that shares several cells is counted in the
first one only, which both of its vectors can tell, so no pair is ever sent anywhere: a cell gives
the number of links and a spanning star of its links for each vector.

Equal vectors are one node with a weight. Cells of more than ``MOST`` nodes are dealt out in blocks
by a hash, and each pair of blocks is compared by a task of its own.

Cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing;
vectors of different lengths neither; a repeated row counts as another vector; a null ``vec_id``
names no component unless it has no other id; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_batches, materialize
from ledgerlake.llm.components import connected_components

# --- Fixed value of the contract -------------------------------------------------------------
COSINE = 0.9
# --- end of fixed value ----------------------------------------------------------------------
LINES = 48
WINDOW = 2.0  # in standard deviations of the distance of a pair at the threshold
RECALL = 0.99
CELL = 64
MOST = 1024
BLOCK = 512
SEED = 20


def least_collisions(lines: int, window: float, recall: float) -> int:
    """The largest count that a pair at the threshold reaches with ``recall``."""
    p = math.erf(window / math.sqrt(2))
    below, count = 0.0, 0
    while True:
        below += math.comb(lines, count) * p**count * (1 - p) ** (lines - count)
        if below > 1 - recall:
            return count
        count += 1


class Plan:
    """Lines, windows and tables for ``nodes`` vectors."""

    def __init__(self, nodes: int, cosine: float = COSINE, recall: float = RECALL, cell: int = CELL):
        self.cosine = cosine
        self.halves = max(4, round(math.log2(max(nodes, 1) / cell))) if nodes > cell else 4
        same = (1 - math.acos(cosine) / math.pi) ** self.halves
        # what the cells and the counts miss together stays within the aim
        self.tables = math.ceil(math.log((1 - recall) / 2) / math.log(1 - same))
        self.window = WINDOW * math.sqrt(2 - 2 * cosine)
        self.least = least_collisions(LINES, WINDOW, 1 - (1 - recall) / 2)

    def lines(self, dim: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng([SEED, dim])
        return rng.normal(size=(dim, LINES)), rng.normal(size=(dim, self.tables * self.halves))

    def cells(self, unit: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Cell of each vector in every table."""
        side = (unit @ cut > 0).reshape(len(unit), self.tables, self.halves)
        return side @ (1 << np.arange(self.halves))


def _units(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions, unit vectors) of the vectors of each length."""
    sizes = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        rows = flat[starts[at][:, None] + np.arange(dim)]
        scale = np.abs(rows).max(axis=1, keepdims=True)
        rows = rows / scale  # neither overflows nor vanishes when squared
        yield int(dim), at, rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _dealer(plan: Plan):
    """One row for each node and table: (cell, node); ``cell`` names length, table and halves."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for dim, at, unit in _units(batch.column("v")):
                cells = plan.cells(unit, plan.lines(dim)[1])
                own = batch.take(pa.array(at))
                for t in range(plan.tables):
                    name = pa.array([f"{dim}.{t}.{c}" for c in cells[:, t].tolist()], pa.string())
                    yield pa.RecordBatch.from_arrays([name, *own.columns], names=["cell", *own.schema.names])

    return run


def _counter(plan: Plan):
    """Links of each node inside its cell; rows come sorted by (cell, a, b)."""

    def links(cell: str, same_block: bool, nodes, weights, side, unit) -> pa.RecordBatch | None:
        table = int(cell.split(".")[1])
        lines, cut = plan.lines(unit.shape[1])
        spots = (unit @ lines).astype(np.float32)
        n = len(nodes)
        count = np.zeros(n, np.int64)
        parent = np.arange(n)
        cells = plan.cells(unit, cut)[:, :table]
        order = np.argsort(spots, axis=0)
        place = np.argsort(order, axis=0)
        step = 256
        for lo in range(0, n, step):
            hi = min(lo + step, n)
            hits = np.zeros((hi - lo, n), np.uint8)
            for k in range(LINES):
                # the window around each query is a stretch of the sorted line
                line = spots[order[:, k], k]
                first = np.searchsorted(line, spots[lo:hi, k] - plan.window, "left")
                last = np.searchsorted(line, spots[lo:hi, k] + plan.window, "right")
                at = place[:, k]
                hits += (at >= first[:, None]) & (at < last[:, None])
            pair = hits >= plan.least
            if same_block:
                pair &= np.arange(lo, hi)[:, None] < np.arange(n)
            else:
                pair &= (side[lo:hi, None] == 0) & (side == 1)
            i, j = np.nonzero(pair)
            i += lo
            for part in range(0, len(i), 1 << 16):
                x, y = i[part : part + (1 << 16)], j[part : part + (1 << 16)]
                near = np.einsum("ij,ij->i", unit[x], unit[y]) >= plan.cosine
                x, y = x[near], y[near]
                new = ~(cells[x] == cells[y]).any(axis=1)  # else an earlier table has counted it
                x, y = x[new], y[new]
                np.add.at(count, x, weights[y])
                np.add.at(count, y, weights[x])
                while len(x):  # hang the larger root on the smaller until both ends agree
                    rx, ry = parent[x], parent[y]
                    apart = rx != ry
                    x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
                    np.minimum.at(parent, np.maximum(rx, ry), np.minimum(rx, ry))
                    while not (parent[parent] == parent).all():
                        parent = parent[parent]
        linked = np.flatnonzero(count)
        if not len(linked):
            return None
        return pa.RecordBatch.from_pydict(
            {"node": nodes[linked], "links": count[linked], "root": nodes[parent[linked]]}
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rest = batch if rest is None else pa.concat_batches([rest, batch])
            key = pa.compute.binary_join_element_wise(
                rest.column("cell"), rest.column("a").cast(pa.string()), rest.column("b").cast(pa.string()), "|"
            )
            codes = key.dictionary_encode().indices.to_numpy()
            heads = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            for start, stop in zip(heads, heads[1:]):
                yield from group(rest.slice(start, stop - start))
            rest = rest.slice(int(heads[-1]))
        if rest is not None:
            yield from group(rest)

    def group(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if rows.num_rows < 2:
            return
        (_, _, unit), *_ = _units(rows.column("v"))
        a, b = rows.column("a")[0].as_py(), rows.column("b")[0].as_py()
        found = links(
            rows.column("cell")[0].as_py(), a == b,
            rows.column("node").to_numpy(), rows.column("weight").to_numpy(),
            (rows.column("block").to_numpy() != a).astype(np.int8), unit,
        )
        if found is not None:
            yield found

    return run


def link_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = COSINE,
    recall: float = RECALL,
    most: int = MOST,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    sound = F.coalesce(
        (F.size("v") > 0)
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0),
        F.lit(False),
    )
    nodes = materialize(
        rows.where(sound)
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first"))
        .select(F.monotonically_increasing_id().alias("node"), "v", "weight", "first"),
        "vector-nodes",
    )
    plan = Plan(nodes.count(), cosine, recall)
    dealt = nodes.select("node", "weight", "v").transform(map_batches,
        _dealer(plan), "cell string, node bigint, weight bigint, v array<double>"
    )
    named = nodes.select("node", "weight", "v").transform(map_batches,
        _dealer(plan), "cell string, node bigint, weight bigint, v array<double>"
    ).select("cell")
    sizes = materialize(
        named.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(
            "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
        ),
        "large-cells",
    )
    blocked = dealt.join(sizes, "cell", "left").withColumn(
        "block", F.coalesce(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.lit(0))
    )
    met = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("other")
    pairs = blocked.select("cell", "node", "weight", "v", "block", met).select(
        "cell", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"),
        "block", "node", "weight", "v",
    )
    found = materialize(
        pairs.repartition("cell", "a", "b")
        .sortWithinPartitions("cell", "a", "b")
        .transform(map_batches, _counter(plan), "node bigint, links bigint, root bigint")
        .groupBy("node", "root")
        .agg(F.sum("links").alias("links")),
        "vector-links",
    )
    roots = connected_components(found.select("node", "root"))
    rooted = nodes.select("node", "v", "weight", "first").join(
        roots.withColumnRenamed("root", "top"), "node", "left"
    ).withColumn("top", F.coalesce("top", "node"))
    least = rooted.groupBy("top").agg(F.min("first").alias("component_id"))
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    judged = rooted.join(least, "top").join(counted, "node", "left").select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    component = F.coalesce("component_id", "vec_id")
    return rows.withColumn("v", F.when(sound, F.col("v"))).join(judged, "v", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
