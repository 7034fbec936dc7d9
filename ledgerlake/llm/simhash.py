"""Operator 4: SimHash near-duplicates by covering locality-sensitive hashing.

A document's fingerprint is the bitwise majority of the XXH64 hashes of its word shingles. Equal
fingerprints are one node from then on. For radius r, each of the 64 bits gets a vector of r + 1
binary coordinates, and each of the 2^(r+1) - 1 non-zero vectors v gives a mask: the bits whose
vector has an odd inner product with v. The vectors of r differing bits span at most r dimensions,
so some v is orthogonal to all of them, and that mask hides every difference: any pair within the
radius collides in some table, with certainty. The vectors are dealt evenly, which makes every
mask keep about half of the bits. First come those with the top coordinate, of these a basis first:
from r + 1 bits on they span all coordinates, so that no mask is empty.

Buckets are counted first. One that holds more than ``MOST`` fingerprints is not gathered: its
rows are dealt out again, by the same covering of the bits that its mask hides (any pair within
the radius meets again there). Each such step hides fewer bits, and a bucket has at most 2^hidden
members, so the steps end; for radius 4 the third has 8 hidden bits at most. Inside a bucket all pairs are compared
and only a spanning star of each linked set leaves it, never the pairs.

Cases: a null or word-less text has fingerprint zero, linked like any other; fewer words than a
shingle make one shingle; equal rows have equal results; a null ``doc_id`` never names a component
unless it has no other id; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ascii_words, column, free_prefix, map_batches, materialize, pieces
from ledgerlake.llm.components import connected_components

# --- Fixed values of the contract ------------------------------------------------------------
SHINGLE = 4
RADIUS = 4
SEED = 42
# --- end of fixed values ---------------------------------------------------------------------
BITS = 64
MOST = 1024  # fingerprints compared in one bucket; larger ones are covered again
PIECE_BYTES = 1 << 20


def fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """SimHash of every text, as unsigned 64-bit integers."""
    from xxhash import xxh64_intdigest

    flat, counts = ascii_words(texts)
    sizes = pa.compute.binary_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = pa.compute.binary_join(
        pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat), " "
    )
    raw = memoryview((joined[0].as_py() or "").encode())
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    ends = starts + sizes
    full = counts > 0
    words = counts[full]
    first = (np.cumsum(counts) - counts)[full]
    shingles = np.maximum(words - shingle + 1, 1)
    begin = np.cumsum(shingles) - shingles
    at = np.repeat(first - begin, shingles) + np.arange(int(shingles.sum()))
    to = at + np.repeat(np.minimum(words, shingle) - 1, shingles)
    hashes = np.fromiter(
        (xxh64_intdigest(raw[a:b], SEED) for a, b in zip(starts[at].tolist(), ends[to].tolist())),
        np.uint64,
        len(at),
    )
    out = np.zeros(len(counts), np.uint64)
    if len(hashes):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
        most = (ones * 2 > shingles[:, None]).astype(np.uint8)
        out[full] = np.packbits(most, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def covering(bits: list[int], radius: int) -> list[int]:
    """Masks over the given bit positions: any ``radius`` of them are missed by some mask."""
    vectors = 1 << (radius + 1)
    top = vectors >> 1
    basis = [top, *(top | 1 << k for k in range(radius))]
    order = basis + [v for v in range(vectors - 1, 0, -1) if v not in basis]
    of = [order[i % len(order)] for i in range(len(bits))]
    masks = []
    for v in range(1, vectors):
        masks.append(sum(1 << b for b, a in zip(bits, of) if (a & v).bit_count() & 1))
    return masks


@lru_cache(maxsize=4096)
def mask_of(path: tuple[int, ...], radius: int) -> int:
    """Bits that agree in a bucket reached by these mask numbers, one for each level."""
    mask = 0
    for step in path:
        mask |= covering([b for b in range(BITS) if not mask >> b & 1], radius)[step]
    return mask


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _deeper(radius: int):
    """Rows of crowded buckets, in every mask of the next level."""
    tables = (1 << (radius + 1)) - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for path in set(paths):
                own = fps[[p == path for p in paths]]
                steps = tuple(map(int, path.split(".")))
                for j in range(tables):
                    mask = np.int64(_signed(mask_of((*steps, j), radius)))
                    yield pa.RecordBatch.from_pydict(
                        {"path": pa.array([f"{path}.{j}"] * len(own)), "key": own & mask, "fp": own}
                    )

    return run


def _linker(radius: int):
    """Spanning stars of the links inside each bucket; rows come sorted by bucket."""

    def stars(bucket: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        n = len(fp)
        heads = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        end = np.repeat(np.r_[heads[1:], n], np.diff(np.r_[heads, n]))
        parent = np.arange(n)
        at = np.arange(n)
        step = 1
        while True:
            at = at[at + step < end[at]]
            if not len(at):
                break
            near = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= radius]
            a, b = near, near + step
            while len(a):  # hang the larger root on the smaller until both ends agree
                ra, rb = parent[a], parent[b]
                apart = ra != rb
                a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
                np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
                while True:
                    up = parent[parent]
                    if (up == parent).all():
                        break
                    parent = up
            step += 1
        hung = np.flatnonzero(parent != np.arange(n))
        pairs = np.unique(np.stack([fp[hung], fp[parent[hung]]]), axis=1).view(np.int64)
        return pa.RecordBatch.from_pydict({"a": pairs[0], "b": pairs[1]})

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, last = np.zeros((2, 0), np.int64), np.zeros(0, np.uint64), {}
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.column("path").dictionary_encode()
            numbers = np.array([last.setdefault(p, len(last)) for p in names.dictionary.to_pylist()])
            key = np.stack(
                [numbers[names.indices.to_numpy()], batch.column("key").to_numpy(zero_copy_only=False)]
            )
            keys = np.concatenate([keys, key], axis=1)
            fps = np.concatenate([fps, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            new = np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]
            cut = int(np.flatnonzero(new)[-1])  # the last bucket may go on in the next batch
            bucket = np.cumsum(new)
            if cut:
                yield stars(bucket[:cut], fps[:cut])
            keys, fps = keys[:, cut:], fps[cut:]
        if len(fps):
            yield stars(np.zeros(len(fps), np.int64), fps)

    return run


def near_links(nodes: DataFrame, radius: int = RADIUS, most: int = MOST) -> DataFrame:
    """``nodes``: distinct fingerprints ``fp`` (long). Returns links (a, b) whose components are
    those of all pairs of fingerprints at ``radius`` or fewer differing bits."""
    tables = range((1 << (radius + 1)) - 1)
    most = max(most, 1 << radius)  # more members differ in over ``radius`` bits: each mask hides fewer of them
    rows = nodes.select(
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(str(j)).alias("path"),
                        F.col("fp").bitwiseAND(F.lit(_signed(mask_of((j,), radius)))).alias("key"),
                    )
                    for j in tables
                )
            )
        ).alias("at"),
        "fp",
    ).select("at.path", "at.key", "fp")
    found = None
    while True:
        counts = rows.groupBy("path", "key").agg(F.count(F.lit(1)).alias("n"))
        hot = materialize(counts.where(F.col("n") > most).select("path", "key"), "hot-buckets")
        crowded = not hot.isEmpty()
        cold = rows.join(hot, ["path", "key"], "left_anti") if crowded else rows
        links = (
            cold.repartition("path", "key")
            .sortWithinPartitions("path", "key")
            .transform(map_batches, _linker(radius), "a bigint, b bigint")
        )
        found = links if found is None else found.union(links)
        if not crowded:
            return found
        rows = materialize(
            rows.join(hot, ["path", "key"], "left_semi").transform(map_batches,
                _deeper(radius), "path string, key bigint, fp bigint"
            ),
            "deeper-buckets",
        )


def with_fingerprint(
    docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp, text_hash) of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", PIECE_BYTES):
            fp = fingerprints(piece.column("text"), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(fp), piece.column("text_hash")], ["doc_id", "fp", "text_hash"]
            )

    text = column(text_col).cast("string")
    return docs.select(
        column(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash")
    ).transform(map_batches, run, "doc_id bigint, fp bigint, text_hash bigint")


def simhash_components(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, fp, component_id) of every document; ``component_id`` is the smallest doc_id
    reachable over links of ``radius`` or fewer differing bits."""
    prints = materialize(with_fingerprint(docs, shingle, id_col, text_col), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-nodes")
    roots = connected_components(near_links(nodes.select("fp"), radius))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = materialize(rooted.join(least, "root").select("fp", "component_id"), "fingerprint-names")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def drop_near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (a row without an id only
    where no row has one), of several the one whose text hashes lowest. All columns are kept."""
    prints = materialize(with_fingerprint(docs, shingle, id_col, text_col), "fingerprints")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    nodes = materialize(
        prints.groupBy("fp", rank.alias("rank")).agg(F.count(F.lit(1)).alias("rows")), "ranked-documents"
    )
    prints = materialize(nodes.select("fp").distinct(), "fingerprint-nodes")
    roots = connected_components(near_links(prints, radius))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        F.coalesce("root", "fp").alias("root"), F.struct("rank", "rows").alias("at")
    )
    own = free_prefix(docs.columns, "_near")
    # equal texts have equal fingerprints, so id and text name one row of one component, or equal rows
    stay = materialize(
        rooted.groupBy("root").agg(F.min("at").alias("at")).select(
            F.col("at.rank.doc_id").alias(f"{own}id"), F.col("at.rank.text_hash").alias(f"{own}hash"), "at.rows"
        ),
        "kept-documents",
    )
    once = stay.where("rows > 1").isEmpty()
    row_id, row_hash = column(id_col).cast("bigint"), F.xxhash64(column(text_col).cast("string"))
    same = row_id.eqNullSafe(F.col(f"{own}id")) & (row_hash == F.col(f"{own}hash"))
    kept = docs.join(stay.drop("rows").hint("merge"), same, "left_semi")
    if once:
        return kept
    plain = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    row = F.min_by(F.struct(*map(column, docs.columns)), F.xxhash64(*map(column, plain)))
    keys = row_id.alias(f"{own}id"), row_hash.alias(f"{own}hash")
    return kept.groupBy(*keys).agg(row.alias(f"{own}row")).select(f"{own}row.*")
