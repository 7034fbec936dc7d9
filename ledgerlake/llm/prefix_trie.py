"""Operator 11: the prefix trie of conversations, by adaptive radix trees over turn ids.

A turn's id has a fixed width of 20 bytes, big-endian: 128 bits of the SHA-256 of role and text, then
the text's length in bytes. A conversation's key is the ids of its turns in order. Equal keys are one
sequence with its smallest conversation and its number of members; the sequences are dealt by
ranges of keys, and each task builds adaptive radix trees over bounded runs of them: inner nodes
hold their children in one of four layouts (4, 16, 48, 256) and grow into the next, chains of
single children are one compressed path. Only byte depths that end a turn give nodes.

Joining runs: a task knows the keys just before and after each of its runs. A trie node that is a
prefix of one of them is shared; every run that has it sends its part, and the parts add up, because a
run counts a node's text, a leaf or a child only where the key before does not have it already. All
other nodes are complete where they are found. So a first turn, or a whole conversation, that a third
of all rows have is split like any other, and only a path for each end of a run is shuffled again.

The digest of the ids that end at a node is taken from lists that many tasks write in parts, in order
(a digest of one list cannot be split; what one task streams is ids only, in pieces).

Cases: rows without conversation id belong to none and are left out; turns are ordered by turn (null
first), repeated turn numbers by their turn id; null role or text is empty; conversations may have no
turns; an empty table gives no row, not even the root; other columns are ignored. A conversation is
one row of 20 bytes a turn, so it may have 100 million turns at most.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import column, map_batches, materialize

WIDTH = 20  # bytes of a turn id, of which the last 4 are the length of its text
LAYOUTS = (4, 16, 48, 256)  # children of an inner node
RUN_KEYS, RUN_BYTES = 50_000, 16 << 20  # of one tree
LIST_BYTES = 1 << 18  # of one part of a list of ids


class Node:
    """An inner node or leaf: the bytes from its parent (branch byte first), the number of the key
    that ends here, and its children in the smallest layout that holds them."""

    __slots__ = ("prefix", "value", "layout", "index", "kids")

    def __init__(self, prefix: bytes, value: int | None = None):
        self.prefix, self.value, self.layout = prefix, value, LAYOUTS[0]
        self.index, self.kids = bytearray(), []

    def find(self, byte: int) -> Node | None:
        if self.layout <= 16:  # sorted bytes beside their children
            at = self.index.find(byte)
            return self.kids[at] if at >= 0 else None
        if self.layout == 48:  # 256 slots that point into the children
            at = self.index[byte]
            return self.kids[at - 1] if at else None
        return self.kids[byte]

    def add(self, byte: int, child: Node) -> None:
        if self.layout < 256 and len(self.kids) == self.layout:
            self._grow()
        if self.layout <= 16:
            at = bisect_left(self.index, byte)
            self.index.insert(at, byte)
            self.kids.insert(at, child)
        elif self.layout == 48:
            self.kids.append(child)
            self.index[byte] = len(self.kids)
        else:
            self.kids[byte] = child

    def _grow(self) -> None:
        children = list(self.children())
        self.layout = LAYOUTS[LAYOUTS.index(self.layout) + 1]
        if self.layout >= 48:
            self.index = bytearray(256 if self.layout == 48 else 0)
            self.kids = [] if self.layout == 48 else [None] * 256
            for child in children:
                self.add(child.prefix[0], child)

    def children(self) -> Iterable[Node]:
        return self.kids if self.layout < 256 else (kid for kid in self.kids if kid is not None)


def _common(a: bytes, b: bytes, at: int) -> int:
    """How many bytes ``a`` and ``b[at:]`` share."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if b.startswith(a[low:mid], at + low):
            low = mid
        else:
            high = mid - 1
    return low


def build_tree(keys: list[bytes]) -> Node:
    root = Node(keys[0], 0)
    for value in range(1, len(keys)):
        key, node, at = keys[value], root, 0
        while True:
            prefix = node.prefix
            same = len(prefix) if key.startswith(prefix, at) else _common(prefix, key, at)
            if same < len(prefix):  # the compressed path is split
                lower = Node(prefix[same:], node.value)
                lower.layout, lower.index, lower.kids = node.layout, node.index, node.kids
                node.prefix, node.value, node.layout = prefix[:same], None, LAYOUTS[0]
                node.index, node.kids = bytearray(), []
                node.add(prefix[same], lower)
            at += same
            if at == len(key):
                node.value = value
                break
            child = node.find(key[at])
            if child is None:
                node.add(key[at], Node(key[at:], value))
                break
            node = child
    return root


def _shared_ids(key: bytes, other: bytes | None) -> list[bytes]:
    """Digests of the turn-aligned prefixes that ``key`` shares with ``other``, shortest first."""
    if other is None:
        return []
    depth, running = _common(key, other, 0) // WIDTH, hashlib.sha256()
    ids = [running.digest()]
    for d in range(depth):
        running.update(key[d * WIDTH : (d + 1) * WIDTH])
        ids.append(running.digest())
    return ids


NODE = pa.schema(
    [
        ("node_id", pa.binary()), ("parent_id", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
        ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
        ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string()),
    ]
)
NODE_SQL = (
    "node_id binary, parent_id binary, conv_id bigint, depth bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, ends string"
)


def trie_nodes(
    keys: list[bytes], firsts: list[int], members: list[int], ends: list[str | None],
    before: bytes | None = None, after: bytes | None = None,
) -> list[list]:
    """Rows of ``NODE`` of one run of ascending keys; ``before`` and ``after``: its neighbours.

    Sums hold what this run adds: ``n_children``, ``n_leaves`` and the text taken off ``saved`` leave
    out nodes that ``before`` has. ``node_id`` is set where a neighbour has the node too.
    """
    last = len(keys) - 1
    left, right = _shared_ids(keys[0], before), _shared_ids(keys[-1], after)
    order = [(build_tree(keys), 0, -1)]  # node, start of its bytes, its parent's place in the list
    for place, (node, start, _) in enumerate(order):
        order.extend((kid, start + len(node.prefix), place) for kid in node.children())
    # of each tree node: members, smallest, first and last key, children not seen before, leaves, saved, rows
    sums = [[0, None, last + 1, -1, 0, 0, 0, []] for _ in order]
    rows: list[list] = []
    for place in range(len(order) - 1, -1, -1):
        node, start, parent = order[place]
        n, least, lo, hi, kids, leaves, saved, waiting = sums[place]
        sums[place] = None
        end, value = start + len(node.prefix), node.value
        if value is not None:
            n, lo, hi = n + members[value], min(lo, value), max(hi, value)
            least = firsts[value] if least is None else min(least, firsts[value])
            goes_on = hi > value or (value == last and after is not None and after.startswith(keys[last]))
            leaves += not goes_on
        for depth in range(end // WIDTH, -1 if parent < 0 else start // WIDTH, -1):
            known = lo == 0 and depth < len(left)
            node_id = left[depth] if known else right[depth] if hi == last and depth < len(right) else None
            size = int.from_bytes(keys[lo][depth * WIDTH - 4 : depth * WIDTH], "big") if depth else 0
            saved += size * (n - (not known))
            for row in waiting:  # children
                rows[row][1], rows[row][4] = node_id, None if node_id else least
            ending = ends[value] if value is not None and depth * WIDTH == end else None
            rows.append([node_id, None, least, depth, None, n, kids, leaves, saved, ending])
            waiting, kids = [len(rows) - 1], int(not known)
        if parent >= 0:
            up = sums[parent]
            up[0] += n
            up[1] = least if up[1] is None else min(up[1], least)
            up[2], up[3] = min(up[2], lo), max(up[3], hi)
            up[4] += kids
            up[5] += leaves
            up[6] += saved
            up[7] += waiting
    return rows


def _trees(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard, before, size = None, None, 0
    run: list[tuple] = []

    def nodes(after: bytes | None) -> Iterator[pa.RecordBatch]:
        rows = trie_nodes(*map(list, zip(*run)), before, after)
        for k in range(0, len(rows), 10_000):
            columns = zip(*rows[k : k + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, NODE)], schema=NODE)

    for batch in batches:
        for at, key, border, *sequence in zip(*(c.to_pylist() for c in batch.columns)):
            new = at != shard
            if run and (new or border or len(run) >= RUN_KEYS or size >= RUN_BYTES):
                yield from nodes(None if new else key)
                before, run, size = run[-1][0], [], 0
            if new:
                shard, before = at, None
            if border:
                before = key
            else:
                run.append((key, *sequence))
                size += len(key)
    if run:
        yield from nodes(None)


def _id_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the lists of ids, from rows in order: (path, first id of the part, ids)."""
    for batch in batches:
        paths, ids = batch.column("path"), batch.column("conv_id")
        texts = ids.cast(pa.string()).to_pylist()
        other = pc.not_equal(paths.slice(1), paths.slice(0, len(paths) - 1)).to_pylist()
        cuts, size = [0], 0
        for k in range(1, len(texts)):
            size += len(texts[k]) + 1
            if other[k - 1] or size > LIST_BYTES:
                cuts.append(k)
                size = 0
        ends = [*cuts[1:], len(texts)]
        yield pa.RecordBatch.from_arrays(
            [paths.take(pa.array(cuts)), ids.take(pa.array(cuts)), pa.array(",".join(texts[a:b]) for a, b in zip(cuts, ends))],
            names=["path", "conv_id", "ids"],
        )


def _list_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, digest of its whole list) from the parts in order."""
    path, running = None, None
    for batch in batches:
        done: list[tuple] = []
        for p, ids in zip(batch.column("path").to_pylist(), batch.column("ids").to_pylist()):
            if p != path:
                if running is not None:
                    done.append((path, running.hexdigest()))
                path, running = p, hashlib.sha256(ids.encode())
            else:
                running.update(f",{ids}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["path", "ends"])
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([running.hexdigest()])], names=["path", "ends"])


def turn_id(role: Column, text: Column) -> Column:
    """The id of a turn, binary of ``WIDTH`` bytes."""
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    size = F.lpad(F.hex(F.octet_length(text)), 8, "0")
    return F.unhex(F.concat(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * (WIDTH - 4)), size))


def turn_sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, ids) of every conversation: the ids of its turns in order."""
    rows = turns.where("conv_id is not null").select(
        column("conv_id").cast("bigint").alias("conv_id"),
        F.struct(column("turn"), turn_id(column("role"), column("text")).alias("id")).alias("t"),
    )
    each = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return each.select("conv_id", F.transform("t", lambda t: t["id"]).alias("ids"))


def rebuild(sequences: DataFrame, every: int = 5, most: int = 8) -> DataFrame:
    """Every conversation c with the first h turns of conversation c - c % ``every`` in place of its
    own first h; h = crc32 of c % (``most`` + 1)."""
    none = F.array().cast("array<binary>")
    heads = sequences.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("head_id"), F.slice("ids", 1, most).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    rows = sequences.withColumn("head_id", F.col("conv_id") - F.col("conv_id") % every).withColumn("h", h)
    own = F.slice("ids", F.col("h") + 1, F.greatest(F.size("ids") - F.col("h"), F.lit(0)))
    ids = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")), own)
    return rows.join(heads, "head_id", "left").select("conv_id", ids.alias("ids"))


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per trie node of (conv_id, ids): conv_id (the smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    key = F.unhex(F.array_join(F.transform("ids", F.hex), ""))
    rows = sequences.select("conv_id", key.alias("key"))
    rows = materialize(rows.withColumn("path", F.unhex(F.sha2("key", 256))), "conversation-keys")

    parts = (
        rows.select("path", "conv_id")
        .repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
        .transform(map_batches, _id_lists, "path binary, conv_id bigint, ids string")
    )
    ends = (
        parts.repartition("path").sortWithinPartitions("path", "conv_id")
        .transform(map_batches, _list_digests, "path binary, ends string")
    )

    distinct = rows.groupBy("key", "path").agg(
        F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("members")
    )
    whole = materialize(distinct.join(ends, "path").select("key", "first", "members", "ends"), "sequences")
    dealt = materialize(
        whole.repartitionByRange("key").select(
            F.spark_partition_id().alias("shard"), "key", F.lit(False).alias("border"), "first", "members", "ends"
        ),
        "sequence-ranges",
    )
    # one row for each range: the keys next to it go along
    edges = dealt.groupBy("shard").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    by_shard = Window.orderBy("shard")
    near = edges.select("shard", F.lag("hi").over(by_shard).alias("a"), F.lead("lo").over(by_shard).alias("b"))
    near = near.select("shard", F.explode(F.array("a", "b")).alias("key"))
    borders = near.where("key is not null").select(
        "shard", "key", F.lit(True).alias("border"), F.lit(None).alias("first"),
        F.lit(None).alias("members"), F.lit(None).alias("ends"),
    )
    runs = dealt.unionByName(borders).repartition("shard").sortWithinPartitions("shard", "key")
    nodes = materialize(runs.transform(map_batches, _trees, NODE_SQL), "trie-nodes")

    sums = ["n_convs", "n_children", "n_leaves", "saved"]
    shared = materialize(
        nodes.where("node_id is not null").groupBy("node_id").agg(
            F.max("parent_id").alias("parent_id"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
            *(F.sum(c).alias(c) for c in sums), F.max("ends").alias("ends"),
        ),
        "shared-nodes",
    )
    columns = ["conv_id", "depth", *sums, "ends"]
    below = nodes.where("node_id is null and parent_id is not null").select("parent_id", *columns)
    parents = shared.select(F.col("node_id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    joined = below.unionByName(shared.select("parent_id", *columns)).join(parents, "parent_id", "left")
    inner = nodes.where("node_id is null and parent_id is null").select(*columns, "parent_conv_id")
    return inner.unionByName(joined.select(*columns, "parent_conv_id")).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


# the conversations are rebuilt with a CRC-32 made from its bitwise rule
SQL = """
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y:
    CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS t
  FROM range(256) AS r(i)),
turns AS (
  SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
    strlen(coalesce(text, '')) AS bytes
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(bytes ORDER BY turn NULLS FIRST, id) AS sizes,
    list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT) AS digits
  FROM turns GROUP BY conv_id),
hashed AS (
  SELECT conv_id, ids, sizes, xor(list_reduce(list_prepend(4294967295, digits), lambda x, b:
    xor(x >> 8, t[(xor(x, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM own, crc),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.ids, [])[1:o.h], o.ids[o.h + 1:]) AS ids,
    list_concat(coalesce(b.sizes, [])[1:o.h], o.sizes[o.h + 1:]) AS sizes
  FROM hashed o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
prefixes AS (SELECT *, unnest(range(0, len(ids) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT array_to_string(ids[1:depth], '') AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    any_value(coalesce(sizes[depth], 0)) AS bytes,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = len(ids)), '') AS ends
  FROM prefixes GROUP BY ALL),
kids AS (SELECT left(path, 64 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT left(n.path, 64 * up) AS path, sum((k.path IS NULL)::INT)::BIGINT AS n_leaves,
    sum((n_convs - 1) * CASE WHEN depth = 0 THEN 0 ELSE bytes END)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM nodes) n LEFT JOIN kids k ON k.path = n.path
  GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
  n_leaves, saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.path = n.path LEFT JOIN kids k ON k.path = n.path
  LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 64 * (n.depth - 1))
"""
