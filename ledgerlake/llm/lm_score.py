"""Operator 6: language-model scores by a weighted backoff automaton learned from the corpus.

Tokens are a text's words and one end. The model is an interpolated bigram with absolute discount
over the smoothed unigram ``(c + ADD) / (N + ADD * (V + 1))``. As an automaton it has a root and a
state for each *history* (every word of the training documents): the state has an arc for each pair
of histories seen in training, however rare, and a failure arc to the root, weighted by the mass
that its arcs leave. Callers may prune: ``history_share`` of all training tokens that a history
makes up at least, ``pair`` times that a kept pair is seen at least. A text is read left to right, carrying the state and adding up log10 weights;
the state after a word depends on that word alone, so all positions of a block step at once.

The model is never gathered in one place. Documents are cut into blocks of bounded text; a block
keeps its tokens as numbers into its own list of distinct words. What a block knows of a word or pair meets
that of other blocks in a *bucket*, a range of hashes that holds about ``BUCKET_TOKENS`` tokens, and the
sums go back: every block gets exactly the part of the automaton that its text can reach, so memory is
bounded by the block and the bucket, whatever the corpus. Both ways go packed lists, one for each block
and bucket, sorted by hash, coded by differences and compressed; sums come back in the order of the list,
without keys. First words are summed, with whether only one block has the word; then pairs, listed by
history. A pair of a word that no other block has needs no sum. The pairs of a frequent history are dealt
to several *units* of about ``CAP`` tokens or 1/65,536 of the corpus, by their second word, so no bucket gets
all of them. Words are known by 64-bit hashes, a history's second words by 48 bits of theirs.

Training takes the documents for which crc32 of the ``doc_id`` as text, modulo ``FOLDS``, is not 0.

Cases: a null or empty text is the end alone; a null ``doc_id`` counts as empty text (held out);
repeated rows are documents of their own; unknown words have count 0; without training documents
every probability is that of the empty model; an empty table gives no row; other columns are
ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import ascii_words, map_batches, materialize, pieces, release

# --- Fixed values of the contract ------------------------------------------------------------
FOLDS = 10
ADD = 0.1
# --- end of fixed values ---------------------------------------------------------------------
PAIR = 1  # all pairs of the training documents
DISCOUNT = 0.75
BLOCK_BYTES = 16 << 20
BUCKET_TOKENS = 2 << 20
CAP = 1 << 20
END = b" "  # no word has a space
SPREAD = np.uint64(0x9E3779B97F4A7C15)

_BLOCK = "block bigint, trained bigint, size bigint, docs binary, words binary, tokens binary"
_LIST = "block bigint, kind int, bucket bigint, list binary, distinct bigint"


def _packed(codes: np.ndarray) -> bytes:
    """Token numbers by byte planes, compressed: frequent words come early in a block's list."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> np.ndarray:
    raw = pa.decompress(packed, decompressed_size=4 * n, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4")[:, 0].astype(np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    """Lists of numbers from 0, each by as many byte planes as its largest number needs."""
    parts, head = [], [len(arrays)]
    for x in arrays:
        x = np.asarray(x).astype("<u8")
        wide = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
        planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T[:wide]).tobytes()
        parts.append(pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")
        head += [len(x), wide, len(parts[-1])]
    return np.array(head, "<i8").tobytes() + b"".join(parts)


def _unpack(packed: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(packed, "<i8", 1)[0])
    head = np.frombuffer(packed, "<i8", 1 + 3 * n)[1:].reshape(n, 3).tolist()
    at, arrays = 8 * (1 + 3 * n), []
    for size, wide, held in head:
        planes = np.zeros((8, size), np.uint8)
        if held:
            raw = pa.decompress(packed[at : at + held], decompressed_size=size * wide, codec="zstd", asbytes=True)
            planes[:wide] = np.frombuffer(raw, np.uint8).reshape(wide, size)
        arrays.append(np.ascontiguousarray(planes.T).view("<u8")[:, 0])
        at += held
    return arrays


def _steps(x: np.ndarray, heads: np.ndarray | None = None) -> np.ndarray:
    """Differences of ascending numbers; those at ``heads`` (the first one) as they are."""
    d = np.diff(x, prepend=x.dtype.type(0))
    if heads is not None:
        d[heads] = x[heads]
    return d


def _sums(d: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
    """The numbers of ``_steps``; ``sizes`` of the runs that begin anew."""
    total = np.cumsum(d, dtype=np.uint64)
    if sizes is None or not len(d):
        return total
    starts = np.cumsum(sizes) - sizes
    full = sizes > 0
    before = total[starts[full]] - d[starts[full]]
    return total - np.repeat(before, sizes[full])


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Number of the range of hashes, ascending with them."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _hashes(words: bytes) -> np.ndarray:
    """Hashes of a block's words and of the end."""
    listed = pa.decompress(words[8:], decompressed_size=int.from_bytes(words[:8], "little"), codec="zstd", asbytes=True)
    return np.array([xxhash.xxh64_intdigest(w) for w in [*listed.split(END), END] if w], np.uint64)


def _listed(docs: list, sizes: np.ndarray) -> bytes:
    """Ids, whether they are there, and sizes of a block's documents."""
    there = [d is not None for d in docs]
    return np.array([[d or 0 for d in docs], there, sizes], "<i8").tobytes()


def _documents(listed: bytes) -> tuple[list, np.ndarray]:
    ids, there, sizes = np.frombuffer(listed, "<i8").reshape(3, -1)
    return [d if t else None for d, t in zip(ids.tolist(), there.tolist())], sizes.astype(np.int64)


def _held(doc_ids: list) -> np.ndarray:
    return np.array([zlib.crc32(b"" if d is None else str(d).encode()) % FOLDS == 0 for d in doc_ids], bool)


def _tokenize(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    for piece in pieces(batches, "text", BLOCK_BYTES):
        docs = piece.column("doc_id").to_pylist()
        flat, counts = ascii_words(piece.column("text"))
        coded = flat.dictionary_encode()
        words = END.join(w.as_py() for w in coded.dictionary.cast(pa.binary()))
        sizes = counts + 1
        codes = np.insert(
            coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(counts), len(coded.dictionary)
        )
        training = np.repeat(~_held(docs), sizes)
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array([part << 32 | number], pa.int64()),
                "trained": pa.array([int(training.sum())], pa.int64()),
                "size": pa.array([len(codes)], pa.int64()),
                "docs": pa.array([_listed(docs, sizes)], pa.binary()),
                "words": pa.array(
                    [len(words).to_bytes(8, "little") + pa.compress(words, codec="zstd", asbytes=True)], pa.binary()
                ),
                "tokens": pa.array([_packed(codes)], pa.binary()),
            }
        )
        number += 1


class Block:
    """A block's documents and words, and what came back from the buckets."""

    def __init__(self, row: dict):
        self.block = row["block"]
        self.docs, self.sizes = _documents(row["docs"])
        self.codes = _unpacked(row["tokens"], int(self.sizes.sum()))
        self.hashes = _hashes(row["words"])
        self.order = np.argsort(self.hashes, kind="stable")
        self.training = np.repeat(~_held(self.docs), self.sizes)
        self.back: dict[int, list[list[np.ndarray]]] = {}

    def returned(self, kind: int, lists: int) -> list[np.ndarray]:
        """What came back, in the order of the hashes."""
        got = self.back.get(kind, [])
        return [np.concatenate([x[k] for x in got] or [np.zeros(0, np.uint64)]).astype(np.int64) for k in range(lists)]

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """(count in all training documents, whether no other block has it) of each word."""
        sums, alone = self.returned(WORDS, 2)
        at = np.empty(len(self.order), np.int64)
        at[self.order] = np.arange(len(self.order))
        return sums[at], alone[at].astype(bool)


HEAD, WORDS, PAIRS = 0, 1, 2  # kinds of a block's rows


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[Block]:
    """Blocks of a stream: each one's own row comes first, then what came back, by kind and bucket."""
    held = None
    for batch in batches:
        for row in range(batch.num_rows):
            row = batch.slice(row, 1).to_pylist()[0]
            if row.get("kind", HEAD) == HEAD:
                if held is not None:
                    yield held
                held = Block(row)
            else:
                held.back.setdefault(row["kind"], []).append(_unpack(row["list"]))
    if held is not None:
        yield held
    release()


def _stream(blocks: DataFrame, *parts: DataFrame) -> DataFrame:
    """Rows of every block together, in order; ``parts``: (block, kind, bucket, list)."""
    rows = blocks.select(
        "block", F.lit(HEAD).alias("kind"), F.lit(0).cast("bigint").alias("bucket"), "docs", "words", "tokens"
    )
    for part in parts:
        rows = rows.unionByName(part.drop("distinct"), allowMissingColumns=True)
    return rows.repartition("block").sortWithinPartitions("block", "kind", "bucket")


def _lists(rows: list[tuple]) -> pa.RecordBatch:
    """Rows (block, kind, bucket, list, distinct)."""
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64())
    columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["block", "kind", "bucket", "list", "distinct"])


def _cuts(buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of ascending bucket numbers."""
    heads = np.flatnonzero(np.diff(buckets, prepend=-1))
    for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(buckets)]):
        yield int(buckets[a]), a, b


def _word_lists(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            hashes = block.hashes[block.order]
            counts = np.bincount(block.codes[block.training], minlength=len(hashes))[block.order]
            yield _lists([
                (block.block, WORDS, k, _pack(_steps(hashes[a:b]), counts[a:b]), 0)
                for k, a, b in _cuts(_bucket(hashes, buckets))
            ])

    return run


def _summed(sum_bucket):
    """Sums a bucket's lists of all blocks and sends each block its own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, blocks, lists = None, [], []
        for batch in batches:
            for b, k, packed in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "list"))):
                if k != bucket and blocks:
                    yield from sum_bucket(bucket, blocks, lists)
                    blocks, lists = [], []
                bucket = k
                blocks.append(b)
                lists.append(_unpack(packed))
        if blocks:
            yield from sum_bucket(bucket, blocks, lists)
        release()

    return run


def _sum_words(bucket: int, blocks: list, lists: list) -> Iterator[pa.RecordBatch]:
    keys, which, times = np.unique(
        np.concatenate([_sums(x[0]) for x in lists]), return_inverse=True, return_counts=True
    )
    counts = np.concatenate([x[1] for x in lists]).astype(np.int64)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, which, counts)
    ends = np.cumsum([len(x[0]) for x in lists])
    for n, (b, end) in enumerate(zip(blocks, ends.tolist())):
        mine = which[end - len(lists[n][0]) : end]
        yield _lists([(b, WORDS, bucket, _pack(sums[mine], times[mine] == 1), 0 if n else int((sums > 0).sum()))])


def _sum_pairs(pair: int):
    def run(bucket: int, blocks: list, lists: list) -> Iterator[pa.RecordBatch]:
        units, which = np.unique(np.concatenate([_sums(x[0]) for x in lists]), return_inverse=True)
        sizes = np.concatenate([x[1] for x in lists]).astype(np.int64)
        unit = np.repeat(which, sizes)
        second = np.concatenate([_sums(x[4], x[1].astype(np.int64)) for x in lists])
        counts = np.concatenate([x[5] for x in lists]).astype(np.int64)
        order = np.lexsort((second, unit))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(unit[order]) != 0) | (np.diff(second[order]) != 0)
        heads = np.flatnonzero(new)
        sums = np.add.reduceat(counts[order], heads) if len(heads) else counts[:0]
        sums[sums < pair] = 0
        seen, kinds = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        np.add.at(seen, unit[order][heads], sums)
        np.add.at(kinds, unit[order][heads], sums > 0)
        for k, into in ((2, seen), (3, kinds)):  # of pairs that one block alone has
            np.add.at(into, which, np.concatenate([x[k] for x in lists]).astype(np.int64))
        back = np.empty(len(order), np.int64)
        back[order] = sums[np.cumsum(new) - 1]
        u, p = 0, 0
        for b, x in zip(blocks, lists):
            mine = which[u : u + len(x[0])]
            yield _lists([(b, PAIRS, bucket, _pack(seen[mine], kinds[mine], back[p : p + len(x[5])]), 0)])
            u, p = u + len(x[0]), p + len(x[5])

    return run


def _pairs_of(codes: np.ndarray, sizes: np.ndarray, history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions whose word and predecessor are both histories, their pair keys)."""
    later = np.ones(len(codes), bool)
    later[np.cumsum(sizes) - sizes] = False
    later[1:] &= history[codes[:-1]]
    later &= history[codes]
    at = np.flatnonzero(later)
    return at, codes[at - 1] << 32 | codes[at]


class Pairs:
    """A block's distinct pairs, those that it shares with other blocks dealt to units of their history."""

    def __init__(self, block: Block, total: int, least: int, pair: int):
        self.counts, alone = block.counted()
        self.history = self.counts >= least
        where, keys = _pairs_of(block.codes, block.sizes, self.history)
        self.keys, which = np.unique(keys, return_inverse=True)
        self.first, second = self.keys >> 32, self.keys & 0xFFFFFFFF
        raw = np.bincount(which[block.training[where]], minlength=len(self.keys))
        self.times = np.where(raw < pair, 0, raw)  # of shared pairs: not yet summed
        self.within = alone[self.first]  # no other block has the history
        shared = ~(self.within | alone[second])
        # units of every history that other blocks have: all of a history's, so that its sums are whole
        self.split = np.flatnonzero(self.history & ~alone)
        cap = max(CAP, total >> 16)
        parts = 1 + self.counts[self.split] // cap
        self.owner = np.repeat(self.split, parts)
        begin = np.cumsum(parts) - parts
        part = np.arange(len(self.owner)) - np.repeat(begin, parts)
        units = block.hashes[self.owner] + part.astype(np.uint64) * SPREAD
        order = np.argsort(units, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.units, self.owner = units[order], self.owner[order]
        place = np.zeros(len(self.history), np.int64)
        place[self.split] = np.arange(len(self.split))
        outer = np.flatnonzero(~self.within)  # pairs whose history is in units
        at = place[self.first[outer]]
        dealt = (block.hashes[second[outer]] % parts[at].astype(np.uint64)).astype(np.int64)
        unit = rank[begin[at] + dealt]
        here = ~shared[outer]
        self.more = [np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)]
        np.add.at(self.more[0], unit[here], self.times[outer[here]])
        np.add.at(self.more[1], unit[here], self.times[outer[here]] > 0)
        outer, unit = outer[~here], unit[~here]
        low = block.hashes[second[outer]] >> np.uint64(16)
        by = np.lexsort((low, unit))
        self.shared, self.unit, self.second = outer[by], unit[by], low[by]
        self.raw = raw[self.shared]

    def lists(self, block: int, buckets: int) -> pa.RecordBatch:
        rows = []
        sizes = np.bincount(self.unit, minlength=len(self.units))
        ends = np.cumsum(sizes)
        for k, a, b in _cuts(_bucket(self.units, buckets)):
            p, q = int(ends[a] - sizes[a]), int(ends[b - 1])
            unit = self.unit[p:q]
            packed = _pack(
                _steps(self.units[a:b]), sizes[a:b], self.more[0][a:b], self.more[1][a:b],
                _steps(self.second[p:q], np.flatnonzero(np.diff(unit, prepend=-1))), self.raw[p:q],
            )
            rows.append((block, PAIRS, k, packed, 0))
        return _lists(rows)

    def joined(self, seen: np.ndarray, kinds: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
        """(pairs seen after, kinds of pairs after each word, times of each pair) in all training documents."""
        self.times[self.shared] = times
        all_seen, all_kinds = np.zeros(len(self.history)), np.zeros(len(self.history))
        np.add.at(all_seen, self.owner, seen)
        np.add.at(all_kinds, self.owner, kinds)
        np.add.at(all_seen, self.first[self.within], self.times[self.within])
        np.add.at(all_kinds, self.first[self.within], self.times[self.within] > 0)
        return all_seen, all_kinds, self.times


def _pair_lists(total: int, least: int, pair: int, buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            yield Pairs(block, total, least, pair).lists(block.block, buckets)

    return run


class Automaton:
    """The part of the backoff automaton that a block's text can reach."""

    def __init__(self, counts, history, total, distinct, seen, kinds, arcs, arc_counts):
        self.root = (counts + ADD) / (total + ADD * (distinct + 1))
        self.counts, self.history = counts, history
        # mass that a state's arcs leave to its failure arc; 1 where there is no arc
        self.fail = np.ones(len(counts))
        full = kinds > 0
        self.fail[full] = 1 - (seen[full] - DISCOUNT * kinds[full]) / counts[full]
        self.arcs, self.arc_counts = arcs, arc_counts

    def read(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """log10 weight of every step."""
        weight = self.root[codes]
        first = np.zeros(len(codes), bool)
        first[np.cumsum(sizes) - sizes] = True
        state = np.r_[0, codes[:-1]]  # the word before; the root at a text's start
        weight = np.where(first, weight, weight * self.fail[state])
        where, keys = _pairs_of(codes, sizes, self.history)
        if len(self.arcs):
            at = np.minimum(np.searchsorted(self.arcs, keys), len(self.arcs) - 1)
            hit = self.arcs[at] == keys
            where, at = where[hit], at[hit]
            weight[where] += (self.arc_counts[at] - DISCOUNT) / self.counts[codes[where - 1]]
        return np.log10(weight)


def _score(total: int, distinct: int, least: int, pair: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            pairs = Pairs(block, total, least, pair)
            seen, kinds, times = pairs.joined(*block.returned(PAIRS, 3))
            arcs = times > 0
            automaton = Automaton(
                pairs.counts, pairs.history, total, distinct, seen, kinds, pairs.keys[arcs], times[arcs]
            )
            codes, sizes = block.codes, block.sizes
            starts = np.cumsum(sizes) - sizes
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(block.docs, pa.int64()),
                    "held_out": _held(block.docs),
                    "n_tokens": sizes,
                    "n_known": np.add.reduceat((pairs.counts > 0)[codes], starts, dtype=np.int64),
                    "train_tokens": np.full(len(sizes), total, np.int64),
                    "base_score": np.add.reduceat(np.log10(automaton.root)[codes], starts),
                    "score": np.add.reduceat(automaton.read(codes, sizes), starts),
                }
            )

    return run


def _met(lists: DataFrame, sum_bucket, name: str) -> DataFrame:
    """Lists of all blocks summed by bucket, one list back for each."""
    rows = lists.drop("distinct").repartition("bucket").sortWithinPartitions("bucket", "block")
    return materialize(rows.transform(map_batches, _summed(sum_bucket), _LIST), name)


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    history_share: float = 0.0,
    pair: int = PAIR,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    kept = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = materialize(kept.transform(map_batches, _tokenize, _BLOCK), "lm-blocks")
    found = blocks.agg(F.sum("trained").alias("trained"), F.sum("size").alias("size")).first()
    total = found["trained"] or 0
    least = max(1, math.ceil(history_share * total))
    buckets = max(1, math.ceil((found["size"] or 0) / BUCKET_TOKENS))
    own = blocks.select("block", "docs", "words", "tokens")
    words = _met(own.transform(map_batches, _word_lists(buckets), _LIST), _sum_words, "lm-words")
    distinct = words.agg(F.sum("distinct").alias("n")).first()["n"] or 0
    listed = _stream(blocks, words).transform(map_batches, _pair_lists(total, least, pair, buckets), _LIST)
    pairs = _met(listed, _sum_pairs(pair), "lm-pairs")
    return _stream(blocks, words, pairs).transform(map_batches,
        _score(total, distinct, least, pair),
        "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )
