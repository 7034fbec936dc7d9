"""Operator 10: benchmark decontamination by edit distance, through the CGK embedding.

Texts and benchmark items are sequences of words (runs of ASCII letters and digits and all
non-ASCII characters, A-Z lowered; in scripts without spaces every character is a word and full-width
punctuation parts words). An item of n words leaks into a document when some stretch of
the document is within ``d = floor((1 - SIMILARITY) * n)`` word edits of it.

The CGK random walk reads a string with a pointer that moves on or stays by a random bit drawn for
(step, symbol); strings at a small edit distance give outputs at a small Hamming distance. Windows
of half an item, spread over it (edits that crowd one place leave another window clean), and the windows of that
size in a document are embedded by shared walks; each repetition keys a window by some sampled steps. A
document window whose key meets an item's in any repetition is a candidate. For each size, repetitions
are added until ``RECALL`` of copies at the full edit budget, edits spread and in one place, are met
(``Index.repeats``; the recall is measured on the items themselves).

What the walks miss is found exactly: an item is cut into d + 1 pieces of nearly equal length. d edits
touch d of them at most, so a leak holds one piece unchanged, shifted by d words at most, and looking
up the pieces completes the candidates, for sizes that reach no ``RECALL`` in ``MOST_REPEATS`` too.
A candidate is dropped early only when the stretch
around it has fewer of the benchmark's word pairs, then of the item's own, than d edits leave (each
undoes two pairs at most); this loses nothing. The others are confirmed by the exact edit distance
of the item to the stretch (bit-parallel approximate matching).

Equal items are searched once; their ids are joined to what was found. The distinct texts are taken
in blocks of about ``BLOCK_WORDS`` words, each sent along with one pass
over the documents; a larger benchmark takes more passes. Items of fewer than 5 words
allow no edit: ``find_leaks`` reports each exact occurrence. A phrase of fewer than ``LEAST_WORDS``
words inside a longer text does not drop it; a text that is nothing but such an item is dropped.

Cases: a null or empty text or item matches nothing; items that repeat are all reported; equal
documents have equal results; an empty benchmark or table gives no match; other columns are
carried or ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import column, map_batches, materialize, pieces, split_lists

SIMILARITY = 0.8
LEAST_WORDS = 5  # shorter items drop only the texts that hold nothing else
RECALL = 0.97
WINDOWS = 4  # of an item, spread evenly
SIZES = tuple(sorted({int(1.25**k + 1) for k in range(1, 42)}))  # words of a window
BITS = 3  # steps sampled for a key; of windows of 128 and more words 2
REACH = 1.3  # steps of a walk for each word; a walk of 2 would end all strings in padding
MOST_REPEATS = 64
TRIED = 150  # edited copies of a size that the recall is measured on
MOST_PLACES = 1 << 18  # candidate places judged at a time
BLOCK_WORDS = 1_000_000
PIECE_BYTES = 1 << 20

_WORD_BYTES = np.array(
    [b | 0x20 if 0x41 <= b <= 0x5A else b if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(256)],
    np.uint8,
)


# scripts written without spaces, and the first bytes that their characters and punctuation have
_UNSPACED = r"([\p{Han}\p{Hiragana}\p{Katakana}\p{Bopomofo}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}])"
_WIDE_MARKS = r"[\x{3000}-\x{3004}\x{3008}-\x{3020}\x{3030}\x{30FB}\x{FF01}-\x{FF0F}\x{FF1A}-\x{FF20}\x{FF3B}-\x{FF40}\x{FF5B}-\x{FF65}]"
_WIDE_BYTES = np.isin(np.arange(256), [0xE0, 0xE1, *range(0xE3, 0xEA), 0xEF, 0xF0])


def _characters_apart(texts: pa.Array) -> pa.Array:
    """Texts with spaces around each character of unspaced scripts and for full-width punctuation."""
    held = texts.buffers()[2]
    if held is None or not _WIDE_BYTES[np.frombuffer(held, np.uint8)].any():
        return texts
    return pc.replace_substring_regex(pc.replace_substring_regex(texts, _WIDE_MARKS, " "), _UNSPACED, r" \1 ")


def plain_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, flattened, and how many each text has."""
    texts = _characters_apart(pc.fill_null(texts, "").cast(pa.large_string()))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    raw = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, np.uint8)
    mapped = pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(_WORD_BYTES[raw])
    )
    return split_lists(pc.ascii_split_whitespace(mapped))


def edits_allowed(n: int, similarity: float = SIMILARITY) -> int:
    return int((1 - similarity) * n + 1e-9)


def best_match(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """(edits, end) of the stretch of ``text`` nearest to ``pattern``, the first of the nearest;
    Myers' bit vectors, one column of the edit table for each word of ``text``."""
    m = len(pattern)
    masks: dict[int, int] = {}
    for i, x in enumerate(pattern):
        masks[x] = masks.get(x, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, edits = full, 0, m
    best = (m, 0)
    for end, x in enumerate(text, 1):
        eq = masks.get(x, 0)
        across = ((((eq & up) + up) ^ up) | eq) & full
        rise = (down | ~(across | up)) & full
        fall = up & across
        if rise & top:
            edits += 1
        elif fall & top:
            edits -= 1
        rise = rise << 1 & full  # the stretch may start anywhere: the first row is zero
        fall = fall << 1 & full
        along = eq | down
        up = (fall | ~(along | rise)) & full
        down = rise & along
        if edits < best[0]:
            best = (edits, end)
    return best


def _mix(step: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """A 64-bit hash of (step, symbol)."""
    with np.errstate(over="ignore"):
        x = symbol.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + step.astype(np.uint64)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sampled_steps(size: int, repeat: int) -> np.ndarray:
    """The steps of a walk over ``size`` words that key repetition ``repeat``."""
    steps = int(REACH * size)
    order = _mix(np.full(steps, repeat + 1_000_003 * size, np.uint64), np.arange(steps, dtype=np.uint64))
    return np.sort(np.argsort(order, kind="stable")[: BITS if size < 128 else BITS - 1])


def cgk_keys(words: np.ndarray, starts: np.ndarray, size: int, repeat: int, last: np.ndarray) -> np.ndarray:
    """Keys of repetition ``repeat`` for the windows of ``size`` words at ``starts``; positions
    from ``last`` on (each window's end of text) read as padding."""
    steps = sampled_steps(size, repeat)
    pointer = starts.copy()
    ends = np.minimum(starts + size, last)
    key = np.full(len(starts), size * 64 + repeat, np.uint64)
    for step in range(int(steps[-1]) + 1):
        symbol = np.where(pointer < ends, words[np.minimum(pointer, len(words) - 1)], -1)
        if step in steps:
            key = _mix(key, symbol)
        bit = _mix(np.full(1, repeat * 4096 + step, np.uint64), symbol) >> np.uint64(63)
        pointer += bit.astype(np.int64)
    return key


def piece_bounds(n: int, edits: int) -> list[int]:
    """Bounds of the ``edits + 1`` pieces of an item of ``n`` words."""
    return [i * n // (edits + 1) for i in range(edits + 2)]


def window_size(n: int) -> int:
    """Words of the windows of an item of ``n`` words: about half."""
    return max((s for s in SIZES if s <= n / 2), default=1)


def spread_windows(n: int, size: int) -> np.ndarray:
    return np.unique(np.arange(WINDOWS) * (n - size) // (WINDOWS - 1))


def _edited(rng: np.random.Generator, words: np.ndarray, edits: int, spread: bool) -> np.ndarray:
    """A copy with ``edits`` words replaced, left out or put in, spread or in one place."""
    first = int(rng.integers(0, len(words) - edits + 1))
    spots = rng.choice(len(words), edits, replace=False) if spread else np.arange(first, first + edits)
    kinds = dict(zip(spots.tolist(), rng.integers(0, 3, edits).tolist()))
    copy: list[int] = []
    for at, word in enumerate(words.tolist()):
        kind = kinds.get(at)
        copy += {None: [word], 0: [0], 1: [0, word], 2: []}[kind]
    return np.array(copy, np.int64)


def _meet(starts, own, keys, items, offsets) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(start, item, offset) wherever a key of ``own`` is among the sorted ``keys``, some at a time."""
    lo, hi = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
    hit = hi > lo
    starts, lo, many = starts[hit], lo[hit], (hi - lo)[hit]
    upto = np.cumsum(many)
    at = 0
    while at < len(starts):
        before = upto[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(upto, before + MOST_PLACES, side="right")))
        n = many[at:stop]
        which = np.repeat(lo[at:stop] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        yield np.repeat(starts[at:stop], n), items[which], offsets[which]
        at = stop


class Index:
    """Embedded windows, pieces and word pairs of a block of benchmark items."""

    def __init__(self, items: list[tuple], similarity: float = SIMILARITY):
        flat, counts = plain_words(pa.array([text for _, text in items], pa.string()))
        coded = flat.dictionary_encode()
        self.vocab = coded.dictionary
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        ends = np.cumsum(counts)
        self.ids, self.words = [], []
        for (item, _), a, b in zip(items, ends - counts, ends):
            if b > a:
                self.ids.append(item)
                self.words.append(codes[a:b])
        self.lens = np.array([len(w) for w in self.words], np.int64)
        self.allowed = np.array([edits_allowed(len(w), similarity) for w in self.words], np.int64)
        self.own_pairs = [w[:-1] << 32 | w[1:] for w in self.words]
        self.pairs = np.unique(np.concatenate(self.own_pairs)) if self.words else np.zeros(0, np.int64)
        # for each size of windows: keys in order, items and offsets of every repetition
        self.walks: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        self.repeats: dict[int, tuple[int, float]] = {}  # by size: how many, and the recall measured
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(self.words):
            by_size.setdefault(window_size(len(w)), []).append(i)
        for size, own in sorted(by_size.items()):
            self._embed(size, np.array(own))
        held: dict[int, list[tuple[int, int]]] = {}
        for i, w in enumerate(self.words):
            bounds = piece_bounds(len(w), int(self.allowed[i]))
            for a, b in zip(bounds, bounds[1:]):
                held.setdefault(b - a, []).append((i, a))
        # for each length of a piece: sorted keys, items, offsets in the item
        self.pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        joined = np.concatenate(self.words) if self.words else codes[:0]
        first = np.cumsum(self.lens) - self.lens
        for length in sorted(held):
            item, offset = np.array(held[length], np.int64).T
            keys = self._keys(joined, first[item] + offset, length)
            order = np.argsort(keys, kind="stable")
            self.pieces[length] = (keys[order], item[order], offset[order])

    def _embed(self, size: int, own: np.ndarray) -> None:
        """Embed the windows of the items ``own``, as often as the measured recall asks for."""
        joined = np.concatenate([self.words[i] for i in own])
        first = np.cumsum(self.lens[own]) - self.lens[own]
        spread = [spread_windows(int(n), size) for n in self.lens[own]]
        many = np.array([len(s) for s in spread])
        item, offset, begin = np.repeat(own, many), np.concatenate(spread), np.repeat(first, many)
        last = np.repeat(first + self.lens[own], many)
        rng = np.random.default_rng(size)
        tried = [own[k] for k in rng.integers(0, len(own), TRIED) if self.allowed[own[k]]]
        copies = [_edited(rng, self.words[i], int(self.allowed[i]), k % 2 == 0) for k, i in enumerate(tried)]
        missed = np.ones(len(copies), bool)
        text = np.concatenate(copies) if copies else joined[:0]
        ends = np.cumsum([len(c) for c in copies], dtype=np.int64)
        of = np.repeat(np.arange(len(copies)), [len(c) for c in copies])
        tables = self.walks.setdefault(size, [])
        more = MOST_REPEATS
        while len(tables) < more:
            keys = cgk_keys(joined, begin + offset, size, len(tables), last)
            order = np.argsort(keys, kind="stable")
            if len(copies):
                seen = cgk_keys(text, np.arange(len(text)), size, len(tables), ends[of])
                for c in np.flatnonzero(missed):
                    missed[c] = not np.isin(keys[item == tried[c]], seen[of == c]).any()
            tables.append((keys[order], item[order], offset[order]))
            if more == MOST_REPEATS and (not len(copies) or missed.mean() <= 1 - RECALL):
                # twice as many, since the sample that says when to stop is among those it judges
                more = min(2 * len(tables), MOST_REPEATS - 1) if len(copies) else 0
        self.repeats[size] = (len(tables), 1 - float(missed.mean()) if len(copies) else 1.0)

    @staticmethod
    def _keys(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        """Hashes of the stretches of ``length`` words at ``starts``."""
        key = np.full(len(starts), length, np.uint64)
        for k in range(length):
            key = _mix(key, words[starts + k])
        return key

    def _places(self, words: np.ndarray, cut: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(position, item, offset) of every piece of an item in ``words``, some at a time. ``cut[i]``:
        how many of the first i word pairs occur in the benchmark."""
        for length, (keys, items, offsets) in self.pieces.items():
            if length == 1:
                starts = np.flatnonzero(words)
            else:
                starts = np.flatnonzero(cut[length - 1 :] - cut[: 1 - length] == length - 1)
            yield from _meet(starts, self._keys(words, starts, length), keys, items, offsets)

    def _walked(self, words: np.ndarray, cut: np.ndarray, row_end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(position, item, offset) of every window whose key meets an item's, some at a time; only of
        windows half of whose word pairs, at least, occur in the benchmark."""
        for size, tables in self.walks.items():
            if size == 1:
                starts = np.flatnonzero(words)
            else:
                upto = np.minimum(np.arange(len(words)) + size - 1, len(words) - 1)
                starts = np.flatnonzero((cut[upto] - cut[: len(words)]) * 2 >= size - 1)
            last = row_end[np.searchsorted(row_end, starts, side="right")]
            for repeat, table in enumerate(tables):
                yield from _meet(starts, cgk_keys(words, starts, size, repeat, last), *table)

    def leaked_rows(self, texts: pa.Array) -> list[int]:
        """Rows to drop."""
        _, counts = plain_words(texts)
        return [
            r for r, i, a, b, _ in self.search(texts) if self.lens[i] >= LEAST_WORDS or b - a == counts[r]
        ]

    def search(self, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(row, item number, first word, end word, edits) of the best match of each leaked item."""
        flat, counts = plain_words(texts)
        if not self.words or not len(flat):
            return []
        codes = pc.fill_null(pc.index_in(flat, value_set=self.vocab.cast(flat.type)), -1)
        words = codes.to_numpy(zero_copy_only=False).astype(np.int64) + 1
        row_end = np.cumsum(counts)
        begin = row_end - counts
        known = np.zeros(len(words) - 1, bool)
        if len(self.pairs):
            at = np.searchsorted(self.pairs, pair := words[:-1] << 32 | words[1:])
            known = self.pairs[np.minimum(at, len(self.pairs) - 1)] == pair
        known[row_end[(row_end > 0) & (row_end < len(words))] - 1] = False
        cut = np.r_[0, np.cumsum(known)]
        found = [np.zeros((0, 4), np.int64)]
        for place, item, offset in chain(self._walked(words, cut, row_end), self._places(words, cut)):
            row = np.searchsorted(row_end, place, side="right")
            n, d = self.lens[item], self.allowed[item]
            lo = np.maximum(begin[row], place - offset - d)
            hi = np.minimum(row_end[row], place - offset + n + d)
            near = cut[hi - 1] - cut[lo] >= n - 1 - 2 * d
            found.append(np.unique(np.stack([row, item, lo, hi], axis=1)[near], axis=0))
        places = np.unique(np.concatenate(found), axis=0)
        if not len(places):
            return []
        # candidates of an item that overlap are confirmed in one stretch
        row, item, lo, hi = places.T
        new = np.r_[True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (lo[1:] > hi[:-1])]
        heads = np.flatnonzero(new)
        tails = np.r_[heads[1:], len(places)] - 1
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for r, i, a, b in zip(row[heads].tolist(), item[heads].tolist(), lo[heads].tolist(), hi[tails].tolist()):
            n, d = int(self.lens[i]), int(self.allowed[i])
            around = words[a:b]
            there = np.isin(self.own_pairs[i], around[:-1] << 32 | around[1:])
            if there.sum() < n - 1 - 2 * d:
                continue
            pattern, stretch = self.words[i].tolist(), around.tolist()
            edits, end = best_match(pattern, stretch)
            if edits <= d and edits < best.get((r, i), (n,))[0]:
                _, back = best_match(pattern[::-1], stretch[end - 1 :: -1] if end else [])
                start = a + end - back - int(begin[r])
                best[r, i] = (edits, start, a + end - int(begin[r]))
        return [(r, i, a, b, e) for (r, i), (e, a, b) in sorted(best.items())]


def _keyed(items: DataFrame, text_col: str, *more: Column) -> DataFrame:
    """(key, t, more) of the items that have a text; equal texts have one key."""
    text = column(text_col).cast("string")
    return items.select(F.xxhash64(text).alias("key"), text.alias("t"), *more).where("t is not null")


def _blocks(items: DataFrame, text_col: str) -> Iterator[list[tuple]]:
    """(key, text) of the distinct texts in blocks of about ``BLOCK_WORDS`` words."""
    rows = materialize(_keyed(items, text_col).distinct(), "benchmark-texts")
    words = rows.agg(F.sum(F.length("t")).alias("n")).first()["n"] or 0
    passes = max(1, -(-words // (4 * BLOCK_WORDS)))
    for k in range(passes):
        block = rows.where(F.pmod(F.xxhash64("t"), F.lit(passes)) == k)
        yield sorted(((r["key"], r["t"]) for r in block.collect()), key=lambda r: (r[1], r[0]))


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """(doc_id, item_id, start, end, edits): the best match of every item in every document it
    leaked into; ``start`` and ``end`` count the document's words."""
    kept = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id bigint, key bigint, start bigint, end bigint, edits bigint"
    found = None
    for block in _blocks(items, item_text):
        index = Index(block, similarity)

        def run(batches: Iterable[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, "text", PIECE_BYTES):
                hits = index.search(piece.column("text"))
                row, item, start, end, edits = (np.array(x, np.int64) for x in zip(*hits)) if hits else [np.zeros(0, np.int64)] * 5
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": piece.column("doc_id").take(pa.array(row)),
                        "key": pa.array([index.ids[i] for i in item], pa.int64()),
                        "start": start, "end": end, "edits": edits,
                    }
                )

        hits = kept.transform(map_batches, run, schema)
        found = hits if found is None else found.union(hits)
    ids = materialize(_keyed(items, item_text, column(item_id).cast("bigint").alias("item_id")).drop("t"), "benchmark-ids")
    return found.join(ids, "key").select("doc_id", "item_id", "start", "end", "edits")


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``docs`` without the rows into which an item leaked; all columns kept."""
    names = docs.columns
    text = f"c{names.index(text_col)}"
    kept = docs.toDF(*(f"c{k}" for k in range(len(names))))  # whatever their names are
    for block in _blocks(items, item_text):
        index = Index(block, similarity)

        def run(batches: Iterable[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, text, PIECE_BYTES):
                clean = np.ones(piece.num_rows, bool)
                clean[index.leaked_rows(piece.column(text))] = False
                yield piece.filter(pa.array(clean))

        kept = kept.transform(map_batches, run, kept.schema)
    return kept.toDF(*names)
