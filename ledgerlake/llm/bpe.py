"""Operator 5: byte-level BPE encoding by a pair occurrence index, and decoding.

The texts of a partition are cut into blocks of bounded size. A text is cut before every space
that a non-space follows; the tokenizer's own pattern always has a boundary there, so each
distinct cut is encoded once. Of the cuts a worker has not met yet, the pattern's pre-tokens are
laid out in one array of symbols, and an index maps each mergeable pair to all its positions. The
active ranks are taken in ascending order from a heap: all occurrences of the pair are merged at
once, and the pairs that arise beside them enter the lists of their own ranks.

Decoding maps ids back to their bytes; what is not UTF-8 becomes U+FFFD, as the library does.

Cases: a null text is empty (no ids, empty decoded text); special tokens written out in a text
become their ids, as in the library; a null or repeated ``doc_id`` is carried as it is, one row
out for each row in; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_batches, pieces, ragged, split_lists, worker_cache

# --- Fixed value: the pre-token pattern of the public byte-level vocabulary ------------------
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# --- end of fixed value ----------------------------------------------------------------------
SPACES = r"\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
PIECE_BYTES = 2 << 20  # text encoded at a time
CACHE_UNITS = 200_000  # cuts whose ids a worker remembers; forgotten all at once beyond
DECODED_IDS = 1 << 18  # ids turned into bytes at a time
MARK = "\x1f"  # put before cuts; a text that has one itself goes the longer way


class Merges:
    """Vocabulary and merge ranks of a byte-level BPE file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = spec["model"]["vocab"]
        self.split = regex.compile(PATTERN).findall
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_special = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        shown = _shown_bytes()
        self.of_byte = np.array([vocab[c] for c in shown], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = self.left << 32 | self.right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of = keys[order], order
        back = {c: i for i, c in enumerate(shown)}
        size = max([*vocab.values(), *self.special.values()]) + 1
        table = [b""] * size
        for token, i in vocab.items():
            table[i] = bytes(back[c] for c in token)
        for token, i in self.special.items():
            table[i] = token.encode()
        self.lens = np.fromiter(map(len, table), np.int64, size)
        self.starts = np.cumsum(self.lens) - self.lens
        self.bytes = np.frombuffer(b"".join(table), np.uint8)

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; -1 where they do not merge."""
        keys = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank_of[at], -1)


def _shown_bytes() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1
    stands for itself, the others follow in order from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def merge_all(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all ``words`` in a row, and how many each word has."""
    raw = np.frombuffer(b"".join(words), np.uint8)
    n = len(raw)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    if not n:
        return np.zeros(0, np.int64), sizes
    symbol = merges.of_byte[raw]
    ends = np.cumsum(sizes)
    last = np.zeros(n, bool)
    last[ends[sizes > 0] - 1] = True
    nxt = np.arange(1, n + 1)
    nxt[last] = -1
    prv = np.arange(-1, n - 1)
    prv[(ends - sizes)[sizes > 0]] = -1
    alive = np.ones(n, bool)

    index: dict[int, list[np.ndarray]] = {}  # rank -> positions of its pair
    active: list[int] = []

    def enter(at: np.ndarray) -> None:
        at = at[nxt[at] >= 0]
        rank = merges.ranks(symbol[at], symbol[nxt[at]])
        at, rank = at[rank >= 0], rank[rank >= 0]
        order = np.argsort(rank, kind="stable")
        at, rank = at[order], rank[order]
        cuts = np.flatnonzero(np.diff(rank)) + 1
        for r, where in zip(rank[np.r_[0, cuts]].tolist() if len(at) else [], np.split(at, cuts)):
            if r in index:
                index[r].append(where)
            else:
                index[r] = [where]
                heapq.heappush(active, r)

    enter(np.arange(n))
    while active:
        r = heapq.heappop(active)
        found = index.pop(r)
        at = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
        a, b, new = merges.left[r], merges.right[r], merges.made[r]
        at = at[alive[at] & (symbol[at] == a) & (nxt[at] >= 0)]
        at = at[symbol[nxt[at]] == b]
        if not len(at):
            continue
        if a == b:  # of pairs that overlap in a run, every other one merges
            at.sort()
            chained = np.r_[False, nxt[at[:-1]] == at[1:]]
            heads = np.flatnonzero(~chained)
            at = at[(np.arange(len(at)) - np.repeat(heads, np.diff(np.r_[heads, len(at)]))) % 2 == 0]
        gone = nxt[at]
        after = nxt[gone]
        symbol[at] = new
        alive[gone] = False
        nxt[at] = after
        inner = after >= 0
        prv[after[inner]] = at[inner]
        before = prv[at]
        enter(np.unique(np.concatenate([at, before[before >= 0]])))
    counts = np.add.reduceat(alive, (ends - sizes)[sizes > 0], dtype=np.int64)
    lens = np.zeros(len(words), np.int64)
    lens[sizes > 0] = counts
    return symbol[alive], lens


def _merges(path: str) -> Merges:
    cache = worker_cache("merges")
    if path not in cache:
        cache[path] = Merges(path)
    return cache[path]


def _unit_ids(units: np.ndarray, merges: Merges, cache: dict) -> list[bytes]:
    """Ids (little-endian 32-bit) of each distinct cut."""
    known = list(map(cache.get, units))
    misses = [at for at, ids in enumerate(known) if ids is None]
    split, words, parts = merges.split, {}, []
    for unit in map(units.__getitem__, misses):
        if unit in merges.special:
            parts.append(unit)
        else:
            parts.append([words.setdefault(w, len(words)) for w in split(unit)])
    ids, lens = merge_all([w.encode() for w in words], merges)
    raw = ids.astype("<u4").tobytes()
    ends = (np.cumsum(lens) * 4).tolist()
    of_word = [raw[a:b] for a, b in zip([0, *ends], ends)]
    for at, part in zip(misses, parts):
        if isinstance(part, str):
            coded = np.array([merges.special[part]], "<u4").tobytes()
        else:
            coded = of_word[part[0]] if len(part) == 1 else b"".join([of_word[w] for w in part])
        cache[units[at]] = known[at] = coded
    return known


def _whole(text: str, merges: Merges) -> list[str]:
    """Pre-tokens and special tokens of a text, taken at once."""
    found, start = [], 0
    for special in merges.cut_special.finditer(text):
        found += merges.split(text[start : special.start()])
        found.append(special.group())
        start = special.end()
    return found + merges.split(text[start:])


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and how many each text has."""
    merges = _merges(path)
    texts = pc.fill_null(texts, "")
    # white space around a single space, a special token or the mark itself: cut by the pattern
    odd = pc.match_substring_regex(texts, f"[{SPACES}] (?:[{SPACES}]|$)|{MARK}")
    for special in merges.special:
        odd = pc.or_(odd, pc.match_substring(texts, special))
    odd_at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    even = pc.if_else(odd, "", texts)
    flat, counts = split_lists(pc.split_pattern(pc.replace_substring(even, " ", MARK + " "), MARK))
    coded = flat.dictionary_encode()
    units = coded.dictionary.to_numpy(zero_copy_only=False)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    if len(odd_at):
        numbers: dict[str, int] = {}
        more = [[numbers.setdefault(w, len(numbers)) for w in _whole(texts[int(i)].as_py(), merges)]
                for i in odd_at]
        counts[odd_at] = [len(m) for m in more]
        ends = np.cumsum(counts)
        own = np.zeros(len(counts), bool)
        own[odd_at] = True
        merged = np.empty(int(counts.sum()), np.int64)
        from_odd = np.repeat(own, counts)
        merged[~from_odd] = codes
        merged[from_odd] = np.array([c for m in more for c in m], np.int64) + len(units)
        codes = merged
        units = np.concatenate([units, np.array([*numbers, None], object)[:-1]])
    cache = worker_cache(f"bpe {path}")
    if len(cache) > CACHE_UNITS:
        cache.clear()
    ids = _unit_ids(units, merges, cache)
    lens = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    table = np.frombuffer(b"".join(ids), "<u4")
    stream = ragged(table, (np.cumsum(lens) - lens)[codes], lens[codes])
    ends = np.concatenate([[0], np.cumsum(lens[codes])])
    return stream, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])


def decode_ids(ids: np.ndarray, lens: np.ndarray, path: str) -> list[bytes]:
    """Decoded text, in UTF-8, of each run of ids."""
    merges = _merges(path)
    sizes = merges.lens[ids]
    raw = b"".join(
        ragged(merges.bytes, merges.starts[ids[k : k + DECODED_IDS]], sizes[k : k + DECODED_IDS]).tobytes()
        for k in range(0, len(ids), DECODED_IDS)
    )
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(lens)])].tolist()
    out = []
    for a, b in zip(ends, ends[1:]):
        text = raw[a:b]
        try:
            text.decode()
        except UnicodeDecodeError:
            text = text.decode(errors="replace").encode()
        out.append(text)
    return out


def bpe_roundtrip(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    outputs: tuple[str, ...] = ("n_tokens", "ids_sha256", "decoded_sha256"),
) -> DataFrame:
    """Encode every text and decode its ids again.

    ``outputs``: any of ``ids`` (array<int>), ``decoded`` (string), ``n_tokens`` and the digests
    ``ids_sha256`` (of little-endian unsigned 32-bit ids) and ``decoded_sha256`` (of UTF-8).
    """
    kinds = {
        "ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string()),
        "n_tokens": ("bigint", pa.int64()), "ids_sha256": ("string", pa.string()),
        "decoded_sha256": ("string", pa.string()),
    }

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", PIECE_BYTES):
            ids, lens = encode_texts(piece.column("text"), tokenizer)
            decoded = decode_ids(ids, lens, tokenizer)
            ends = np.cumsum(lens)
            rows = [ids[b - n : b] for b, n in zip(ends, lens)]
            columns = {
                "ids": lambda: [r.astype(np.int32) for r in rows],
                "decoded": lambda: [d.decode() for d in decoded],
                "n_tokens": lambda: lens,
                "ids_sha256": lambda: [hashlib.sha256(r.tobytes()).hexdigest() for r in rows],
                "decoded_sha256": lambda: [hashlib.sha256(d).hexdigest() for d in decoded],
            }
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *(pa.array(columns[o](), kinds[o][1]) for o in outputs)],
                names=["doc_id", *outputs],
            )

    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    return kept.transform(map_batches, run, f"doc_id {kind}, " + ", ".join(f"{o} {kinds[o][0]}" for o in outputs))
