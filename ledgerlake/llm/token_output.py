"""Operator 1: token ids of all documents in Simple-8b coded files.

Documents are put in ascending ``doc_id`` order by a range partitioning; every range writes one
part file (its rows in order) through Spark's committed writer, so the format works on any store
and a lost executor only repeats its own file. A row of a file is a *chunk* of whole documents:

``shard, chunk, doc_ids, doc_lens, words, block_offsets, n_ids``

``words`` are little-endian 64-bit words: the high 4 bits select how many ids the word holds and
of how many bits (``PACKINGS``; the last one, a single id of 60 bits, is the escape for ids that
no other fits). Ids are packed greedily, afresh in every block of ``BLOCK`` ids, and
``block_offsets`` has the first word of each block, so blocks decode on their own.

The position of a document in the whole stream is the sum of the shards before its own (one row
for each shard) plus what stands before it in the shard.

Cases: a null text is empty and gets the end id only; a null ``doc_id`` sorts first; repeated
rows are documents of their own (ties in any order); an empty table gives no row; other columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import map_batches, materialize, pieces, ragged, split_lists, worker_cache

# --- Fixed values: Simple-8b packings (ids in a word, bits of an id), by selector ------------
PACKINGS = (
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12),
    (4, 15), (3, 20), (2, 30), (1, 60),
)
# --- end of fixed values ---------------------------------------------------------------------
BLOCK = 4096  # ids in a block
CHUNK_IDS = 1 << 19  # ids of a chunk, unless one document has more
PIECE_BYTES = 8 << 20  # text encoded at a time
CACHE_WORDS = 600_000  # words whose ids a worker remembers; forgotten all at once beyond

FILE_SCHEMA = (
    "shard int, chunk int, doc_ids array<bigint>, doc_lens array<bigint>, words binary, "
    "block_offsets array<bigint>, n_ids bigint"
)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Simple-8b words of ``ids`` (below 2**60) and the first word of each block."""
    ids = np.asarray(ids)
    n = len(ids)
    if not n:
        return np.zeros(0, "<u8"), np.zeros(0, np.int64)
    if int(ids.max()) >> 60:
        raise ValueError("an id does not fit in 60 bits")
    at = np.arange(n, dtype=np.int32)
    room = np.minimum(BLOCK - (at & (BLOCK - 1)), n - at).astype(np.int16)
    which = np.full(n, len(PACKINGS) - 1, np.uint8)  # packing of the word that would start here
    high, width = ids, 1  # largest of the next ``width`` ids
    for selector in range(len(PACKINGS) - 2, -1, -1):
        count, bits = PACKINGS[selector]
        while width < count:
            step = min(width, count - width)
            longer = high.copy()
            longer[: n - step] = np.maximum(high[: n - step], high[step:])
            high, width = longer, width + step
        fits = (high < (1 << bits)) & (room >= count)
        if not fits.any():
            break  # more ids in fewer bits fit nowhere either
        which -= fits  # what fits here fitted every packing of fewer ids before
    counts = np.array([c for c, _ in PACKINGS])
    at = np.arange(0, n, BLOCK)
    ends = np.minimum(at + BLOCK, n)
    lanes, lane, path = np.arange(len(at)), [], []
    while len(at):  # all blocks at once, a word of each at a time
        path.append(at)
        lane.append(lanes)
        at = at + counts[which[at]]
        going = at < ends
        at, ends, lanes = at[going], ends[going], lanes[going]
    starts = np.sort(np.concatenate(path))
    offsets = np.searchsorted(starts, np.arange(0, n, BLOCK))
    chosen = which[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(chosen):
        count, bits = PACKINGS[selector]
        rows = np.flatnonzero(chosen == selector)
        for j in range(count):
            words[rows] |= ids[starts[rows] + j].astype(np.uint64) << np.uint64(bits * j)
    return words.astype("<u8"), offsets.astype(np.int64)


def unpack(words: np.ndarray) -> np.ndarray:
    """Ids held by Simple-8b words."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([c for c, _ in PACKINGS])[chosen]
    starts = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.uint64)
    for selector in np.unique(chosen):
        count, bits = PACKINGS[selector]
        rows = chosen == selector
        held, at = words[rows], starts[rows]
        for j in range(count):
            out[at + j] = (held >> np.uint64(bits * j)) & np.uint64((1 << bits) - 1)
    return out


def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    cache = worker_cache("tokenizers")
    if path not in cache:
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        cache[path] = tokenizer
    return cache[path]


def _closing(path: str) -> np.ndarray:
    """For each id, whether it ends a pre-token (with the model's word-end mark)."""
    cache = worker_cache("closing")
    if path not in cache:
        import json

        tokenizer = _tokenizer(path)
        mark = json.loads(tokenizer.to_str())["model"]["end_of_word_suffix"]
        if not mark:
            raise ValueError("the tokenizer's model has no word-end mark")
        size = tokenizer.get_vocab_size()
        cache[path] = np.array([tokenizer.id_to_token(i).endswith(mark) for i in range(size)])
    return cache[path]


# Letters that need no normalizing make one pre-token.
STEM = re.compile(r"[a-zà-öø-ÿ]+")
# A run of letters with punctuation behind it is encoded as two pre-tokens whatever the letters.
TAILED = re.compile(r"([a-zà-öø-ÿ]+)([.,;:!?]+)")


def _ids_of(words: np.ndarray, path: str, cache: dict) -> list[bytes]:
    """Ids of white-space free words, each asked of the library once."""
    need: dict[str, None] = {}
    tails: dict[str, tuple[str, str]] = {}
    known = list(map(cache.get, words))
    misses = [at for at, ids in enumerate(known) if ids is None]
    for word in map(words.__getitem__, misses):
        tailed = TAILED.fullmatch(word)
        if tailed:
            tails[word] = tailed.groups()
        need.update(dict.fromkeys(tailed.groups() if tailed else (word,)))
    for part in [part for part in need if part in cache]:
        del need[part]
    tokenizer = _tokenizer(path)
    closing = _closing(path)
    stems = [part for part in need if STEM.fullmatch(part)]
    for at in range(0, len(stems), 1000):  # each stem's last id, and no other, closes a word
        some = stems[at : at + 1000]
        ids = np.array(tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
        ends = (np.flatnonzero(closing[ids]) + 1) * 4
        raw, start = ids.tobytes(), 0
        for part, end in zip(some, ends.tolist(), strict=True):
            cache[part] = raw[start:end]
            start = end
    parts = [part for part in need if part not in cache]
    for at in range(0, len(parts), 20_000):
        some = parts[at : at + 20_000]
        for part, coded in zip(some, tokenizer.encode_batch_fast(some, add_special_tokens=False)):
            cache[part] = np.array(coded.ids, "<u4").tobytes()
    for word, (stem, tail) in tails.items():
        cache[word] = cache[stem] + cache[tail]
    for at in misses:
        known[at] = cache[words[at]]
    return known


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, and how many each text has.

    The tokenizer drops white space and never joins across it, so every distinct word is encoded
    once. It lower-cases too; A-Z are lowered before, but in words that may hold a special token.
    """
    flat, counts = split_lists(pc.ascii_split_whitespace(pc.fill_null(texts, "")))
    special = pc.match_substring(flat, "<|")
    flat = pc.if_else(special, flat, pc.ascii_lower(flat))
    coded = flat.dictionary_encode()
    cache = worker_cache(path)
    if len(cache) > CACHE_WORDS:
        cache.clear()
    ids = _ids_of(coded.dictionary.to_numpy(zero_copy_only=False), path, cache)
    lens = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    table = np.frombuffer(b"".join(ids), "<u4")
    codes = coded.indices.to_numpy(zero_copy_only=False)
    stream = ragged(table, (np.cumsum(lens) - lens)[codes], lens[codes])
    ends = np.concatenate([[0], np.cumsum(lens[codes])])
    return stream, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])


def _encoder(path: str, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk = TaskContext.get().partitionId(), 0
        schema = pa.schema(
            [
                ("shard", pa.int32()), ("chunk", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                ("doc_lens", pa.list_(pa.int64())), ("words", pa.binary()),
                ("block_offsets", pa.list_(pa.int64())), ("n_ids", pa.int64()),
            ]
        )
        for piece in pieces(batches, "text", PIECE_BYTES):
            docs = piece.column("doc_id").to_pylist()
            stream, lens = encode_texts(piece.column("text"), path)
            ends = np.cumsum(lens)
            stream = np.insert(stream, ends, end_id)
            lens = lens + 1
            ends = np.cumsum(lens)
            start = 0
            while start < len(docs):
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + CHUNK_IDS, "right")))
                ids = stream[before : ends[stop - 1]]
                words, offsets = pack(ids)
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "shard": shard, "chunk": chunk, "doc_ids": docs[start:stop],
                            "doc_lens": lens[start:stop].tolist(), "words": words.tobytes(),
                            "block_offsets": offsets.tolist(), "n_ids": len(ids),
                        }
                    ],
                    schema=schema,
                )
                chunk += 1
                start = stop

    return run


def write_tokens(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode ``docs`` and write the files; returns them as read back (``FILE_SCHEMA``)."""
    ordered = (
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
        )
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    )
    return materialize(ordered.transform(map_batches, _encoder(tokenizer, end_id), FILE_SCHEMA), "token-files")


def _reader(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(np.frombuffer(row["words"], "<u8")).astype("<u4")
            lens = np.array(row["doc_lens"], np.int64)
            ends = np.cumsum(lens)
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([row["shard"]] * len(lens), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "in_chunk": ends - lens,
                    "chunk": pa.array([row["chunk"]] * len(lens), pa.int32()),
                    "n_tokens": lens,
                    "ids_crc32": pa.array(
                        [zlib.crc32(ids[b - n : b].tobytes()) for b, n in zip(ends, lens)],
                        pa.int64(),
                    ),
                }
            )


def token_digest(files: DataFrame) -> DataFrame:
    """Read the files: (doc_id, start, n_tokens, ids_crc32) of every document."""
    sizes = files.select("shard", "chunk", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    # one row for each shard, then for each chunk of a shard: never for each document
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = sizes.select(
        "shard", "chunk", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("in_shard")
    )
    # few narrow rows, written so that the joins know their size
    bases = materialize(
        chunks.join(shards, "shard").select(
            "shard", "chunk", (F.col("base") + F.col("in_shard")).alias("base")
        ),
        "token-offsets",
    )
    docs = files.select("shard", "chunk", "doc_ids", "doc_lens", "words").transform(map_batches,
        _reader,
        "shard int, doc_id bigint, in_chunk bigint, chunk int, n_tokens bigint, ids_crc32 bigint",
    )
    return docs.join(bases, ["shard", "chunk"]).select(
        "doc_id", (F.col("base") + F.col("in_chunk")).alias("start"), "n_tokens", "ids_crc32"
    )
