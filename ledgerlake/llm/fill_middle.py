"""Operator 12: fill-in-middle transformation, cut by a learned rank index.

A text is cut into lines, each with its line feed. The boundaries of all lines of a batch are one
ascending sequence of offsets; a piecewise-linear index learns it: each segment is a line through the
ranks from which no offset lies further than ``error`` (a greedy cone: a segment goes on while some
slope fits all of its points), and the difference that is left for each rank is stored in 16 bits. A cut at
a line number is the rank's segment, its prediction and the stored residual: the exact offset.

Prefix, middle and suffix are the text before, between and after two cuts drawn from SHA-256 of a
seed and the id, so a rerun, another partitioning or a lost executor gives the same cuts.

Cases: a null text is an empty one, an empty text has no lines and stays plain, as do texts that hold
a sentinel; a null id counts as an empty decimal; a single line longer than ``error`` opens a segment;
texts and line counts are not limited (64-bit offsets, batches cut by bytes); rows that repeat give
rows that repeat; an empty table gives no row; other columns are carried, but for ones named like a
result, which are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import column, map_batches, pieces

ERROR = 255  # bytes that a predicted boundary may be off
PIECE_BYTES = 4 << 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
LOOK = 64  # ranks looked at first for the end of a segment; then twice as many each time


@dataclass
class RankIndex:
    """Offsets by rank: segments (first rank, slope, offset there) and a residual for each rank."""

    first: np.ndarray
    slope: np.ndarray
    base: np.ndarray
    residual: np.ndarray

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.first, ranks, side="right") - 1
        return self.base[k] + np.rint(self.slope[k] * (ranks - self.first[k])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        return self.predict(ranks) + self.residual[ranks]


def fit_rank_index(offsets: np.ndarray, error: int = ERROR) -> RankIndex:
    """The index of an ascending sequence of offsets; every prediction is off by ``error`` at most."""
    offsets = np.asarray(offsets, np.int64)
    first, slope, n, start = [], [], len(offsets), 0
    reach = error - 0.5  # what rounding may add to a prediction stays within the bound
    while start < n:
        low, high, end, look = -np.inf, np.inf, start + 1, LOOK
        while end < n:
            stop = min(n, end + look)
            steps = np.arange(end - start, stop - start)
            rise = offsets[end:stop] - offsets[start]
            lows = np.maximum.accumulate(np.maximum((rise - reach) / steps, low))
            highs = np.minimum.accumulate(np.minimum((rise + reach) / steps, high))
            fits = int(np.argmax(lows > highs)) if (lows > highs).any() else stop - end
            if fits:
                low, high = lows[fits - 1], highs[fits - 1]
            end, look = end + fits, 2 * look
            if end < stop:
                break
        first.append(start)
        slope.append((low + high) / 2 if end > start + 1 else 0.0)
        start = end
    first = np.array(first, np.int64)
    index = RankIndex(first, np.array(slope), offsets[first], np.zeros(n, np.int16))
    if n:
        index.residual = (offsets - index.predict(np.arange(n))).astype(np.int16)
    return index


def line_boundaries(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple:
    """Offsets of all line boundaries of the texts ``data[start:stop]``, text after text, and the
    number of lines of each. A text without lines has one boundary."""
    feeds = np.flatnonzero(data == 10) + 1
    a, b = np.searchsorted(feeds, start, "right"), np.searchsorted(feeds, stop, "right")
    inner = b - a  # boundaries right after a line feed
    tail = (stop > start) & (data[np.maximum(stop, 1) - 1] != 10) if len(data) else np.zeros(len(start), bool)
    lines = inner + tail
    at = np.cumsum(lines + 1) - (lines + 1)
    out = np.empty(int((lines + 1).sum()), np.int64)
    out[at] = start
    each = np.repeat(at + 1 - (np.cumsum(inner) - inner), inner) + np.arange(int(inner.sum()))
    out[each] = feeds[np.repeat(a - (np.cumsum(inner) - inner), inner) + np.arange(int(inner.sum()))]
    out[(at + lines)[tail]] = stop[tail]
    return out, lines


def draws(seed: int, row_id: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit draws of a document."""
    text = f"{seed}:{'' if row_id is None else row_id}"
    digest = hashlib.sha256(text.encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def _cutter(id_col: str, text_col: str, seed: int, rate: int, spm_rate: int, error: int):
    sentinels = [s.encode() for s in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = sentinels

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text_col, PIECE_BYTES):
            texts = piece.column(text_col).fill_null("").cast(pa.large_binary())
            offs = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
            buffer = texts.buffers()[2]
            view = memoryview(buffer if buffer is not None else b"")
            data = np.frombuffer(view, np.uint8)[: offs[-1]]
            bounds, lines = line_boundaries(data, offs[:-1], offs[1:])
            index = fit_rank_index(bounds, error)
            drawn = np.array([draws(seed, i) for i in piece.column(id_col).to_pylist()], np.int64)
            cuts = np.sort(drawn[:, :2] % (lines + 1)[:, None], axis=1)
            rank = np.cumsum(lines + 1) - (lines + 1)
            one, two = (index.offsets(rank + cuts[:, k]).tolist() for k in range(2))
            form, out, before, between = [], [], [], []
            for k in range(len(texts)):
                a, b = int(offs[k]), int(offs[k + 1])
                text = bytes(view[a:b])
                if a == b or drawn[k, 2] % 100 >= rate or any(x in text for x in sentinels):
                    form.append("plain"), out.append(text), before.append(None), between.append(None)
                    continue
                prefix, middle, suffix = text[: one[k] - a], text[one[k] - a : two[k] - a], text[two[k] - a :]
                spm = drawn[k, 3] % 100 < spm_rate
                form.append("spm" if spm else "psm")
                out.append(s + suffix + p + prefix + m + middle if spm else p + prefix + s + suffix + m + middle)
                before.append(len(prefix.decode())), between.append(len(middle.decode()))
            results = {
                "n_lines": pa.array(lines, pa.int64()), "fim_form": pa.array(form, pa.string()),
                "prefix_chars": pa.array(before, pa.int64()), "middle_chars": pa.array(between, pa.int64()),
                "fim_text": pa.array(out, pa.binary()).cast(pa.string()),
            }
            yield pa.RecordBatch.from_pydict({c: piece.column(c) for c in piece.schema.names} | results)

    return run


RESULTS = {
    "n_lines": T.LongType(), "fim_form": T.StringType(), "prefix_chars": T.LongType(),
    "middle_chars": T.LongType(), "fim_text": T.StringType(),
}


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7,
    rate: int = 100, spm_rate: int = 50, error: int = ERROR,
) -> DataFrame:
    """``docs`` with ``fim_text`` and ``fim_form`` (plain, psm, spm), the number of lines, and the
    characters of prefix and middle. ``rate``: percent of texts that are transformed; ``spm_rate``:
    percent of those that put the suffix first."""
    own = [c for c in docs.columns if c not in RESULTS]
    # plain names on the way through Python, whatever the columns are called
    rows = docs.select(*(column(c).alias(f"c{k}") for k, c in enumerate(own)))
    schema = T.StructType(rows.schema.fields + [T.StructField(c, t) for c, t in RESULTS.items()])
    at = f"c{own.index(id_col)}", f"c{own.index(text_col)}"
    cut = rows.transform(map_batches, _cutter(*at, seed, rate, spm_rate, error), schema)
    return cut.toDF(*own, *RESULTS)


def restore(text: Column, form: Column) -> Column:
    """The text that a transformed one was made of."""
    def between(start: str, end: str | None) -> Column:
        begin = F.locate(start, text) + len(start)
        return F.substring(text, begin, F.locate(end, text) - begin if end else F.length(text))

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(text)


SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS lines
  FROM documents),
numbers AS (
  SELECT *, len(lines) AS n, list_transform([1, 9, 17, 25], lambda i:
    list_reduce(list_transform(range(0, 8), lambda k: (instr('0123456789abcdef', h[i + k]) - 1)::BIGINT),
      lambda x, y: x * 16 + y)) AS r
  FROM drawn),
cuts AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR r[3] % 100 >= 100 THEN 'plain' WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT *, array_to_string(lines[1:a], '') AS prefix, array_to_string(lines[a + 1:b], '') AS middle,
    array_to_string(lines[b + 1:], '') AS suffix FROM cuts)
SELECT doc_id, n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM parts
"""
