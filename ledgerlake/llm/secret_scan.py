"""Operator 3: secret scan by fixed rules and by inferred formats.

The rules' matches label credentials by kind. From a bounded sample of them a prefix tree is built
for each kind, and its states are merged when their next-character and end frequencies are
statistically compatible (Hoeffding bound, tested through the whole subtree), which gives a small
probabilistic automaton of the format. *Candidates* are all maximal runs of the characters that the
rules allow in a credential, of the rules' least length or more, without full stops at their ends:
every longer word is one. Each is scored by the log-likelihood of each automaton against the better of
two models of other text: character pairs of the candidates that no rule labels, and plain numbers (dates,
telephone and card numbers, addresses), which hexadecimal formats would take for their own. Those above
``LEAST`` in total and ``LEAST_EACH`` for a character, outside all matches of the rules, are spans of kind
``format``.

The texts are read twice, for the sample and for the spans, so candidates are never stored or
shuffled. The sample: ``SAMPLE`` distinct values of a kind (and as many other candidates), the first
by their hash, none longer than ``LONGEST`` characters; every task keeps its own first ones, which
hold all of the table's first ones. Only it reaches the driver, so the automata are bounded too and
travel inside the scoring function. Equal candidates of a piece are scored once, all side by side.

Cases: a null text is empty; very long texts and candidates are scanned whole; a null or repeated
``doc_id`` is carried as it is, one row out for each row in; without labelled credentials no format
is inferred; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import discard, map_batches, materialize, pieces, ragged

# --- Fixed values: kinds in order, their patterns and least lengths --------------------------
KINDS = ("assign", "access", "hex")
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = rb"AKIA[A-Z0-9]+"
HEX = rb"[0-9a-f]+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
# --- end of fixed values ---------------------------------------------------------------------
FORMAT = "format"
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
LEAST_RUN = min(LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX)
SAMPLE = 1500
LONGEST = 128
ALPHA = 0.05  # confidence of the merge test
SEEN = 10  # states visited less often are merged untested
LEAST, LEAST_EACH = 12.0, 0.8  # log-likelihood ratio: in total, for a character
SMOOTH = 0.5
CHARS = 256
PIECE_BYTES = 4 << 20
SIDE_BY_SIDE = 1024  # longer candidates are scored one by one

_HEX_CLASS = bytes(0x68 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))
_SYMBOL = np.full(256, 255, np.uint8)  # number of a credential character
_SYMBOL[np.frombuffer(ALPHABET, np.uint8)] = np.arange(len(ALPHABET))


# log-probability of a character, and of the end, in a plain number
_IN_NUMBER = np.full(CHARS, -30.0)
_IN_NUMBER[np.frombuffer(b"\x000123456789+-./", np.uint8)] = -math.log(15)


def base_spans(text: bytes) -> list[tuple[int, int, int, bytes]]:
    """(start, kind number, end, credential) of the rules' matches, in bytes."""
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        for m in re.finditer(ASSIGN, text, re.I):
            if len(m[2]) >= LEAST_ASSIGN:
                found.append((m.start(), 0, m.end(), m[2]))
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in re.finditer(ACCESS, text) if len(m[0]) >= LEAST_ACCESS]
    if b"h" * LEAST_HEX in text.translate(_HEX_CLASS):
        found += [(m.start(), 2, m.end(), m[0]) for m in re.finditer(HEX, text) if len(m[0]) >= LEAST_HEX]
    return sorted(found)


def candidates(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of all candidates of texts that are joined by line ends."""
    inside = _SYMBOL[raw] != 255
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    wide = ends - starts >= LEAST_RUN
    starts, ends = starts[wide], ends[wide]
    dots = (raw[starts] == 0x2E) | (raw[ends - 1] == 0x2E)
    for k in np.flatnonzero(dots):
        run = raw[starts[k] : ends[k]].tobytes()
        starts[k] += len(run) - len(run.lstrip(b"."))
        ends[k] = max(starts[k], ends[k] - len(run) + len(run.rstrip(b".")))
    wide = ends - starts >= LEAST_RUN
    return starts[wide], ends[wide]


def _points(text: bytes, at: list[int]) -> dict[int, int]:
    """Code point offset of each byte offset."""
    if text.isascii() or not at:
        return {a: a for a in at}
    raw = np.frombuffer(text, np.uint8)
    before = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
    return {a: int(before[a]) for a in at}


def _found(texts: pa.Array) -> tuple[list[bytes], list[list], np.ndarray, np.ndarray, pa.DictionaryArray]:
    """(texts, rule matches of each, text number and offset of each candidate outside the rules'
    matches, the candidates' values) of a piece."""
    plain = [t.as_py() for t in pc.fill_null(texts, "").cast(pa.large_binary())]
    raw = np.frombuffer(b"\n".join(plain), np.uint8)
    offsets = np.cumsum([0, *(len(t) + 1 for t in plain)])
    base = [base_spans(t) for t in plain]
    starts, ends = candidates(raw)
    ruled = np.array([(o + a, o + b) for o, f in zip(offsets.tolist(), base) for a, _, b, _ in f], np.int64).reshape(-1, 2)
    # a candidate is free when no match begins before its end and ends after its start
    begun = np.searchsorted(np.sort(ruled[:, 0]), ends, side="left")
    ended = np.searchsorted(np.sort(ruled[:, 1]), starts, side="right")
    free = begun == ended
    starts, ends = starts[free], ends[free]
    number = np.searchsorted(offsets, starts, side="right") - 1
    held = ragged(raw, starts, ends - starts)
    bounds = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    values = pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(held.tobytes())]
    )
    return plain, base, number, starts - offsets[number], values.dictionary_encode()


def _first_values(sample: int):
    """Distinct values of each kind and of other candidates, the first ``sample`` of the task by hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[dict[bytes, int]] = [{} for _ in range(len(KINDS) + 1)]
        for piece in pieces(batches, "text", PIECE_BYTES):
            _, base, _, _, values = _found(piece.column("text"))
            new: list[set[bytes]] = [set() for _ in kept]
            for spans in base:
                for _, kind, _, value in spans:
                    new[kind].add(value)
            new[-1].update(values.dictionary.to_pylist())
            for kind, more in enumerate(new):
                kept[kind].update((v, xxhash.xxh64_intdigest(v) >> 1) for v in more if len(v) <= LONGEST)
                kept[kind] = dict(sorted(kept[kind].items(), key=lambda x: (x[1], x[0]))[:sample])
        rows = [(k, v.decode(), h) for k, values in enumerate(kept) for v, h in values.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()),
             pa.array([r[2] for r in rows], pa.int64())],
            names=["kind", "value", "at"],
        )

    return run


class Automaton:
    """Probabilistic automaton inferred from strings by merging prefix-tree states."""

    def __init__(self, strings: list[bytes], alpha: float = ALPHA, seen: int = SEEN):
        self.visits, self.ends, self.arcs, self.uses = [0], [0], [{}], [{}]
        for s in strings:
            state = 0
            self.visits[0] += 1
            for c in s:
                self.uses[state][c] = self.uses[state].get(c, 0) + 1
                if c not in self.arcs[state]:
                    self.arcs[state][c] = len(self.visits)
                    self.visits.append(0)
                    self.ends.append(0)
                    self.arcs.append({})
                    self.uses.append({})
                state = self.arcs[state][c]
                self.visits[state] += 1
            self.ends[state] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.seen = seen
        kept = [0]
        border = [(0, c) for c in sorted(self.arcs[0])]
        while border:
            # the most visited state beyond the kept ones is settled next
            at = max(range(len(border)), key=lambda i: self.visits[self.arcs[border[i][0]][border[i][1]]])
            parent, c = border.pop(at)
            state = self.arcs[parent][c]
            if state in kept:
                continue
            same = next((k for k in kept if self._alike(k, state)), None)
            if same is None:
                kept.append(state)
                border += [(state, x) for x in sorted(self.arcs[state])]
            else:
                self.arcs[parent][c] = same
                self._fold(same, state)
                reached = set(border)
                border += [
                    (k, x) for k in kept for x in self.arcs[k]
                    if self.arcs[k][x] not in kept and (k, x) not in reached
                ]
        number = {k: i for i, k in enumerate(kept)}
        self.table = []
        for k in kept:
            total = self.visits[k] + SMOOTH
            spare = SMOOTH / total / CHARS
            steps = {
                c: (math.log(n / total + spare), number[self.arcs[k][c]]) for c, n in self.uses[k].items()
            }
            self.table.append((steps, math.log(spare), math.log(self.ends[k] / total + spare)))

    def _far(self, a: int, n: int, b: int, m: int) -> bool:
        return abs(a / n - b / m) > self.bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _alike(self, x: int, y: int) -> bool:
        stack = [(x, y)]
        while stack:
            x, y = stack.pop()
            n, m = self.visits[x], self.visits[y]
            if min(n, m) < self.seen:
                continue
            if self._far(self.ends[x], n, self.ends[y], m):
                return False
            for c in self.uses[x].keys() | self.uses[y].keys():
                if self._far(self.uses[x].get(c, 0), n, self.uses[y].get(c, 0), m):
                    return False
                if c in self.arcs[x] and c in self.arcs[y] and y != self.arcs[y][c]:
                    stack.append((self.arcs[x][c], self.arcs[y][c]))
        return True

    def _fold(self, x: int, y: int) -> None:
        stack = [(x, y)]
        while stack:
            x, y = stack.pop()
            if x == y:
                continue
            self.visits[x] += self.visits[y]
            self.ends[x] += self.ends[y]
            for c, n in self.uses[y].items():
                self.uses[x][c] = self.uses[x].get(c, 0) + n
                if c in self.arcs[x]:
                    stack.append((self.arcs[x][c], self.arcs[y][c]))
                else:
                    self.arcs[x][c] = self.arcs[y][c]


def automaton_score(table: list, value: bytes) -> float:
    """Log-likelihood of ``value``; a character unknown to a state keeps the state."""
    state, score = 0, 0.0
    for c in value:
        steps, spare, _ = table[state]
        step = steps.get(c)
        if step is None:
            score += spare
        else:
            score += step[0]
            state = step[1]
    return score + table[state][2]


def pair_model(strings: list[bytes]) -> np.ndarray:
    """Log-probabilities of a character after another (0: start and end)."""
    counts = np.zeros((CHARS, CHARS))
    for s in strings:
        row = np.frombuffer(b"\0" + s + b"\0", np.uint8)
        np.add.at(counts, (row[:-1], row[1:]), 1)
    singles = counts.sum(0) + 0.05
    singles /= singles.sum()
    return np.log((counts + 5 * singles) / (counts.sum(1, keepdims=True) + 5))


def side_by_side(table: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weight and next state of [state, symbol], weight of ending) of an automaton."""
    weight = np.empty((len(table), len(ALPHABET)))
    after = np.repeat(np.arange(len(table))[:, None], len(ALPHABET), axis=1)
    for state, (steps, spare, _) in enumerate(table):
        weight[state] = spare
        for c, (w, to) in steps.items():
            weight[state, _SYMBOL[c]], after[state, _SYMBOL[c]] = w, to
    return weight, after, np.array([end for _, _, end in table])


def infer_formats(texts: DataFrame, sample: int = SAMPLE) -> tuple[list, np.ndarray]:
    """Automata of the labelled kinds, and the pair model of other candidates. ``texts``: (text)."""
    first = materialize(
        texts.select("text").transform(map_batches, _first_values(sample), "kind int, value string, at bigint"),
        "secret-sample",
    )  # ``sample`` values of a kind at most from every task
    by_kind: list[list[bytes]] = []
    for kind in range(len(KINDS) + 1):
        rows = first.where(F.col("kind") == kind).distinct().orderBy("at", "value").limit(sample)
        by_kind.append([r["value"].encode() for r in rows.collect()])
    discard(first)
    tables, floor = [], math.inf
    for strings in by_kind[:-1]:
        if strings:
            tables.append(Automaton(strings).table)
            own = sorted(automaton_score(tables[-1], s) / (len(s) + 1) for s in strings)
            floor = min(floor, own[len(own) // 100])
    # a candidate as likely as nearly all labelled credentials may be one: no example of the others
    others = [s for s in by_kind[-1] if max((automaton_score(t, s) / (len(s) + 1) for t in tables), default=0) < floor]
    return tables, pair_model(others)


def is_secret(tables: list, pairs: np.ndarray, value: bytes) -> bool:
    """Whether ``value`` is far likelier as a credential of some format than as other text."""
    if not tables:
        return False
    row = np.frombuffer(b"\0" + value + b"\0", np.uint8)
    other = max(float(pairs[row[:-1], row[1:]].sum()), float(_IN_NUMBER[row[1:]].sum()))
    ratio = max(automaton_score(t, value) for t in tables) - other
    return ratio >= LEAST and ratio >= LEAST_EACH * len(value)


def _judge(tables: list, pairs: np.ndarray):
    def judged(values: pa.Array, dense: list) -> np.ndarray:
        """``is_secret`` of all values, one character of all of them a step."""
        secret = np.zeros(len(values), bool)
        if not tables or not len(values):
            return secret
        sizes = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
        for k in np.flatnonzero(sizes > SIDE_BY_SIDE):
            secret[k] = is_secret(tables, pairs, values[k].as_py())
        rows = np.flatnonzero(sizes <= SIDE_BY_SIDE)
        rows = rows[np.argsort(-sizes[rows], kind="stable")]  # those that go on are always the first ones
        sizes = sizes[rows]
        bounds = np.frombuffer(values.buffers()[1], np.int64)[values.offset :][: len(values) + 1]
        raw = np.frombuffer(values.buffers()[2], np.uint8)
        begin = bounds[rows]
        upto = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")
        score = np.zeros((len(dense), len(rows)))
        state = np.zeros((len(dense), len(rows)), np.int64)
        other, number, last = np.zeros(len(rows)), np.full(len(rows), _IN_NUMBER[0]), np.zeros(len(rows), np.uint8)
        for step, n in enumerate(upto):
            chars = raw[begin[:n] + step]
            other[:n] += pairs[last[:n], chars]
            number[:n] += _IN_NUMBER[chars]
            last[:n] = chars
            symbol = _SYMBOL[chars]
            for k, (weight, after, _) in enumerate(dense):
                score[k, :n] += weight[state[k, :n], symbol]
                state[k, :n] = after[state[k, :n], symbol]
        other = np.maximum(other + pairs[last, 0], number)
        best = np.max([score[k] + dense[k][2][state[k]] for k in range(len(dense))], axis=0)
        secret[rows] = (best - other >= LEAST) & (best - other >= LEAST_EACH * sizes)
        return secret

    names = (*KINDS, FORMAT)

    def shown(spans: list[tuple]) -> str:
        return ",".join(f"{names[k]}:{a}:{b}" for a, k, b in sorted(spans))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = [side_by_side(t) for t in tables]
        for piece in pieces(batches, "text", PIECE_BYTES):
            plain, base, number, begin, values = _found(piece.column("text"))
            hits = np.flatnonzero(judged(values.dictionary, dense)[values.indices.to_numpy()])
            more: list[list] = [[] for _ in plain]
            for h in hits:
                more[number[h]].append((int(begin[h]), len(KINDS), int(begin[h]) + len(values[h].as_py())))
            counts, digests, spans = [[], [], []], [], []
            for text, found, extra in zip(plain, base, more):
                found = [f[:3] for f in found]
                point = _points(text, [x for a, _, b in found + extra for x in (a, b)])
                own = [(point[a], k, point[b]) for a, k, b in found]
                for k in range(len(KINDS)):
                    counts[k].append(sum(x[1] == k for x in own))
                digests.append(hashlib.sha256(shown(own).encode()).hexdigest())
                spans.append(shown(own + [(point[a], k, point[b]) for a, k, b in extra]))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return run


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every document."""
    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    tables, pairs = infer_formats(kept, sample)
    return kept.transform(map_batches,
        _judge(tables, pairs),
        f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    )
