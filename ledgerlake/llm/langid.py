"""Operator 9: language identification by Bayesian evidence fusion.

For each row the posterior over the trained languages, and one class ``und`` for text of none of
them, joins three kinds of evidence:

* text: hashed byte trigrams of the letters (UTF-8, A-Z lowered, everything else a space) under a
  multinomial model of each language, ``und`` being uniform; tempered by ``TEMPER`` as trigrams
  overlap;
* declared language (markup or metadata, its primary subtag): the probability of declaring it given
  the true language, from a table of text posteriors summed by declared value over all rows;
* address: a prior for each host. Text posteriors are summed by host, rolled up to registered
  domain and suffix, and smoothed from the whole table down to the host, each level with
  ``KAPPA`` pseudo-rows of its parent.

Counts by host are pre-aggregated by each task, so a hot host costs one row of each; the priors
are written and joined back, broadcast only when that table is measured to be small. The text model
is fitted on distinct labelled texts, about ``SAMPLE`` of each language at most, chosen by their hash
(all texts of a language that has fewer). Every declared language with ``LEAST_TEXTS`` distinct texts
or more is modelled, however rare it is among the rows; every table of counts covers all rows.

A row is accepted when its best class is a language with posterior ``LEAST`` or more.

Cases: a text without letters (or null) has no language and is not accepted; a null or unknown
declared language is no evidence or the value ``other``; a null host has the empty name; equal rows
have equal results; an empty table gives no row; all carried columns are kept, but those named like
the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType

from ledgerlake.llm.common import column, map_batches, materialize, pieces

UND = "und"
SAMPLE = 4000
LEAST_TEXTS = 5
GRAMS = 1 << 16
SMOOTH = 0.5
TEMPER = 1 / 3
KAPPA = 20.0
UND_PRIOR = 1e-3
LEAST = 0.5
PIECE_BYTES = 1 << 20
RESULTS = ("lang_id", "lang_posterior", "lang_ok")

_LETTERS = np.array(
    [b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)],
    np.uint8,
)
_SPACES = np.uint32(0x202020)


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of each text's letters, each text padded with a space on both sides, without
    those of spaces only; and how many each text has."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    raw = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.zeros(0, np.uint8)
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)
    padded = np.full(len(raw) + 2 * len(sizes), 0x20, np.uint8)
    padded[np.arange(len(raw)) + 2 * row + 1] = _LETTERS[raw]
    wide = padded.astype(np.uint32)
    gram = wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]
    starts = np.cumsum(sizes + 2) - (sizes + 2)
    per_row = np.repeat(np.arange(len(sizes)), sizes)  # a text of n bytes has n windows
    gram = gram[per_row * 2 + np.arange(len(per_row))] if len(per_row) else gram[:0]
    real = gram != _SPACES
    counts = np.bincount(per_row[real], minlength=len(starts))
    return (gram[real] * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.int64), counts


def primary_tag(declared: Column) -> Column:
    """Primary subtag in lower case: ``en`` of ``en-US``."""
    return F.lower(F.regexp_extract(declared.cast("string"), r"^\s*([A-Za-z]+)", 1))


def fit_text_model(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE
) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities [language, trigram]) from about ``sample`` distinct labelled
    texts of each language at most."""
    rows = labelled.select(
        F.col(text_col).cast("string").alias("text"), primary_tag(F.col(lang_col)).alias("lang")
    ).where("text is not null and lang <> ''")
    rows = rows.withColumn("key", F.xxhash64("text"))
    distinct = rows.select("lang", "key").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    found = {r["lang"]: r["n"] for r in distinct.where(F.col("n") >= LEAST_TEXTS).collect()}
    langs = sorted(found)
    number = {x: k for k, x in enumerate(langs)}
    counts = np.zeros((len(langs), GRAMS))
    if langs:
        upto = [(x, int(min(1.0, sample / n) * (1 << 30))) for x, n in found.items()]
        shares = labelled.sparkSession.createDataFrame(upto, "lang string, upto bigint")
        chosen = rows.join(F.broadcast(shares), "lang").where(F.pmod("key", F.lit(1 << 30)) < F.col("upto"))

        def once(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Equal texts of a task go on once; no more than the sample has are kept in mind."""
            seen = set()
            for batch in batches:
                marks = list(zip(batch.column("lang").to_pylist(), batch.column("key").to_pylist()))
                new = np.zeros(len(marks), bool)
                for k, mark in enumerate(marks):
                    if mark not in seen:
                        seen.add(mark)
                        new[k] = True
                yield batch.filter(pa.array(new))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, "text", PIECE_BYTES):
                gram, sizes = trigrams(piece.column("text"))
                lang = np.array([number[x] for x in piece.column("lang").to_pylist()], np.int64)
                at, n = np.unique(np.repeat(lang, sizes) * GRAMS + gram, return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": at // GRAMS, "gram": at % GRAMS, "n": n.astype(np.int64)})

        chosen = chosen.select("lang", "key", "text").transform(
            map_batches, once, "lang string, key bigint, text string"
        )
        counted = chosen.dropDuplicates(["lang", "key"]).transform(map_batches, run, "lang bigint, gram bigint, n bigint")
        summed = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        got = summed.toPandas()  # at most languages x GRAMS rows, whatever the input
        counts[got["lang"].to_numpy(int), got["gram"].to_numpy(int)] = got["n"].to_numpy(float)
    model = np.log((counts + SMOOTH) / (counts.sum(1, keepdims=True) + SMOOTH * GRAMS))
    return langs, model.astype(np.float32)


def _scorer(model: np.ndarray, text: str, result: str):
    """Puts ``result`` for ``text``: tempered log-likelihood of each class, the last one ``und``; null
    without letters."""
    kind = pa.list_(pa.float64())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text, PIECE_BYTES):
            gram, counts = trigrams(piece.column(text))
            full = np.flatnonzero(counts)
            scores = np.zeros((len(counts), len(model) + 1))
            if len(full):
                begin = (np.cumsum(counts) - counts)[full]
                for k, row in enumerate(model):
                    scores[full, k] = np.add.reduceat(row[gram], begin, dtype=np.float64)
            scores[:, -1] = -counts * np.log(GRAMS)
            scores *= TEMPER
            ll = pa.array([s if n else None for s, n in zip(scores.tolist(), counts)], kind)
            at = piece.schema.get_field_index(text)
            piece = piece.remove_column(at)
            yield pa.RecordBatch.from_arrays([*piece.columns, ll], names=[*piece.schema.names, result])

    return run


def _softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    raised = F.transform(scores, lambda x: F.exp(x - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, y: a + y))


def host_priors(rows: DataFrame, classes: int, kappa: float = KAPPA) -> DataFrame:
    """``rows``: (_host, _soft). Returns (_host, _prior): log-prior of each class by host."""
    sums = [F.sum(F.col("_soft")[k]).alias(f"c{k}") for k in range(classes)]
    hosts = materialize(
        rows.groupBy("_host").agg(*sums).select(
            "_host",
            F.substring_index("_host", ".", -2).alias("_domain"),
            F.substring_index("_host", ".", -1).alias("_suffix"),
            *(F.coalesce(f"c{k}", F.lit(0.0)).alias(f"c{k}") for k in range(classes)),
        ),
        "host-languages",
    )
    total = hosts.agg(*(F.sum(f"c{k}").alias(f"c{k}") for k in range(classes))).first()
    counts = [total[f"c{k}"] or 0.0 for k in range(classes)]
    even = [(1 - UND_PRIOR) / max(classes - 1, 1)] * (classes - 1) + [UND_PRIOR]
    root = [(c + kappa * e) / (sum(counts) + kappa) for c, e in zip(counts, even)]
    above, parents = None, None
    for level in ("_suffix", "_domain", "_host"):
        keys = [level, above] if above else [level]
        rows = hosts.groupBy(*keys).agg(*(F.sum(f"c{k}").alias(f"c{k}") for k in range(classes)))
        if above:
            rows = rows.join(parents, above)
        all_rows = sum((F.col(f"c{k}") for k in range(classes)), F.lit(0.0))
        shares = [
            ((F.col(f"c{k}") + kappa * (F.col(f"p{k}") if above else F.lit(root[k]))) / (all_rows + kappa))
            for k in range(classes)
        ]
        parents = rows.select(level, *(s.alias(f"p{k}") for k, s in enumerate(shares)))
        above = level
    return parents.select("_host", F.array(*(F.log(f"p{k}") for k in range(classes))).alias("_prior"))


def identify_language(
    rows: DataFrame,
    langs: list[str],
    model: np.ndarray,
    text: Column,
    declared: Column,
    host: Column,
    carry: list[str] | None = None,
    least: float = LEAST,
) -> DataFrame:
    """``rows`` (their columns ``carry``, by default all) with ``lang_id``, ``lang_posterior`` and
    ``lang_ok``."""
    carry = [c for c in (rows.columns if carry is None else carry) if c not in RESULTS]
    classes = len(langs) + 1
    said_as, at_host, ll = "declared", "host", "ll"
    seen = rows.select(
        *(column(c).alias(f"c{k}") for k, c in enumerate(carry)),  # whatever their names are
        primary_tag(declared).alias(said_as),
        F.coalesce(F.lower(host.cast("string")), F.lit("")).alias(at_host),
        text.cast("string").alias("text"),
    )
    schema = StructType([f for f in seen.schema if f.name != "text"]).add(ll, ArrayType(DoubleType()))
    scored = materialize(seen.transform(map_batches, _scorer(model, "text", ll), schema), "text-evidence")
    known = F.when(F.col(said_as) == "", F.lit(None)).otherwise(
        F.when(F.col(said_as).isin(langs), F.col(said_as)).otherwise("other")
    )
    soft = scored.where(F.col(ll).isNotNull()).select(
        F.col(at_host).alias("_host"), known.alias("_declared"), _softmax(F.col(ll)).alias("_soft")
    )
    # probability of each declared value given the class: at most one row for each language, and one
    declared_sums = {
        r["_declared"]: [r[f"c{k}"] for k in range(classes)]
        for r in soft.where("_declared is not null")
        .groupBy("_declared")
        .agg(*(F.sum(F.col("_soft")[k]).alias(f"c{k}") for k in range(classes)))
        .collect()
    }
    values = [*langs, "other"]
    sums = np.array([declared_sums.get(v, [0.0] * classes) for v in values])
    declares = np.log((sums + 1.0) / (sums.sum(0) + len(values)))
    priors = materialize(host_priors(soft, classes), "host-priors")
    even = [float(np.log((1 - UND_PRIOR) / max(classes - 1, 1)))] * (classes - 1) + [float(np.log(UND_PRIOR))]

    def literal(numbers) -> Column:
        return F.array(*(F.lit(float(x)) for x in numbers))

    said = F.lit(None).cast("array<double>")
    for v, row in zip(values, declares):
        said = F.when(known == v, literal(row)).otherwise(said)
    fused = F.zip_with(
        F.zip_with(ll, F.coalesce(said, literal([0.0] * classes)), lambda x, y: x + y),
        F.coalesce("prior", literal(even)),
        lambda x, y: x + y,
    )
    priors = priors.select(F.col("_host").alias(at_host), F.col("_prior").alias("prior"))
    judged = scored.join(priors, at_host, "left").select(
        *(F.col(f"c{k}") for k in range(len(carry))),
        F.when(F.col(ll).isNotNull(), _softmax(fused)).alias("posterior"),
    )
    posterior = F.col("posterior")
    best = F.array_max(posterior)
    names = F.array(*(F.lit(x) for x in [*langs, UND]))
    lang = F.element_at(names, F.array_position(posterior, best).cast("int"))
    return judged.select(
        *(F.col(f"c{k}").alias(c) for k, c in enumerate(carry)),
        F.when(posterior.isNotNull(), lang).alias("lang_id"),
        best.alias("lang_posterior"),
        F.coalesce((lang != UND) & (best >= least), F.lit(False)).alias("lang_ok"),
    )


def page_text(html: Column) -> Column:
    """Text of a page: without scripts, styles, comments and tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(bare, r"<[^>]*>", " ")


def markup_language(html: Column) -> Column:
    """``lang`` of the page's ``html`` element."""
    return F.regexp_extract(html, r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z-]+)""", 1)
