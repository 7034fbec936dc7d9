"""Pair-index BPE against the library on odd texts, and its decoding."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "  ", " \n ", "a  b", "a   b", " a \n\n  b", "x\x1c y\x1f z \x1d\x1d a", "don't 'S I'll",
    "aaaaaaaaaaaa aaa aaaaa", "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>  c",
    "é x　 y  z \x85 w", "😀😀 ٣٤ 12 3", "\r\n \r\n", "tab\tx \t y", "long " * 4000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(texts, library):
    ids, lens = bpe.encode_texts(pa.array(texts, pa.string()), PATH)
    decoded = bpe.decode_ids(ids, lens, PATH)
    ends = np.cumsum(lens)
    for text, end, n, back in zip(texts, ends, lens, decoded):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids[end - n : end].tolist() == want, text
        assert back.decode() == library.decode(want, skip_special_tokens=False)


def test_odd_texts(library):
    check(ODD, library)


def test_random_texts(library):
    rng = random.Random(11)
    bits = [" ", "  ", "\n", "\t", "a", "b", "e", "the", "ing", " t", "é", "\x1f", "\x85", "1", "23", "!!",
            "'s", "<|endoftext|>", "　", "日本", "😀", "\ufeff", "\x00"]
    check(["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(1500)], library)


def test_cache_limit_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_UNITS", 2)
    check(ODD, library)
    check(ODD[::-1], library)


def test_invalid_utf8_decodes_like_the_library(library):
    ids = np.array([162, 106, 99, 250, 255, 1])
    assert bpe.decode_ids(ids, np.array([6]), PATH)[0].decode() == library.decode(ids.tolist())


def test_rows(spark, library):
    rows = [(1, "Some text."), (1, "Some text."), (None, "x"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS n_tokens", "2 AS ids")
    got = bpe.bpe_roundtrip(docs, PATH, outputs=("n_tokens", "ids", "decoded", "decoded_sha256")).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in got) == [(0, "x"), (1, "Some text."), (1, "Some text."), (4, "")]
    for r in got:
        assert r.ids == library.encode(r.decoded, add_special_tokens=False).ids and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert bpe.bpe_roundtrip(docs.limit(0), PATH).collect() == []
