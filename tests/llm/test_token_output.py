"""Simple-8b token files against the library, word by word and after a round trip."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import token_output as op

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("high", [1, 2, 90, 50_000, 1 << 33, 1 << 60])
def test_pack_round_trip(high):
    ids = np.random.default_rng(5).integers(0, high, 3 * op.BLOCK + 77).astype(np.uint64)
    words, offsets = op.pack(ids)
    assert (op.unpack(words) == ids).all()
    for k, start in enumerate(offsets):  # every block decodes on its own
        end = offsets[k + 1] if k + 1 < len(offsets) else len(words)
        assert (op.unpack(words[start:end]) == ids[k * op.BLOCK : (k + 1) * op.BLOCK]).all()


def test_pack_extremes():
    assert len(op.pack(np.zeros(0, np.uint32))[0]) == 0
    assert len(op.pack(np.zeros(op.BLOCK, np.uint32))[0]) < op.BLOCK / 50
    with pytest.raises(ValueError, match="60 bits"):
        op.pack(np.array([1 << 60], np.uint64))


TEXTS = [
    "Plain words, here.", None, "", "  \n\t ", "don't  <|endoftext|>x <|ENDOFTEXT|> É İ ß ſ",
    "a\x1cb\x85c d", "x,y. ÀÖ! 12.5 ÷..", "word " * 5000, "Plain words, here.", "ﬁ ̀a e\u0301 日本 😀",
]


def test_files_against_the_library(spark):
    ids = [7, 3, None, 12, 1, 5, 9, 2, 7, 40]
    docs = spark.createDataFrame(
        [(i, t, "x", 1) for i, t in zip(ids, TEXTS)], "doc_id bigint, text string, shard string, words int"
    ).repartition(3)
    got = op.token_digest(op.write_tokens(docs, PATH, end_id=1)).collect()
    library = Tokenizer.from_file(PATH)
    want = {}
    for i, t in zip(ids, TEXTS):
        coded = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.setdefault(i, []).append((len(coded), zlib.crc32(coded.tobytes())))
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted(x for v in want.values() for x in v)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(ids, key=lambda i: -1 if i is None else i)
    ends = np.cumsum([r.n_tokens for r in got])
    assert [r.start for r in got] == [0, *ends[:-1]]
    for r in got:
        assert (r.n_tokens, r.ids_crc32) in want[r.doc_id]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert op.token_digest(op.write_tokens(docs, PATH, end_id=1)).collect() == []
