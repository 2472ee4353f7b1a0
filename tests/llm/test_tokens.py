"""BPE and token files against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketlens.llm import bpe, queries, token_file
from basketlens.llm.common import shared_path

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", "   ", " 　x", "Hello World's  12345 café <|endoftext|> x​ ÀÉ 😀!? don't", "\x00\x1d a\u0085b c d İ ǅ é <|STARTOFTEXT|>",
    "a<|endoftext|>b'S 'Re ΑΣΣ Σ J̌ aaaaaaa b ½² ٣٤ 漢字かな", "́x é", "'", "''s", "<|startoftext|><|endoftext|>", "<|endof text|>",
    "a" * 35, "!" * 1000, "hahahaha" * 50, "long word " * 3000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(2)
    letters = list("abcdeéß'sStT tlLre 019!?.-Σ́ \n\t<|>漢😀\x1f")
    return [*ODD, *("".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(800))]


def test_encoding_and_decoding_equal_the_library(spark, library):
    rows = [(i, t, 5) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    for got in (bpe.round_trip(docs, PATH), bpe.decode(bpe.encode(docs, PATH), PATH)):
        for r in got.collect():
            expected = library.encode(rows[r.doc_id][1] or "", add_special_tokens=False).ids
            assert np.frombuffer(bytes(r.ids), "<u4").tolist() == expected
            assert r.decoded == library.decode(expected, skip_special_tokens=False)


def test_cache_limit_does_not_change_ids(monkeypatch):
    whole = bpe.WordBpe(PATH).encode(texts())
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 6)
    known = bpe.WordBpe(PATH)
    assert [known.encode([t])[0] for t in texts()] == whole


@pytest.mark.parametrize("segment", [64, 1 << 21])
def test_token_file_round_trip(spark, library, monkeypatch, segment):
    monkeypatch.setattr(token_file, "SEGMENT_IDS", segment)
    rows = [(i * 7 - 300, t) for i, t in enumerate(texts()[:120])] + [(None, "no id"), (5, "twice"), (5, "twice"), (1 << 40, "far")]
    path = shared_path(spark, "tokens")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("part", F.lit(1)).repartition(5)
    token_file.write(docs, path, PATH, 2)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_file.read(spark, path).collect()), key=lambda r: r[1])
    start, expected = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == expected


def test_empty_token_file(spark):
    path = shared_path(spark, "tokens")
    token_file.write(spark.createDataFrame([], "doc_id long, text string"), path, PATH, 2)
    assert token_file.read(spark, path).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(3)
    for n, top in [(1, 0), (1, 10**12), (5, 3), (1000, 10**6), (700, 50), (3000, 10**11)]:
        values = np.sort(rng.integers(0, top + 1, n))
        code = token_file.EliasFano.build(values)
        assert code.values().tolist() == values.tolist()
        assert [code.select(i) for i in range(0, n, 7)] == values[::7].tolist()
        for i, j in [(0, n), (n // 3, n // 2), (n // 2, n), (n - 1, n), (min(n, 256), min(n, 512)), (n, n)]:
            assert code.span(i, j).tolist() == values[i:j].tolist()
        assert len(code.low) + len(code.high) <= (n * (3 + max(0, np.log2(max(top, 1) / n)))) / 8 + 16
    assert token_file.EliasFano.build(np.zeros(0, np.int64)).values().tolist() == []


def test_queries_equal_the_library_on_a_whole_table(spark, library):
    folder = "/root/testdata/sf0.01"
    docs = sorted(map(tuple, spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()))
    coded, start, placed = {}, 0, []
    for doc, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids
        plain = library.decode(ids, skip_special_tokens=False)
        coded[doc] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(plain.encode()).hexdigest())
        placed.append((doc, start, len(ids) + 1, zlib.crc32(np.array([*ids, 2], "<u4").tobytes())))
        start += len(ids) + 1
    assert {r[0]: tuple(r)[1:] for r in queries.op2_bpe(spark, folder).collect()} == coded
    assert sorted(map(tuple, queries.op4_token_file(spark, folder).collect())) == placed


def test_empty_table(spark):
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
