"""Byte-pair encoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftmill.llm import bytebpe, queries

PATH = public_tokenizers.path(queries.BYTE_TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def rows(codec, texts):
    ids, ends = codec.encode([t.encode() for t in texts])
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])], codec.decode(ids, ends)


@pytest.mark.parametrize("short", [256, 6, 0])
def test_random_texts(library, monkeypatch, short):
    """Contractions, blanks of all kinds, added strings; words merged by scanning and by heap."""
    monkeypatch.setattr(bytebpe, "SHORT", short)
    rnd = random.Random(11)
    signs = [*"aab bc  \n\t'sdlmtrev123.,!?\u00e9\u65e5\u672c\U0001f600 \u0085\u00a0\u2028", "<|endoftext|>", "'ll", "   ", "=="]
    texts = ["", " ", "'", "'s", " 's", "<|endoftext|><|endoftext|>"]
    texts += ["".join(rnd.choices(signs, k=rnd.randint(0, 50))) for _ in range(3000)]
    got, decoded = rows(bytebpe.Codec(PATH), texts)
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert decoded == [library.decode(i, skip_special_tokens=False).encode() for i in got]


def test_every_character(library):
    codec = bytebpe.Codec(PATH)
    points = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)} 1{chr(c)}b {chr(c)}\n" for c in points[k : k + 64]) for k in range(0, len(points), 64)]
    assert rows(codec, texts)[0] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_long_words(library):
    texts = ["ab" * 5000, "a" * 20_000, "\u65e5\u672c" * 4000, " " * 9000 + "x", "=-" * 3000]
    assert rows(bytebpe.Codec(PATH), texts)[0] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_cut_characters_become_replacement(library):
    codec = bytebpe.Codec(PATH)
    ids = library.encode("\u65e5\u672c\U0001f600").ids
    for n in range(len(ids)):
        for part in (ids[:n], ids[n:]):
            got = codec.decode(np.array(part, np.int64), np.array([0, len(part)]))[0]
            assert got.decode() == library.decode(part, skip_special_tokens=False)


def test_query_equals_library(spark, library, sf_dir, odd_tables):
    for folder in (odd_tables, sf_dir):
        expected = []
        for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect():
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            sha = lambda b: hashlib.sha256(b).hexdigest()
            expected.append(str((r["doc_id"], len(ids), sha(np.array(ids, "<u4").tobytes()), sha(text.encode()))))
        found = queries.queries()["op13_rank_array_bpe"](spark, folder).collect()
        assert sorted(str(tuple(r)) for r in found) == sorted(expected)


def test_encode_and_decode_columns(spark, library):
    texts = [(1, "It's a test, isn't it?"), (2, None), (3, ""), (4, "\u65e5\u672c <|endoftext|> x")]
    docs = spark.createDataFrame(texts, "i int, text string")
    encoded = bytebpe.encode(docs, PATH, carry=[F.col("i")])
    for r in encoded.collect():
        assert r["ids"] == library.encode(dict(texts)[r["i"]] or "", add_special_tokens=False).ids
    decoded = {r["i"]: r["text"] for r in bytebpe.decode(encoded, PATH, carry=[F.col("i")]).collect()}
    assert decoded == {i: t or "" for i, t in texts}
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert bytebpe.decode(nothing, PATH).collect()[0]["text"] is None
