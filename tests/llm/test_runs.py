"""Periodic runs against a direct search, on made-up and on given texts."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftmill.llm import queries, runs


def direct(words):
    """Maximal stretches at every lag; of equal stretches the smallest lag is the period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(12, 2 * q):
                found.setdefault((start, i + q), q)
            i += i == start
    return sorted((s, e - s, q) for (s, e), q in found.items())


def flat(texts):
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    return np.array([w for t in texts for w in t], np.int64), first


@pytest.mark.parametrize("share", [1 / 16, 2.0])
@pytest.mark.parametrize("anchors", [1, 40, 1 << 18])
def test_random_words(monkeypatch, share, anchors):
    """Both ways of splitting, and lags one by one or many together."""
    monkeypatch.setattr(runs, "ROUND_SHARE", share)
    monkeypatch.setattr(runs, "LAG_ANCHORS", anchors)
    rnd = random.Random(7)
    for _ in range(400):
        texts = []
        for _ in range(rnd.randint(1, 4)):
            w = [rnd.randrange(rnd.choice([1, 2, 3, 20])) for _ in range(rnd.randint(0, 50))]
            if w and rnd.random() < 0.6:
                a, p = rnd.randrange(len(w)), rnd.randint(1, 9)
                w = w[:a] + (w[a : a + p] * 40)[: rnd.randint(0, 60)] + w[a:]
            texts.append(w)
        assert runs.find_runs(*flat(texts)) == [direct(t) for t in texts]


def test_words_that_peel_off_one_by_one():
    """Each round of splitting makes only one more word rare: the work must not be rounds times words."""
    w = [x for i in range(60_000) for x in (i, i + 1)]
    assert runs.find_runs(*flat([w])) == [[]]


def test_one_word_many_times():
    assert runs.find_runs(*flat([[5] * 100_000])) == [[(0, 100_000, 1)]]


def expected(doc_id, text):
    words = [w for w in runs_words(text)]
    h, n = (1 if doc_id is None else zlib.crc32(str(doc_id).encode())), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = direct(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found).encode()
    rest = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (n, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines), sha(rest))


def runs_words(text):
    out, word = [], b""
    for b in (text or "").encode() + b" ":
        if b in (9, 10, 11, 12, 13, 32):
            if word:
                out.append(word)
            word = b""
        else:
            word += bytes([b])
    return out


def test_query_equals_direct_search(spark, sf_dir, odd_tables):
    for folder in (odd_tables, sf_dir):
        docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
        long = {r["doc_id"] for r in docs if len(r["text"] or "") > 100_000}
        found = queries.queries()["op11_periodic_runs"](spark, folder).collect()
        assert len(found) == len(docs)
        got = sorted((str(tuple(r)) for r in found if r["doc_id"] not in long))
        assert got == sorted(str((r["doc_id"], *expected(r["doc_id"], r["text"]))) for r in docs if r["doc_id"] not in long)
        for r in found:
            if r["doc_id"] in long:  # one pair of words, over and over
                assert (r["n_runs"], r["start"], r["length"], r["period"]) == (1, 0, 80_000, 2)


def test_details(spark):
    text = "x " + "a b c " * 5 + "y  \n z"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "i int, text string")
    found = runs.periodic_runs(docs, carry=[F.col("i")], with_details=True).orderBy("i").collect()
    assert [tuple(r) for r in found[0]["runs"]] == [(1, 15, 3)]
    assert [r["collapsed"] for r in found] == ["x a b c y z", "", ""]
    assert [r["exponent_milli"] for r in found] == [5000, None, None]
