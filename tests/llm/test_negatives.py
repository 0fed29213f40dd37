"""Hard negatives against a search of all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftmill.llm import negatives, queries


def usable(r):
    v = r["embedding"]
    return r["label"] is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)


def expected(rows):
    """`rows` are (vec_id, label, vector); every row counts, also equal ones."""
    at = [(i, (la + 1) % 10 if i is not None and i % 7 == 0 else la, [math.floor(256 * x) for x in v]) for i, la, v in rows]
    out = []
    for k, (i, la, v) in enumerate(at):
        if i is None or i % 100:
            continue
        scored = [(-sum(map(lambda a, b: a * b, v, w)), math.inf if j is None else j, j, lb) for m, (j, lb, w) in enumerate(at) if m != k]
        scored.sort(key=lambda s: s[:2])
        for ps, _, p, _ in [s for s in scored if s[3] == la][:5]:
            inside = [s for s in scored if s[3] != la and 30 * -ps <= 100 * -s[0] <= 90 * -ps]
            out += [(i, p, rank, n, -ps, -ns) for rank, (ns, _, n, _) in enumerate(inside[:10], 1)]
    return sorted(map(str, out))


@pytest.mark.parametrize("blocks", [(1 << 15, 1 << 14), (40, 3)])
def test_query_equals_all_pairs(spark, sf_dir, odd_tables, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", blocks[1])
    for folder in (odd_tables, sf_dir):
        rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "label", "embedding").collect()
        found = queries.queries()["op12_threshold_negatives"](spark, folder).collect()
        names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
        assert sorted(str(tuple(r[n] for n in names)) for r in found) == expected([tuple(r) for r in rows if usable(r)])
        assert found


def test_repeated_rows_and_null_ids(spark):
    """A copy of an anchor is an anchor and a positive; a null id is the last of a tie."""
    rows = [(100, [0.5, 0.5], 1)] * 3 + [(None, [0.25, 0.25], 2)] * 2 + [(5, [0.25, 0.25], 2), (6, [0.25, 0.125], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = negatives.hard_negatives(df, F.col("id") % 100 == 0).collect()
    assert sorted(str(tuple(r)) for r in found) == expected([(i, la, v) for i, v, la in rows])


def test_large_components_are_exact(spark):
    rows = [(100, [2.0**19, 3.0, 1.0], 1), (1, [2.0**19, 4.0, 0.0], 1), (2, [2.0**18, 1.5, 1.0], 2), (3, [2.0**18, 1.25, 1.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = negatives.hard_negatives(df, F.col("id") % 100 == 0).collect()
    assert sorted(str(tuple(r)) for r in found) == expected([(i, la, v) for i, v, la in rows])


def test_search_ends_early(monkeypatch):
    """The lists are not read to their ends once the threshold is below the last place."""
    rng = np.random.default_rng(1)
    matrix = np.floor(rng.normal(0, 20, (20_000, 4)))
    matrix[:30] = np.floor(rng.normal(0, 5, (30, 4)) + np.array([200, -200, 200, -200]))
    lists, met = negatives.Lists(matrix), []
    read = negatives.Lists.read
    monkeypatch.setattr(negatives.Lists, "read", lambda self, a: ((met.append(len(n)), (n, s, t))[1] for n, s, t in read(self, a)))
    anchor = np.array([100.0, -100.0, 100.0, -100.0])
    rows, scores = negatives.nearest(lists, np.arange(20_000), np.ones(20_000, bool), anchor, 5)
    exact = matrix @ anchor
    assert rows.tolist() == np.lexsort((np.arange(20_000), -exact))[:5].tolist() and (scores == exact[rows]).all()
    assert sum(met) < 2000
