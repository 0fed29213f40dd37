from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftmill.operators import ranking


def rows_of(df):
    return sorted((r["seq_id"], -r["value"], r["token"]) for r in df.collect())


@pytest.fixture(scope="module")
def tied(spark):
    """Items with many equal scores."""
    rng = np.random.default_rng(3)
    items = rng.integers(-2, 3, (300, 6)).astype(float)
    queries = rng.integers(-2, 3, (120, 6)).astype(float)
    expected = []
    for q, row in enumerate(queries @ items.T):
        best = sorted((-s, t) for t, s in enumerate(row))[:7]
        expected += [(q, s, t) for s, t in best]
    table = lambda m, key: spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(m)], f"{key} long, values array<double>"
    )
    return table(queries, "seq_id"), table(items, "token"), sorted(expected)


def test_top_n_with_ties(tied):
    queries, items, expected = tied
    assert rows_of(ranking.top_n_by_inner_product(queries, items, 7)) == expected


def test_top_n_by_tiles(tied):
    queries, items, expected = tied
    out = ranking.top_n_by_inner_product(queries, items, 7, max_item_bytes=0, tile_rows=16)
    assert rows_of(out) == expected


def test_top_n_with_fewer_items(spark, tied):
    queries, items, _ = tied
    out = ranking.top_n_by_inner_product(queries, items.filter("token < 3"), 7)
    assert out.count() == 3 * queries.count()


def test_last_place(spark):
    df = spark.createDataFrame(
        [(1, 0, [1.0]), (1, 1, [2.0]), (2, 0, [3.0])], "seq_id long, place int, values array<double>"
    )
    assert {r["seq_id"]: r["values"] for r in ranking.last_place(df).collect()} == {1: [2.0], 2: [3.0]}
    lengths = spark.createDataFrame([(1, 2), (2, 5)], "seq_id long, n_seq int")
    assert [r["seq_id"] for r in ranking.last_place(df, lengths).collect()] == [1]


def test_temperature_softmax(spark):
    top = spark.createDataFrame([(1, 10, 2.0), (1, 11, 1.0)], "seq_id long, token long, value double")
    out = {(r["temperature"], r["token"]): r["softmax"] for r in ranking.temperature_softmax(top, [0.5, 1, 2]).collect()}
    for t in (0.5, 1.0, 2.0):
        e = np.exp(-1 / t)
        assert abs(out[(t, 10)] - 1 / (1 + e)) < 1e-12 and abs(out[(t, 11)] - e / (1 + e)) < 1e-12


@pytest.fixture
def tied_chances(spark):
    rows = [(1, 5, 0.25), (1, 6, 0.25), (1, 7, 0.5), (2, 9, 1.0)]
    return spark.createDataFrame(rows, "seq_id long, token long, softmax double")


def test_intervals_tile_the_unit(tied_chances):
    out = {r["token"]: (r["low"], r["high"]) for r in ranking.cumulative_intervals(tied_chances).collect()}
    assert out == {5: (0.0, 0.25), 6: (0.25, 0.5), 7: (0.5, 1.0), 9: (0.0, 1.0)}


def test_reference_intervals_coincide(tied_chances):
    spans = ranking.cumulative_intervals(tied_chances, mode="reference")
    out = {r["token"]: (r["low"], r["high"]) for r in spans.collect()}
    assert out == {5: (0.25, 0.5), 6: (0.25, 0.5), 7: (0.5, 1.0), 9: (0.0, 1.0)}
    draw = lambda u: sorted(
        r["token"] for r in ranking.weighted_sample(spans, F.lit(u), mode="reference").collect() if r["seq_id"] == 1
    )
    assert draw(0.3) == [5, 6] and draw(0.1) == [] and draw(0.6) == [7]


@pytest.mark.parametrize("u, token", [(0.0, 5), (0.25, 6), (0.49, 6), (0.5, 7), (0.999, 7), (1.0, 7)])
def test_sample(tied_chances, u, token):
    spans = ranking.cumulative_intervals(tied_chances)
    out = {r["seq_id"]: r["token"] for r in ranking.weighted_sample(spans, F.lit(u)).collect()}
    assert out == {1: token, 2: 9}


def test_uniform_does_not_depend_on_partitioning(spark):
    ids = spark.range(2000).withColumnRenamed("id", "seq_id")
    draw = lambda df: {r[0]: r[1] for r in df.select("seq_id", ranking.uniform(1, "seq_id", F.lit(3))).collect()}
    a, b = draw(ids.repartition(7)), draw(ids.coalesce(1))
    assert a == b and len(set(a.values())) == 2000
    values = np.array(list(a.values()))
    assert values.min() >= 0 and values.max() < 1 and abs(values.mean() - 0.5) < 0.03


def test_best_with_ties_and_nan():
    import numpy as np

    from weftmill.functions.kernels import best

    scores = np.array([[1.0, 3.0, 3.0, 3.0], [np.nan, 0.0, 2.0, 1.0], [np.nan] * 4])
    tokens, values = best(scores, np.array([10, 20, 30, 40]), 2)
    assert tokens.tolist()[:2] == [[20, 30], [30, 40]] and values.tolist()[:2] == [[3.0, 3.0], [2.0, 1.0]]
    assert np.isnan(values[2]).all()


@pytest.mark.parametrize("max_bytes", [1 << 30, 0])
def test_no_items_give_no_candidates(spark, max_bytes):
    from weftmill.operators.ranking import top_n_by_inner_product

    queries = spark.createDataFrame([(1, [1.0, 2.0])], "seq_id int, values array<double>")
    items = spark.createDataFrame([], "token int, values array<double>")
    assert top_n_by_inner_product(queries, items, 3, max_item_bytes=max_bytes).collect() == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tiles_are_neither_joined_nor_broadcast(tied):
    queries, items, _ = tied
    plan = plan_of(ranking.top_n_by_inner_product(queries, items, 7, max_item_bytes=0, tile_rows=16))
    assert "Join" not in plan and "BroadcastExchange" not in plan


def test_streamed_top_in_any_order():
    from weftmill.functions.kernels import StreamedTop, best_of

    rng = np.random.default_rng(5)
    queries, items = rng.integers(-2, 3, (40, 4)).astype(float), rng.integers(-2, 3, (200, 4)).astype(float)
    items[17] = np.nan
    for order in (rng.permutation(200), np.argsort(items.sum(axis=1)), np.arange(200)[::-1]):
        state = StreamedTop(queries, 6)
        for at in np.array_split(order, 23):
            state.add(items[at], at)
        tokens, values = best_of(queries, items, np.arange(200), 6)
        assert (state.tokens == tokens).all() and (state.values == values).all()
