"""Attention by tiles, products by blocks, loud failures, and work along one order."""

from __future__ import annotations

import numpy as np
import pytest
from frames import values_of
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weftmill import model as models
from weftmill.functions import kernels
from weftmill.functions import vectors as V
from weftmill.operators import attention, layers, matrix, ordering
from weftmill.plans import forward

PLACE = ["seq_id", "place"]


def qkv_rows(spark, lengths, width=8, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(s, i, rng.normal(0, 2, 3 * width).tolist()) for s, n in lengths.items() for i in range(n)]
    return spark.createDataFrame(rows, "seq_id long, place int, values array<double>"), rows


def expected(rows, n_head):
    out = {}
    for s in {r[0] for r in rows}:
        m = np.array([r[2] for r in sorted(r for r in rows if r[0] == s)])
        for i, v in enumerate(kernels.attend(m, np.array([0, len(m)]), n_head)):
            out[s, i] = v
    return out


@pytest.mark.parametrize("tile", [1, 3, 16, 256])
def test_tiles_merge_to_the_whole(spark, tile):
    df, rows = qkv_rows(spark, {1: 1, 2: 16, 3: 37, 4: 100})
    found = values_of(attention.tiled_attention(df, 2, tile=tile), PLACE)
    exact = expected(rows, 2)
    assert found.keys() == exact.keys()
    assert all(np.allclose(found[k], exact[k], rtol=0, atol=1e-12) for k in exact)


def test_missing_places_and_carried_column(spark):
    """Whole tiles may be missing; the carried column stays with its place."""
    df, _ = qkv_rows(spark, {1: 40})
    kept = df.filter("place < 3 OR place > 33").withColumn("c", F.array(F.col("place").cast("double")))
    found = attention.tiled_attention(kept, 2, carry="c", tile=4).collect()
    assert len(found) == 9 and all(r["c"] == [float(r["place"])] for r in found)
    dense = kept.withColumn("place", F.when(F.col("place") < 3, F.col("place")).otherwise(F.col("place") - 31).cast("int"))
    whole = values_of(attention.tiled_attention(dense, 2), PLACE)
    for r in found:
        at = r["place"] if r["place"] < 3 else r["place"] - 31
        assert np.allclose(r["values"], whole[1, at], rtol=0, atol=1e-12)


def test_long_sequence_is_the_work_of_many_tasks(spark):
    """20,000 places: all scores would be 3.2 GB a head; tasks hold a tile of queries and one of keys."""
    n, width = 20_000, 4
    df = spark.range(n).selectExpr(
        "0L AS seq_id", "cast(id AS int) AS place", f"transform(sequence(1, {3 * width}), j -> sin(id * j * 0.37D)) AS values"
    )
    found = attention.tiled_attention(df, 1, tile=512)
    rows = found.withColumn("_task", F.spark_partition_id()).select("place", "values", "_task").collect()
    assert len(rows) == n and len({r["_task"] for r in rows}) > 4
    m = np.array([r["values"] for r in df.orderBy("place").collect()])
    for r in rows[:: n // 50]:
        i = r["place"]
        scores = m[: i + 1, width : 2 * width] @ m[i, :width] / 2
        e = np.exp(scores - scores.max())
        assert np.allclose(r["values"], e @ m[: i + 1, 2 * width :] / e.sum(), rtol=0, atol=1e-10)


def test_merging_underflow_and_order():
    """Scores far apart, keys in any order of blocks."""
    rng = np.random.default_rng(3)
    q, k, v = rng.normal(0, 60, (5, 4)), rng.normal(0, 60, (12, 4)), rng.normal(0, 1, (12, 4))
    at = np.arange(12)
    whole = kernels.MergedAttention(q, np.full(5, 99), 2)
    whole.add(k, v, at)
    for order in ([0, 4, 8], [8, 0, 4]):
        parts = kernels.MergedAttention(q, np.full(5, 99), 2)
        for a in order:
            parts.add(k[a : a + 4], v[a : a + 4], at[a : a + 4])
        assert np.allclose(parts.result(), whole.result(), rtol=0, atol=1e-12)


def test_relational_sublayer_shuffles_once(spark, model, token_rows):
    x = layers.embed(token_rows, model.table("wte"), model.table("wpe"))
    plans = []
    held = attention.attention_tiles

    def seen(qkv, carry, tile):
        rows = qkv.groupBy("seq_id").agg(F.count("*"))
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return held(qkv, carry, tile)

    attention.attention_tiles = seen
    try:
        out = forward.multi_head_attention(x, model, 0, method="relational")
    finally:
        attention.attention_tiles = held
    # Up to the tiles one exchange (that of the grouping), behind them none.
    assert plans[0].count("Exchange hashpartitioning") == 1
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_scores_held_are_bounded(monkeypatch):
    rng = np.random.default_rng(0)
    m = rng.normal(0, 1, (50, 24))
    whole = kernels.attend(m, np.array([0, 20, 20, 50]), 2)
    monkeypatch.setattr(kernels, "SCORE_CELLS", 64)
    assert np.allclose(kernels.attend(m, np.array([0, 20, 20, 50]), 2), whole, rtol=0, atol=1e-12)


def weight_table(spark, w):
    return spark.createDataFrame([(i, r) for i, r in enumerate(w.tolist())], "y int, values array<double>")


@pytest.mark.parametrize("grid", [(3, 2, 2), (100, 5, 7), (7, 100, 100)])
def test_block_product(spark, grid):
    rng = np.random.default_rng(1)
    x, w = rng.normal(0, 1, (40, 7)), rng.normal(0, 1, (5, 7))
    df = spark.createDataFrame([(i, "a", None if i == 9 else r) for i, r in enumerate(x.tolist())], "k long, c string, values array<double>")
    out = matrix.block_product(df, weight_table(spark, w), "y", *grid)
    assert out.columns == ["k", "c", "values"]
    found = values_of(out, ["k"])
    assert found.pop((9,)) is None and len(found) == 39
    assert all(np.allclose(v, w @ x[k], rtol=0, atol=1e-12) for (k,), v in found.items())


def test_block_product_of_a_large_layer_without_broadcast(spark):
    """768 x 3072, with no join allowed to broadcast."""
    rows = "transform(sequence(1, 768), j -> cos(id * j * 0.01D))"
    df = spark.range(300).selectExpr("id", f"{rows} AS values")
    weights = spark.range(3072).selectExpr("cast(id AS int) AS y", "transform(sequence(1, 768), j -> sin(id * j * 0.01D)) AS values")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = matrix.block_product(df, weights, "y")
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
        found = values_of(out, ["id"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    j = np.arange(1, 769)
    w = np.sin(np.arange(3072)[:, None] * j * 0.01)
    assert len(found) == 300
    for k in (0, 17, 299):
        assert np.allclose(found[k,], w @ np.cos(k * j * 0.01), rtol=0, atol=1e-9)


def test_wrong_widths_fail(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0])], "a array<double>, b array<double>")
    for value in (V.vec_add("a", "b"), V.vec_mul("a", "b"), V.vec_add(F.col("a"), F.col("b")), V.inner_product("a", "b")):
        with pytest.raises(PySparkException, match="width"):
            df.select(value).collect()
    narrow = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "k int, values array<double>")
    with pytest.raises(PySparkException, match="expected 2 elements"):
        matrix.block_product(narrow, weight_table(spark, np.ones((2, 2))), "y").collect()


def test_null_vectors_stay_null(spark):
    df = spark.createDataFrame([([1.0], None)], "a array<double>, b array<double>")
    assert list(df.select(V.vec_add("a", "b"), V.inner_product("a", "b")).first()) == [None, None]


def test_two_row_and_missing_parameters_fail(spark, model):
    df = spark.createDataFrame([(1, 0, [1.0, 2.0])], "seq_id long, place int, values array<double>")
    one = spark.createDataFrame([([1.0, 1.0],)], "values array<double>")
    assert layers.layer_norm(df, one, one).count() == 1
    for bad in (one.union(one), one.limit(0)):
        with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS|no parameter row"):
            layers.layer_norm(df, bad, one).collect()
    with pytest.raises(ValueError, match="one parameter row"):
        models.collect_matrix(one.union(one))


def test_packed_checks_its_size(spark, model, monkeypatch):
    monkeypatch.setattr(layers, "table_fits", lambda df: False)
    df = spark.createDataFrame([(1, [1.0, 2.0])], "k int, values array<double>")
    with pytest.raises(ValueError, match="too large"):
        layers.linear(df, weight_table(spark, np.ones((2, 2))), weight_table(spark, np.ones((1, 2))).drop("y"), "packed")


def test_beyond_the_bound_the_pass_is_relational(spark, embeddings, token_rows, monkeypatch):
    from weftmill import fixtures

    inside = values_of(forward.encode_sequences(token_rows, fixtures.mini_model(fixtures.embedding_tokens(embeddings))), PLACE)
    monkeypatch.setattr(models, "MAX_TABLE_BYTES", 1000)
    big = fixtures.mini_model(fixtures.embedding_tokens(embeddings))
    some = token_rows.filter("seq_id < 3")
    found = values_of(forward.encode_sequences(some, big), PLACE)
    assert len(found) == 30 and all(np.allclose(v, inside[k], rtol=0, atol=1e-9) for k, v in found.items())


def running(rows, frame):
    """`(key, value)` in order, to sums by position."""
    out, total = [], 0
    for k, v in rows:
        total += v or 0
        out.append(total)
    if frame == "range":
        last = {k: t for (k, _), t in zip(rows, out)}
        out = [last[k] for k, _ in rows]
    return out


@pytest.mark.parametrize("frame", ["range", "rows"])
def test_running_sum(spark, frame):
    """Ties, nulls, negative values; one key holds a third of the rows."""
    rows = [(None if i % 50 == 7 else 0 if i % 3 == 0 else i % 40, i, None if i % 11 == 0 else i % 9 - 3) for i in range(600)]
    df = spark.createDataFrame(rows, "k int, i int, v long")
    order = ["k"] if frame == "range" else ["k", "i"]
    out = ordering.running_sum(df.repartition(7), order, "v", frame=frame)
    assert out.columns == ["k", "i", "v", "running"]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    sums = running([(r[0], r[2]) for r in ordered], frame)
    assert {r["i"]: r["running"] for r in out.collect()} == {r[1]: s for r, s in zip(ordered, sums)}


def test_running_sum_has_no_global_window(spark):
    df = spark.range(1000).selectExpr("id AS k", "1.5D AS v")
    out = ordering.running_sum(df, ["k"], "v", frame="rows")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert {r["k"]: r["running"] for r in out.collect()} == {k: 1.5 * (k + 1) for k in range(1000)}
    assert ordering.running_sum(df.limit(0), ["k"], "v").collect() == []


@pytest.mark.parametrize("bins", [1, 4, 50])
def test_interval_join(spark, bins):
    """Gaps, empty and coinciding intervals, long ones over many bins, values at the edges, and outside."""
    spans = [(0, 10, "a"), (10, 11, "b"), (11, 11, "none"), (20, 90, "c"), (20, 90, "c2"), (90, 95, "d")]
    points = [(i, v) for i, v in enumerate([-1, 0, 9, 10, 11, 15, 19, 20, 89, 90, 94, 95, None] + [50] * 40 + list(range(20, 90)))]
    p = spark.createDataFrame(points, "i int, u int")
    s = spark.createDataFrame(spans, "low int, high int, name string")
    out = ordering.interval_join(p, "u", s, bins=bins)
    assert out.columns == ["i", "u", "low", "high", "name"]
    expected = [(i, u, lo, hi, n) for i, u in points for lo, hi, n in spans if u is not None and lo <= u < hi]
    assert sorted(map(tuple, out.collect())) == sorted(expected)


def test_interval_join_makes_no_pairs(spark):
    p = spark.range(100).withColumnRenamed("id", "u")
    s = spark.range(20).selectExpr("id * 5 AS low", "id * 5 + 5 AS high", "id AS n")
    plan = ordering.interval_join(p, "u", s)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
