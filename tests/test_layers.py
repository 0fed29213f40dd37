from __future__ import annotations

import math

import numpy as np
import pytest
from frames import values_of
from pyspark.sql import functions as F

from weftmill import fixtures
from weftmill.functions import vectors as V
from weftmill.operators import layers
from weftmill.operators import vectors as vops
from weftmill.plans import forward

PLACE = ["seq_id", "place"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "seq_id long, place int, values array<double>")


def vector_table(spark, values, **key):
    names = ", ".join(f"{k} int" for k in key)
    schema = f"{names}, values array<double>" if key else "values array<double>"
    return spark.createDataFrame([(*key.values(), values)], schema)


def close(a, b, tol=1e-9):
    assert a.keys() == b.keys()
    for k in a:
        assert np.allclose(a[k], b[k], rtol=0, atol=tol), k


def test_vector_functions(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [4.0, 5.0, 6.0])], "a array<double>, b array<double>")
    row = df.select(
        V.vec_add("a", "b"), V.vec_mul("a", "b"), V.vec_scale("a", 2.0), V.inner_product("a", "b"),
        V.vec_slice("b", 2, 2), V.vec_preview("b", 5), V.gelu("a"),
    ).first()
    assert list(row)[:6] == [[5.0, 7.0, 9.0], [4.0, 10.0, 18.0], [2.0, 4.0, 6.0], 32.0, [5.0, 6.0], [4.0, 5.0, 6.0]]
    one = 0.5 * (1 + math.tanh(0.797884560802 * 1.044715))
    assert abs(row[6][0] - one) < 1e-12


def test_safe_exp(spark):
    rows = spark.createDataFrame([(-746.0,), (-745.14,), (-745.13,), (0.0,)], "d double")
    out = [r[0] for r in rows.select(V.safe_exp(F.col("d"))).collect()]
    assert out == [0.0, 0.0, 5e-324, 1.0]


def test_sum_and_renest(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])], "g int, v array<double>")
    assert values_of(vops.vec_sum(df, ["g"], "v", 2), ["g"]) == {(1,): [4.0, 6.0], (2,): [5.0, 6.0]}
    assert values_of(vops.centroids(df, ["g"], "v", 2), ["g"])[(1,)] == [2.0, 3.0]
    rows = vops.unnest_vector(df.filter("g = 2"), ["g"], "v")
    assert values_of(vops.renest_vector(rows, ["g"]), ["g"]) == {(2,): [5.0, 6.0]}


def test_vec_sum_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0])], "g int, v array<double>")
    plan = vops.vec_sum(df, ["g"], "v", 2)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "Generate" not in plan


def test_embed_drops_and_counts(spark):
    tokens = spark.createDataFrame([(1, 0, 7), (1, 1, 99), (1, 2, 7)], "seq_id long, place int, token int")
    wte = vector_table(spark, [1.0, 2.0], token=7)
    wpe = spark.createDataFrame([(0, [0.5, 0.5]), (1, [0.0, 0.0])], "place int, values array<double>")
    assert values_of(layers.embed(tokens, wte, wpe), PLACE) == {(1, 0): [1.5, 2.5]}
    dropped = {r["reason"]: r["n"] for r in layers.embed_dropped(tokens, wte, wpe).collect()}
    assert dropped == {"unknown token": 1, "unknown place": 1}


def test_embed_with_tables_beyond_broadcast(spark, model, token_rows, monkeypatch):
    from weftmill import lineage

    expected = values_of(layers.embed(token_rows, model.table("wte"), model.table("wpe")), PLACE)
    monkeypatch.setattr(lineage, "fits", lambda *a, **k: False)
    close(values_of(layers.embed(token_rows, model.table("wte"), model.table("wpe")), PLACE), expected, 0)


def test_layer_norm(spark):
    x = frame(spark, [(1, 0, [1.0, 2.0, 3.0, 6.0])])
    g, b = vector_table(spark, [1.0, 1.0, 2.0, 1.0]), vector_table(spark, [0.0, 0.0, 0.0, 10.0])
    sd = math.sqrt(3.5 + 1e-5)
    out = values_of(layers.layer_norm(x, g, b), PLACE)
    close(out, {(1, 0): [-2 / sd, -1 / sd, 0.0, 3 / sd + 10]})
    ones = vector_table(spark, [1.0] * 4)
    zero = vector_table(spark, [0.0] * 4)
    assert abs(sum(values_of(layers.layer_norm(x, ones, zero), PLACE)[(1, 0)])) < 1e-12


@pytest.mark.parametrize("method", ["arrow", "packed", "shuffle", "auto"])
def test_linear(spark, method):
    x = frame(spark, [(1, 0, [1.0, 2.0]), (1, 1, [0.0, -1.0]), (2, 0, [3.0, 0.5])])
    w = spark.createDataFrame([(0, 2, [5.0, 6.0]), (0, 0, [1.0, 2.0]), (0, 1, [3.0, 4.0])], "block int, place int, values array<double>")
    b = vector_table(spark, [10.0, 20.0, 30.0], block=0)
    out = values_of(layers.linear(x, w, b, method), PLACE)
    assert out == {(1, 0): [15.0, 31.0, 47.0], (1, 1): [8.0, 16.0, 24.0], (2, 0): [14.0, 31.0, 48.0]}


def test_split_heads(spark):
    x = frame(spark, [(1, 0, [float(i) for i in range(12)])])
    rows = layers.split_heads(x, 2).orderBy("head").collect()
    assert [(r["head"], r["q"], r["k"], r["v"]) for r in rows] == [
        (0, [0.0, 1.0], [4.0, 5.0], [8.0, 9.0]),
        (1, [2.0, 3.0], [6.0, 7.0], [10.0, 11.0]),
    ]


def test_softmax_rows_sum_to_one_and_mask_is_zero(spark, model, token_rows):
    rows = layers.embed(token_rows, model.table("wte"), model.table("wpe"))
    heads = forward.attention_heads(rows, model, 0)
    pruned = forward.attention_weights(heads)
    full = layers.softmax(layers.attention_scores(heads, mask="full"), ["seq_id", "head", "x"])
    sums = pruned.groupBy("seq_id", "head", "x").agg(F.sum("value").alias("s"))
    assert sums.filter("abs(s - 1) > 1e-12").isEmpty()
    assert full.filter("y > x AND value <> 0").isEmpty()
    both = full.filter("y <= x").join(pruned.withColumnRenamed("value", "p"), ["seq_id", "head", "x", "y"])
    assert both.count() == pruned.count()
    assert both.filter("abs(value - p) > 1e-12").isEmpty()


def test_softmax_of_large_scores(spark):
    df = spark.createDataFrame([(1, 0, 1e9), (1, 1, 1e9 - 1), (1, 2, -1e10)], "seq_id long, i int, value double")
    out = [r["value"] for r in layers.softmax(df, ["seq_id"]).orderBy("i").collect()]
    assert abs(out[0] - 1 / (1 + math.exp(-1))) < 1e-12 and out[2] == 0.0


@pytest.mark.parametrize("residual", [True, False])
def test_attention_methods_agree(model, token_rows, residual):
    rows = layers.embed(token_rows, model.table("wte"), model.table("wpe"))
    arrow = forward.multi_head_attention(rows, model, 1, residual)
    relational = forward.multi_head_attention(rows, model, 1, residual, method="relational")
    close(values_of(arrow, PLACE), values_of(relational, PLACE))


def test_forward_methods_agree(model, token_rows):
    arrow = values_of(forward.encode_sequences(token_rows, model), PLACE)
    close(arrow, values_of(forward.encode_sequences(token_rows, model, "relational"), PLACE))


def test_later_tokens_do_not_change_earlier_places(model, token_rows):
    whole = values_of(forward.encode_sequences(token_rows, model), PLACE)
    short = values_of(forward.encode_sequences(token_rows.filter("place < 6"), model), PLACE)
    close(short, {k: v for k, v in whole.items() if k[1] < 6})


def test_sequences_of_any_length_and_gaps(spark, model):
    """One long sequence between short ones, and a dropped token in the middle."""
    rows = [(1, p, p * 3) for p in range(64)] + [(2, 0, 5)] + [(3, 0, 1), (3, 2, 9)]
    tokens = spark.createDataFrame(rows, "seq_id long, place int, token int")
    arrow = values_of(forward.encode_sequences(tokens, model), PLACE)
    close(arrow, values_of(forward.encode_sequences(tokens, model, "relational"), PLACE))
    assert len(arrow) == 67


def test_arrow_forward_has_one_shuffle_by_sequence(spark, model, token_rows):
    rows = layers.embed(token_rows, model.table("wte"), model.table("wpe"))
    plan = forward.transform(rows, model)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(seq_id") == 1
    assert plan.count("+- ArrowEvalPython") == 1


def test_model_write_and_read(spark, model, token_rows, tmp_path):
    from weftmill.model import Model
    from weftmill.operators.ingest import validate_table
    from weftmill.sources.tables import model_specs

    model.write(str(tmp_path))
    again = Model.read(spark, str(tmp_path), model.n_head, model.n_block)
    for name, spec in model_specs(64, 256).items():
        assert validate_table(again.table(name), spec).isEmpty(), name
    plan = again.table("c_attn_w", 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block" in plan
    a, b = (values_of(forward.encode_sequences(token_rows, m), PLACE) for m in (model, again))
    close(a, b, 1e-12)


def test_model_beyond_broadcast(model, monkeypatch):
    from weftmill import model as model_module

    monkeypatch.setattr(model_module, "MAX_TABLE_BYTES", 1000)
    fresh = fixtures.mini_model(model.table("wte"))
    with pytest.raises(ValueError, match="relational"):
        fresh.shared()


def test_sum_of_another_width_fails(spark):
    from weftmill.operators.vectors import vec_sum

    df = spark.createDataFrame([(1, [1.0, 2.0]), (1, None), (1, [1.0, 2.0])], "g int, v array<double>")
    assert vec_sum(df, ["g"], "v", 2).first()["values"] == [2.0, 4.0]
    with pytest.raises(Exception, match="expected 1 elements, found 2"):
        vec_sum(df, ["g"], "v", 1).collect()


def test_matrix_functions_keep_nulls_and_refuse_mixed_widths(spark):
    from weftmill.functions import kernels

    double = kernels._column(kernels.VECTOR, lambda m, _o: 2 * m)
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [3.0, 4.0])], "id int, v array<double>").coalesce(1)
    found = {r["id"]: r["r"] for r in df.select("id", double("v").alias("r")).collect()}
    assert found == {1: [2.0, 4.0], 2: None, 3: [6.0, 8.0]}
    mixed = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [1.0])], "id int, v array<double>").coalesce(1)
    with pytest.raises(Exception, match="differ in width"):
        mixed.select(double("v").alias("r")).collect()


def test_matrix_functions_work_in_slices(monkeypatch):
    from weftmill.functions import kernels

    rng = np.random.default_rng(3)
    offsets = np.array([0, 3, 3, 10, 11, 30], np.int32)
    qkv = rng.normal(size=(30, 12))
    whole = kernels.attend(qkv, offsets, 2)
    bounds = kernels._cut_points(30, offsets, 8)
    assert bounds == [0, 3, 11, 30]
    parts = [kernels.attend(qkv[a:b], offsets[(offsets >= a) & (offsets <= b)] - a, 2) for a, b in zip(bounds, bounds[1:])]
    assert np.allclose(np.concatenate(parts), whole)


def test_gap_in_the_place_table(model, token_rows):
    """Both ways look places up by their id."""
    import dataclasses

    from weftmill.plans import forward

    tables = {**model.tables, "wpe": model.table("wpe").filter("place <> 3")}
    gap = dataclasses.replace(model, tables=tables, _shared=None)
    some = token_rows.filter("seq_id < 3")
    ways = []
    for method in ("arrow", "relational"):
        rows = forward.encode_sequences(some, gap, method).collect()
        ways.append({(r["seq_id"], r["place"]): r["values"] for r in rows})
    assert ways[0].keys() == ways[1].keys() and not any(p == 3 for _, p in ways[0])
    assert all(np.allclose(ways[0][k], ways[1][k]) for k in ways[0])


def test_packed_weights_evaluate_a_row_once(spark, model, token_rows):
    """The optimizer leaves the input of the product outside the lambda over the weight rows."""
    x = layers.embed(token_rows, model.table("wte"), model.table("wpe"))
    x = layers.layer_norm(x, model.table("ln_1_g", 0), model.table("ln_1_b", 0))
    out = layers.linear(x, model.table("c_attn_w", 0), model.table("c_attn_b", 0), "packed")
    assert "Generate explode(array(" in out._jdf.queryExecution().optimizedPlan().toString()
