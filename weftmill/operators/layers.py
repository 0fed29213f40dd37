"""Transformer stages as DataFrame operators over many sequences.

Relations: sequence rows `(seq_id, place, values)`, head rows `(seq_id, head, place, q, k, v)`,
score rows `(seq_id, head, x, y, value)` with x the query place and y the key place. Every join and
window includes `seq_id`. A sequence has at most as many places as the place table has rows, so
all groups by `seq_id` are bounded by the model, not by the data.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftmill.functions import kernels
from weftmill.functions.vectors import (
    MASK_ADDEND,
    NORM_EPSILON,
    gelu,
    inner_product,
    normalise,
    safe_exp,
    vec_add,
)
from weftmill.lineage import lookup, ordered
from weftmill.model import MAX_TOKEN_BYTES, collect_matrix, table_fits
from weftmill.operators.matrix import block_product
from weftmill.operators.vectors import sum_elements


def sequence_rows(sequences: DataFrame, id_cols: list[str] | None = None) -> DataFrame:
    """Token arrays as `(seq_id, place, token)`, place from 0."""
    ids = id_cols or ["seq_id"]
    return sequences.select(*ids, F.posexplode("input").alias("place", "token"))


def embed(tokens: DataFrame, wte: DataFrame, wpe: DataFrame) -> DataFrame:
    """`(seq_id, place, token)` to `(seq_id, place, values)`: token vector + place vector.

    A token or place without a row drops; `embed_dropped` counts those.
    """
    size = F.size("t") * 8
    t = wte.select("token", F.col("values").alias("t"))
    p = wpe.select("place", F.col("values").alias("p"))
    # Vectors are wide, so a large token table is repeated for few salts only.
    facts = tokens.select("seq_id", "place", "token")
    rows = lookup(facts, t, "token", ["seq_id", "place"], size, max_bytes=MAX_TOKEN_BYTES, salts=8)
    rows = lookup(rows, p, "place", ["seq_id"], F.size("p") * 8)
    return rows.select("seq_id", "place", vec_add("t", "p").alias("values"))


def embed_dropped(tokens: DataFrame, wte: DataFrame, wpe: DataFrame) -> DataFrame:
    """`(reason, n)`: rows that `embed` drops because of an unknown token or place."""

    def count(table: DataFrame, key: str) -> DataFrame:
        missing = tokens.groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(
            table.select(key), key, "left_anti"
        )
        return missing.agg(
            F.lit(f"unknown {key}").alias("reason"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")
        )

    return count(wte, "token").unionByName(count(wpe, "place"))


def with_parameter(df: DataFrame, table: DataFrame, name: str) -> DataFrame:
    """Attach the single vector of a one-row table as column `name`: a scalar subquery, evaluated once and
    without a join. A table of any other number of rows fails the job."""
    none = F.raise_error(F.lit(f"no parameter row for {name}"))
    return df.withColumn(name, F.coalesce(table.select("values").scalar(), none))


def layer_norm(df: DataFrame, gain: DataFrame, bias: DataFrame, eps: float = NORM_EPSILON) -> DataFrame:
    """Normalise `values` per row with population variance. Map side only."""
    keys = [c for c in df.columns if c != "values"]
    wide = with_parameter(with_parameter(df, gain, "_g"), bias, "_b")
    return wide.select(*keys, normalise("values", "_g", "_b", eps).alias("values"))


def linear(df: DataFrame, weights: DataFrame, bias: DataFrame, method: str = "auto") -> DataFrame:
    """`values` times the weight rows, plus bias; all other columns stay.

    `auto`: `arrow` while the weights are within the broadcast bound, else `shuffle`.
    `arrow`: one matrix product per Arrow batch against broadcast weights. No shuffle.
    `packed`: weights as one array-of-arrays row, higher-order functions only. No shuffle; an error beyond
    the bound.
    `shuffle`: rows and weights cut into a grid of blocks, see `matrix.block_product`; weights of any size.
    """
    keys = [c for c in df.columns if c != "values"]
    row_key = next(c for c in weights.columns if c not in ("block", "values"))
    if method not in ("auto", "arrow", "packed", "shuffle"):
        raise ValueError(f"unknown method {method!r}")
    if method == "auto":
        method = "arrow" if table_fits(weights) else "shuffle"
    if method == "arrow":
        sc = df.sparkSession.sparkContext
        w = sc.broadcast(next(iter(collect_matrix(weights)[0].values())))
        b = sc.broadcast(next(iter(collect_matrix(bias)[0].values())))
        return linear_shared(df, lambda: w.value, lambda: b.value)
    if method == "packed":
        if not table_fits(weights):
            raise ValueError("the weights are too large to broadcast; use method='shuffle'")
        packed = weights.agg(ordered(row_key, "values").alias("values"))
        # The generator keeps the optimizer from moving what `values` is made of into the lambda over the weight
        # rows, where it would be evaluated once for each of them.
        held = df.select(*keys, F.explode(F.array("values")).alias("values"))
        wide = with_parameter(with_parameter(held, packed, "_w"), bias, "_b")
        product = F.transform("_w", lambda w: inner_product(F.col("values"), w))
        return wide.select(*keys, vec_add(product, "_b").alias("values"))
    return with_parameter(block_product(df, weights, row_key), bias, "_b").select(
        *keys, vec_add("values", "_b").alias("values")
    )


def linear_shared(df: DataFrame, weights: Callable[[], np.ndarray], bias: Callable[[], np.ndarray]) -> DataFrame:
    """The same against arrays that have been broadcast already; the calls give them in the worker."""
    keys = [c for c in df.columns if c != "values"]
    # The generator keeps the optimizer from merging nested higher-order functions into the
    # arguments of the Arrow function, from where Spark 4.1 does not extract it.
    held = df.select(*keys, F.explode(F.array("values")).alias("values"))
    return held.select(*keys, kernels.linear_column(weights, bias)("values").alias("values"))


def split_heads(df: DataFrame, n_head: int) -> DataFrame:
    """qkv rows to `(seq_id, head, place, q, k, v)`."""
    width = (F.size("values") / F.lit(3 * n_head)).cast("int")
    part = lambda i: F.slice("values", (F.col("head") + F.lit(i * n_head)) * width + 1, width)
    return df.withColumn("head", F.explode(F.sequence(F.lit(0), F.lit(n_head - 1)))).select(
        "seq_id", "head", "place", part(0).alias("q"), part(1).alias("k"), part(2).alias("v")
    )


def attention_scores(heads: DataFrame, mask: str = "prune") -> DataFrame:
    """`(seq_id, head, x, y, value)`: q.k / sqrt(head width).

    Key places after the query place are masked. `prune` leaves them out of the join: their weight
    is exactly zero. `full` keeps them with the addend of -1e10.
    """
    q = heads.select("seq_id", "head", F.col("place").alias("x"), "q")
    k = heads.select("seq_id", "head", F.col("place").alias("y"), "k")
    score = inner_product("q", "k") / F.sqrt(F.size("q").cast("double"))
    after = F.col("y") > F.col("x")
    pairs = q.join(k, ["seq_id", "head"])
    if mask == "prune":
        pairs = pairs.filter(~after)
    elif mask == "full":
        score = score + F.when(after, F.lit(MASK_ADDEND)).otherwise(F.lit(0.0))
    else:
        raise ValueError("mask must be 'prune' or 'full'")
    return pairs.select("seq_id", "head", "x", "y", score.alias("value"))


def softmax(df: DataFrame, partition: list[str], value: str = "value") -> DataFrame:
    """Replace `value` by its softmax within the partition, safe against overflow."""
    w = Window.partitionBy(*partition)
    keys = [c for c in df.columns if c != value]
    diff = df.withColumn("_diff", F.col(value) - F.max(value).over(w))
    e = diff.select(*keys, safe_exp(F.col("_diff")).alias("_e"))
    return e.select(*keys, (F.col("_e") / F.sum("_e").over(w)).alias(value))


def attention_output(weights: DataFrame, heads: DataFrame, head_width: int) -> DataFrame:
    """Weights times v, heads side by side: `(seq_id, place, values)`.

    The weighted sum is one fixed-width aggregation; v is never exploded by element.
    """
    v = heads.select("seq_id", "head", F.col("place").alias("y"), "v")
    summed = (
        weights.join(v, ["seq_id", "head", "y"])
        .groupBy("seq_id", "x", "head")
        .agg(sum_elements("v", head_width, F.col("value")).alias("values"))
    )
    return summed.groupBy("seq_id", F.col("x").alias("place")).agg(
        F.flatten(ordered("head", "values")).alias("values")
    )


def gelu_rows(df: DataFrame) -> DataFrame:
    """tanh GELU on every element of `values`."""
    keys = [c for c in df.columns if c != "values"]
    return df.select(*keys, gelu("values").alias("values"))


def add_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Residual: rows of equal `(seq_id, place)` added."""
    other = b.select("seq_id", "place", F.col("values").alias("_r"))
    return a.join(other, ["seq_id", "place"]).select(
        "seq_id", "place", vec_add("values", "_r").alias("values")
    )


def pack_sequences(df: DataFrame) -> DataFrame:
    """Sequence rows as one row per sequence `(seq_id, places, rows)`, in place order.

    The only shuffle of the Arrow forward pass. A packed row is bounded by the place table.
    """
    rows = F.sort_array(F.collect_list(F.struct("place", "values")))
    return df.groupBy("seq_id").agg(rows.alias("_p")).select(
        "seq_id", F.col("_p.place").alias("places"), F.col("_p.values").alias("rows")
    )


def unpack_sequences(df: DataFrame) -> DataFrame:
    """Back to `(seq_id, place, values)`."""
    return df.select("seq_id", F.inline(F.arrays_zip("places", "rows"))).toDF("seq_id", "place", "values")
