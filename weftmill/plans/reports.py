"""Formatted reports over single stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftmill.lineage import cut, fits, ordered
from weftmill.model import Model
from weftmill.operators.layers import attention_output
from weftmill.plans.forward import attention_heads, attention_weights, model_width


def _preview(values: str, n: int = 3) -> Column:
    text = F.transform(F.slice(values, 1, n), lambda x: F.format_string("%+.3f", x))
    return F.concat(F.array_join(text, " "), F.lit(" …"))


def attention_matrix_report(df: DataFrame, model: Model, block: int = 0, head: int = 0) -> DataFrame:
    """One head of one block as text, per place: first values of q, k, v and of the head's output,
    and the row of attention weights (`matrix`, one cell per key place up to the last place)."""
    heads = cut(attention_heads(df, model, block).filter(F.col("head") == head))
    weights = cut(attention_weights(heads))
    output = attention_output(weights, heads, model_width(model) // model.n_head)
    cell = F.when(F.col("value") > 0, F.format_string(" %.2f", "value")).otherwise(F.lit("    0"))
    places = heads.select("seq_id", F.col("place").alias("y"))
    # Masked cells are not in the pruned weights: fill them from the places of the sequence.
    grid = heads.select("seq_id", F.col("place").alias("x")).join(places, "seq_id")
    matrix = (
        grid.join(weights.drop("head"), ["seq_id", "x", "y"], "left")
        .select("seq_id", F.col("x").alias("place"), "y", cell.alias("cell"))
        .groupBy("seq_id", "place")
        .agg(F.array_join(ordered("y", "cell"), " ").alias("matrix"))
    )
    keys = ["seq_id", "place"]
    return (
        heads.select(*keys, *[_preview(c).alias(c) for c in "qkv"])
        .join(matrix, keys)
        .join(output.select(*keys, _preview("values").alias("attention")), keys)
        .select(*keys, "q", "k", "v", "matrix", "attention")
    )


def temperature_comparison(rows: DataFrame, vocab: DataFrame, temperatures: list[float]) -> DataFrame:
    """Candidates side by side over temperatures: `(seq_id, token, cluster, score,
    temperature_<t>...)`, numbers as text. `rows` comes from `temperature_softmax`; candidates
    without vocabulary row drop."""
    wide = (
        rows.groupBy("seq_id", "token", "value")
        .pivot("temperature", [float(t) for t in temperatures])
        .agg(F.max("softmax"))
    )
    words = vocab.select("token", "cluster")
    hint = F.broadcast(words) if fits(words, F.octet_length("cluster")) else words
    return wide.join(hint, "token").select(
        "seq_id",
        "token",
        "cluster",
        F.format_string("%+07.3f", "value").alias("score"),
        *[
            F.format_string(" %.2f", F.col(f"`{float(t)}`")).alias(f"temperature_{t}".replace(".", "_"))
            for t in temperatures
        ],
    )
