"""Forward pass: attention and feed-forward sublayers, blocks, whole model.

Two ways with equal results. `arrow` packs each sequence into one row and runs every sublayer
as an Arrow column function against broadcast parameters: one shuffle for the whole pass, whatever
the number of blocks. `relational` keeps places as rows: attention goes by tiles of places with a merged
softmax, and a weight table that can't be broadcast is multiplied block by block, so sequences and parameters
are of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftmill.functions import kernels
from weftmill.functions.vectors import vec_add
from weftmill.model import Model
from weftmill.operators.attention import TILE, tiled_attention
from weftmill.operators.layers import (
    attention_scores,
    embed,
    gelu_rows,
    layer_norm,
    linear,
    linear_shared,
    pack_sequences,
    softmax,
    split_heads,
    unpack_sequences,
)


def _relational(method: str) -> bool:
    if method not in ("arrow", "relational"):
        raise ValueError("method must be 'arrow' or 'relational'")
    return method == "relational"


def _on_packed(df: DataFrame, functions: list[kernels.RowsFn]) -> DataFrame:
    return unpack_sequences(pack_sequences(df).withColumn("rows", kernels.rows_column(functions)("rows")))


def attention_heads(df: DataFrame, model: Model, block: int) -> DataFrame:
    """Norm, qkv projection and head split of one block."""
    t = lambda name: model.table(name, block)
    normed = layer_norm(df, t("ln_1_g"), t("ln_1_b"), model.eps)
    return split_heads(linear(normed, t("c_attn_w"), t("c_attn_b")), model.n_head)


def attention_weights(heads: DataFrame) -> DataFrame:
    """`(seq_id, head, x, y, value)`: causal attention weights."""
    return softmax(attention_scores(heads), ["seq_id", "head", "x"])


def model_width(model: Model) -> int:
    return model.table("wpe").select(F.size("values").alias("n")).first()["n"]


def project(df: DataFrame, model: Model, name: str, block: int) -> DataFrame:
    """`values` through one linear layer of a block: against broadcast weights, read once per model, or block
    by block when the table is beyond the bound."""
    weights, bias = model.shared_table(f"{name}_w"), model.shared_table(f"{name}_b")
    if weights is None or bias is None:
        return linear(df, model.table(f"{name}_w", block), model.table(f"{name}_b", block), "shuffle")
    return linear_shared(df, lambda: weights.of(f"{name}_w", block), lambda: bias.of(f"{name}_b", block))


def multi_head_attention(
    df: DataFrame, model: Model, block: int, residual: bool = True, method: str = "arrow", tile: int = TILE
) -> DataFrame:
    """Attention sublayer; without `residual` the input is not added back.

    The relational way evaluates q, k and v once, carries the input along as a column, and shuffles once to
    put tiles together (once more for sequences of several tiles).
    """
    if not _relational(method):
        return _on_packed(df, [kernels.attention_rows(model.shared(), block, model.n_head, model.eps, residual)])
    held = df.select("seq_id", "place", "values", *([F.col("values").alias("_input")] if residual else []))
    normed = layer_norm(held, model.table("ln_1_g", block), model.table("ln_1_b", block), model.eps)
    qkv = project(normed, model, "c_attn", block)
    mixed = tiled_attention(qkv, model.n_head, "_input" if residual else None, tile)
    out = project(mixed, model, "c_proj", block)
    return out.select("seq_id", "place", vec_add("values", "_input").alias("values")) if residual else out


def feed_forward(df: DataFrame, model: Model, block: int, method: str = "arrow") -> DataFrame:
    """Feed-forward sublayer with residual. Both ways are map side while the weights can be broadcast:
    the relational one carries the input along as a column."""
    if not _relational(method):
        column = kernels.rows_column([kernels.feed_forward_rows(model.shared(), block, model.eps)], kernels.VECTOR)
        return df.withColumn("values", column("values"))
    held = df.withColumn("_input", F.col("values"))
    normed = layer_norm(held, model.table("ln_2_g", block), model.table("ln_2_b", block), model.eps)
    down = project(gelu_rows(project(normed, model, "mlp_c_fc", block)), model, "mlp_c_proj", block)
    return down.select(*[c for c in df.columns if c != "values"], vec_add("values", "_input").alias("values"))


def block_functions(model: Model, blocks: range | None = None) -> list[kernels.RowsFn]:
    """The sublayers of some blocks (of all by default) as matrix functions of packed sequences."""
    p, out = model.shared(), []
    for block in range(model.n_block) if blocks is None else blocks:
        out.append(kernels.attention_rows(p, block, model.n_head, model.eps, True))
        out.append(kernels.feed_forward_rows(p, block, model.eps))
    return out


def _encoding_functions(model: Model) -> list[kernels.RowsFn]:
    """All blocks and the final norm."""
    return [*block_functions(model), kernels.norm_rows(model.shared(), "ln_f_g", "ln_f_b", 0, model.eps)]


def transformer_block(df: DataFrame, model: Model, block: int, method: str = "arrow") -> DataFrame:
    """Attention and feed-forward sublayers of one block."""
    if not _relational(method):
        return _on_packed(df, block_functions(model, range(block, block + 1)))
    attended = multi_head_attention(df, model, block, method=method)
    return feed_forward(attended, model, block, method=method)


def transform(df: DataFrame, model: Model, method: str = "arrow") -> DataFrame:
    """All blocks, in order; only the last state is kept."""
    if not _relational(method):
        return _on_packed(df, block_functions(model))
    for block in range(model.n_block):
        # Each block is read once by the next, up to the tiles that its attention writes.
        df = transformer_block(df, model, block, method)
    return df


def final_norm(df: DataFrame, model: Model) -> DataFrame:
    return layer_norm(df, model.table("ln_f_g"), model.table("ln_f_b"), model.eps)


def encode_sequences(tokens: DataFrame, model: Model, method: str = "auto") -> DataFrame:
    """`(seq_id, place, token)` through embedding, all blocks and the final norm.

    `auto`: `arrow` while all parameters can be broadcast together, else `relational`.

    The Arrow way brings the token ids of a sequence together and embeds them afterwards: the one
    shuffle moves a few bytes per token and never a vector. Places past the place table, which
    embedding drops, are left out before, so that no sequence is longer than that table.
    """
    if method == "auto":
        method = "arrow" if model.fits() else "relational"
    if _relational(method):
        rows = embed(tokens, model.table("wte"), model.table("wpe"))
        return final_norm(transform(rows, model, method), model)
    if not model.shares_tokens():
        # The token table stays a table: vectors are joined and shuffled, the blocks are the same.
        rows = embed(tokens, model.table("wte"), model.table("wpe"))
        return _on_packed(rows, _encoding_functions(model))
    ids = F.sort_array(F.collect_list(F.struct("place", "token")))
    places = model.shared().of("wpe_id")
    known = tokens.filter(F.col("place").between(int(places[0]), int(places[-1])) if len(places) else F.lit(False))
    packed = known.groupBy("seq_id").agg(ids.alias("_p")).select(
        "seq_id", F.col("_p.place").alias("p"), F.col("_p.token").alias("t")
    )
    return unpack_sequences(
        packed.select(
            "seq_id",
            kernels.kept_places_column(model.shared())("t", "p").alias("places"),
            encoded_rows(model, F.col("t"), F.col("p")).alias("rows"),
        )
    )


def encoded_rows(model: Model, tokens: Column, places: Column) -> Column:
    """Token and place arrays to the final hidden vectors of each kept place. No shuffle."""
    return kernels.embedded_column(model.shared(), _encoding_functions(model))(tokens, places)
