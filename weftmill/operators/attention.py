"""Causal attention by tiles of places, for sequences of any length.

A tile is a bounded run of places of one sequence. The softmax is merged from key tile to key tile (see
`kernels.MergedAttention`), so there are no score rows and no window, and no task holds more than a tile of queries
and a tile of keys of a sequence.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftmill.functions import kernels
from weftmill.lineage import cut

# Places of a tile. All sequences up to this length are one tile each.
TILE = 256
# Elements of q, k and v that a task works on, about.
TASK_CELLS = 1 << 21


def attention_tiles(qkv: DataFrame, carry: str | None, tile: int) -> DataFrame:
    """`(seq_id, place, values)` with q, k and v side by side as `(seq_id, tile, places, rows, carry)`, written
    once: queries, keys and values are all read from there."""
    carried = F.col(carry) if carry else F.lit(None).cast("array<double>")
    number = F.floor(F.col("place") / F.lit(tile)).cast("int").alias("tile")
    rows = F.sort_array(F.collect_list(F.struct("place", "values", carried.alias("carry"))))
    packed = qkv.groupBy("seq_id", number).agg(rows.alias("_r"))
    columns = [F.col(f"_r.{a}").alias(b) for a, b in (("place", "places"), ("values", "rows"), ("carry", "carry"))]
    return cut(packed.select("seq_id", "tile", *columns))


def tiled_attention(qkv: DataFrame, n_head: int, carry: str | None = None, tile: int = TILE) -> DataFrame:
    """`(seq_id, place, values[, carry])`: attention of rows `(seq_id, place, values[, carry])` whose values are
    q, k and v side by side. The column named `carry` comes along unchanged.

    Grouping into tiles is the one shuffle while every sequence is a single tile. Beyond, a query tile and each
    key tile up to it meet in the group of the query tile, key tiles in order; a long sequence is the work of as
    many tasks as it has tiles.
    """
    tiles = attention_tiles(qkv, carry, tile)
    size = tiles.agg(F.max("tile").alias("last"), F.sum(F.size(F.flatten("rows"))).alias("cells")).first()
    if (size["last"] or 0) == 0:
        # A task hands all its tiles to Python at once, up to the session's rows a batch.
        dealt = tiles.repartition(max(tiles.sparkSession.sparkContext.defaultParallelism, math.ceil((size["cells"] or 0) / TASK_CELLS)))
        attended = dealt.withColumn("rows", kernels.self_attention_column(n_head)("rows"))
    else:
        attended = _merged(tiles, n_head)
    zipped = F.arrays_zip("places", "rows", *(["carry"] if carry else []))
    return attended.select("seq_id", F.inline(zipped)).toDF("seq_id", "place", "values", *([carry] if carry else []))


def _merged(tiles: DataFrame, n_head: int) -> DataFrame:
    width = (F.size(F.get("rows", F.lit(0))) / 3).cast("int")
    part = lambda i: F.transform("rows", lambda r: F.slice(r, i * width + 1, width))
    queries = tiles.select(
        "seq_id", "tile", F.lit(-1).alias("key_tile"), "places", part(F.lit(0)).alias("a"), F.col("carry").alias("b")
    )
    last = tiles.groupBy("seq_id").agg(F.max("tile").alias("_last"))
    keys = tiles.join(last, "seq_id").select(
        "seq_id", F.explode(F.sequence("tile", "_last")).alias("_of"), F.col("tile").alias("key_tile"), "places",
        part(F.lit(1)).alias("a"), part(F.lit(2)).alias("b"),
    )
    dealt = queries.unionByName(keys.withColumnRenamed("_of", "tile"))
    ordered = dealt.repartition("seq_id", "tile").sortWithinPartitions("seq_id", "tile", "key_tile")
    schema = T.StructType(
        [
            T.StructField("seq_id", tiles.schema["seq_id"].dataType),
            T.StructField("places", T.ArrayType(T.IntegerType())),
            T.StructField("rows", kernels.SEQUENCE),
            T.StructField("carry", kernels.SEQUENCE),
        ]
    )
    return ordered.mapInArrow(kernels.merged_attention(n_head), schema)
