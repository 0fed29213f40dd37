"""Matrix products of row vectors with weight tables of any size."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftmill.functions import kernels
from weftmill.lineage import cut

# Rows of a row block, and weight rows and columns of a weight block (8 MB of doubles at most).
BLOCK_ROWS = 512
BLOCK_OUT = 512
BLOCK_IN = 1024
# Copies of each weight block, over which row blocks are dealt out: many row blocks meet the same one.
SALTS = 16


def block_product(
    df: DataFrame, weights: DataFrame, row_key: str, rows: int = BLOCK_ROWS, out: int = BLOCK_OUT, inner: int = BLOCK_IN,
) -> DataFrame:
    """`values` of each row times the rows of `weights` (in `row_key` order); all other columns stay.

    Rows go to blocks of about `rows` by hash of their other columns, and weights to a grid of `out` weight rows
    by `inner` elements. Every pair of a row block and a weight block that share elements is one join row and one
    matrix product. Partial products of a row block are summed and put side by side in its own group, so
    nothing but the blocks is ever in memory, whatever the size of either side. A null vector stays null; a vector
    of another width than the weight rows fails the job.
    """
    keys = [c for c in df.columns if c != "values"]
    shape = weights.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("values")).alias("width")).first()
    n_out, width = shape["n"], shape["width"] or 0
    n_tiles = max(1, math.ceil(df.count() / rows))
    wrong = F.raise_error(F.concat(F.lit(f"expected {width} elements, found "), F.size("values").cast("string")))
    none = F.col("values").isNull()
    # Zeros stand in for a null vector, so that every row has its place in its block.
    zeros = F.lit([0.0] * width).cast("array<double>")
    held = F.when(none, zeros).when(F.size("values") == width, F.col("values").cast("array<double>")).otherwise(wrong)
    tile = F.pmod(F.xxhash64(*keys), F.lit(n_tiles)).cast("int") if keys else F.lit(0)
    row = F.struct(F.struct(none.alias("_none"), *keys).alias("id"), held.alias("vector"))
    grouped = df.groupBy(tile.alias("tile")).agg(F.collect_list(row).alias("_r"))
    tiles = cut(grouped.select("tile", F.col("_r.id").alias("ids"), F.col("_r.vector").alias("vectors")))
    steps = F.explode(F.sequence(F.lit(0), F.lit(max(0, math.ceil(width / inner) - 1))))
    part = lambda v, i: F.slice(v, i * inner + 1, F.lit(inner))
    left = (
        tiles.select("tile", "vectors", steps.alias("i"))
        .select("tile", "i", F.transform("vectors", lambda v: part(v, F.col("i"))).alias("x"))
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(max(0, math.ceil(n_out / out) - 1)))))
        .withColumn("salt", F.pmod(F.col("tile"), F.lit(SALTS)))
    )
    # Only the keys are numbered in one order, one integer per element of the result's width.
    number = weights.select(row_key, (F.row_number().over(Window.orderBy(row_key)) - 1).alias("_y"))
    numbered = weights.select(row_key, "values").join(number, row_key).select("_y", "values").withColumn("i", steps)
    cells = F.sort_array(F.collect_list(F.struct("_y", part(F.col("values"), F.col("i")).alias("cells"))))
    right = (
        numbered.groupBy(F.floor(F.col("_y") / out).cast("int").alias("o"), "i")
        .agg(cells["cells"].alias("w"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    pairs = left.join(right, ["i", "o", "salt"]).select("tile", "o", "i", kernels.multiply_blocks("x", "w").alias("m"))
    summed = pairs.groupBy("tile").agg(F.sort_array(F.collect_list(F.struct("o", "i", "m"))).alias("parts"))
    products = summed.select("tile", kernels.sum_blocks(F.col("parts.o"), F.col("parts.m")).alias("rows"))
    joined = tiles.select("tile", "ids").join(products, "tile", "left")
    each = joined.select(F.posexplode("ids").alias("_at", "_k"), "rows")
    found = F.when(~F.col("_k._none"), F.get("rows", F.col("_at")))
    return each.select(*[F.col(f"_k.{c}").alias(c) for c in keys], found.alias("values"))
