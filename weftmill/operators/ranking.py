"""Scoring against an item table, temperatures, intervals and draws."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftmill.functions import kernels
from weftmill.functions.vectors import EXP_UNDERFLOW, safe_exp
from weftmill.lineage import cut, fits
from weftmill.model import collect_matrix

# Item tables up to this size are broadcast whole (each worker holds one several times); larger ones are scored
# tile by tile.
MAX_ITEM_BYTES = 32 * 1024 * 1024
TILE_ROWS = 8192
TILE_BYTES = 16 * 1024 * 1024


def last_place(df: DataFrame, lengths: DataFrame | None = None) -> DataFrame:
    """`(seq_id, values)` of the last place.

    With `lengths` (`seq_id, n_seq`) that is place `n_seq - 1`, and a sequence whose last place is
    missing gives no row; without, the highest place present, by a partial aggregation.
    """
    if lengths is None:
        return df.groupBy("seq_id").agg(F.max_by("values", "place").alias("values"))
    last = lengths.select("seq_id", (F.col("n_seq") - 1).cast("int").alias("place"))
    return df.join(last, ["seq_id", "place"]).select("seq_id", "values")


def top_n_by_inner_product(
    queries: DataFrame, items: DataFrame, n: int, max_item_bytes: int = MAX_ITEM_BYTES,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """`(seq_id, token, value)`: per query the `n` items of highest inner product (exact).

    `queries` is `(seq_id, values)`, `items` is `(token, values)`; ties go to the lower token.
    Within the bound the items are broadcast and each query batch is one matrix product: no
    shuffle, and only `n` rows per query leave the task. Beyond it all items stream past groups of
    queries, a tile at a time, and the `n` best so far are kept.
    """
    if not fits(items, F.size("values") * 8, max_bytes=max_item_bytes):
        return _top_by_tiles(queries, items, n, tile_rows)
    matrix, tokens = collect_matrix(items.select("token", "values"))
    vectors = matrix[0].astype(float) if matrix else np.zeros((0, 0))
    shared = queries.sparkSession.sparkContext.broadcast((tokens, vectors))
    top = kernels.top_column(lambda: shared.value, n)
    vectors = queries.select("seq_id", F.col("values").cast("array<double>").alias("values"))
    return vectors.select("seq_id", F.inline(top("values")))


def _top_by_tiles(queries: DataFrame, items: DataFrame, n: int, tile_rows: int) -> DataFrame:
    """Queries are dealt to groups of at most `TILE_BYTES` on average, one task each and at least one a core.
    All items stream past every group, `tile_rows` at a time, and a group keeps the `n` best of each of its
    queries so far: no task holds more than its queries and one tile of scores, and what is shuffled is the items
    once a group."""
    queries = cut(queries.select("seq_id", F.col("values").cast("array<double>").alias("values")))
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("values")).alias("width")).first()
    cores = queries.sparkSession.sparkContext.defaultParallelism
    per_group = max(1, TILE_BYTES // (8 * max(1, size["width"] or 1)))
    fewest = min(cores, math.ceil(size["n"] / tile_rows))
    groups = max(1, fewest, math.ceil(size["n"] / per_group))
    # Full rounds of tasks.
    groups = math.ceil(groups / cores) * cores if groups > cores else groups
    left = queries.select(
        F.pmod(F.xxhash64("seq_id"), F.lit(groups)).cast("int").alias("group"), F.lit(False).alias("is_item"),
        "seq_id", F.lit(None).cast("long").alias("token"), "values",
    )
    right = items.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(True).alias("is_item"),
        F.lit(None).cast(queries.schema["seq_id"].dataType).alias("seq_id"), F.col("token").cast("long").alias("token"),
        F.col("values").cast("array<double>").alias("values"),
    )
    met = left.unionByName(right).repartitionById(groups, F.col("group")).sortWithinPartitions("group", "is_item")
    schema = T.StructType([queries.schema["seq_id"], *kernels.SCORED])
    found = met.mapInArrow(kernels.streamed_top(n, tile_rows), schema)
    w = Window.partitionBy("seq_id").orderBy(F.desc("value"), F.asc("token"))
    return (
        found.withColumn("_rank", F.row_number().over(w))
        .filter(F.col("_rank") <= n)
        .select("seq_id", "token", "value")
    )


def temperature_softmax(top: DataFrame, temperatures: list[float]) -> DataFrame:
    """`(seq_id, token, value, temperature, softmax)`: probabilities among the given candidates
    for every temperature."""
    levels = F.explode(F.array(*[F.lit(float(t)) for t in temperatures]))
    rows = top.withColumn("temperature", levels)
    w = Window.partitionBy("seq_id", "temperature")
    # (value - max) / T is at most 0, so its own maximum is 0 and softmax needs no second shift.
    e = rows.withColumn("_diff", (F.col("value") - F.max("value").over(w)) / F.col("temperature"))
    e = e.withColumn("_e", safe_exp(F.col("_diff")))
    return e.select(
        "seq_id", "token", "value", "temperature", (F.col("_e") / F.sum("_e").over(w)).alias("softmax")
    )


def cumulative_intervals(df: DataFrame, mode: str = "rows") -> DataFrame:
    """`(seq_id, token, softmax, low, high)`: candidates as adjoining intervals in [0, 1).

    `rows`: ordered by `(softmax, token)`, every candidate has its own interval.
    `reference`: ordered by softmax alone with the default RANGE frame, so candidates of equal
    softmax share `high` and their intervals coincide.
    """
    w = Window.partitionBy("seq_id").orderBy("softmax")
    if mode == "rows":
        w = Window.partitionBy("seq_id").orderBy("softmax", "token").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
    elif mode != "reference":
        raise ValueError("mode must be 'rows' or 'reference'")
    high = F.sum("softmax").over(w)
    return df.withColumn("high", high).select(
        "seq_id", "token", "softmax", (F.col("high") - F.col("softmax")).alias("low"), "high"
    )


def uniform(seed: int, *keys: str | Column) -> Column:
    """Reproducible number in [0, 1) from a hash of the seed and the keys, independent of
    partitioning."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11)
    return bits.cast("double") * F.lit(2.0**-53)


def weighted_sample(intervals: DataFrame, u: Column, mode: str = "rows") -> DataFrame:
    """`(seq_id, token)`: the candidate whose `[low, high)` contains `u`.

    `u` may use `seq_id`. In mode `rows` each sequence gets exactly one token: the last candidate
    also takes a `u` that lies above the rounded total. Mode `reference` is the bare range
    predicate: coinciding intervals give several tokens and gaps none.
    """
    drawn = intervals.withColumn("_u", u)
    if mode == "reference":
        return drawn.filter("_u >= low AND _u < high").select("seq_id", "token")
    # Rounding can leave a hair between one high and the next low, so the draw goes by `high`
    # alone: the first candidate whose `high` is above u, else the last one.
    rows = F.struct((F.col("_u") >= F.col("high")).alias("past"), "high", "softmax", "token")
    top = F.struct("softmax", "token")
    picked = drawn.groupBy("seq_id").agg(F.min(rows).alias("first"), F.max(top).alias("last"))
    return picked.select(
        "seq_id",
        F.when(F.col("first.past"), F.col("last.token")).otherwise(F.col("first.token")).alias("token"),
    )


def draw_token(candidates: str, top_n: str, temperature: str, u: str) -> Column:
    """The token that `u` draws from a row's candidate array `array<struct<token, value>>`, best first: softmax
    of the first `top_n` at the row's temperature, adjoining intervals in `(softmax, token)` order, and the
    first one whose end lies above `u`, else the last. As `temperature_softmax`, `cumulative_intervals` and
    `weighted_sample` one after the other, inside the row: no window and no shuffle. Null without candidates.

    The arguments are column names; one SQL expression, since nested lambdas are slow to build one by one.
    """
    once = lambda value, name, body: f"get(transform(array({value}), {name} -> {body}), 0)"
    kept = f"slice({candidates}, 1, greatest({top_n}, 0))"
    diff = f"(c.value - h) / {temperature}"
    power = f"if({diff} < {EXP_UNDERFLOW}D, 0D, exp({diff}))"
    powers = once(
        f"array_max(transform({kept}, c -> c.value))", "h",
        f"transform({kept}, c -> struct({power} AS e, cast(c.token AS bigint) AS token))",
    )
    chances = once("aggregate(p, 0D, (a, r) -> a + r.e)", "t", "array_sort(transform(p, r -> struct(r.e / t AS softmax, r.token AS token)))")
    # Until an interval ends above u the token so far is the last one.
    picked = f"""aggregate(
      {chances}, named_struct('high', 0D, 'token', cast(NULL AS bigint), 'done', false),
      (a, r) -> named_struct('high', a.high + r.softmax, 'token', if(a.done, a.token, r.token),
                             'done', a.done OR {u} < a.high + r.softmax),
      a -> a.token)"""
    return F.expr(once(powers, "p", picked))
