"""Small vocabulary and model for tests and demos.

Real vocabularies and weights are not shipped. The vocabulary is counted from a text table and
the weights come from integer arithmetic, so any SQL engine can build the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftmill.functions.bytesym import encoder_table, symbols
from weftmill.lineage import cut
from weftmill.model import Model
from weftmill.operators.text import distinct_parts

SEED_PARTS = 300


def prefix_vocab(df: DataFrame, text_col: str, n_parts: int = SEED_PARTS) -> DataFrame:
    """`(token, cluster)`: the 256 byte symbols, then every prefix of two or more symbols of the
    `n_parts` most frequent parts, numbered from 256 by (length, cluster)."""
    spark = df.sparkSession
    top = distinct_parts(df, text_col).orderBy(F.desc("n"), "part").limit(n_parts)
    prefix = F.expr("transform(sequence(2, greatest(length(s), 2)), k -> substring(s, 1, k))")
    found = (
        top.select(symbols("part").alias("s"))
        .select(F.explode(prefix).alias("cluster"))
        .filter(F.length("cluster") > 1)
        .distinct()
    )
    # At most n_parts times the longest part: one ordered numbering over a small table.
    number = F.row_number().over(Window.orderBy(F.length("cluster"), "cluster"))
    words = found.select((number + 255).alias("token"), "cluster")
    single = encoder_table(spark).select(F.col("byte").alias("token"), F.col("character").alias("cluster"))
    return cut(single.unionByName(words).coalesce(1))


def value_sql(k: int, block: str, row: str, column: str) -> str:
    """Weight of table code `k` in [-1, 1]; same text in Spark and DuckDB but for the divisor."""
    return (
        f"(({k} * 7919 + {block} * 6101 + {row} * 104729 + {column} * 1299709"
        f" + {row} * {column} * 8191) % 2003 - 1001)"
    )


# Name: (code, rows or None for a vector, width, offset, scale, per block), widths in units of
# d (model) and f (feed-forward).
MODEL_TABLES = {
    "c_attn_w": (1, "3d", "d", 0.0, 0.1, True),
    "c_attn_b": (2, None, "3d", 0.0, 0.02, True),
    "c_proj_w": (3, "d", "d", 0.0, 0.1, True),
    "c_proj_b": (4, None, "d", 0.0, 0.02, True),
    "ln_1_g": (5, None, "d", 1.0, 0.1, True),
    "ln_1_b": (6, None, "d", 0.0, 0.02, True),
    "ln_2_g": (7, None, "d", 1.0, 0.1, True),
    "ln_2_b": (8, None, "d", 0.0, 0.02, True),
    "mlp_c_fc_w": (9, "f", "d", 0.0, 0.1, True),
    "mlp_c_fc_b": (10, None, "f", 0.0, 0.02, True),
    "mlp_c_proj_w": (11, "d", "f", 0.0, 0.1, True),
    "mlp_c_proj_b": (12, None, "d", 0.0, 0.02, True),
    "ln_f_g": (13, None, "d", 1.0, 0.1, False),
    "ln_f_b": (14, None, "d", 0.0, 0.02, False),
}
TABLE_CODE_WPE, TABLE_CODE_WTE = 15, 16


def _values(k: int, block: str, row: str, width: int, offset: float, scale: float) -> str:
    cell = f"{offset}D + {scale}D * ({value_sql(k, block, row, 'j')} / 1001.0D)"
    return f"transform(sequence(0L, {width - 1}L), j -> {cell}) AS values"


def formula_rows(spark: SparkSession, k: int, key: str, n: int, width: int, scale: float = 0.1) -> DataFrame:
    """`(key, values)`: `n` formula vectors, as for the place table."""
    return spark.range(n, numPartitions=1).selectExpr(
        f"cast(id AS int) AS {key}", _values(k, "0L", "id", width, 0.0, scale)
    )


def mini_model(
    wte: DataFrame, width: int = 64, feed_forward: int = 256, n_head: int = 4, n_block: int = 2,
    n_place: int = 64,
) -> Model:
    """A model of formula weights around a given token table `(token, values)`."""
    spark = wte.sparkSession
    size = {"d": width, "3d": 3 * width, "f": feed_forward}
    tables: dict[str, DataFrame] = {}
    for name, (k, rows, cols, offset, scale, per_block) in MODEL_TABLES.items():
        n_rows = size[rows] if rows else 1
        base = spark.range(n_rows * (n_block if per_block else 1), numPartitions=1)
        base = base.selectExpr(f"id div {n_rows} AS b", f"id % {n_rows} AS i")
        keys = ["cast(b AS int) AS block"] if per_block else []
        if rows:
            keys.append(f"cast(i AS int) AS {'y' if name == 'c_attn_w' else 'place'}")
        block = "b" if per_block else "0L"
        tables[name] = base.selectExpr(*keys, _values(k, block, "i", size[cols], offset, scale))
    tables["wte"] = wte
    tables["wpe"] = formula_rows(spark, TABLE_CODE_WPE, "place", n_place, width)
    return Model(tables, n_head, n_block)


def embedding_tokens(embeddings: DataFrame) -> DataFrame:
    """The vector table as token table `(token, values)`."""
    return embeddings.select(
        F.col("vec_id").cast("int").alias("token"), F.col("embedding").cast("array<double>").alias("values")
    )


def embedding_sequences(embeddings: DataFrame) -> DataFrame:
    """`(seq_id, place, token)`: the whole vector table as sequences of ten tokens."""
    n = embeddings.count()
    return embeddings.selectExpr(
        "vec_id div 10 AS seq_id",
        "cast(vec_id % 10 AS int) AS place",
        f"cast((vec_id * 37 + 11) % {n} AS int) AS token",
    )
