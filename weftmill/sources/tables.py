"""Declared schemas, readers and writers of the model and vocabulary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftmill.operators.ingest import TableSpec, explode_dictionary

_VECTOR = T.ArrayType(T.DoubleType())


def _schema(*keys: str) -> T.StructType:
    fields = [T.StructField(k, T.IntegerType(), False) for k in keys]
    return T.StructType([*fields, T.StructField("values", _VECTOR)])


# Tables of one row per matrix row, of one row per block, and of one row in all.
MODEL_SCHEMAS: dict[str, T.StructType] = {
    "c_attn_w": _schema("block", "y"),
    "c_attn_b": _schema("block"),
    "ln_1_b": _schema("block"),
    "ln_1_g": _schema("block"),
    "c_proj_w": _schema("block", "place"),
    "c_proj_b": _schema("block"),
    "ln_2_b": _schema("block"),
    "ln_2_g": _schema("block"),
    "mlp_c_fc_w": _schema("block", "place"),
    "mlp_c_fc_b": _schema("block"),
    "mlp_c_proj_w": _schema("block", "place"),
    "mlp_c_proj_b": _schema("block"),
    "ln_f_b": _schema(),
    "ln_f_g": _schema(),
    "wte": _schema("token"),
    "wpe": _schema("place"),
}
VOCAB_SCHEMA = T.StructType(
    [T.StructField("token", T.IntegerType(), False), T.StructField("cluster", T.StringType(), False)]
)
ENCODER_SCHEMA = T.StructType(
    [T.StructField("character", T.StringType(), False), T.StructField("byte", T.IntegerType(), False)]
)

# Splits hold at most spark.sql.files.maxPartitionBytes (128 MB), so this is a few gigabytes.
SMALL_SPLITS = 32


def model_specs(width: int, feed_forward: int) -> dict[str, TableSpec]:
    """What `validate_table` has to hold for every model table of the given widths."""
    widths = {"c_attn_b": 3 * width, "mlp_c_fc_b": feed_forward, "mlp_c_proj_w": feed_forward}
    return {
        name: TableSpec(
            key=tuple(f.name for f in schema if f.name != "values"),
            not_null=tuple(f.name for f in schema),
            widths={"values": widths.get(name, width)},
        )
        for name, schema in MODEL_SCHEMAS.items()
    }


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan with a declared schema where one is known.

    A small table (at most `SMALL_SPLITS` splits, fewer than there are cores) is dealt out over all
    cores first, since tokenising and matrix work cost much more than moving it. Any larger table
    is scanned where it lies, without a shuffle.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < min(cores, SMALL_SPLITS):
        df = df.repartition(cores)
    return df


def write_model_table(df: DataFrame, path: str) -> None:
    """Write a model table; per-block tables are partitioned by block so that a block filter
    prunes files."""
    writer = df.write
    if "block" in df.columns:
        writer = df.repartition("block").write.partitionBy("block")
    writer.parquet(path)


def read_model_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    schema = MODEL_SCHEMAS[name]
    return spark.read.schema(schema).parquet(path).select([f.name for f in schema])


def read_json_dictionary(
    spark: SparkSession, path: str, value: str, key: str, value_type: str = "int"
) -> DataFrame:
    """JSON object files as `(value, key)` rows, e.g. `(token, cluster)`; one object per file."""
    files = spark.read.text(path, wholetext=True).withColumnRenamed("value", "_json")
    rows = explode_dictionary(files, "_json", [])
    return rows.select(F.col("value").cast(value_type).alias(value), F.col("key").alias(key))
