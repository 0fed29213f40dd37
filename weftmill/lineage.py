"""Lineage cuts and size-checked broadcasts.

Loops (generated tokens, blocks in the relational path) and tables that are read more than
once are written to the shared folder named by `spark.checkpoint.dir`, so a lost executor
costs one re-read, never the whole loop.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 * 1024 * 1024

_local_root: str | None = None
_written: list[str] = []


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    `spark.checkpoint.dir` always wins. Only a `local[...]` session without it gets a
    temporary folder; on a cluster a missing setting is an error, since a folder on one
    machine cannot be read by the others.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="weftmill-")
    return _local_root


def cut(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write `df` once and continue from the written table. `compression`: Parquet's, else the session's."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/weftmill-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.parquet(path, compression=compression)
    table = spark.read.schema(df.schema).parquet(path)
    table._weftmill_path = path
    return table


def remove_cut(df: DataFrame) -> None:
    """Delete the one table that `cut` gave as `df`, when nothing reads it any more."""
    spark = df.sparkSession
    path = df._weftmill_path
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    if path in _written:
        _written.remove(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run inside are deleted when their query ends, not when the driver
    happens to collect its garbage. For queries whose result is written and whose plan isn't run again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def remove_cuts(spark: SparkSession) -> int:
    """Delete every table that `cut` wrote in this process; the number of tables.

    Call it when all results have been written: a DataFrame that was built on a cut can't be read
    afterwards.
    """
    n = len(_written)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    while _written:
        path = hadoop.Path(_written.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n


def fits(
    df: DataFrame,
    payload: Column | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> bool:
    """True when `df` has at most `max_rows` rows and `sum(payload)` is at most `max_bytes`.

    One aggregate over the (column-pruned) table; nothing but two numbers reaches the driver.
    """
    size = payload if payload is not None else F.lit(0)
    row = df.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("bytes")
    ).first()
    return row["n"] <= max_rows and row["bytes"] <= max_bytes


def salted_join(
    facts: DataFrame, table: DataFrame, key: str, spread_by: list[str], salts: int = 32
) -> DataFrame:
    """Inner equi-join on `key` for a `table` too big to broadcast.

    `table` is unique on `key`, but one key may hold a third of `facts`: fact rows of a key are
    spread over `salts` reducers by a hash of `spread_by`, and each table row is repeated once
    per salt.
    """
    left = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    right = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "_salt"]).drop("_salt")


def lookup(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    spread_by: list[str],
    payload: Column | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    salts: int = 32,
) -> DataFrame:
    """Inner equi-join of facts to a lookup table: broadcast within the bound, salted beyond it."""
    if fits(table, payload, max_rows, max_bytes):
        return facts.join(F.broadcast(table), key)
    return salted_join(facts, table, key, spread_by, salts)


def ordered(key: str | list[str], value: str, get: Callable[[Column], Column] | None = None) -> Column:
    """Aggregate: values of a group as an array in `key` order."""
    keys = [key] if isinstance(key, str) else key
    rows = F.sort_array(F.collect_list(F.struct(*keys, F.col(value).alias("_value"))))
    return F.transform(rows, lambda r: r["_value"] if get is None else get(r["_value"]))
