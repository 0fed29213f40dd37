"""Bucketed tables: rows of one key lie together, so that grouping and joining by it need no shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from weftmill.lineage import checkpoint_root


class BucketedTable:
    """A table in the shared folder, bucketed by `key` and sorted by `(key, sort)` within each written part.

    Appending writes new files only. Reading it grouped or joined by `key` needs no exchange on its side. The
    catalog entry lives as long as the session; `drop` removes it and the files.
    """

    def __init__(self, spark: SparkSession, key: str, sort: str, n_buckets: int):
        self.spark, self.key, self.sort, self.n_buckets = spark, key, sort, max(1, n_buckets)
        self.name = f"weftmill_{uuid.uuid4().hex}"
        self.path = f"{checkpoint_root(spark)}/{self.name}"
        self.written = False

    def append(self, df: DataFrame) -> None:
        """Add rows: one task and one file per bucket."""
        dealt = df.repartition(self.n_buckets, self.key)
        writer = dealt.write.format("parquet").bucketBy(self.n_buckets, self.key).sortBy(self.key, self.sort)
        writer.option("path", self.path).mode("append").saveAsTable(self.name)
        self.written = True

    @property
    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        if self.written:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
            at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
            self.written = False
