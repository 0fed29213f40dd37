"""Loading parameter tables as one checked job.

Tables are written to a new version of the target folder, read back and checked there, and only then does
the folder's pointer name the new version. Readers follow the pointer, so they see the old tables or the new
ones and never a mixture; a bad table leaves the old version in place.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftmill.operators.ingest import TableSpec, validate_table
from weftmill.sources.tables import read_model_table, read_table, write_model_table

POINTER = "CURRENT"


class LoadError(ValueError):
    """Tables that break their rules; `violations` are `(table_name, rule, rows)`."""

    def __init__(self, violations: list[tuple[str, str, int]]):
        self.violations = violations
        super().__init__("; ".join(f"{t}: {rule} in {n} rows" for t, rule, n in violations))


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.hadoop.fs


def _files(spark: SparkSession, path: str):
    at = _hadoop(spark).Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def current_version(spark: SparkSession, folder: str) -> str | None:
    """The folder that the pointer names, or none before the first load."""
    fs, at = _files(spark, f"{folder}/{POINTER}")
    if not fs.exists(at):
        return None
    # The pointer is written whole and renamed into place, so it is read whole.
    return f"{folder}/{spark.read.text(str(at), wholetext=True).first()[0].strip()}"


def _point_to(spark: SparkSession, folder: str, version: str) -> None:
    """One rename: atomic where the file system renames atomically."""
    fs, staged = _files(spark, f"{folder}/_{POINTER}-{uuid.uuid4().hex}")
    out = fs.create(staged, True)
    out.writeBytes(version)
    out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = _hadoop(spark).FileContext.getFileContext(fs.getUri(), conf)
    context.rename(fs.makeQualified(staged), fs.makeQualified(_hadoop(spark).Path(f"{folder}/{POINTER}")), options)


def _read(spark: SparkSession, version: str, name: str) -> DataFrame:
    """A table of a version: with the declared schema if it is a model table, else as written."""
    try:
        return read_model_table(spark, f"{version}/{name}", name)
    except KeyError:
        return read_table(spark, f"{version}/{name}")


def load_tables(tables: dict[str, DataFrame], folder: str, specs: dict[str, TableSpec]) -> str:
    """Write, check and publish `tables`; the new version's folder.

    Tables with a `block` column are partitioned by it, so that a block is read from its own files. All rules of
    `specs` are checked on what was written; if any is broken the new version is deleted, the pointer stays, and
    `LoadError` says which. Versions before stay for readers that have begun; see `remove_old_versions`.
    """
    spark = next(iter(tables.values())).sparkSession
    version = f"versions/{uuid.uuid4().hex}"
    for name, df in tables.items():
        write_model_table(df, f"{folder}/{version}/{name}")
    checks = [
        validate_table(_read(spark, f"{folder}/{version}", name), specs[name]).select(F.lit(name).alias("table_name"), "rule", "n")
        for name in tables
        if name in specs
    ]
    violations = []
    if checks:
        found = reduce(DataFrame.unionByName, checks).groupBy("table_name", "rule").agg(F.sum("n").alias("n"))
        violations = sorted(tuple(r) for r in found.collect())
    if violations:
        fs, at = _files(spark, f"{folder}/{version}")
        fs.delete(at, True)
        raise LoadError(violations)
    _point_to(spark, folder, version)
    return f"{folder}/{version}"


def loaded_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the current version."""
    version = current_version(spark, folder)
    if version is None:
        raise FileNotFoundError(f"nothing has been loaded to {folder}")
    return _read(spark, version, name)


def remove_old_versions(spark: SparkSession, folder: str) -> int:
    """Delete all versions but the current one; how many."""
    fs, at = _files(spark, f"{folder}/versions")
    current, n = current_version(spark, folder), 0
    for status in fs.listStatus(at):
        if current is None or not current.endswith(status.getPath().getName()):
            fs.delete(status.getPath(), True)
            n += 1
    return n
