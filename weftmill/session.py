"""Session settings the engine relies on."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Runtime SQL settings, applied only where the session still has Spark's own default.
# Text parts and vectors are small at rest and grow many times over inside a task
# (substrings, matrix products), so coalescing shuffle output down to 1 MB pieces would
# leave most cores idle.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": ("1048576b", "131072b"),
}

_shipped_to: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply `RUNTIME_SETTINGS` to an existing session and return it."""
    for key, (default, wanted) in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, wanted)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per Spark application), so that Arrow
    functions can import it wherever the driver was started."""
    global _shipped_to
    application = spark.sparkContext.applicationId
    if _shipped_to == application:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="weftmill-"), "weftmill.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _dirs, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped_to = application


def build_session(app_name: str = "weftmill", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session; `conf` keys use `__` for the dot."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())
