"""Model parameters as tables, with size-checked access."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftmill.functions.vectors import NORM_EPSILON
from weftmill.lineage import fits
from weftmill.sources.loading import current_version, load_tables
from weftmill.sources.tables import MODEL_SCHEMAS, model_specs, read_model_table, write_model_table

# A model is broadcast to the workers when its tables have at most this many bytes together, a single
# table when it has at most this many.
MAX_MODEL_BYTES = 2 * 1024**3
MAX_TABLE_BYTES = 512 * 1024**2
# The token table grows with the vocabulary and every worker would hold it more than once: beyond this many bytes it
# stays a table, joined and scored as such.
MAX_TOKEN_BYTES = 32 * 1024**2


class SharedParameters:
    """Broadcast parameter arrays, `of(name, block)` in driver and workers alike.

    One broadcast per table, so a worker loads what its functions use.
    """

    def __init__(self, spark: SparkSession, arrays: dict[str, dict[int, np.ndarray]]):
        self._parts = {name: spark.sparkContext.broadcast(a) for name, a in arrays.items()}

    def of(self, name: str, block: int = 0) -> np.ndarray:
        return self._parts[name].value[block]


@dataclass
class Model:
    """`tables` maps the names of `MODEL_SCHEMAS` to DataFrames."""

    tables: dict[str, DataFrame]
    n_head: int
    n_block: int
    eps: float = NORM_EPSILON
    _shared: SharedParameters | None = field(default=None, repr=False)
    _tokens_fit: bool | None = field(default=None, repr=False)
    _single: dict[str, SharedParameters | None] = field(default_factory=dict, repr=False)

    @classmethod
    def read(cls, spark: SparkSession, folder: str, n_head: int, n_block: int) -> Model:
        """Tables that `write` or `load` has left in `folder`; of loaded ones the current version."""
        folder = current_version(spark, folder) or folder
        tables = {n: read_model_table(spark, f"{folder}/{n}", n) for n in MODEL_SCHEMAS}
        return cls(tables, n_head, n_block)

    def write(self, folder: str) -> None:
        for name, df in self.tables.items():
            write_model_table(df, f"{folder}/{name}")

    def load(self, folder: str) -> str:
        """Write all tables as a new checked version of `folder` (see `loading.load_tables`); its path."""
        sizes = {n: (self.tables[n].select(F.size("values").alias("n")).first() or [0])[0] for n in ("wpe", "mlp_c_proj_w")}
        return load_tables(self.tables, folder, model_specs(sizes["wpe"], sizes["mlp_c_proj_w"]))

    def table(self, name: str, block: int | None = None) -> DataFrame:
        df = self.tables[name]
        return df if block is None else df.filter(F.col("block") == block)

    def shared_table(self, name: str) -> SharedParameters | None:
        """One table as broadcast arrays, read once per model; None when it is beyond the bound of a table."""
        if self._shared is not None:
            return self._shared
        if name not in self._single:
            df = self.tables[name]
            shared = SharedParameters(df.sparkSession, {name: collect_matrix(df)[0]}) if table_fits(df) else None
            self._single[name] = shared
        return self._single[name]

    def fits(self) -> bool:
        """Whether all parameters but the token table can be broadcast together."""
        if self._shared is None:
            found = self._sizes()
            return sum(found.values()) <= MAX_MODEL_BYTES and max(found.values(), default=0) <= MAX_TABLE_BYTES
        return True

    def shares_tokens(self) -> bool:
        """Whether the token table can be broadcast as well."""
        if self._tokens_fit is None:
            self._tokens_fit = fits(self.tables["wte"], F.size("values") * 8, max_bytes=MAX_TOKEN_BYTES)
        return self._tokens_fit

    def _sizes(self) -> dict[str, int]:
        stacked = reduce(DataFrame.unionByName, (_keyed(n, df) for n, df in self.tables.items() if n != "wte"))
        sizes = stacked.groupBy("name").agg(F.sum(F.size("values") * 8).alias("bytes"))
        return {name: size or 0 for name, size in sizes.collect()}

    def shared(self) -> SharedParameters:
        """All parameters as broadcast arrays, the token table only within its own bound; an error when the others
        are beyond the bound together (the relational operators take any size)."""
        if self._shared is None:
            found = self._sizes()
            if sum(found.values()) > MAX_MODEL_BYTES or max(found.values(), default=0) > MAX_TABLE_BYTES:
                raise ValueError(f"{found} bytes of parameters are too many to broadcast; use method='relational'")
            arrays: dict[str, dict[int, np.ndarray]] = {}
            # Table by table, so that no more than one table passes to the driver at a time.
            for name, df in self.tables.items():
                if name == "wte" and not self.shares_tokens():
                    continue
                part = _keyed(name, df).toArrow().combine_chunks()
                arrays[name], ids = _matrices(part, _row_key(df) is not None)
                if name in ("wte", "wpe"):
                    arrays[f"{name}_id"] = {0: ids}
            self._shared = SharedParameters(df.sparkSession, arrays)
        return self._shared


def table_fits(df: DataFrame) -> bool:
    return fits(df, F.size("values") * 8, max_bytes=MAX_TABLE_BYTES)


def _row_key(df: DataFrame) -> str | None:
    return next((c for c in df.columns if c not in ("block", "values")), None)


def _keyed(name: str, df: DataFrame) -> DataFrame:
    block = F.col("block") if "block" in df.columns else F.lit(0)
    row = F.col(_row_key(df)) if _row_key(df) else F.lit(0)
    return df.select(
        F.lit(name).alias("name"),
        block.cast("int").alias("b"),
        row.cast("long").alias("r"),
        F.col("values").cast("array<double>").alias("values"),
    )


def _matrices(rows: pa.Table, is_matrix: bool) -> tuple[dict[int, np.ndarray], np.ndarray]:
    if not rows.num_rows:
        return {}, np.zeros(0, np.int64)
    blocks, ids = rows["b"].to_numpy(), rows["r"].to_numpy()
    cells = rows["values"].combine_chunks()
    matrix = cells.flatten().to_numpy(zero_copy_only=False).reshape(len(cells), -1)
    out, order = {}, ids
    for b in np.unique(blocks):
        at = np.flatnonzero(blocks == b)
        at = at[np.argsort(ids[at], kind="stable")]
        order = ids[at]
        if not is_matrix and len(at) > 1:
            raise ValueError(f"one parameter row expected for block {b}, found {len(at)}")
        out[int(b)] = matrix[at] if is_matrix else matrix[at[0]]
    return out, order


def collect_matrix(df: DataFrame) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """A bounded parameter table as `{block: matrix}` and the row ids of the last block.

    A table without row key gives one-dimensional arrays. Check `table_fits` first.
    """
    return _matrices(_keyed("", df).toArrow(), _row_key(df) is not None)
