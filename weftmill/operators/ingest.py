"""Loading jobs: JSON dictionaries, transposition of weight tables, table checks."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftmill.lineage import ordered


def explode_dictionary(df: DataFrame, json_col: str, id_cols: list[str]) -> DataFrame:
    """Each JSON object as `(ids, value, key)` rows, value before key. A null gives no row; text that
    is no JSON object fails the job (see `malformed_dictionaries`)."""
    parsed = F.from_json(F.col(json_col), "map<string,string>", {"mode": "FAILFAST"})
    return df.select(*id_cols, F.explode(parsed).alias("key", "value")).select(*id_cols, "value", "key")


def malformed_dictionaries(df: DataFrame, json_col: str, id_cols: list[str]) -> DataFrame:
    """The ids of rows whose text is no JSON object, which `explode_dictionary` would fail on."""
    parsed = F.from_json(F.col(json_col), "map<string,string>", {"mode": "PERMISSIVE"})
    return df.filter(F.col(json_col).isNotNull() & parsed.isNull()).select(*id_cols)


def transpose_row_vectors(
    df: DataFrame, row_key: str, values: str, block_cols: list[str] | None = None
) -> DataFrame:
    """Transpose the matrix of each block: `(block, place, values)`, one row per former column,
    elements ordered by `row_key`.

    An output vector has one element per row of its block, so this is for blocks of parameter-table
    height; `transpose_long` takes any height.
    """
    blocks = block_cols or []
    return transpose_long(df, row_key, values, blocks).groupBy(*blocks, "place").agg(
        ordered("row_key", "value").alias("values")
    )


def transpose_long(
    df: DataFrame, row_key: str, values: str, block_cols: list[str] | None = None
) -> DataFrame:
    """Transposed matrix in long form `(block, place, row_key, value)`; no shuffle, any height."""
    blocks = block_cols or []
    return df.select(
        *blocks, F.col(row_key).alias("row_key"), F.posexplode(values).alias("place", "value")
    ).select(*blocks, "place", "row_key", "value")


@dataclass(frozen=True)
class TableSpec:
    """Rules of one table: unique key, required columns, fixed vector widths."""

    key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    widths: dict[str, int] = field(default_factory=dict)


def validate_table(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Violations `(rule, key, n)`.

    Row rules (null, width, not-a-number, infinite) are found in one pass, each bad row once per rule
    it breaks; duplicate keys come from one partial aggregation on the key, and as in a unique index a
    key with a null never counts as one. `key` is the bad row's key: its columns as text joined by `|`,
    each with backslash and `|` escaped and null as `\\N`; the empty string for a table without key.
    """
    escaped = lambda c: F.regexp_replace(F.col(c).cast("string"), r"([\\|])", r"\\$1")
    texts = [F.coalesce(escaped(c), F.lit("\\N")) for c in spec.key]
    key_text = F.concat_ws("|", *texts) if texts else F.lit("")
    rules = [F.when(F.col(c).isNull(), F.lit(f"null:{c}")) for c in spec.not_null]
    for c, width in spec.widths.items():
        rules.append(F.when(F.size(c) != width, F.lit(f"width:{c}")))
        rules.append(F.when(F.exists(c, lambda x: F.isnan(x)), F.lit(f"nan:{c}")))
        infinite = F.exists(c, lambda x: F.abs(x) == float("inf"))
        rules.append(F.when(infinite, F.lit(f"infinite:{c}")))
    found: list[DataFrame] = []
    if rules:
        found.append(
            df.select(key_text.alias("key"), F.explode(F.array_compact(F.array(*rules))).alias("rule"))
            .groupBy("rule", "key")
            .agg(F.count(F.lit(1)).alias("n"))
        )
    if spec.key:
        complete = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in spec.key))
        found.append(
            df.filter(complete)
            .groupBy(*spec.key)
            .agg(F.count(F.lit(1)).alias("n"))
            .filter("n > 1")
            .select(F.lit("duplicate").alias("rule"), key_text.alias("key"), "n")
        )
    return reduce(DataFrame.unionByName, found).select("rule", "key", "n")
