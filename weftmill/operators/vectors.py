"""Vector jobs that regroup rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftmill.lineage import ordered


def sum_elements(values: Column | str, width: int, weight: Column | None = None) -> Column:
    """Aggregate: element-wise (weighted) sum of vectors as one array.

    One plain `sum` per element: a fixed-width aggregation buffer, combined before the shuffle,
    so a group of any size travels as one vector per task. Null vectors are left out; a vector of
    another width fails the job.
    """
    v = F.col(values) if isinstance(values, str) else values
    wrong = F.raise_error(F.concat(F.lit(f"expected {width} elements, found "), F.size(v)))
    # Checked once per vector, with the first element.
    first = F.when(v.isNull() | (F.size(v) == width), F.get(v, F.lit(0))).otherwise(wrong)
    term = lambda i: (F.get(v, F.lit(i)) if i else first).cast("double")
    return F.array(*[F.sum(term(i) if weight is None else weight * term(i)) for i in range(width)])


def vec_sum(df: DataFrame, group: list[str], values: str, width: int) -> DataFrame:
    """`(group, values, n)`: sum of the vectors of each group."""
    return df.groupBy(*group).agg(
        sum_elements(values, width).alias("values"), F.count(F.lit(1)).alias("n")
    )


def centroids(df: DataFrame, group: list[str], values: str, width: int) -> DataFrame:
    """`(group, values)`: mean vector of each group."""
    n = F.col("n").cast("double")
    return vec_sum(df, group, values, width).select(
        *group, F.transform("values", lambda x: x / n).alias("values")
    )


def unnest_vector(df: DataFrame, id_cols: list[str], values: str) -> DataFrame:
    """Vectors as `(ids, ordinality, value)` rows, ordinality from 1."""
    return df.select(*id_cols, F.posexplode(values).alias("_i", "value")).select(
        *id_cols, (F.col("_i") + 1).alias("ordinality"), "value"
    )


def renest_vector(df: DataFrame, id_cols: list[str]) -> DataFrame:
    """`(ids, ordinality, value)` rows back to `(ids, values)`. A group is one vector."""
    return df.groupBy(*id_cols).agg(ordered("ordinality", "value").alias("values"))
