"""Work along one global order without one global task: running sums and interval look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftmill.lineage import cut, lookup


def running_sum(df: DataFrame, order: list[str], value: str, name: str = "running", frame: str = "range") -> DataFrame:
    """`df` with `name`, the sum of `value` over all rows up to this one in `order`, nulls first.

    `range`: rows that are equal in `order` share the sum of all of them, as in the default frame of a window;
    they are summed up before anything is ordered, so a very frequent key is no large group. `rows`: every row has
    its own sum, and `order` has to tell rows apart (equal rows come in any order).

    Rows are dealt out by ranges of the order and summed within each range; the totals of the ranges before are
    added. Only one number per range passes through the driver. A null value adds nothing.
    """
    if frame not in ("range", "rows"):
        raise ValueError("frame must be 'range' or 'rows'")
    if frame == "rows":
        return _running(df, order, value, name)
    key = F.struct(*[F.col(c) for c in order])
    summed = df.groupBy(*order).agg(F.sum(value).alias("_sum"))
    sums = _running(summed, order, "_sum", name).select(F.xxhash64(*order).alias("_key"), key.alias("_own"), name)
    # Joined by hash and compared in full, so that nulls find their group too; collisions share a hash row.
    table = sums.groupBy("_key").agg(F.collect_list(F.struct("_own", name)).alias("_rows"))
    facts = df.withColumn("_key", F.xxhash64(*order))
    found = lookup(facts, cut(table), "_key", df.columns, F.size("_rows") * 64)
    same = F.filter("_rows", lambda r: r["_own"].eqNullSafe(key))
    return found.select(*df.columns, F.get(same, F.lit(0))[name].alias(name))


def _running(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Running sums row by row; equal keys lie in one range."""
    dealt = cut(df.repartitionByRange(*[F.col(c) for c in order]).withColumn("_range", F.spark_partition_id()))
    totals = {r["_range"]: r["total"] or 0 for r in dealt.groupBy("_range").agg(F.sum(value).alias("total")).collect()}
    before, rows = 0, []
    for number in sorted(totals):
        rows.append((number, str(before)))
        before += totals[number]
    # As text, which gives any kind of number back unchanged.
    kind = dealt.agg(F.sum(value).alias("s")).schema["s"].dataType
    offsets = df.sparkSession.createDataFrame(rows, "_range int, _before string")
    offsets = offsets.withColumn("_before", F.col("_before").cast(kind))
    upto = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = dealt.withColumn("_within", F.coalesce(F.sum(value).over(upto), F.lit(0)))
    joined = within.join(F.broadcast(offsets), "_range")
    return joined.select(*df.columns, (F.col("_before") + F.col("_within")).alias(name))


def interval_join(
    points: DataFrame, value: str, intervals: DataFrame, low: str = "low", high: str = "high", bins: int | None = None
) -> DataFrame:
    """Every point with the intervals `[low, high)` that hold its `value`: the columns of both (names must differ).

    Intervals may coincide but not overlap in part, as the intervals of a running sum. A point outside all of
    them, a null value and an empty interval give no row.

    There is no key to join by. So the line is cut into bins at quantiles of the different values and interval starts,
    and within a bin both are read in one order, each value taking the last interval that began. An interval over
    several bins is there in each of them. No pair of a point and an interval that doesn't hold it is ever made,
    and a value that many points share is looked up once.
    """
    n_bins = bins or int(df_partitions(points))
    packed = intervals.filter(F.col(low) < F.col(high)).groupBy(low, high).agg(
        F.collect_list(F.struct(*[c for c in intervals.columns if c not in (low, high)])).alias("_rest")
    )
    packed = cut(packed.select(F.col(low).alias("_low"), F.col(high).alias("_high"), "_rest"))
    values = cut(points.select(F.col(value).alias("_at")).filter("_at IS NOT NULL").distinct())
    both = values.unionByName(packed.select(F.col("_low").alias("_at")))
    shares = [i / n_bins for i in range(1, n_bins)]
    edges = both.agg(F.percentile_approx("_at", shares, 10_000).alias("e")).first()["e"] if shares else []
    edges = sorted(set(edges or []))
    bin_of = lambda at: _bin(at, edges, both.schema["_at"].dataType)
    # The last bin an interval reaches into: an edge at its end isn't inside.
    last = F.greatest(bin_of(F.col("_low")), F.when(_is_edge(F.col("_high"), edges), bin_of(F.col("_high")) - 1).otherwise(bin_of(F.col("_high"))))
    spans = packed.select(
        F.explode(F.sequence(bin_of(F.col("_low")), last)).alias("_bin"), F.col("_low").alias("_at"),
        F.struct("_low", "_high", "_rest").alias("_span"),
    )
    asked = values.select(bin_of(F.col("_at")).alias("_bin"), "_at", F.lit(None).cast(spans.schema["_span"].dataType).alias("_span"))
    order = Window.partitionBy("_bin").orderBy("_at", F.col("_span").isNull())
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = spans.withColumn("_asked", F.lit(False)).unionByName(asked.withColumn("_asked", F.lit(True)))
    began = both.withColumn("_span", F.last("_span", ignorenulls=True).over(upto))
    held = began.filter(F.col("_asked") & (F.col("_at") < F.col("_span._high"))).select("_at", "_span")
    found = lookup(
        points.withColumnRenamed(value, "_at"), cut(held), "_at", [c for c in points.columns if c != value] or ["_at"],
        F.size("_span._rest") * 64,
    )
    rest = [c for c in intervals.columns if c not in (low, high)]
    each = found.withColumn("_r", F.explode("_span._rest"))
    taken = {low: F.col("_span._low"), high: F.col("_span._high")} | {c: F.col(f"_r.{c}") for c in rest}
    own = [F.col("_at").alias(c) if c == value else F.col(c) for c in points.columns]
    return each.select(*own, *[taken[c].alias(c) for c in intervals.columns])


def df_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _bin(at: Column, edges: list, kind) -> Column:
    """Number of edges at or below a value."""
    if not edges:
        return F.lit(0)
    line = F.lit(list(edges)).cast(f"array<{kind.simpleString()}>")
    return F.size(F.filter(line, lambda e: e <= at))


def _is_edge(at: Column, edges: list) -> Column:
    return at.isin(list(edges)) if edges else F.lit(False)
