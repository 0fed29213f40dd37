"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target of words and a weight schedule over training time. A source deals out its
documents pass by pass until the target is met; the words dealt out before a document, as a share of
the target, are turned into a training position by inverting the integral of the schedule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftmill.lineage import cut, fits, salted_join
from weftmill.llm.texts import WORD

# A document above this share of its source's words goes before the others of a pass, longest first,
# so that the last, partial pass ends at a small document.
LARGE_SHARE = 1 / 256
# Documents of one (source, bucket) group on average at most; groups are cut by hash of the id.
BUCKET_ROWS = 4096

Schedule = list[tuple[float, float]]
# Piecewise linear weight over time 0..1, dealt out to the sources in turn: steady, fading, rising.
SCHEDULES: list[Schedule] = [[(0, 1), (1, 1)], [(0, 3), (0.5, 2), (1, 1)], [(0, 1), (0.5, 2), (1, 3)]]


def word_count(text: str | Column) -> Column:
    """Number of words; null and empty texts have none."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(
    sizes: DataFrame, weights: list[int], share: float, cap: float
) -> DataFrame:
    """`(source, source_size, n_docs, place, target)` from one row per source.

    Sources by code point, null last, have the weights in turn and share `share` times all words.
    A target stops at `cap` times its source's size; what is over is shared by weight among the
    others until none is above. There is one row per source, and one task sorts them. So target = min(cap * size, weight * level) with one level for all:
    going through the sources by the weight they need, a source is capped if the level that is left
    for it and those after it lies above its need.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("place") % len(weights) + 1)
    need = Window.orderBy("need", "place")
    upto = need.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    rows = (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("top", F.lit(float(cap)) * F.col("source_size"))
        .withColumn("need", F.col("top") / F.col("weight"))
        .withColumn("all_words", F.lit(float(share)) * F.sum("source_size").over(whole))
        .withColumn("before", F.sum("top").over(upto) - F.col("top"))
        .withColumn("weights_left", F.sum("weight").over(whole) - F.sum("weight").over(upto) + F.col("weight"))
        .withColumn("capped", (F.col("all_words") - F.col("before")) >= F.col("need") * F.col("weights_left"))
    )
    taken = F.coalesce(F.sum(F.when(F.col("capped"), F.col("top"))).over(whole), F.lit(0.0))
    left = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(whole)
    level = (F.col("all_words") - taken) / left
    return rows.withColumn("level", level).select(
        "source",
        "source_size",
        "n_docs",
        "place",
        F.when(F.col("capped"), F.col("top")).otherwise(F.col("weight") * F.col("level")).alias("target"),
    )


def position(demand: Column, place: Column, schedules: list[Schedule] = SCHEDULES) -> Column:
    """Training time at which the share `demand` (0..1) of a source's words has been dealt out; null from 1 on,
    when training is over.

    The integral of a piecewise linear weight is quadratic on each piece and is inverted there.
    """
    out = None
    for at, knots in enumerate(schedules):
        pieces = list(zip(knots, knots[1:]))
        areas = [(t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in pieces]
        time, done = F.lit(None).cast("double"), sum(areas)
        for ((t0, a), (t1, b)), area in reversed(list(zip(pieces, areas))):
            done -= area
            inside = demand * F.lit(float(sum(areas))) - F.lit(float(done))
            slope = (b - a) / (t1 - t0)
            if slope == 0:
                when = F.lit(float(t0)) + inside / F.lit(float(a))
            else:
                root = F.sqrt(F.lit(float(a * a)) + F.lit(2.0 * slope) * F.greatest(inside, F.lit(0.0)))
                when = F.lit(float(t0)) + (root - F.lit(float(a))) / F.lit(float(slope))
            time = F.when(inside < F.lit(float(area)), when).otherwise(time)
        out = F.when(place % len(schedules) == at, time) if out is None else out.when(place % len(schedules) == at, time)
    return out


def plan_mix(
    docs: DataFrame,
    weights: list[int],
    share: float,
    cap: float,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    payload: Column | None = None,
    schedules: list[Schedule] = SCHEDULES,
) -> DataFrame:
    """`(doc_id, source, size, source_size, target, copies, positions[, payload])`, one row per row of `docs`.

    `positions` is when (0 to 1) the mix takes the whole document and `copies` how often. In each
    pass documents come by md5 of their id, long ones first (see `LARGE_SHARE`). The words up to a copy's middle
    one, as a share of the target, are turned into its training position by the inverted schedule; a copy
    whose demand comes after the end of training isn't taken. So a source misses its target by at
    most half of the document at the boundary, and no document is taken more than `cap` times,
    rounded up. Repeated rows are documents of their own. A null text has size 0, a null id the md5
    of the empty string, a null source is a source of its own, the last. No rows give no rows.

    Running sums go over (source, bucket) groups of a few thousand rows and then over the buckets,
    so that a source with a third of all rows is no single group.
    """
    doc = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(docs[text_col]).alias("size"),
        *([] if payload is None else [payload.alias("payload")]),
    )
    # The counts need no payload: the optimizer reads only these columns.
    sizes = doc.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = source_targets(sizes, weights, share, cap)
    rows = _with_sources(doc, targets)
    large = F.col("size") > F.lit(LARGE_SHARE) * F.col("source_size")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    n_buckets = F.ceil(F.col("n_docs") / BUCKET_ROWS)
    lead = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    rows = (
        rows.withColumn("key", key)
        .withColumn("large", F.when(large, -F.col("size")).otherwise(F.lit(0)))
        .withColumn(
            "bucket",
            F.when(large, F.lit(-1)).otherwise(F.shiftrightunsigned(lead * n_buckets, 32)).cast("long"),
        )
    )
    group = Window.partitionBy("source", "bucket").orderBy("large", "key", "size")
    before = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("within", F.sum("size").over(before) - F.col("size"))
    buckets = _bucket_offsets(rows)
    same = rows["source"].eqNullSafe(buckets["source"]) & (rows["bucket"] == buckets["bucket"])
    rows = rows.join(buckets, same).drop(buckets["source"]).drop(buckets["bucket"])
    start = F.col("within") + F.col("offset")
    # A copy stands where the demand of its middle word is met; without such a time it isn't taken.
    middle = "CAST(p * source_size + _start + size / 2 AS DOUBLE)"
    rows = rows.withColumn("_start", start)
    demands = F.expr(f"transform(sequence(0, {int(-(-cap // 1)) - 1}), p -> try_divide({middle}, target))")
    taken = F.array_compact(F.transform(demands, lambda d: position(d, F.col("place"), schedules)))
    return rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.size(taken).cast("long").alias("copies"),
        taken.alias("positions"),
        *([] if payload is None else ["payload"]),
    )


def _with_sources(doc: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents with the row of their source: broadcast, since there is one row per source; beyond
    the bound of `fits` a salted join."""
    targets = cut(targets)
    key = F.concat(F.when(F.col("source").isNull(), F.lit("0")).otherwise(F.lit("1")), F.coalesce("source", F.lit("")))
    facts = doc.withColumn("source_key", key)
    table = targets.withColumn("source_key", key).drop("source")
    if fits(targets, F.coalesce(F.octet_length("source"), F.lit(0))):
        return facts.join(F.broadcast(table), "source_key").drop("source_key")
    return salted_join(facts, table, "source_key", ["doc_id"]).drop("source_key")


def _bucket_offsets(rows: DataFrame) -> DataFrame:
    """`(source, bucket, offset)`: words of the source in the buckets before."""
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("source", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))


def curriculum(plan: DataFrame) -> DataFrame:
    """`plan_mix` rows as training order: one row per copy, range-sorted by `position`."""
    copies = plan.withColumn("position", F.explode("positions")).drop("positions", "copies")
    return copies.repartitionByRange("position", "source", "doc_id").sortWithinPartitions("position", "source", "doc_id")
