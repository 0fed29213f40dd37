"""SimHash near-duplicates with pivot distance tables.

Two fingerprints within `radius` bits agree in at least `blocks - radius` of `blocks` bit blocks, so
they meet under at least one choice of that many agreeing blocks (pigeonhole: no link is lost). Of
the fingerprints that meet there, a table holds the Hamming distances to many reference fingerprints
(pivots). By the triangle inequality a pair whose distances to any pivot differ by more than `radius`
is discarded; the survivors are verified by their own distance.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftmill.lineage import cut
from weftmill.llm.components import connected_components
from weftmill.llm.dedup import join_groups
from weftmill.llm.texts import Words, map_slices

RADIUS = 4
SHINGLE = 4
# Pivots: the pairs that meet are first sorted by the first one's distance, then cut by the others'.
PIVOTS = np.random.Generator(np.random.PCG64(64)).integers(0, 2**64, 12, dtype=np.uint64)
# Bits per fingerprint that a meeting place should have beyond log2 of the number of fingerprints.
SPARE_BITS = -4
# A meeting place with more fingerprints than this is dealt out in tiles, pair of tiles by pair.
TILE = 3000
# Rows of small meeting places that one task holds on average.
TASK_ROWS = 200_000
# Pairs that are compared in one numpy step.
STEP = 1 << 20


def _bit_majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text, the bits set in over half of its hashes; no hash gives zero."""
    n = np.diff(first)
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, first[full], axis=0, dtype=np.int32)
        major = (2 * sums > n[full, None]).astype(np.uint8)
        out[full] = np.packbits(major, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def text_fingerprints(texts: pa.Array, size: int = SHINGLE) -> np.ndarray:
    """64-bit SimHash of each text over word shingles: a bit is set if it is in over half the hashes.

    A-Z is lowered, words are split by ASCII white space, a shingle is `size` words joined by spaces
    (repeats count; a shorter text is one shingle), its hash XXH64 with seed 42. No word: zero.
    """
    words = Words(texts)
    n = words.counts()
    # Words joined by single spaces: start and end of each word in that text.
    lengths = words.ends - words.starts
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    joined = np.full(int(ends[-1]) + 1 if len(ends) else 0, 32, np.uint8)
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    joined[np.repeat(starts, lengths) + inside] = words.data[np.repeat(words.starts, lengths) + inside]
    per_text = np.where(n == 0, 0, np.maximum(n - size + 1, 1))
    first = np.concatenate([[0], np.cumsum(per_text)])
    head = np.repeat(words.first[:-1] - first[:-1], per_text) + np.arange(first[-1])
    tail = np.minimum(head + size, np.repeat(words.first[1:], per_text)) - 1
    view, xxh64 = memoryview(joined.tobytes()), xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (xxh64(view[a:b], 42) for a, b in zip(starts[head].tolist(), ends[tail].tolist())), np.uint64, len(head)
    )
    return _bit_majority(hashes, first)


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """`(doc_id, text_key, fp)`, one row per row of `docs`; `fp` is the fingerprint as a signed long."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = text_fingerprints(batch.column("text"), size).view(np.int64)
        kept = [batch.column(c) for c in ("doc_id", "text_key")]
        return pa.record_batch([*kept, pa.array(found)], names=["doc_id", "text_key", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(docs[text_col]).alias("text_key"), docs[text_col].alias("text"))
    return map_slices(rows, "text", run, "doc_id long, text_key long, fp long")


def meeting_masks(n: int, radius: int = RADIUS) -> list[int]:
    """Bit masks of the block choices for n fingerprints: enough agreeing bits that random
    fingerprints rarely meet, with as few choices as that takes."""
    wanted = math.log2(max(n, 2)) + SPARE_BITS
    for blocks in range(radius + 1, radius + 6):
        if 64 * (blocks - radius) / blocks >= wanted:
            break
    edges = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(some) for some in combinations(parts, blocks - radius)]


def _stars(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots after joining the trees of all pairs (i, j)."""
    while not (root[i] == root[j]).all():
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while (root[root] != root).any():
            root = root[root]
    return root


def join_close(x: np.ndarray, place: np.ndarray, side: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each fingerprint the index of one that represents all it is connected to.

    Pairs are made within a place: among all its fingerprints if all have side 0, else of side 0 with
    side 1. In the order of place and distance to the first pivot, the partners of a fingerprint are a
    range; the other columns of the distance table discard pairs by their maximum coordinate
    difference before the verification. Pairs are made and joined in steps of bounded size.
    """
    table = np.bitwise_count(x[:, None] ^ PIVOTS).astype(np.int8)
    key = place.astype(np.int64) * 256 + table[:, 0]
    order = np.argsort(key, kind="stable")
    split = side.any()
    left, right = (order[side[order] == 0], order[side[order] == 1]) if split else (order, order)
    low = np.searchsorted(key[right], key[left] - radius, "left")
    high = np.searchsorted(key[right], key[left] + radius, "right")
    if not split:
        low = np.maximum(low, np.arange(len(left)) + 1)
    width = np.maximum(high - low, 0)
    ends = np.cumsum(width)
    columns = np.ascontiguousarray(table.T)
    root, at = np.arange(len(x)), 0
    while at < len(left):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + STEP, "right")))
        n = width[at:stop]
        i = np.repeat(left[at:stop], n)
        j = right[np.arange(len(i)) + np.repeat(low[at:stop] - (ends[at:stop] - n - before), n)]
        for column in columns[1:]:
            near = np.abs(column[i] - column[j]) <= radius
            i, j = i[near], j[near]
        near = np.bitwise_count(x[i] ^ x[j]) <= radius
        root = _stars(root, i[near], j[near])
        at = stop
    return root


def _links(rows: pa.Table) -> pa.Table:
    """`(a, b)` for every fingerprint that is connected to another one at a place of this task."""
    column = lambda name: rows.column(name).combine_chunks().to_numpy()
    x = column("fp").view(np.uint64)
    _, place = np.unique(column("place"), return_inverse=True)
    root = join_close(x, place, column("side"))
    moved = np.flatnonzero(root != np.arange(len(x)))
    return pa.table({"a": pa.array(x[moved].view(np.int64)), "b": pa.array(x[root[moved]].view(np.int64))})


def links(distinct: DataFrame, n: int) -> DataFrame:
    """`(a, b)`: links that connect all n fingerprints `(fp)` within the radius of one another.

    Where more than two meet, a star of links is given instead of all pairs; the components are the
    same. A place with more than `TILE` fingerprints is cut by hash into tiles that meet pair by pair,
    so no task holds more than two tiles of it; small places share tasks.
    """
    masks = [m - (1 << 64) if m >> 63 else m for m in meeting_masks(n)]
    places = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m))) for k, m in enumerate(masks)])
    met = distinct.select("fp", F.explode(places).alias("place"))
    sizes = met.groupBy("place").agg(F.count(F.lit(1)).alias("n"))
    large = cut(sizes.filter(F.col("n") > TILE).select("place", F.ceil(F.col("n") / TILE).cast("int").alias("tiles")))
    tasks = max(1, -(-n * len(masks) // TASK_ROWS))
    small = met.join(large, "place", "left_anti").withColumn("side", F.lit(0))
    schema = "a long, b long"
    near = small.groupBy(F.pmod("place", F.lit(tasks)).alias("task")).applyInArrow(_links, schema)
    tile = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    dealt = met.join(large, "place").withColumn("tile", tile)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "fp",
        "place",
        F.least("tile", "other").alias("one"),
        F.greatest("tile", "other").alias("two"),
        (F.col("tile") > F.col("other")).cast("int").alias("side"),
    )
    far = dealt.groupBy("place", "one", "two").applyInArrow(_links, schema)
    return near.unionByName(far)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`(doc_id, text_key, fp, component_id, is_first)`, one row per row of `docs`.

    `component_id` is the smallest id that is reachable over links, `is_first` marks the rows of the
    document that represents its component (smallest id, then smallest fingerprint), `text_key` a hash
    of the text. Null and empty texts have fingerprint zero and are linked like any other; null ids
    are never the smallest unless there is no other. Extra columns aren't read; no rows give no rows.
    Equal fingerprints are one node, so copies are never paired.
    """
    rows = cut(fingerprints(docs, id_col, text_col))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")))
    size = distinct.agg(F.count(F.lit(1)).alias("fps"), F.sum("n").alias("docs")).first()
    roots = connected_components(links(distinct.select("fp"), size["fps"]))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.withColumn("root", F.coalesce("root", "fp"))
    # A component has few fingerprints or many; their minimum is combined before the shuffle.
    first = named.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull(), "first_id", "fp")).alias("f"))
    groups = cut(named.join(first, "root").select("fp", "n", F.col("f.first_id").alias("component_id"), F.col("f.fp").alias("first_fp")))
    is_first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("first_fp"))
    return join_groups(rows, groups, "fp", "n", size["docs"] or 0).select(
        "doc_id", "text_key", "fp", "component_id", is_first.alias("is_first")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component of `near_duplicates`, with all its columns."""
    kept = near_duplicates(docs, id_col, text_col).filter("is_first").select("doc_id", "text_key").distinct()
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
        docs[id_col].cast("long").alias("row_id"),
        text_key(docs[text_col]).alias("row_key"),
    )
    same = F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_key") == F.col("text_key"))
    # Rows that repeat id and text may differ elsewhere: the first one by all columns stays, in every run.
    first = Window.partitionBy("row_key", "row_id").orderBy(*[F.col(f"doc.`{c}`") for c in _others(docs, id_col, text_col)])
    found = rows.join(kept, same, "left_semi").withColumn("row", F.row_number().over(first))
    return found.filter("row = 1").select("doc.*")


def _others(docs: DataFrame, id_col: str, text_col: str) -> list[str]:
    """The columns besides id and text that rows can be ordered by."""
    names = [f.name for f in docs.schema.fields if not f.dataType.simpleString().startswith(("map", "variant"))]
    return [c for c in names if c not in (id_col, text_col)] or [id_col]
