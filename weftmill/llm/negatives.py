"""Hard negatives by the threshold algorithm over sorted lists per dimension.

Rows are dealt out to blocks by hash. Within a block every dimension is a list of rows sorted by that
component. For one anchor the lists are read from the end that its component's sign prefers, all to the same
depth; rows met there are scored in full (integer inner product). No row that hasn't been met scores above
the sum of the anchor's components times the values at that depth, so a search ends once this threshold lies
strictly below the last score it still wants. Blocks give their best rows, and the best of those are merged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftmill.lineage import cut

# Rows of a block of candidates and of a block of anchors on average. A pair of blocks is one task's work.
BLOCK_ROWS = 1 << 15
ANCHOR_ROWS = 1 << 14
# Depth of the first reading of the lists; each later one goes as deep again as all before.
FIRST_DEPTH = 4

# Below this, a hundred times a score is exact in a double.
EXACT = (1 << 53) // 100


def clean_rows(df: DataFrame, id_col: str, label: Column, vector_col: str) -> DataFrame:
    """`(row, id, label, vector)`: the rows that take part, written once. `row` tells equal rows apart."""
    wrong = F.exists(vector_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    vector = F.transform(vector_col, lambda x: x.cast("double"))
    rows = df.filter(label.isNotNull() & F.col(vector_col).isNotNull() & ~F.coalesce(wrong, F.lit(True)))
    return cut(
        rows.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
            label.cast("long").alias("label"), vector.alias("vector"),
        )
    )


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Integer components floor(256 x), as whole doubles; shorter vectors end in zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.asarray(vectors.value_lengths()).astype(np.int64)
    flat = np.floor(256 * vectors.flatten().to_numpy(zero_copy_only=False))
    out = np.zeros((len(sizes), max(1, int(sizes.max(initial=0)))))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))
    # Doubles hold these sums exactly; if they might not, Python's integers do.
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * width >= EXACT:
        a, b = (np.vectorize(int, otypes=[object])(m) if m.size else m.astype(object) for m in (a, b))
    return a, b


class Lists:
    """Rows of a block, each dimension sorted by component."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.order = np.argsort(matrix.astype(float), axis=0, kind="stable")

    def read(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, object]]:
        """`(rows, scores, threshold)` per reading: rows not met before, and what the others can score at
        most (None when all have been met)."""
        n = len(self.matrix)
        met = np.zeros(n, bool)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        depth, left = 0, n
        while left:
            end = min(n, depth * 2 or FIRST_DEPTH)
            # A component of zero prefers no row, so its list is not read.
            seen = np.concatenate([self.order[n - end : n - depth][:, up].ravel(), self.order[depth:end][:, down].ravel()])
            if not len(seen):
                end, seen = n, np.arange(n)
            new = np.unique(seen[~met[seen]])
            met[new] = True
            left -= len(new)
            depth = end
            threshold = None
            if left:
                high = self.matrix[self.order[n - end, up], up]
                low = self.matrix[self.order[end - 1, down], down]
                threshold = (anchor[up] * high).sum() + (anchor[down] * low).sum()
            yield new, self.matrix[new] @ anchor, threshold


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """The `n` first places by score, highest first, ties by id."""
    if len(scores) > 4 * n:
        # All that reach the n-th score; ties are cut by id afterwards.
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:n]


def nearest(lists: Lists, ids: np.ndarray, allowed: np.ndarray, anchor: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the `n` best allowed rows of a block."""
    rows, scores = np.zeros(0, np.int64), np.zeros(0, lists.matrix.dtype)
    for new, found, threshold in lists.read(anchor):
        keep = allowed[new]
        rows, scores = np.concatenate([rows, new[keep]]), np.concatenate([scores, found[keep]])
        best = _best(scores, ids[rows], n)
        rows, scores = rows[best], scores[best]
        if threshold is None or (len(rows) == n and threshold < scores[-1]):
            break
    return rows, scores


def in_windows(
    lists: Lists, ids: np.ndarray, allowed: np.ndarray, anchor: np.ndarray, wanted: list[int], share: tuple[int, int], n: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """`(positive score, places, scores)`: for each of the `wanted` positive scores the `n` best allowed rows
    whose score, times 100, lies from share[0] to share[1] times the positive one. One reading serves all."""
    windows = {p: (np.zeros(0, np.int64), np.zeros(0, lists.matrix.dtype)) for p in wanted if share[0] * p <= share[1] * p}
    going = set(windows)
    for new, found, threshold in lists.read(anchor) if going else ():
        keep = allowed[new]
        new, found = new[keep], found[keep]
        for p in list(going):
            inside = (share[0] * p <= 100 * found) & (100 * found <= share[1] * p)
            rows, scores = windows[p]
            rows, scores = np.concatenate([rows, new[inside]]), np.concatenate([scores, found[inside]])
            best = _best(scores, ids[rows], n)
            windows[p] = rows, scores = rows[best], scores[best]
            # Nothing unseen reaches the window, or its last place.
            if threshold is None or 100 * threshold < share[0] * p or (len(rows) == n and threshold < scores[-1]):
                going.discard(p)
        if not going:
            break
    for p, (rows, scores) in windows.items():
        yield p, rows, scores


def _blocks(df: DataFrame, n_blocks: int, own: str, other: str, n_other: int) -> DataFrame:
    """Rows with their block, once for each block of the other side."""
    block = F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int")
    return df.withColumn(own, block).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """Ids as doubles would lose digits, so nulls become the largest integer: they come last among ties."""
    return column.combine_chunks().fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def _search(kind: str, n: int, share: tuple[int, int]):
    """The function of one pair of blocks: `(anchor_row, positive_score, row, id, score)`."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if anchors.num_rows and rows.num_rows:
            a, x = _same_width(_matrix(anchors["vector"]), _matrix(rows["of_vector"]))
            labels, ids, row = (_numbers(rows[f"of_{c}"]) for c in ("label", "id", "row"))
            own_row, own_label = _numbers(anchors["row"]), _numbers(anchors["label"])
            wanted = anchors["scores"].to_pylist() if kind == "negatives" else None
            # Positives come from the anchor's label, so each label has lists of its own.
            whole = Lists(x) if kind == "negatives" else None
            groups = {} if whole else {k: np.flatnonzero(labels == k) for k in np.unique(own_label)}
            lists = {k: Lists(x[at]) for k, at in groups.items()}
            for i, anchor in enumerate(a):
                if whole:
                    parts = in_windows(whole, ids, labels != own_label[i], anchor, wanted[i], share, n)
                else:
                    at = groups[own_label[i]]
                    places, scores = nearest(lists[own_label[i]], ids[at], row[at] != own_row[i], anchor, n)
                    parts = [(0, at[places], scores)]
                for p, places, scores in parts:
                    out[0] += [own_row[i]] * len(places)
                    out[1] += [int(p)] * len(places)
                    out[2] += row[places].tolist()
                    out[3] += rows["of_id"].take(pa.array(places)).to_pylist()
                    out[4] += [int(s) for s in scores]
        names = ["anchor_row", "positive_score", "row", "id", "score"]
        return pa.table([pa.array(c, pa.int64()) for c in out], names=names)

    return run


def _merged(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The `n` best of all blocks, ranked from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def hard_negatives(
    df: DataFrame, is_anchor: Column, n_positive: int = 5, n_negative: int = 10, share: tuple[int, int] = (30, 90),
    id_col: str = "vec_id", label: Column | None = None, vector_col: str = "embedding",
) -> DataFrame:
    """`(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`.

    Positives are an anchor's `n_positive` best other rows of its label; for each of them the `n_negative` best
    rows of other labels whose score times 100 lies from share[0] to share[1] times the positive's. Scores are inner
    products of floor(256 x), highest first, ties by smaller id, a null id last. `is_anchor` is over `id_col`.
    Rows with a null label, a null vector, or a null or non-finite component take no part; a shorter vector
    counts as ending in zeros. Repeated rows are rows of their own, so a copy of an anchor is an anchor and may
    be its positive. Fewer rows than asked for give fewer; a negative positive score has no window. Scores
    must fit 64 bits. Extra columns aren't read, no rows give none.

    Each pair of an anchor block and a candidate block is a group, bounded whatever the labels or copies.
    """
    rows = clean_rows(df, id_col, F.col("label") if label is None else label, vector_col)
    own = rows.filter(F.coalesce(is_anchor, F.lit(False)))
    n_rows, n_own = rows.count(), own.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    n_blocks, n_anchor_blocks = max(cores, math.ceil(n_rows / BLOCK_ROWS)), max(1, math.ceil(n_own / ANCHOR_ROWS))
    # Names of their own, since both sides are read from one table.
    others = rows.select("row", *(F.col(c).alias(f"of_{c}") for c in ("id", "label", "vector")))
    candidates = _blocks(others, n_blocks, "of_block", "of_anchor_block", n_anchor_blocks)
    candidates = candidates.withColumnRenamed("row", "of_row").groupBy("of_anchor_block", "of_block")

    def search(anchors: DataFrame, kind: str, n: int) -> DataFrame:
        left = _blocks(anchors, n_anchor_blocks, "anchor_block", "block", n_blocks)
        return left.groupBy("anchor_block", "block").cogroup(candidates).applyInArrow(
            _search(kind, n, share), "anchor_row long, positive_score long, row long, id long, score long"
        )

    found = search(own, "positives", n_positive).drop("positive_score")
    positives = cut(
        _merged(found, ["anchor_row"], n_positive).select(
            "anchor_row", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
        )
    )
    asked = positives.groupBy("anchor_row").agg(F.collect_set("positive_score").alias("scores"))
    asked = own.join(asked.withColumnRenamed("anchor_row", "row"), "row")
    best = _merged(search(asked, "negatives", n_negative), ["anchor_row", "positive_score"], n_negative)
    ids = own.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"))
    return (
        positives.join(best, ["anchor_row", "positive_score"])
        .join(ids, "anchor_row")
        .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
