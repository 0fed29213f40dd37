"""Exact deduplication over a cuckoo-filter index of text digests.

The index is a table of live digests, dealt out by digest. Each shard is a cuckoo filter whose slots
stand beside the stored keys: a hit in the filter is verified against the whole stored digest, a
deletion frees its slot, and an overflow rebuilds the filter at twice the size from the stored keys.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftmill.lineage import cut

SLOTS = 4
MAX_KICKS = 200
# Digests that one task indexes on average, and that a task holds before it hands them on.
SHARD_ROWS, MIN_SHARDS = 100_000, 16
FLUSH_ROWS = 500_000
# Groups with more than 1/HOT_GROUPS of all rows (fewer than HOT_GROUPS, by counting) are broadcast.
HOT_GROUPS = 2_000

INDEX_SCHEMA = "digest binary, keep_id long, group_size long"
_ARROW = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


class CuckooIndex:
    """Digest -> value. Keys are at least 16 evenly distributed bytes (a cryptographic digest)."""

    def __init__(self, buckets: int = 16):
        self.size = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self._mask = buckets - 1
        self._prints = array("H", bytes(2 * SLOTS * buckets))
        self._content: list[tuple[bytes, object] | None] = [None] * (SLOTS * buckets)

    def _places(self, key: bytes) -> tuple[int, int, int]:
        """Fingerprint (never 0, which marks a free slot) and both buckets."""
        mark = int.from_bytes(key[8:10], "little") or 1
        one = int.from_bytes(key[10:16], "little") & self._mask
        return mark, one, self._other(one, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ ((mark * 0x5BD1E995 >> 3) & self._mask)

    def _slot(self, key: bytes) -> int:
        mark, one, two = self._places(key)
        prints, content = self._prints, self._content
        for bucket in (one, two):
            for at in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if prints[at] == mark and content[at][0] == key:
                    return at
        return -1

    def get(self, key: bytes) -> object | None:
        at = self._slot(key)
        return self._content[at][1] if at >= 0 else None

    def delete(self, key: bytes) -> bool:
        at = self._slot(key)
        if at < 0:
            return False
        self._prints[at] = 0
        self._content[at] = None
        self.size -= 1
        return True

    def insert(self, key: bytes, value: object) -> None:
        """Add a key that isn't in the index."""
        pending = self._place(key, value)
        if pending is not None:
            self._resize([*self.items(), pending])
        self.size += 1

    def _resize(self, stored: list[tuple[bytes, object]]) -> None:
        """Overflow: twice the buckets, filled from the stored keys."""
        buckets = 2 * (self._mask + 1)
        self._clear(buckets)
        while any(self._place(*item) is not None for item in stored):
            buckets *= 2
            self._clear(buckets)

    def _place(self, key: bytes, value: object) -> tuple[bytes, object] | None:
        """Put an entry in, moving others; the entry left over when no place is found."""
        mark, one, two = self._places(key)
        entry = (key, value)
        prints, content = self._prints, self._content
        for bucket in (one, two):
            for at in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not prints[at]:
                    prints[at], content[at] = mark, entry
                    return None
        bucket = two
        for kick in range(MAX_KICKS):
            at = bucket * SLOTS + kick % SLOTS
            prints[at], mark = mark, prints[at]
            content[at], entry = entry, content[at]
            bucket = self._other(bucket, mark)
            for free in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not prints[free]:
                    prints[free], content[free] = mark, entry
                    return None
        return entry

    def items(self) -> Iterator[tuple[bytes, object]]:
        return (x for x in self._content if x is not None)

    def merge(self, key: bytes, keep_id: int | None, n: int) -> None:
        """Count n rows of a digest in; the entry of the largest id takes the place of a smaller one."""
        old = self.get(key)
        if old is not None:
            self.delete(key)
            ids = [x for x in (old[0], keep_id) if x is not None]
            keep_id, n = (max(ids) if ids else None), old[1] + n
        self.insert(key, (keep_id, n))

    def batch(self) -> pa.RecordBatch:
        rows = list(self.items())
        columns = [[k for k, _ in rows], [v[0] for _, v in rows], [v[1] for _, v in rows]]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _ARROW.types)], schema=_ARROW)


def text_digest(text: str | Column) -> Column:
    """SHA-256 of the text in UTF-8 as 32 bytes; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the rows of one task before the shuffle: a digest leaves it once per flush."""
    index = CuckooIndex()
    for batch in batches:
        for key, row_id in zip(batch.column("digest").to_pylist(), batch.column("doc_id").to_pylist()):
            index.merge(key, row_id, 1)
        if index.size >= FLUSH_ROWS:
            yield index.batch()
            index = CuckooIndex()
    if index.size:
        yield index.batch()


def _merge_shard(rows: pa.Table) -> pa.Table:
    """Stored entries, then deletions, then insertions of one shard."""
    index = CuckooIndex()
    rows = rows.sort_by("op")
    columns = (rows.column(c).to_pylist() for c in ("op", "digest", "keep_id", "group_size"))
    for op, key, keep_id, n in zip(*columns):
        if op == 1:
            index.delete(key)
        else:
            index.merge(key, keep_id, n)
    return pa.Table.from_batches([index.batch()])


def update_index(
    index: DataFrame | None, inserts: DataFrame, deletes: DataFrame | None = None, shards: int = 1
) -> DataFrame:
    """`(digest, keep_id, group_size)` after deleting digests and inserting `(doc_id, digest)` rows.

    `deletes` has a `digest` column; a digest that isn't stored is ignored. Deletions come before
    insertions. Rows are combined per task first, so one digest brings one row per task to its shard
    however often it occurs; shards are cut by digest and so are even.
    """
    parts = [(2, inserts.select("doc_id", "digest").mapInArrow(_combine, INDEX_SCHEMA))]
    if index is not None:
        parts.append((0, index.select("digest", "keep_id", "group_size")))
    if deletes is not None:
        gone = deletes.select("digest").distinct()
        parts.append((1, gone.select("digest", F.lit(None).cast("long").alias("keep_id"), F.lit(0).cast("long").alias("group_size"))))
    rows = None
    for op, part in parts:
        part = part.withColumn("op", F.lit(op))
        rows = part if rows is None else rows.unionByName(part)
    shard = F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard")
    return rows.groupBy(shard).applyInArrow(_merge_shard, INDEX_SCHEMA)


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int) -> DataFrame:
    """Inner join of rows to their group, where one group may hold a third of all rows."""
    hot = F.col(size) > F.lit(n_rows / HOT_GROUPS)
    few, rest = F.broadcast(groups.filter(hot)), groups.filter(~hot)
    cold = rows.join(few.select(key), key, "left_anti").join(rest, key)
    return rows.join(few, key).unionByName(cold)


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`(doc_id, keep_id, group_size, kept, digest)`, one row per row of `docs`.

    Rows with equal text (null counts as empty) form a group; the largest id stays. A null id is
    smaller than any other. Of rows that repeat both text and id exactly one has `kept`. Other columns
    are not read; an empty table gives no rows.
    """
    rows = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(docs[text_col]).alias("digest")))
    n = rows.count()
    index = cut(update_index(None, rows, shards=max(MIN_SHARDS, -(-n // SHARD_ROWS))))
    repeated = rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("_n"))
    each = repeated.select("digest", "doc_id", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_copy"))
    return join_groups(each, index, "digest", "group_size", n).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
        "digest",
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `duplicates` keeps, with all their columns."""
    kept = duplicates(docs, id_col, text_col).filter("kept").select("doc_id", "digest")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
        docs[id_col].cast("long").alias("row_id"),
        text_digest(docs[text_col]).alias("row_digest"),
    )
    same = (F.col("row_digest") == F.col("digest")) & F.col("row_id").eqNullSafe(F.col("doc_id"))
    # Rows that repeat id and text may differ elsewhere: the first one by all columns stays, in every run.
    first = Window.partitionBy("row_digest", "row_id").orderBy(*[F.col(f"doc.`{c}`") for c in _others(docs, id_col, text_col)])
    found = rows.join(kept, same, "left_semi").withColumn("row", F.row_number().over(first))
    return found.filter("row = 1").select("doc.*")


def _others(docs: DataFrame, id_col: str, text_col: str) -> list[str]:
    """The columns besides id and text that rows can be ordered by."""
    names = [f.name for f in docs.schema.fields if not f.dataType.simpleString().startswith(("map", "variant"))]
    return [c for c in names if c not in (id_col, text_col)] or [id_col]
