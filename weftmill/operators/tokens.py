"""Corpus tokenising, token statistics and decoding."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftmill.functions import merging
from weftmill.functions.bytesym import known_symbols, symbol_bytes
from weftmill.lineage import cut, fits, lookup, ordered
from weftmill.operators.bpe import merge_parts, merged_together, pair_table
from weftmill.operators.dictionary import PartDictionary
from weftmill.operators.text import distinct_parts, parts_of, pretokenize

# A dictionary beyond the broadcast bound is joined in two ways: parts that hold more than
# 1/HEAVY_PARTS of all occurrences (by counting, fewer than HEAVY_PARTS of them) by broadcast,
# all others by a shuffle in which no key can be large.
HEAVY_PARTS = 20_000
# Ordered regrouping works on chunks of this many parts / tokens, then on the chunks.
CHUNK = 4096


def part_dictionary(df: DataFrame, text_col: str, vocab: DataFrame) -> DataFrame:
    """`(part, n, clusters, tokens)` for every distinct part of a text column, written once."""
    return cut(merge_parts(distinct_parts(df, text_col), vocab, carry=["n"]))


def _with_tokens(occurrences: DataFrame, dictionary: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Occurrences joined to their dictionary row by `part`, safe against frequent parts."""
    entries = dictionary.select("part", "clusters", "tokens")
    bytes_per_row = F.octet_length("part") * 2 + F.size("tokens") * 24
    bound = {} if max_rows is None else {"max_rows": max_rows}
    if fits(dictionary, bytes_per_row, **bound):
        return occurrences.join(F.broadcast(entries), "part")
    total = dictionary.agg(F.sum("n")).first()[0]
    heavy = F.col("n") > F.lit(total / HEAVY_PARTS)
    hot = F.broadcast(dictionary.filter(heavy).select("part", "clusters", "tokens"))
    rest = dictionary.filter(~heavy).select("part", "clusters", "tokens")
    cold = occurrences.join(hot.select("part"), "part", "left_anti").join(rest, "part")
    return occurrences.join(hot, "part").unionByName(cold)


def part_tokens(
    df: DataFrame, text_col: str, id_cols: list[str], vocab: DataFrame, kept: PartDictionary | None = None
) -> DataFrame:
    """`(ids, part_position, part, clusters, tokens)`: tokens of each part as arrays. With a `kept` dictionary
    (of the same vocabulary) only parts that it doesn't have are merged."""
    dictionary = cut(kept.entries(df, text_col)) if kept else part_dictionary(df, text_col, vocab)
    return _with_tokens(pretokenize(df, text_col, id_cols), dictionary).select(
        *id_cols, "part_position", "part", "clusters", "tokens"
    )


def tokenize(df: DataFrame, text_col: str, id_cols: list[str], vocab: DataFrame) -> DataFrame:
    """`(ids, part_position, position, token, cluster)`; symbols without a token id drop."""
    pairs = F.arrays_zip("tokens", "clusters")
    rows = part_tokens(df, text_col, id_cols, vocab).select(
        *id_cols, "part_position", F.posexplode(pairs).alias("_i", "_t")
    )
    return rows.filter(F.col("_t.tokens").isNotNull()).select(
        *id_cols,
        "part_position",
        (F.col("_i") + 1).alias("position"),
        F.col("_t.tokens").alias("token"),
        F.col("_t.clusters").alias("cluster"),
    )


def _regroup(df: DataFrame, id_cols: list[str], order: list[str], value: str, merge) -> DataFrame:
    """Ordered concatenation per id in two levels: chunks of the leading order column first, so
    that one long text is put together by many tasks and only its chunks meet in one."""
    chunk = F.floor(F.col(order[0]) / F.lit(CHUNK)).alias("_chunk")
    pieces = df.groupBy(*id_cols, chunk).agg(merge(ordered(order, value)).alias("_piece"))
    return pieces.groupBy(*id_cols).agg(merge(ordered("_chunk", "_piece")).alias(value))


def token_sequences(tokens: DataFrame, id_cols: list[str]) -> DataFrame:
    """Token rows as `(ids, input, n_seq)`, ordered by `(part_position, position)`."""
    by_part = tokens.groupBy(*id_cols, "part_position").agg(
        ordered("position", "token").alias("input")
    )
    return _regroup(by_part, id_cols, ["part_position"], "input", F.flatten).select(
        *id_cols, "input", F.size("input").alias("n_seq")
    )


def text_sequences(
    df: DataFrame, text_col: str, id_cols: list[str], vocab: DataFrame, kept: PartDictionary | None = None
) -> DataFrame:
    """Texts straight to `(ids, input, n_seq)`. A text without tokens gives no row. `kept`: see `part_tokens`.

    While the vocabulary can be broadcast, each text is tokenised where it lies: no row per part, no dictionary and
    no shuffle but one of the bare ids, to find those that several rows have. Rows of one id, and all rows beyond
    the bound or with a `kept` dictionary, are put together by part position.
    """
    table = pair_table(vocab) if kept is None else None
    if table is None:
        return _grouped_sequences(df, text_col, id_cols, vocab, kept)
    repeated = df.groupBy(*id_cols).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    once = df
    if not repeated.isEmpty():
        several = cut(repeated.toDF(*[f"_id{i}" for i in range(len(id_cols))]))
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_id{i}")) for i, c in enumerate(id_cols)])
        once, again = df.join(several, same, "left_anti"), df.join(several, same, "left_semi")
    parts = once.select(*id_cols, parts_of(text_col).alias("parts")).filter(F.size("parts") > 0)

    def run(batches):
        for batch in batches:
            sizes = np.append(0, np.cumsum(batch["parts"].value_lengths().to_numpy(zero_copy_only=False)))
            for lo, hi in merging.slices(sizes, merging.SLICE_SYMBOLS):
                rows = batch.slice(lo, hi - lo)
                found = merging.text_tokens(table.value, rows["parts"])
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], found], [*rows.schema.names[:-1], "input"])

    tokens = T.StructField("input", T.ArrayType(T.IntegerType()))
    rows = parts.mapInArrow(run, T.StructType([*parts.schema.fields[:-1], tokens])).filter(F.size("input") > 0)
    found = rows.select(*id_cols, "input", F.size("input").alias("n_seq"))
    return found if once is df else found.unionByName(_grouped_sequences(again, text_col, id_cols, vocab))


def _grouped_sequences(
    df: DataFrame, text_col: str, id_cols: list[str], vocab: DataFrame, kept: PartDictionary | None = None
) -> DataFrame:
    """Texts to `(ids, input, n_seq)` by a dictionary of their parts, whose per-part arrays are never exploded."""
    arrays = part_tokens(df, text_col, id_cols, vocab, kept).select(
        *id_cols, "part_position", F.array_compact("tokens").alias("input")
    )
    return (
        _regroup(arrays, id_cols, ["part_position"], "input", F.flatten)
        .filter(F.size("input") > 0)
        .select(*id_cols, "input", F.size("input").alias("n_seq"))
    )


def _part_counts(df: DataFrame, text_col: str, by: list[str], vocab: DataFrame) -> DataFrame:
    """`(by, part, n, clusters, tokens)`: occurrences are counted per group and part in one pass over the text.
    While the vocabulary can be broadcast the counted parts are merged where they lie; beyond, a dictionary is built
    from those counts and joined."""
    counts = (
        df.select(*by, F.explode(parts_of(text_col)).alias("part"))
        .groupBy(*by, "part")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    table = pair_table(vocab)
    if table is not None:
        return merged_together(counts, table)
    counts = cut(counts)
    parts = counts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    return _with_tokens(counts, cut(merge_parts(parts, vocab, carry=["n"])))


def token_stats(df: DataFrame, text_col: str, by: list[str], vocab: DataFrame) -> DataFrame:
    """Per group: texts, characters, tokens, distinct tokens and tokens per character."""
    texts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.sum(F.length(text_col)).cast("long").alias("n_chars"),
    )
    counts = token_counts(df, text_col, by, vocab)
    tokens = counts.groupBy(*by).agg(
        F.sum("n").alias("n_tokens"), F.count(F.lit(1)).alias("n_distinct")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    joined = texts.join(tokens, by, "left").select(
        *by, "n_texts", "n_chars", zero("n_tokens"), zero("n_distinct")
    )
    return joined.withColumn(
        "tokens_per_char", F.try_divide(F.col("n_tokens").cast("double"), F.col("n_chars"))
    )


def token_counts(df: DataFrame, text_col: str, by: list[str], vocab: DataFrame) -> DataFrame:
    """`(by, token, n)`."""
    return (
        _part_counts(df, text_col, by, vocab)
        .select(*by, "n", F.explode(F.array_compact("tokens")).alias("token"))
        .groupBy(*by, "token")
        .agg(F.sum("n").alias("n"))
    )


def top_tokens(df: DataFrame, text_col: str, by: list[str], vocab: DataFrame, k: int) -> DataFrame:
    """The `k` most frequent tokens per group, ties by lower token: `(by, rank, token, n)`.

    The ranked rows are at most one per group and token, and the rank filter is applied per task
    before the shuffle.
    """
    w = Window.partitionBy(*by).orderBy(F.desc("n"), F.asc("token"))
    return (
        token_counts(df, text_col, by, vocab)
        .withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select(*by, "rank", "token", "n")
    )


def detokenize(
    token_rows: DataFrame, vocab: DataFrame, id_cols: list[str], on_invalid: str = "null"
) -> DataFrame:
    """`(ids, ordinality, token)` rows as `(ids, bytes, response)`.

    Tokens without vocabulary row drop. `bytes` is always the full result; `response` is its
    UTF-8 text. Bytes that are not UTF-8 give a null response, or fail with `on_invalid='raise'`.
    """
    words = vocab.select("token", known_symbols("cluster").alias("cluster"))
    rows = lookup(token_rows, words, "token", [*id_cols, "ordinality"], F.octet_length("cluster"))
    joined = _joined_runs(_runs(rows, id_cols), id_cols)
    raw = symbol_bytes("cluster")
    return joined.select(*id_cols, raw.alias("bytes"), _response(raw, on_invalid).alias("response"))


def _runs(rows: DataFrame, id_cols: list[str]) -> DataFrame:
    """`(ids, start, clusters)`: neighbouring rows of one id and of ordinalities that follow one another, as one row
    within each chunk of ordinalities. Map side only; rows in any other order are runs of one."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch["ordinality"].fill_null(0).to_numpy()
            fresh = (np.diff(at) != 1) | (at[1:] % CHUNK == 0) | np.asarray(batch["ordinality"].is_null())[1:]
            for name in id_cols:
                column = batch[name]
                here, last = column.slice(1), column.slice(0, len(column) - 1)
                differs = pc.not_equal(here, last).fill_null(True)
                both = pc.and_(here.is_null(), last.is_null())
                fresh |= np.asarray(pc.and_not(differs, both))
            first = np.append(0, np.flatnonzero(fresh) + 1)
            ends = pa.array(np.append(first, len(at)).astype(np.int32))
            clusters = pa.ListArray.from_arrays(ends, batch["cluster"])
            heads = batch.select([*id_cols, "ordinality"]).take(pa.array(first))
            yield pa.RecordBatch.from_arrays([*heads.columns, clusters], [*id_cols, "start", "clusters"])

    held = rows.select(*id_cols, F.col("ordinality").cast("long"), "cluster")
    added = [T.StructField("start", T.LongType()), T.StructField("clusters", T.ArrayType(T.StringType()))]
    return held.mapInArrow(run, T.StructType([*held.schema.fields[: len(id_cols)], *added]))


def _joined_runs(runs: DataFrame, id_cols: list[str]) -> DataFrame:
    """`(ids, cluster)`: runs put together by ordinality in two levels, as `_regroup` does. Only in a chunk of
    several runs, which may overlap, are clusters sorted one by one."""
    chunk = F.floor(F.col("start") / F.lit(CHUNK)).alias("_chunk")
    pieces = runs.groupBy(*id_cols, chunk).agg(F.collect_list(F.struct("start", "clusters")).alias("_r"))
    each = "flatten(transform(_r, r -> transform(r.clusters, (c, i) -> struct(r.start + i AS start, c AS cluster))))"
    listed = F.expr(f"if(size(_r) = 1, _r[0].clusters, transform(array_sort({each}), r -> r.cluster))")
    pieces = pieces.select(*id_cols, "_chunk", F.array_join(listed, "").alias("_piece"))
    return pieces.groupBy(*id_cols).agg(F.array_join(ordered("_chunk", "_piece"), "").alias("cluster"))


def decode_sequences(
    df: DataFrame, vocab: DataFrame, tokens_col: str, id_cols: list[str], on_invalid: str = "null"
) -> DataFrame:
    """Token arrays as `(ids, bytes, response)`, as `detokenize` gives for token rows.

    The vocabulary's bytes are broadcast (behind a size check) and each array is decoded inside its
    row: no explosion, no regrouping, no shuffle. Beyond the bound the arrays become token rows. An
    array without a known token is the empty text; a null array gives no row.
    """
    words = vocab.select("token", symbol_bytes(known_symbols("cluster")).alias("b"))
    rows = df.filter(F.col(tokens_col).isNotNull())
    if not fits(words, F.octet_length("b") + 16):
        each = rows.select(*id_cols, F.posexplode(tokens_col).alias("ordinality", "token"))
        return detokenize(each, vocab, id_cols, on_invalid)
    entries = words.orderBy("token").toArrow()
    ids = entries.column("token").to_numpy()
    parts = entries.column("b").to_pylist()
    ends = np.cumsum([0, *map(len, parts)])
    table = df.sparkSession.sparkContext.broadcast((ids, ends, np.frombuffer(b"".join(parts), np.uint8)))

    def of(flat: np.ndarray, stops: np.ndarray) -> list[bytes]:
        ids, ends, pool = table.value
        at = np.searchsorted(ids, flat).clip(max=max(len(ids) - 1, 0))
        known = ids[at] == flat if len(ids) else np.zeros(len(flat), bool)
        at = np.where(known, at, 0)
        n = np.where(known, (ends[1:] - ends[:-1])[at], 0) if len(ids) else np.zeros(len(flat), int)
        edges = np.append(0, np.cumsum(n))
        blob = pool[np.repeat(ends[at] - edges[:-1], n) + np.arange(edges[-1])].tobytes()
        edges = edges[stops].tolist()
        return [blob[a:b] for a, b in zip(edges, edges[1:])]

    @F.arrow_udf("binary")
    def decode(tokens: pa.Array) -> pa.Array:
        stops = np.append(0, np.cumsum(np.asarray(tokens.value_lengths().fill_null(0)).astype(np.int64)))
        flat = tokens.flatten().to_numpy(zero_copy_only=False)
        found = []
        for lo, hi in merging.slices(stops, merging.SLICE_SYMBOLS):
            found += of(flat[stops[lo] : stops[hi]], stops[lo : hi + 1] - stops[lo])
        return pa.array(found, pa.binary())

    found = rows.select(*id_cols, decode(tokens_col).alias("bytes"))
    return found.withColumn("response", _response(F.col("bytes"), on_invalid))


def _response(raw: Column, on_invalid: str) -> Column:
    if on_invalid not in ("null", "raise"):
        raise ValueError("on_invalid must be 'null' or 'raise'")
    return F.decode(raw, "UTF-8") if on_invalid == "raise" else F.try_validate_utf8(raw.cast("string"))


def roundtrip_check(
    df: DataFrame, text_col: str, id_cols: list[str], by: list[str], vocab: DataFrame
) -> DataFrame:
    """Per group: texts, and texts that differ after tokenising and decoding.

    The two sides are compared by length and SHA-256, so that the join moves no text.
    """
    digest = lambda c: F.struct(F.octet_length(c), F.sha2(c, 256))
    arrays = text_sequences(df, text_col, id_cols, vocab)
    decoded = decode_sequences(arrays, vocab, "input", id_cols).select(*id_cols, digest("bytes").alias("_decoded"))
    # A text without tokens is right when it is empty.
    empty = digest(F.lit("").cast("binary"))
    texts = df.select(*id_cols, *by, digest(F.encode(text_col, "UTF-8")).alias("_text"))
    differs = ~F.coalesce("_decoded", empty).eqNullSafe(F.col("_text"))
    return (
        texts.join(decoded, id_cols, "left")
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_texts"), F.sum(differs.cast("long")).alias("n_different"))
    )
