"""Language-model scoring from a log-frequency Bloom filter.

Counts are quantised to levels on a log scale; an n-gram of level L is in the filter L times, once
with each level up to L. Probing levels until one fails gives the level back, and with it bounds of the
count. Probabilities are smoothed from such probes: every order is mixed with the next lower one.

The filter is cut by n-gram hash into shards, built where the shuffle brings their counts together, and
shards are put together to segments of bounded size. Texts are cut into pieces; the different n-grams of a piece
go to the tasks that hold their segments, and the levels found come back to the piece. So each text is read a
fixed number of times and each n-gram of a piece is moved once, however many segments there are.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from weftmill.lineage import cut, remove_cut, shuffles_removed
from weftmill.llm.texts import Words, mix, slices, with_fields

ORDER = 3
# First count of each level: 1, 2, 3, 4, 5, 6, 8, 10, ... (a quarter more each time).
LEVELS = np.array(sorted({math.floor(1.25**i) for i in range(150)} | {1, 2, 3, 4, 5, 6}), np.int64)
# Bits of the filter per entry and bits set by an entry. All bits of an n-gram lie in one 64-byte block.
ENTRY_BITS, HASHES = 11, 4
# What a task probes at a time: filter blocks and exact word counts of a segment.
SEGMENT_BYTES = 8 << 20
# Text bytes whose n-grams one shard gets on average; words and n-grams are combined per so many tokens.
SHARD_BYTES = 16 << 20
COMBINE_TOKENS = 4 << 20
# Tokens of a piece at least, unless its block ends before, and text bytes of a block of consecutive rows on average.
PIECE_TOKENS = 2 << 20
BLOCK_BYTES = 12 << 20
# Parts of the texts that are probed one after the other: n-grams of one of them lie in the shuffle at a time.
ROUNDS = 3
# Weight of the lower order, per order from 2 on: p = (count + weight * p_lower) / (context + weight).
BACKOFF = (100.0, 10.0)

_START = np.uint64(0x9D2C5680A5B3C7F1)
_END = np.uint64(0x1F83D9ABFB41BD6B)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts (their words, then one end each) and where each text begins."""
    words = Words(texts)
    n = words.counts()
    first = np.concatenate([[0], np.cumsum(n + 1)])
    tokens = np.full(first[-1], _END, np.uint64)
    inside = np.ones(first[-1], bool)
    inside[first[1:] - 1] = False
    tokens[inside] = words.hashes()
    return tokens, first


def _ngrams(tokens: np.ndarray, first: np.ndarray, order: int) -> list[np.ndarray]:
    """Keys of the n-grams that end at each token, per order; before a text stand START tokens."""
    place = np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first))
    keys, out = tokens, [mix(tokens)]
    for n in range(1, order):
        earlier = np.full(len(tokens), _START, np.uint64)
        earlier[n:] = np.where(place[n:] >= n, tokens[:-n] if n else tokens, _START)
        keys = mix(keys * _STEP + np.uint64(n)) ^ mix(earlier + np.uint64(n))
        out.append(mix(keys + np.uint64(n + 1)))
    return out


def _combined(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, sorted, with the sum of their counts."""
    if counts is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(keys) else counts


def _different(keys: np.ndarray) -> np.ndarray:
    """Different keys, sorted; faster than `np.unique`, which hashes them."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as gaps, whose upper bytes are mostly zero; nothing is lost."""
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return gaps[:5].tobytes() + zlib.compress(gaps[5:].tobytes(), 1)


def _unpacked_keys(keys: bytes, n: int) -> np.ndarray:
    gaps = np.frombuffer(keys[: 5 * n] + zlib.decompress(keys[5 * n :]), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(gaps.T).view("<u8").ravel(), dtype=np.uint64)


def _packed(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending keys and their counts."""
    planes = counts.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return _packed_keys(keys), zlib.compress(planes.tobytes(), 1)


def _unpacked(keys: bytes, counts: bytes) -> tuple[bytes, bytes]:
    """What `_packed` was given, as bytes of 64-bit keys and 32-bit counts."""
    planes = np.frombuffer(zlib.decompress(counts), np.uint8).reshape(4, -1)
    return _unpacked_keys(keys, planes.shape[1]).astype("<u8").tobytes(), planes.T.tobytes()


def _shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def _count_texts(order: int, bits: int):
    """Task function: `(shard, is_word, keys, counts)`, combined over `COMBINE_TOKENS` tokens."""

    def rows(pending: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for n in range(order):
            keys, counts = _combined(np.concatenate(pending[n]))
            pending[n] = []
            edges = np.searchsorted(_shard_of(keys, bits), np.arange((1 << bits) + 1))
            full = np.flatnonzero(np.diff(edges))
            packed = [_packed(keys[edges[s] : edges[s + 1]], counts[edges[s] : edges[s + 1]]) for s in full]
            columns = [
                pa.array(full.astype(np.int32)),
                pa.array(np.full(len(full), n == 0)),
                pa.array([k for k, _ in packed], pa.binary()),
                pa.array([c for _, c in packed], pa.binary()),
            ]
            yield pa.record_batch(columns, names=["shard", "is_word", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[list[np.ndarray]] = [[] for _ in range(order)]
        held = 0
        for batch in batches:
            for part in slices(batch, "text"):
                tokens, first = _tokens(part.column("text"))
                for kept, keys in zip(pending, _ngrams(tokens, first, order)):
                    kept.append(keys)
                held += len(tokens)
                if held >= COMBINE_TOKENS:
                    yield from rows(pending)
                    pending, held = [[] for _ in range(order)], 0
        if held:
            yield from rows(pending)

    return run


def _level_code(level: int) -> np.uint64:
    return np.uint64(level * int(_STEP) & (1 << 64) - 1)


def _bit_places(keys: np.ndarray, level: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte and bit mask of each of the `HASHES` bits of keys at a level, as (key, hash) tables."""
    block = ((keys & np.uint64(0xFFFFFFFF)) * np.uint64(blocks)) >> np.uint64(32)
    bits = mix(keys ^ _level_code(level))
    shifts = np.arange(HASHES, dtype=np.uint64) * np.uint64(9)
    place = (bits[:, None] >> shifts) & np.uint64(511)
    byte = block[:, None] * np.uint64(64) + (place >> np.uint64(3))
    return byte.astype(np.int64), np.left_shift(1, (place & np.uint64(7)).astype(np.uint8), dtype=np.uint8)


def _build_shard(rows: pa.Table) -> pa.Table:
    """One row: the shard's filter blocks, its exact word counts, and totals."""
    sides = {}
    is_word = rows.column("is_word").to_numpy()
    for side in (True, False):
        own = rows.filter(pa.array(is_word == side))
        read = lambda name, kind: np.frombuffer(b"".join(own.column(name).to_pylist()), kind)  # noqa: B023, E731
        sides[side] = _combined(read("keys", "<u8"), read("counts", "<u4").astype(np.int64))
    keys = np.concatenate([sides[True][0], sides[False][0]])
    counts = np.concatenate([sides[True][1], sides[False][1]])
    levels = np.searchsorted(LEVELS, counts, "right")
    entries = int(levels.sum())
    blocks = max(1, -(-entries * ENTRY_BITS // 512))
    bits = np.zeros(64 * blocks, np.uint8)
    level, alive = 1, np.arange(len(keys))
    while len(alive):
        byte, mask = _bit_places(keys[alive], level, blocks)
        np.bitwise_or.at(bits, byte.ravel(), mask.ravel())
        level += 1
        alive = alive[levels[alive] >= level]
    words, word_counts = sides[True]
    return pa.table(
        {
            "shard": rows.column("shard").slice(0, 1),
            "blocks": pa.array([bits.tobytes()], pa.binary()),
            "words": pa.array([words.tobytes()], pa.binary()),
            "word_counts": pa.array([word_counts.tobytes()], pa.binary()),
            "n_tokens": pa.array([int(word_counts.sum())], pa.int64()),
            "n_words": pa.array([len(words)], pa.int64()),
            "n_bytes": pa.array([len(bits) + 12 * len(words)], pa.int64()),
        }
    )


def _build_packed(rows: pa.Table) -> pa.Table:
    pairs = [_unpacked(*pair) for pair in zip(rows.column("keys").to_pylist(), rows.column("counts").to_pylist())]
    for at, name in enumerate(("keys", "counts")):
        rows = rows.set_column(rows.schema.get_field_index(name), name, pa.array([p[at] for p in pairs], pa.binary()))
    return _build_shard(rows)


SHARDS_SCHEMA = "shard int, blocks binary, words binary, word_counts binary, n_tokens long, n_words long, n_bytes long"


@dataclass
class LanguageModel:
    """Written shards, and what probabilities need besides them."""

    shards: DataFrame
    bits: int
    order: int
    n_tokens: int
    n_words: int
    n_texts: int
    segments: list[tuple[int, int]]


def train(texts: DataFrame, text_col: str = "text", order: int = ORDER, segment_bytes: int = SEGMENT_BYTES) -> LanguageModel:
    """Count all words and n-grams of `texts` and build the filter. Null texts count as empty ones."""
    size = texts.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text_col)).alias("bytes")).first()
    bits = max(0, math.ceil(math.log2(max((size["bytes"] or 0) / SHARD_BYTES, 1))))
    rows = texts.select(texts[text_col].alias("text")).mapInArrow(
        _count_texts(order, bits), "shard int, is_word boolean, keys binary, counts binary"
    )
    with shuffles_removed(texts.sparkSession):
        shards = cut(rows.groupBy("shard").applyInArrow(_build_packed, SHARDS_SCHEMA))
    # Sizes only: one row of three numbers per shard.
    sizes = shards.select("shard", "n_tokens", "n_words", "n_bytes").orderBy("shard").collect()
    segments, begin, held = [], 0, 0
    for r in sizes:
        if held and held + r["n_bytes"] > segment_bytes:
            segments.append((begin, r["shard"]))
            begin, held = r["shard"], 0
        held += r["n_bytes"]
    segments.append((begin, 1 << bits))
    n_tokens, n_words = (sum(r[c] for r in sizes) for c in ("n_tokens", "n_words"))
    return LanguageModel(shards, bits, order, n_tokens, n_words, size["n"], segments)


class Segment:
    """Shards from `begin` to before `end`, as arrays."""

    def __init__(self, rows: list, begin: int, end: int, bits: int):
        self.begin, self.end, self.bits = begin, end, bits
        n = end - begin
        self.blocks, self.offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
        parts, at = [], 0
        for r in rows:
            k = r["shard"] - begin
            self.blocks[k], self.offset[k] = len(r["blocks"]) // 64, at
            parts.append(np.frombuffer(r["blocks"], np.uint8))
            at += len(r["blocks"])
        self.filter = np.concatenate([*parts, np.zeros(0, np.uint8)])
        rows = sorted(rows, key=lambda r: r["shard"])  # so that word keys ascend
        join = lambda name, kind: np.frombuffer(b"".join(bytes(r[name]) for r in rows), kind)
        self.words, self.word_counts = join("words", "<u8"), join("word_counts", "<i8")

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key by repeated probes (0: not there); 0 for keys of other segments."""
        out = np.zeros(len(keys), np.uint8)
        shard = _shard_of(keys, self.bits)
        alive = np.flatnonzero((shard >= self.begin) & (shard < self.end))
        local = shard[alive] - self.begin
        alive, local = alive[self.blocks[local] > 0], local[self.blocks[local] > 0]
        for level in range(1, len(LEVELS) + 1):
            if not len(alive):
                break
            k = keys[alive]
            block = ((k & np.uint64(0xFFFFFFFF)) * self.blocks[local].astype(np.uint64)) >> np.uint64(32)
            base = self.offset[local] + block.astype(np.int64) * 64
            bits = mix(k ^ _level_code(level))
            there = np.ones(len(alive), bool)
            for h in range(HASHES):
                place = (bits >> np.uint64(9 * h)) & np.uint64(511)
                there &= (self.filter[base + (place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1) > 0
            alive, local = alive[there], local[there]
            out[alive] = level
        return out

    def exact(self, keys: np.ndarray) -> np.ndarray:
        """Training count of each word key, 0 for words of other segments."""
        if not len(self.words):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        return np.where(self.words[at] == keys, self.word_counts[at], 0)


_LOW = np.concatenate([[0], LEVELS]).astype(float)
_HIGH = np.concatenate([[0], LEVELS[1:] - 1, [2 * LEVELS[-1]]]).astype(float)


def log_probabilities(levels: list[np.ndarray], first: np.ndarray, n_texts: int, n_tokens: int, n_words: int) -> np.ndarray:
    """log10 probability of each token from the levels of the n-grams that end there.

    A count in the numerator is the lower bound of its level and in the denominator the upper bound, so
    the probabilities after a context sum to at most one (but for false positives of the filter).
    """
    p = (_LOW[levels[0]] + 1) / (n_tokens + 1 * (n_words + 1))
    begin = np.zeros(len(p), bool)
    begin[first[:-1]] = True
    for n in range(1, len(levels)):
        # Count of the context: the n-gram one shorter that ends at the token before.
        context = np.zeros(len(p))
        context[1:] = _HIGH[levels[n - 1]][:-1]
        context[begin] = n_texts
        count = np.minimum(_LOW[levels[n]], context)
        p = (count + BACKOFF[n - 1] * p) / (context + BACKOFF[n - 1])
    return np.log10(p)


def _probe_texts(order: int, bits: int, starts: np.ndarray, shift: int):
    """Task function over `(id, text)` in written order: `(piece, n, segment, n_keys, keys)`, the different n-grams of
    each piece. A piece is a run of consecutive rows of one block, named by its first id."""

    def rows(piece: int, pending: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for n in range(order):
            keys = _different(np.concatenate(pending[n]))
            pending[n] = []
            edges = np.append(np.searchsorted(_shard_of(keys, bits), starts), len(keys))
            full = np.flatnonzero(np.diff(edges))
            columns = [
                pa.array(np.full(len(full), piece)),
                pa.array(np.full(len(full), n, np.int32)),
                pa.array(full.astype(np.int32)),
                pa.array(np.diff(edges)[full].astype(np.int32)),
                pa.array([_packed_keys(keys[edges[s] : edges[s + 1]]) for s in full], pa.binary()),
            ]
            yield pa.record_batch(columns, names=["piece", "n", "segment", "n_keys", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[list[np.ndarray]] = [[] for _ in range(order)]
        held, piece, last = 0, 0, -2
        for batch in batches:
            ids = batch.column("id").to_numpy()
            ends = np.append(np.flatnonzero((np.diff(ids) != 1) | (np.diff(ids >> shift) != 0)) + 1, len(ids))
            for lo, hi in zip(np.append(0, ends), ends):
                for part in slices(batch.slice(lo, hi - lo), "text"):
                    begin = part.column("id")[0].as_py()
                    if held and (held >= PIECE_TOKENS or begin != last + 1 or begin >> shift != last >> shift):
                        yield from rows(piece, pending)
                        pending, held = [[] for _ in range(order)], 0
                    piece = piece if held else begin
                    tokens, first = _tokens(part.column("text"))
                    for kept, keys in zip(pending, _ngrams(tokens, first, order)):
                        kept.append(keys)
                    held, last = held + len(tokens), begin + part.num_rows - 1
            pa.default_memory_pool().release_unused()
        if held:
            yield from rows(piece, pending)

    return run


def _answer_probes(segments: list[tuple[int, int]], bits: int):
    """Task function over shards and, behind those of their segment, packed n-grams: `(piece, n, segment, levels,
    exact)`, the levels in the order of the keys and for words their exact counts. One segment is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, segment = None, [], None
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                if row["segment"] != at:
                    at, held, segment = row["segment"], [], None
                if row["piece"] is None:
                    held.append(row)
                    continue
                if segment is None:
                    segment, held = Segment(held, *segments[at], bits), []
                keys = _unpacked_keys(row["keys"], row["n_keys"])
                exact = zlib.compress(segment.exact(keys).astype("<i8").tobytes(), 1) if row["n"] == 0 else None
                found.append((row["piece"], row["n"], at, zlib.compress(segment.levels(keys).tobytes(), 1), exact))
            if found:
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
                columns = [pa.array(values, kind) for values, kind in zip(zip(*found), kinds)]
                yield pa.record_batch(columns, names=["piece", "n", "segment", "levels", "exact"])

    return run


def _score_piece(parts: list[tuple], answers: list[list[tuple]], order: int, n_texts: int, n_tokens: int, n_words: int):
    """Result columns of the texts of one piece; `parts` are `(carried columns, tokens, tokens of each text)`."""
    tokens = np.concatenate([t for _, t, _ in parts])
    size = np.concatenate([n for _, _, n in parts])
    first = np.append(0, np.cumsum(size))
    read = lambda blobs, kind: np.frombuffer(b"".join(map(zlib.decompress, blobs)), kind)
    levels, exact = [], None
    for keys, own in zip(_ngrams(tokens, first, order), answers):
        different, places = np.unique(keys, return_inverse=True)
        found = read((a for a, _ in own), np.uint8)
        if len(found) != len(different):
            raise RuntimeError(f"levels of {len(found)} n-grams came back for {len(different)}")
        if exact is None:
            exact = read((b for _, b in own), "<i8")[places]
        levels.append(found[places])
    known = np.add.reduceat(exact > 0, first[:-1], dtype=np.int64)
    logs = np.add.reduceat(np.log10(exact + 1.0), first[:-1])
    base = logs - size * math.log10(n_tokens + 1 * (n_words + 1))
    p = np.add.reduceat(log_probabilities(levels, first, n_texts, n_tokens, n_words), first[:-1])
    at = 0
    for carried, _, n in parts:
        here = slice(at, at + len(n))
        yield [*carried, *(pa.array(x[here]) for x in (size, known, base, p))]
        at += len(n)


def _score_blocks(order: int, n_texts: int, n_tokens: int, n_words: int, carried: list[str]):
    """Task function over blocks: rows of found levels, then the rows of the texts by id. One piece is held at a
    time, without its texts."""
    names = [*carried, "n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers: dict[int, list[list[tuple]]] = {}
        block, piece, parts = None, None, []

        def close() -> Iterator[pa.RecordBatch]:
            if parts:
                for columns in _score_piece(parts, answers.pop(piece), order, n_texts, n_tokens, n_words):
                    yield pa.record_batch(columns, names=names)

        for batch in batches:
            owner = batch.column("_block").to_numpy() * 2 + np.asarray(batch.column("_piece").is_null())
            ends = np.append(np.flatnonzero(np.diff(owner)) + 1, len(owner))
            for lo, hi in zip(np.append(0, ends), ends):
                rows = batch.slice(lo, hi - lo)
                if owner[lo] >> 1 != block:
                    yield from close()
                    block, answers, piece, parts = owner[lo] >> 1, {}, None, []
                if not owner[lo] & 1:
                    for r in rows.select(["_piece", "_n", "_levels", "_exact"]).to_pylist():
                        answers.setdefault(r["_piece"], [[] for _ in range(order)])[r["_n"]].append((r["_levels"], r["_exact"]))
                    starts = np.array(sorted(answers))
                    continue
                of = starts[np.searchsorted(starts, rows.column("_id").to_numpy(), "right") - 1]
                stops = np.append(np.flatnonzero(np.diff(of)) + 1, len(of))
                for a, b in zip(np.append(0, stops), stops):
                    if of[a] != piece:
                        yield from close()
                        piece, parts = int(of[a]), []
                    for part in slices(rows.slice(a, b - a), "_text"):
                        tokens, first = _tokens(part.column("_text"))
                        parts.append(([part.column(c) for c in carried], tokens, np.diff(first)))
            pa.default_memory_pool().release_unused()
        yield from close()

    return run


def score(docs: DataFrame, model: LanguageModel, text_col: str = "text", carry: list[Column] | None = None) -> DataFrame:
    """`carry` columns with `n_tokens`, `n_known`, `base_score` and `score`, one row per row of `docs`, written.

    `score` is the model's log10 probability of the text, `base_score` that of the exact word counts
    with add-one smoothing. Null and empty texts are the end token alone. Texts are written once with an id by their
    place, and read to take their n-grams to the segments and to bring the levels back by block of ids; what has
    been read is deleted.
    """
    spark = docs.sparkSession
    order, bits, segments = model.order, model.bits, model.segments
    seen = Observation()
    whole = docs.select(docs[text_col].alias("_text"), *(carry or []), F.monotonically_increasing_id().alias("_id"))
    sizes = (F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("_text")).alias("bytes"), F.max("_id").alias("last"))
    texts = cut(whole.observe(seen, *sizes), compression="zstd")
    carried, kept = texts.columns[1:-1], texts.schema[1:-1]
    n, last = seen.get["n"] or 0, seen.get["last"] or 0
    # Blocks of 2 ** shift ids. An id has the number of its task above bit 33.
    shift = min(32, max(0, round(math.log2(max(BLOCK_BYTES * n / max(seen.get["bytes"] or 0, 1), 1)))))
    tasks = (last >> 33) + 1
    starts = np.array([begin for begin, _ in segments])
    # One row of two numbers per shard.
    of = np.repeat(np.arange(len(segments), dtype=np.int32), [end - begin for begin, end in segments])
    place = spark.createDataFrame(pa.table({"shard": np.arange(len(of), dtype=np.int32), "segment": of}))
    shards = model.shards.join(F.broadcast(place), "shard").select("segment", "shard", "blocks", "words", "word_counts")
    rounds = min(ROUNDS, tasks)
    levels = []
    with shuffles_removed(spark):
        for r in range(rounds):
            lo, hi = (tasks * k // rounds << 33 for k in (r, r + 1))
            part = texts.filter((F.col("_id") >= lo) & (F.col("_id") < hi)).select(F.col("_id").alias("id"), F.col("_text").alias("text"))
            probes = part.mapInArrow(
                _probe_texts(order, bits, starts, shift), "piece long, n int, segment int, n_keys int, keys binary"
            )
            met = shards.unionByName(probes, allowMissingColumns=True).repartitionById(len(segments), F.col("segment"))
            met = met.sortWithinPartitions("segment", F.asc_nulls_first("piece"), "shard")
            levels.append(cut(met.mapInArrow(_answer_probes(segments, bits), "piece long, n int, segment int, levels binary, exact binary")))
        back = reduce(DataFrame.unionByName, levels)
        back = back.select(*(F.col(c).alias(f"_{c}") for c in back.columns), F.col("_piece").alias("_id"))
        met = back.unionByName(texts, allowMissingColumns=True).withColumn("_block", F.shiftright("_id", shift))
        met = met.repartition("_block").sortWithinPartitions("_block", F.col("_piece").isNull(), "_id", "_n", "_segment")
        schema = with_fields(kept, "n_tokens long, n_known long, base_score double, score double")
        scored = cut(met.mapInArrow(_score_blocks(order, model.n_texts, model.n_tokens, model.n_words, carried), schema))
    for spent in (texts, *levels):
        remove_cut(spent)
    return scored
