"""Arrow column functions for dense matrix work.

Spark decides which rows meet in a task; inside a task one Arrow batch is one matrix. A column is
either `array<double>` (one vector per row) or `array<array<double>>` (one sequence per row, a
vector per place). Functions of one column chain inside a single Python pass.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftmill.functions.vectors import EXP_UNDERFLOW, GELU_CUBIC, GELU_SCALE, NORM_EPSILON

VECTOR = T.ArrayType(T.DoubleType())
SEQUENCE = T.ArrayType(VECTOR)
PLACES = T.ArrayType(T.IntegerType())
SCORED = [T.StructField("token", T.LongType()), T.StructField("value", T.DoubleType())]
CANDIDATES = T.ArrayType(T.StructType(SCORED))
# Most cells of a score matrix held at a time, and input cells that a matrix function works on at a
# time (what it makes of them is a few times as much). Small enough for a core's cache, and little next to
# what a worker holds anyway.
SCORE_CELLS = 1 << 19
SLICE_CELLS = 1 << 17
# Items scored at a time.
ITEM_ROWS = 8192
# Queries of a sequence that meet their keys at a time; a run doesn't look past its last place.
QUERY_ROWS = 64
# Added to the scores of a run of queries and their own places: none sees a later one.
_BAR = np.where(np.triu(np.ones((QUERY_ROWS, QUERY_ROWS), bool), 1), -np.inf, 0.0)

Matrix = np.ndarray


def _open(col: pa.Array) -> tuple[Matrix, np.ndarray | None]:
    """All vectors of a batch as matrix rows, and for sequences the row offsets.

    The column has no null (see `_column`); a null vector or element inside a sequence or vectors of
    different widths fail the job, since rows would otherwise run into one another.
    """
    offsets = None
    if pa.types.is_list(col.type.value_type):
        lengths = np.asarray(col.value_lengths())
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        col = col.flatten()
    widths = np.unique(np.asarray(col.value_lengths().fill_null(-1)))
    if len(widths) > 1 or -1 in widths:
        raise ValueError(f"vectors of one matrix differ in width (-1 is null): {widths.tolist()}")
    n, values = len(col), col.flatten()
    if values.null_count:
        raise ValueError("a vector has a null element")
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(n, -1) if n and flat.size else np.zeros((n, 0)), offsets


def _close(m: Matrix, offsets: np.ndarray | None) -> pa.Array:
    starts = np.arange(len(m) + 1, dtype=np.int32) * np.int32(m.shape[1])
    rows = pa.ListArray.from_arrays(pa.array(starts), pa.array(np.ascontiguousarray(m).ravel()))
    return rows if offsets is None else pa.ListArray.from_arrays(pa.array(offsets), rows)


def _with_nulls(found: pa.Array, col: pa.Array) -> pa.Array:
    """Results of the rows of `col` that aren't null, back at their rows; null elsewhere."""
    if not col.null_count:
        return found
    valid = np.asarray(col.is_valid())
    at = np.cumsum(valid) - 1
    return found.take(pa.array(at, pa.int64(), mask=~valid))


def _cut_points(rows: int, offsets: np.ndarray | None, step: int) -> list[int]:
    """Row bounds of slices of about `step` rows that don't cut a sequence."""
    bounds = [0]
    while bounds[-1] < rows:
        stop = min(bounds[-1] + step, rows)
        if offsets is not None and stop < rows:
            at = int(np.searchsorted(offsets, stop, "right")) - 1
            stop = int(offsets[at] if offsets[at] > bounds[-1] else offsets[at + 1])
        bounds.append(stop)
    return bounds


def norm(m: Matrix, gain: Matrix, bias: Matrix, eps: float = NORM_EPSILON) -> Matrix:
    centred = m - m.mean(axis=1, keepdims=True)
    return centred / np.sqrt((centred**2).mean(axis=1, keepdims=True) + eps) * gain + bias


def gelu(m: Matrix) -> Matrix:
    out = m * m
    out *= GELU_CUBIC
    out += 1
    out *= m
    out *= GELU_SCALE
    np.tanh(out, out=out)
    out += 1
    out *= m
    out *= 0.5
    return out


def soft_rows(m: Matrix) -> Matrix:
    diff = m - m.max(axis=-1, keepdims=True)
    e = np.where(diff < EXP_UNDERFLOW, 0.0, np.exp(diff))
    return e / e.sum(axis=-1, keepdims=True)


def _heads(m: Matrix, n_head: int) -> Matrix:
    """Rows by heads side by side to `(head, row, element)`."""
    return m.reshape(len(m), n_head, -1).transpose(1, 0, 2)


def attend(qkv: Matrix, offsets: np.ndarray, n_head: int) -> Matrix:
    """Causal attention inside each sequence; places after the query have weight zero. Queries go through in
    short runs over the keys up to their last one, so that hardly any score is computed for nothing and no more
    than about `SCORE_CELLS` are held whatever the length."""
    width = qkv.shape[1] // 3
    out, held = np.empty((len(qkv), width)), np.zeros(0)
    for lo, hi in zip(offsets[:-1], offsets[1:]):
        if lo == hi:
            continue
        q, k, v = (_heads(part, n_head) for part in np.split(qkv[lo:hi], 3, axis=1))
        n = hi - lo
        q = q / np.sqrt(q.shape[-1])
        step = max(1, min(QUERY_ROWS, SCORE_CELLS // (n_head * n)))
        if n_head * step * n > len(held):
            held = np.empty(n_head * step * n)
        for a in range(0, n, step):
            b = min(a + step, n)
            # The same memory for all runs: fresh pages cost as much as the scores.
            scores = held[: n_head * (b - a) * b].reshape(n_head, b - a, b)
            np.matmul(q[:, a:b], k[:, :b].transpose(0, 2, 1), out=scores)
            scores[:, :, a:] += _BAR[: b - a, : b - a]
            scores -= scores.max(axis=-1, keepdims=True)
            # What `soft_rows` takes for zero is zero or next to it here.
            np.exp(scores, out=scores)
            mixed = (scores @ v[:, :b]) / scores.sum(axis=-1, keepdims=True)
            out[lo + a : lo + b] = mixed.transpose(1, 0, 2).reshape(b - a, width)
    return out


def attend_last(q: Matrix, kv: Matrix, starts: np.ndarray, n_head: int) -> Matrix:
    """Attention of one query per sequence over all its places; no sequence is empty, `starts` are their first rows."""
    of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(kv))))
    q, k, v = (m.reshape(len(m), n_head, -1) for m in (q, *np.split(kv, 2, axis=1)))
    scores = np.einsum("rhd,rhd->rh", k, q[of]) / np.sqrt(q.shape[-1])
    e = _safe_exp(scores - np.maximum.reduceat(scores, starts, axis=0)[of])
    mixed = np.add.reduceat(e[..., None] * v, starts, axis=0) / np.add.reduceat(e, starts, axis=0)[..., None]
    return mixed.reshape(len(starts), -1)


class MergedAttention:
    """Attention of some query rows, key block after key block. The state per query and head is the highest
    score so far, the sum of the exponentials below it, and the values weighted by them; `add` merges a
    block into it, in any grouping of the keys."""

    def __init__(self, q: Matrix, places: np.ndarray, n_head: int):
        self.q, self.places = _heads(q, n_head), places
        self.high = np.full(self.q.shape[:2], -np.inf)
        self.total = np.zeros(self.q.shape[:2])
        self.mixed = np.zeros(self.q.shape)

    def add(self, k: Matrix, v: Matrix, places: np.ndarray) -> None:
        k, v = _heads(k, len(self.q)), _heads(v, len(self.q))
        scores = self.q @ k.transpose(0, 2, 1) / np.sqrt(self.q.shape[-1])
        scores[:, places[None, :] > self.places[:, None]] = -np.inf
        high = np.maximum(self.high, scores.max(axis=-1))
        # A query that has met no key of its past keeps its empty state.
        base = np.where(np.isneginf(high), 0.0, high)
        e, kept = _safe_exp(scores - base[..., None]), _safe_exp(self.high - base)
        self.total = self.total * kept + e.sum(axis=-1)
        self.mixed = self.mixed * kept[..., None] + e @ v
        self.high = high

    def result(self) -> Matrix:
        out = self.mixed / self.total[..., None]
        return out.transpose(1, 0, 2).reshape(len(self.places), -1)


def _safe_exp(diff: Matrix) -> Matrix:
    return np.where(diff < EXP_UNDERFLOW, 0.0, np.exp(np.maximum(diff, EXP_UNDERFLOW)))


def _sequences(matrices: list[Matrix]) -> pa.Array:
    """One sequence per matrix."""
    none = np.zeros((0, 0))
    return pa.concat_arrays([_close(m, np.array([0, len(m)], np.int32)) for m in matrices] or [_close(none, np.zeros(1, np.int32))])


def _rows_of_one(column: pa.Array, i: int) -> Matrix:
    return _open(column.slice(i, 1))[0]


def merged_attention(n_head: int) -> Callable:
    """For `mapInArrow` over rows `(seq_id, tile, key_tile, places, a, b)`, by tile: one row of queries
    (`key_tile` -1, a the queries, b what is carried along), then rows of keys (a) and values (b). Gives
    `(seq_id, places, rows, carry)` per query row; one tile and one state are held at a time."""

    def run(batches):
        state, held = None, None

        def close():
            seq, places, carry = held
            rows = _close(state.result(), np.array([0, len(state.places)], np.int32))
            return pa.RecordBatch.from_arrays([seq, places, rows, carry], ["seq_id", "places", "rows", "carry"])

        for batch in batches:
            seq, tile, key_tile, places, a, b = batch.columns
            for i in range(batch.num_rows):
                at = places[i].values.to_numpy(zero_copy_only=False)
                if key_tile[i].as_py() < 0:
                    if state is not None:
                        yield close()
                    state = MergedAttention(_rows_of_one(a, i), at, n_head)
                    held = (seq.slice(i, 1), places.slice(i, 1), b.slice(i, 1))
                    owner = (seq[i].as_py(), tile[i].as_py())
                elif state is not None and owner == (seq[i].as_py(), tile[i].as_py()):
                    state.add(_rows_of_one(a, i), _rows_of_one(b, i), at)
        if state is not None:
            yield close()

    return run


def self_attention_column(n_head: int) -> Callable:
    """Sequences of q, k and v side by side to their attention."""
    return _column(SEQUENCE, lambda m, offsets: attend(m, offsets, n_head))


@F.arrow_udf(SEQUENCE)
def multiply_blocks(x: pa.Array, w: pa.Array) -> pa.Array:
    """Rows times weight rows, block by block."""
    return _sequences([_rows_of_one(x, i) @ _rows_of_one(w, i).T for i in range(len(x))])


@F.arrow_udf(SEQUENCE)
def sum_blocks(out: pa.Array, parts: pa.Array) -> pa.Array:
    """Partial products, ordered by output block, summed per output block and put side by side."""
    found = []
    for i in range(len(out)):
        blocks: dict[int, Matrix] = {}
        for o, part in zip(out[i].as_py(), range(len(parts[i]))):
            m = _rows_of_one(parts[i].values, part)
            blocks[o] = blocks[o] + m if o in blocks else m
        found.append(np.concatenate(list(blocks.values()), axis=1))
    return _sequences(found)


RowsFn = Callable[[Matrix, np.ndarray | None], Matrix]


def chained(fns: list[RowsFn]) -> RowsFn:
    """Matrix functions one after the other as one."""

    def fn(m: Matrix, offsets: np.ndarray | None) -> Matrix:
        for each in fns:
            m = each(m, offsets)
        return m

    return fn


def _in_slices(fn: RowsFn, rows: Callable[[int, int], Matrix], n: int, width: int, offsets: np.ndarray | None) -> Matrix:
    """`fn` of `n` rows of `width`, given by row range, in slices of whole sequences: besides the rows and the result
    no more than a slice is held."""
    bounds = _cut_points(n, offsets, max(1, SLICE_CELLS // max(1, width)))
    out = None
    for lo, hi in zip(bounds, bounds[1:]):
        inner = None if offsets is None else offsets[(offsets >= lo) & (offsets <= hi)] - lo
        found = fn(rows(lo, hi), inner)
        out = np.empty((n, found.shape[1])) if out is None else out
        out[lo:hi] = found
    return np.zeros((0, width)) if out is None else out


def _column(kind: T.DataType, fn: RowsFn) -> Callable[[Column | str], Column]:
    """Column function of a matrix function. Null rows stay null. The matrix is worked on in slices of
    whole sequences, so what a function holds besides its input and output doesn't depend on the
    number of rows that Spark hands over."""

    @F.arrow_udf(kind)
    def run(col: pa.Array) -> pa.Array:
        m, offsets = _open(col.drop_null())
        if not m.size:
            return _with_nulls(_close(m, offsets), col)
        out = _in_slices(fn, lambda lo, hi: m[lo:hi], *m.shape, offsets)
        return _with_nulls(_close(out, offsets), col)

    return run


def rows_column(fns: list[RowsFn], kind: T.DataType = SEQUENCE) -> Callable[[Column | str], Column]:
    """Matrix functions as one column function: each slice goes through all of them, so nothing between them is
    ever held for a whole batch."""
    return _column(kind, chained(fns))


def linear_column(weights, bias=None, kind: T.DataType = VECTOR) -> Callable[[Column | str], Column]:
    """`x W' + b`; `weights` and `bias` are calls that give the (broadcast) arrays in the worker."""

    def fn(m: Matrix, _offsets) -> Matrix:
        out = m @ weights().astype(np.float64, copy=False).T
        return out if bias is None else out + bias()

    return _column(kind, fn)


def norm_rows(params, gain: str, bias: str, block: int, eps: float) -> RowsFn:
    return lambda m, _offsets: norm(m, params.of(gain, block), params.of(bias, block), eps)


def attention_rows(params, block: int, n_head: int, eps: float, residual: bool) -> RowsFn:
    """Norm, qkv projection, causal attention, output projection (+ input)."""

    def fn(m: Matrix, offsets: np.ndarray) -> Matrix:
        p = lambda name: params.of(name, block)
        qkv = norm(m, p("ln_1_g"), p("ln_1_b"), eps) @ p("c_attn_w").T + p("c_attn_b")
        out = attend(qkv, offsets, n_head) @ p("c_proj_w").T + p("c_proj_b")
        return m + out if residual else out

    return fn


def feed_forward_rows(params, block: int, eps: float) -> RowsFn:
    """Norm, projection up, GELU, projection down, + input."""

    def fn(m: Matrix, _offsets) -> Matrix:
        p = lambda name: params.of(name, block)
        up = norm(m, p("ln_2_g"), p("ln_2_b"), eps) @ p("mlp_c_fc_w").T + p("mlp_c_fc_b")
        return m + gelu(up) @ p("mlp_c_proj_w").T + p("mlp_c_proj_b")

    return fn


def _known(tokens: pa.Array, places: pa.Array | None, params) -> tuple[np.ndarray, ...]:
    """For all tokens of a batch: row in the token table, place, row in the place table, whether both
    exist, and the row offsets. Without `places` they count from 0."""
    lengths = np.asarray(tokens.value_lengths().fill_null(0))
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(int)
    flat = tokens.flatten().to_numpy(zero_copy_only=False)
    if places is None:
        at_place = np.arange(len(flat)) - np.repeat(ends[:-1], lengths)
    else:
        at_place = places.flatten().to_numpy(zero_copy_only=False)
    token_row, has_token = _rows_of(params.of("wte_id"), flat)
    place_row, has_place = _rows_of(params.of("wpe_id"), at_place)
    return token_row, at_place, place_row, has_token & has_place, ends


def _rows_of(ids: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row of each wanted id in a table with ascending ids, and whether it is there."""
    if not len(ids):
        return np.zeros(len(wanted), int), np.zeros(len(wanted), bool)
    at = np.searchsorted(ids, wanted).clip(max=len(ids) - 1)
    return at, ids[at] == wanted


def _kept_offsets(keep: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(keep)])[ends].astype(np.int32)


def embedded_column(params, fns: list[RowsFn]) -> Callable:
    """Token and place arrays to sequences of token + place vectors, through matrix functions; unknown tokens and
    places past the place table drop. Vectors are looked up a slice at a time."""

    @F.arrow_udf(SEQUENCE)
    def run(tokens: pa.Array, places: pa.Array) -> pa.Array:
        at, _place, place_row, keep, ends = _known(tokens, places, params)
        at, place_row, offsets = at[keep], place_row[keep], _kept_offsets(keep, ends)
        rows = lambda lo, hi: params.of("wte")[at[lo:hi]] + params.of("wpe")[place_row[lo:hi]]
        return _close(_in_slices(chained(fns), rows, len(at), params.of("wpe").shape[1], offsets), offsets)

    return run


def kept_places_column(params) -> Callable:
    """The places that `embedded_column` keeps."""

    @F.arrow_udf(PLACES)
    def run(tokens: pa.Array, places: pa.Array) -> pa.Array:
        _at, place, _row, keep, ends = _known(tokens, places, params)
        kept = pa.array(place[keep].astype(np.int32))
        return pa.ListArray.from_arrays(pa.array(_kept_offsets(keep, ends)), kept)

    return run


_SCORED_PLACE = T.StructType([T.StructField("candidates", CANDIDATES), T.StructField("kv", VECTOR)])
_SCORED_PROMPT = T.StructType([T.StructField("candidates", CANDIDATES), T.StructField("kv", SEQUENCE)])
_ENCODED_PLACE = T.StructType([T.StructField("last", VECTOR), T.StructField("kv", VECTOR)])
_ENCODED_PROMPT = T.StructType([T.StructField("last", VECTOR), T.StructField("kv", SEQUENCE)])


def _through_blocks(x: Matrix, params, n_block: int, eps: float, attention: Callable[[int, Matrix], Matrix]) -> tuple[Matrix, Matrix]:
    """Rows through all blocks, and the keys and values they leave behind, block after block. `attention` is
    given the block and the rows' q, k and v."""
    kept = []
    for block in range(n_block):
        p = lambda name, block=block: params.of(name, block)
        qkv = norm(x, p("ln_1_g"), p("ln_1_b"), eps) @ p("c_attn_w").T + p("c_attn_b")
        kept.append(qkv[:, x.shape[1] :])
        x = x + attention(block, qkv) @ p("c_proj_w").T + p("c_proj_b")
        up = norm(x, p("ln_2_g"), p("ln_2_b"), eps) @ p("mlp_c_fc_w").T + p("mlp_c_fc_b")
        x = x + gelu(up) @ p("mlp_c_proj_w").T + p("mlp_c_proj_b")
    return x, np.concatenate(kept, axis=1) if kept else np.zeros((len(x), 0))


class LastPlaces:
    """Last places of some sequences, none of them empty: `vectors` are what the blocks make of them, and a token may be
    appended to each. Of the last block the other places only give their keys and values; those of all blocks stay."""

    def __init__(self, x: Matrix, offsets: np.ndarray, params, n_block: int, n_head: int, eps: float):
        self.shape, self.n_head = (params, n_block, eps), n_head
        self.starts, self.ends = offsets[:-1], offsets[1:]
        before, cells = _through_blocks(x, params, max(n_block - 1, 0), eps, lambda _b, qkv: attend(qkv, offsets, n_head))
        self.vectors, self.kept = before[self.ends - 1], np.split(cells, max(n_block - 1, 1), axis=1)[: n_block - 1]
        if not n_block:
            return
        p, width = lambda name: params.of(name, n_block - 1), x.shape[1]
        normed = norm(before, p("ln_1_g"), p("ln_1_b"), eps)
        w, b = p("c_attn_w"), p("c_attn_b")
        self.kept.append(normed @ w[width:].T + b[width:])
        mixed = attend_last(normed[self.ends - 1] @ w[:width].T + b[:width], self.kept[-1], self.starts, n_head)
        last = self.vectors + mixed @ p("c_proj_w").T + p("c_proj_b")
        up = norm(last, p("ln_2_g"), p("ln_2_b"), eps) @ p("mlp_c_fc_w").T + p("mlp_c_fc_b")
        self.vectors = last + gelu(up) @ p("mlp_c_proj_w").T + p("mlp_c_proj_b")

    def append(self, x: Matrix) -> None:
        """One new place for each sequence."""
        params, n_block, eps = self.shape
        starts = self.starts + np.arange(len(self.starts))

        def attention(block: int, qkv: Matrix) -> Matrix:
            width = x.shape[1]
            self.kept[block] = np.insert(self.kept[block], self.ends, qkv[:, width:], axis=0)
            return attend_last(qkv[:, :width], self.kept[block], starts, self.n_head)

        self.vectors, _ = _through_blocks(x, params, n_block, eps, attention)
        self.starts, self.ends = starts, self.ends + np.arange(1, len(starts) + 1)


def _candidate_lists(last: Matrix, has: np.ndarray, params, eps: float, n: int) -> pa.Array:
    """Candidates of the rows that have a last vector, none for the others."""
    normed = norm(last, params.of("ln_f_g"), params.of("ln_f_b"), eps)
    ids, values = best_of(normed, params.of("wte"), params.of("wte_id"), n)
    found = pa.StructArray.from_arrays([pa.array(ids.ravel()), pa.array(values.ravel())], names=["token", "value"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(has * ids.shape[1])]).astype(np.int32)), found)


def _scored_rows(x: Matrix, offsets: np.ndarray, params, n_block: int, n_head: int, eps: float) -> tuple[Matrix, Matrix]:
    """Last vectors of the sequences that aren't empty, and keys and values of all rows; a slice of whole sequences at
    a time."""
    width = x.shape[1]
    last, kv = [np.zeros((0, width))], [np.zeros((0, 2 * width * n_block))]
    bounds = _cut_points(len(x), offsets, max(1, SLICE_CELLS // max(1, width)))
    for lo, hi in zip(bounds, bounds[1:]):
        inner = offsets[(offsets >= lo) & (offsets <= hi)] - lo
        at = np.unique(inner[1:][np.diff(inner) > 0]) - 1
        out, cells = _through_blocks(x[lo:hi], params, n_block, eps, lambda _b, qkv, o=inner: attend(qkv, o, n_head))
        last.append(out[at])
        kv.append(cells)
    return np.concatenate(last), np.concatenate(kv)


def _prompt_rows(tokens: pa.Array, params) -> tuple[Callable[[int, int], Matrix], np.ndarray, np.ndarray]:
    """Vectors of token arrays with places from 0, by row range; the row offsets, and which sequences have a last
    vector. Those without are empty, since nothing can follow them."""
    at, _place, place_row, keep, ends = _known(tokens, None, params)
    has = np.array([hi > lo and keep[hi - 1] for lo, hi in zip(ends[:-1], ends[1:])], bool)
    keep &= np.repeat(has, np.diff(ends))
    at, place_row = at[keep], place_row[keep]
    rows = lambda lo, hi: params.of("wte")[at[lo:hi]] + params.of("wpe")[place_row[lo:hi]]
    return rows, _kept_offsets(keep, ends), has


def prompt_candidates_column(params, n_block: int, n_head: int, eps: float, n: int) -> Callable:
    """Token arrays, and for how many steps: the `n` best next tokens, then those after the best of them, and so on
    (fewer steps where the place table ends). Vectors of no more than a slice of sequences are held at a time."""

    def steps_of(last: LastPlaces, place: np.ndarray, steps: np.ndarray):
        """`(rows, tokens, values)` of each step, rows being those that it reaches."""
        rows = np.arange(len(place))
        for step in range(int(steps.max()) if n > 0 else 0):
            rows = rows[steps[rows] > step]
            if step:
                at, there = _rows_of(params.of("wpe_id"), place + step - 1)
                rows = rows[there[rows]]
                if not len(rows):
                    return
                last.append(params.of("wte")[_rows_of(params.of("wte_id"), best)[0]] + params.of("wpe")[at])
            normed = norm(last.vectors, params.of("ln_f_g"), params.of("ln_f_b"), eps)
            ids, values = best_of(normed, params.of("wte"), params.of("wte_id"), n)
            yield rows, ids[rows], values[rows]
            best = ids[:, 0]

    @F.arrow_udf(T.ArrayType(CANDIDATES))
    def run(tokens: pa.Array, steps: pa.Array) -> pa.Array:
        rows, offsets, has = _prompt_rows(tokens, params)
        own = np.flatnonzero(has)
        bounds = np.append(0, offsets[1:][has])
        place = np.asarray(tokens.value_lengths().fill_null(0))[has]
        steps = np.asarray(steps.fill_null(0))[has]
        k = max(0, min(n, len(params.of("wte_id"))))
        at, ids, values = [np.zeros(0, int)], [np.zeros((0, k), np.int64)], [np.zeros((0, k))]
        cuts = _cut_points(int(offsets[-1]), bounds, max(1, SLICE_CELLS // max(1, params.of("wpe").shape[1])))
        for lo, hi in zip(cuts, cuts[1:]):
            first, end = np.searchsorted(bounds, [lo, hi])
            last = LastPlaces(rows(lo, hi), bounds[first : end + 1] - lo, params, n_block, n_head, eps)
            for reached, t, v in steps_of(last, place[first:end], steps[first:end]):
                at.append(own[first + reached])
                ids.append(t)
                values.append(v)
        at, ids, values = map(np.concatenate, (at, ids, values))
        order = np.argsort(at, kind="stable")
        found = pa.StructArray.from_arrays([pa.array(ids[order].ravel()), pa.array(values[order].ravel())], names=["token", "value"])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * np.int32(k)), found)
        ends = np.append(0, np.cumsum(np.bincount(at, minlength=len(tokens)))).astype(np.int32)
        out = pa.ListArray.from_arrays(pa.array(ends), lists)
        return _with_nulls(out.filter(tokens.is_valid()), tokens)

    return run


def scored_prompt_column(params, n_block: int, n_head: int, eps: float, n: int) -> Callable:
    """Token arrays to `(candidates, kv)`: the `n` best next tokens, and per kept place the keys and values of
    all blocks. Places and tokens without a vector drop; a sequence whose last one drops has neither."""

    @F.arrow_udf(_SCORED_PROMPT)
    def run(tokens: pa.Array) -> pa.Array:
        rows, offsets, has = _prompt_rows(tokens, params)
        last, kv = _scored_rows(rows(0, int(offsets[-1])), offsets, params, n_block, n_head, eps)
        lists = _candidate_lists(last, has, params, eps, n)
        return pa.StructArray.from_arrays([lists, _close(kv, offsets)], names=["candidates", "kv"])

    return run


def scored_rows_column(params, n_block: int, n_head: int, eps: float) -> Callable:
    """As `scored_prompt_column` for sequences of vectors, to `(last, kv)`: the final vector of the last place
    instead of candidates."""

    @F.arrow_udf(_ENCODED_PROMPT)
    def run(rows: pa.Array) -> pa.Array:
        x, offsets = _open(rows.drop_null())
        last, kv = _scored_rows(x, offsets, params, n_block, n_head, eps)
        has = np.zeros(len(rows), bool)
        has[np.asarray(rows.is_valid())] = np.diff(offsets) > 0
        normed = norm(last, params.of("ln_f_g"), params.of("ln_f_b"), eps)
        at = pa.array(np.cumsum(has) - 1, pa.int64(), mask=~has)
        return pa.StructArray.from_arrays(
            [_close(normed, None).take(at), _with_nulls(_close(kv, offsets), rows)], names=["last", "kv"]
        )

    return run


def _next_place(x: Matrix, kept: pa.Array, params, n_block: int, n_head: int, eps: float) -> tuple[Matrix, Matrix]:
    """One new row per sequence through the blocks, over its kept keys and values."""
    cells, offsets = _open(kept)
    width = x.shape[1]

    def attention(block: int, qkv: Matrix) -> Matrix:
        out = np.empty((len(qkv), width))
        here = slice(2 * width * block, 2 * width * (block + 1))
        for i, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:])):
            k, v = np.split(np.concatenate([cells[lo:hi, here], qkv[i : i + 1, width:]]), 2, axis=1)
            scores = _heads(qkv[i : i + 1, :width], n_head) @ _heads(k, n_head).transpose(0, 2, 1)
            out[i] = (soft_rows(scores / np.sqrt(width // n_head)) @ _heads(v, n_head)).ravel()
        return out

    return _through_blocks(x, params, n_block, eps, attention)


def scored_place_column(params, n_block: int, n_head: int, eps: float, n: int) -> Callable:
    """Last token, its place and the kept keys and values of the places before to `(candidates, kv)` of
    that one place: whatever the length, one row of each sequence goes through the blocks."""

    @F.arrow_udf(_SCORED_PLACE)
    def run(token: pa.Array, place: pa.Array, kept: pa.Array) -> pa.Array:
        row, has_token = _rows_of(params.of("wte_id"), token.to_numpy(zero_copy_only=False))
        place_row, has_place = _rows_of(params.of("wpe_id"), place.to_numpy(zero_copy_only=False))
        has = has_token & has_place & np.asarray(kept.is_valid())
        x = params.of("wte")[row[has]] + params.of("wpe")[place_row[has]]
        x, own = _next_place(x, kept.filter(pa.array(has)), params, n_block, n_head, eps)
        lists = _candidate_lists(x, has, params, eps, n)
        places = pa.array(np.cumsum(has) - 1, pa.int64(), mask=~has)
        return pa.StructArray.from_arrays([lists, _close(own, None).take(places)], names=["candidates", "kv"])

    return run


def scored_vector_column(params, n_block: int, n_head: int, eps: float) -> Callable:
    """As `scored_place_column` for the vector of the new place, to `(last, kv)`."""

    @F.arrow_udf(_ENCODED_PLACE)
    def run(vector: pa.Array, kept: pa.Array) -> pa.Array:
        has = np.asarray(vector.is_valid()) & np.asarray(kept.is_valid())
        x, own = _next_place(_open(vector.filter(pa.array(has)))[0], kept.filter(pa.array(has)), params, n_block, n_head, eps)
        normed = norm(x, params.of("ln_f_g"), params.of("ln_f_b"), eps)
        at = pa.array(np.cumsum(has) - 1, pa.int64(), mask=~has)
        return pa.StructArray.from_arrays([_close(m, None).take(at) for m in (normed, own)], names=["last", "kv"])

    return run


def top_column(items: Callable[[], tuple[np.ndarray, Matrix]], n: int) -> Callable:
    """Vector (or one-row sequence) to its `n` items of highest inner product, ties by lower
    token; an empty sequence and an empty item table give no candidates, a null stays null."""

    @F.arrow_udf(CANDIDATES)
    def run(vectors: pa.Array) -> pa.Array:
        tokens, matrix = items()
        m, offsets = _open(vectors.drop_null())
        rows = np.ones(len(m), int) if offsets is None else np.diff(offsets)
        ids, values = best_of(m, matrix, tokens, n)
        found = pa.StructArray.from_arrays(
            [pa.array(ids.ravel()), pa.array(values.ravel())], names=["token", "value"]
        )
        ends = np.concatenate([[0], np.cumsum(rows * min(n, len(tokens)))]).astype(np.int32)
        return _with_nulls(pa.ListArray.from_arrays(pa.array(ends), found), vectors)

    return run


class StreamedTop:
    """The `n` best items of each query, items coming in any number of tiles."""

    def __init__(self, queries: Matrix, n: int):
        self.queries, self.n = queries, n
        self.tokens, self.values = np.zeros((len(queries), 0), np.int64), np.zeros((len(queries), 0))

    def add(self, items: Matrix, tokens: np.ndarray) -> None:
        """A slice of queries at a time, so that no more than about `SCORE_CELLS` scores are held however many
        queries there are."""
        if not len(tokens):
            return
        tokens, items = _ascending(tokens, items)
        k, full = min(self.n, len(tokens)), self.tokens.shape[1] == self.n
        kept = min(self.n, self.tokens.shape[1] + k)
        found = self.tokens if full else np.empty((len(self.queries), kept), np.int64)
        values = self.values if full else np.empty((len(self.queries), kept))
        step = max(1, SCORE_CELLS // len(tokens))
        for lo in range(0, len(self.queries), step):
            part = slice(lo, lo + step)
            scores = self.queries[part] @ items.T
            if full:
                # Only a score that isn't below the lowest kept one can change anything; most tiles have few.
                low = _ranked(self.values[part]).min(axis=1, initial=np.inf)
                row, at = np.nonzero(~(scores < low[:, None]))
                if len(row) <= len(scores):
                    self._insert(lo + row, tokens[at], scores[row, at])
                    continue
            t, v = best(scores, tokens, k)
            t, v = np.hstack([self.tokens[part], t]), np.hstack([self.values[part], v])
            found[part], values[part] = _merged_top(t, v, self.n)
        self.tokens, self.values = found, values

    def _insert(self, row: np.ndarray, token: np.ndarray, value: np.ndarray) -> None:
        while len(row):
            # One new item of each query at a time.
            first = np.concatenate([[True], row[1:] != row[:-1]])
            r = row[first]
            t, v = np.column_stack([self.tokens[r], token[first]]), np.column_stack([self.values[r], value[first]])
            self.tokens[r], self.values[r] = _merged_top(t, v, self.n)
            row, token, value = row[~first], token[~first], value[~first]


def _ascending(tokens: np.ndarray, items: Matrix) -> tuple[np.ndarray, Matrix]:
    """Items in token order; a copy only if they aren't."""
    if (tokens[1:] >= tokens[:-1]).all():
        return tokens, items
    order = np.argsort(tokens, kind="stable")
    return tokens[order], items[order]


def _ranked(scores: Matrix) -> Matrix:
    """A score that is not a number comes after all others."""
    return np.where(np.isnan(scores), -np.inf, scores)


def _merged_top(tokens: Matrix, values: Matrix, n: int) -> tuple[Matrix, Matrix]:
    at = np.lexsort((tokens, -_ranked(values)), axis=1)[:, :n]
    return np.take_along_axis(tokens, at, axis=1), np.take_along_axis(values, at, axis=1)


def streamed_top(n: int, tile_rows: int) -> Callable:
    """For `mapInArrow` over rows `(group, is_item, seq_id, token, values)`, by group and queries first, to the
    `(seq_id, token, value)` of the `n` best items of each query of the group."""

    def run(batches):
        group, seq, ids, queries, state = None, None, [], [], None

        def close():
            if state is None or not state.tokens.shape[1]:
                return
            step = max(1, SCORE_CELLS // (8 * n))
            for lo in range(0, len(seq), step):
                t, v = state.tokens[lo : lo + step], state.values[lo : lo + step]
                of = pa.array(np.repeat(np.arange(lo, lo + len(t)), t.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [seq.take(of), pa.array(t.ravel()), pa.array(v.ravel())], ["seq_id", "token", "value"]
                )

        for batch in batches:
            owners = batch["group"].to_numpy()
            kinds = owners.astype(np.int64) * 2 + batch["is_item"].to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(kinds)) + 1, [len(kinds)]]).tolist()
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if owners[lo] != group:
                    yield from close()
                    group, ids, queries, state = owners[lo], [], [], None
                m = _open(batch["values"].slice(lo, hi - lo))[0]
                if not kinds[lo] % 2:
                    ids.append(batch["seq_id"].slice(lo, hi - lo))
                    queries.append(m)
                    continue
                if state is None:
                    if not queries:
                        continue
                    # Copies, so that the batches they came in can go.
                    seq = pa.chunked_array(ids).combine_chunks()
                    seq = seq.take(pa.array(np.arange(len(seq))))
                    state, ids, queries = StreamedTop(np.concatenate(queries), n), [], []
                tokens = batch["token"].slice(lo, hi - lo).to_numpy(zero_copy_only=False)
                for a in range(0, len(m), tile_rows):
                    state.add(m[a : a + tile_rows], tokens[a : a + tile_rows])
        yield from close()

    return run


def best_of(m: Matrix, items: Matrix, tokens: np.ndarray, n: int) -> tuple[Matrix, Matrix]:
    """Tokens and scores of the `n` best items per row of `m`, a tile of items and a slice of rows at a time."""
    k = min(n, len(tokens))
    if not m.size or not k:
        return np.zeros((0, k), np.int64), np.zeros((0, k))
    tokens, items = _ascending(tokens, items)
    state = StreamedTop(m, k)
    for lo in range(0, len(tokens), ITEM_ROWS):
        state.add(items[lo : lo + ITEM_ROWS], tokens[lo : lo + ITEM_ROWS])
    return state.tokens, state.values


def best(scores: Matrix, tokens: np.ndarray, k: int) -> tuple[Matrix, Matrix]:
    """Per row the `k` highest scores by (score desc, token asc); `tokens` ascend. A score that is
    not a number comes after all others."""
    ranked = _ranked(scores)
    lowest = np.partition(ranked, ranked.shape[1] - k, axis=1)[:, -k, None]
    above, equal = ranked > lowest, ranked == lowest
    # Of the scores that equal the k-th, the first ones in token order fill up.
    room = k - above.sum(axis=1, keepdims=True)
    picked = above | (equal & (np.cumsum(equal, axis=1) <= room))
    at = np.nonzero(picked)[1].reshape(len(scores), k)
    at = np.take_along_axis(at, np.argsort(-np.take_along_axis(ranked, at, axis=1), axis=1, kind="stable"), axis=1)
    return tokens[at], np.take_along_axis(scores, at, axis=1)
