"""What a Python worker holds doesn't grow with the rows of a batch, of a group of queries or of the item table."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from weftmill.functions import kernels
from weftmill.plans import forward

MB = 1 << 20


def peak_of(fn):
    """Result of `fn` and the most bytes that numpy held meanwhile."""
    tracemalloc.start()
    try:
        return fn(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def whole(queries, items, tokens, n):
    scores = queries @ items.T
    at = np.array([np.lexsort((tokens, -row))[:n] for row in scores])
    return tokens[at], np.take_along_axis(scores, at, axis=1)


def numbers(rows, width, seed):
    """Small integers: products are exact and many are equal."""
    return np.random.default_rng(seed).integers(-3, 4, (rows, width)).astype(float)


def test_scores_against_a_large_item_table_are_bounded():
    queries, items = numbers(300, 8, 1), numbers(30_000, 8, 2)
    tokens = np.random.default_rng(3).permutation(len(items))
    (found, values), peak = peak_of(lambda: kernels.best_of(queries, items, tokens, 5))
    expected = whole(queries, items, tokens, 5)
    assert (found == expected[0]).all() and (values == expected[1]).all()
    assert peak < 50 * MB, peak / MB


def test_scores_of_a_large_group_of_queries_are_bounded():
    queries, items, rows = numbers(20_000, 4, 4), numbers(600, 4, 5), 5_000
    kind = pa.list_(pa.float64())

    def batches():
        for is_item, m in ((False, queries), (True, items)):
            for lo in range(0, len(m), rows):
                part = m[lo : lo + rows]
                ids = pa.array(np.arange(lo, lo + len(part)))
                none = pa.nulls(len(part), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.zeros(len(part), np.int32)), pa.array([is_item] * len(part)),
                        none if is_item else ids, ids if is_item else none, pa.array(part.tolist(), kind),
                    ],
                    ["group", "is_item", "seq_id", "token", "values"],
                )

    given = list(batches())
    out, peak = peak_of(lambda: list(kernels.streamed_top(5, 256)(iter(given))))
    found = pa.Table.from_batches(out)
    tokens, values = whole(queries[:500], items, np.arange(len(items)), 5)
    assert found["seq_id"].to_pylist() == np.repeat(np.arange(len(queries)), 5).tolist()
    assert found["token"].to_pylist()[:2500] == tokens.ravel().tolist()
    assert found["value"].to_pylist()[:2500] == values.ravel().tolist()
    assert peak < 60 * MB, peak / MB


def sequences(n, places, width):
    return kernels._close(numbers(n * places, width, 6), np.arange(n + 1, dtype=np.int32) * places)


def test_a_batch_of_sequences_goes_through_in_small_slices():
    up, down = numbers(256, 64, 7) / 100, numbers(64, 256, 8) / 100
    run = kernels._column(kernels.SEQUENCE, lambda m, _o: kernels.gelu(m @ up.T) @ down.T).func
    batch = sequences(2_000, 10, 64)
    out, peak = peak_of(lambda: run(batch))
    expected = kernels.gelu(kernels._open(batch)[0] @ up.T) @ down.T
    assert np.allclose(kernels._open(out)[0], expected, rtol=0, atol=1e-9)
    assert peak < expected.nbytes + 50 * MB, peak / MB


def test_all_blocks_at_once_equal_block_after_block(model, monkeypatch):
    batch = sequences(30, 4, 64)
    functions = forward.block_functions(model)
    single = batch
    for function in functions:
        single = kernels.rows_column([function]).func(single)
    monkeypatch.setattr(kernels, "SLICE_CELLS", 64 * 9)
    together = kernels.rows_column(functions).func(batch)
    assert len(functions) == 4 and together.value_lengths().to_pylist() == [4] * 30
    assert np.allclose(kernels._open(together)[0], kernels._open(single)[0], rtol=0, atol=1e-9)


def test_blocks_keep_nothing_between_them_for_the_whole_batch(model):
    batch = sequences(4_000, 10, 64)
    run = kernels.rows_column(forward.block_functions(model)).func
    out, peak = peak_of(lambda: run(batch))
    assert len(out) == 4_000
    # The result, and slices.
    assert peak < 4_000 * 10 * 64 * 8 + 50 * MB, peak / MB
