"""Byte-pair merging of many parts at once, as array work inside a task.

The symbols of all parts of a batch lie in one array, a pair never crosses the end of a part. The lowest pending
token of the whole batch is merged in all parts that have it; it is the lowest one of each of them, so every part
goes through the steps it would go through alone.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

from weftmill.functions.bytesym import encoder_rows

# Symbols that are merged at a time (a longer part goes alone), and pairs of which a square table is kept.
SLICE_SYMBOLS = 1 << 20
SQUARE_PAIRS = 1 << 22

Cuts = list[tuple[int, int]]


class PairTable:
    """A vocabulary `(cluster, token)` by symbol number: 0 to 255 are the bytes, then come its entries of two or
    more symbols. `strings` and `tokens` are cluster and token of each number."""

    def __init__(self, vocab: Iterable[tuple[str, int | None]]):
        letters = {c: b for c, b in encoder_rows()}
        number = {bytes([b]): b for b in range(256)}
        strings = sorted(letters, key=letters.get)
        token: dict[bytes, int | None] = {}
        names: dict[bytes, str] = {}
        for cluster, t in vocab:
            # An entry with a symbol of no byte is never met.
            if not cluster or any(c not in letters for c in cluster):
                continue
            key = bytes(letters[c] for c in cluster)
            if len(key) == 1:
                token[key] = t
            elif t is not None:
                token[key] = min(t, token.get(key, t))
                names[key] = cluster
        for key, cluster in names.items():
            number[key] = len(strings)
            strings.append(cluster)
        self.strings, self.size = pa.array(strings, pa.string()), len(strings)
        self.tokens = pa.array([token.get(key) for key in number], pa.int32())
        order = np.array([-1 if t is None else t for t in self.tokens.to_pylist()])
        self.rank = np.unique(order, return_inverse=True)[1].astype(np.int32)
        # The symbol after the last one has no pair, and neither has one that is gone.
        self.none = self.size
        pairs = {}
        for key in names:
            for i in range(1, len(key)):
                left, right = number.get(key[:i]), number.get(key[i:])
                if left is not None and right is not None:
                    pairs[left * (self.size + 1) + right] = number[key]
        self.keys = np.array(sorted(pairs), np.int64)
        self.found = np.array([pairs[k] for k in sorted(pairs)], np.int32)
        self.square = None
        if (self.size + 1) ** 2 <= SQUARE_PAIRS:
            self.square = np.full((self.size + 1) ** 2, -1, np.int32)
            self.square[self.keys] = self.found

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of the entry that each pair of symbols makes, -1 if none."""
        key = left.astype(np.int64) * (self.size + 1) + right
        if self.square is not None:
            return self.square[key]
        if not len(self.keys):
            return np.full(len(key), -1, np.int32)
        at = np.searchsorted(self.keys, key).clip(max=len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.found[at], -1)

    def merge(self, symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of parts, and where the parts end (from 0), to their final symbols and where those end."""
        n = len(symbols)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(ends), np.int64)
        symbol = np.append(symbols.astype(np.int32), self.none).astype(np.int32)
        after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        after[n] = n
        full = np.diff(ends) > 0
        after[ends[1:][full] - 1], before[ends[:-1][full]] = n, n
        pending: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def add(at: np.ndarray) -> None:
            made = self.of(symbol[at], symbol[after[at]])
            at, made = at[made >= 0], made[made >= 0]
            if not len(at):
                return
            rank = self.rank[made]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            edges = np.flatnonzero(np.diff(rank)) + 1
            for r, found in zip(rank[np.append(0, edges)].tolist(), np.split(at, edges)):
                if r not in pending:
                    pending[r] = []
                    heapq.heappush(queue, r)
                pending[r].append(found)

        add(np.arange(n, dtype=np.int32))
        while queue:
            rank = heapq.heappop(queue)
            at = pending.pop(rank)
            at = np.unique(np.concatenate(at)) if len(at) > 1 else at[0]
            made = self.of(symbol[at], symbol[after[at]])
            valid = (made >= 0) & (self.rank[made] == rank)
            at, made = at[valid], made[valid]
            if not len(at):
                continue
            # Of pairs that overlap, every second one from the left.
            place = np.arange(len(at))
            linked = np.append(False, after[at[:-1]] == at[1:])
            taken = (place - np.maximum.accumulate(np.where(linked, 0, place))) % 2 == 0
            at, made = at[taken], made[taken]
            gone = after[at]
            symbol[at], symbol[gone] = made, self.none
            after[at] = after[gone]
            before[after[at]] = at
            touched = np.concatenate([before[at], at])
            add(np.unique(touched[touched < n]))
        kept = symbol[:n] != self.none
        return symbol[:n][kept], np.append(0, np.cumsum(kept, dtype=np.int64))[ends]


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an array of strings without nulls, and where they end, from 0."""
    held = strings.cast(pa.large_binary())
    _valid, offsets, data = held.buffers()
    ends = np.frombuffer(offsets, np.int64)[held.offset : held.offset + len(held) + 1] if len(held) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def slices(ends: np.ndarray, most: int) -> Cuts:
    """Runs of rows of at most `most` elements together, at least one row each; `ends` are of all rows."""
    found, lo = [], 0
    while lo < len(ends) - 1:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most, "right")) - 1)
        found.append((lo, hi))
        lo = hi
    return found


def merge_strings(table: PairTable, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Final symbols of each string, one after the other, and where they end."""
    data, ends = _bytes_of(strings)
    found, stops = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    for lo, hi in slices(ends, SLICE_SYMBOLS):
        symbols, inner = table.merge(data[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo])
        found.append(symbols)
        stops.append(inner[1:] + stops[-1][-1])
    return np.concatenate(found), np.concatenate(stops)


def clusters_and_tokens(table: PairTable, strings: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Of each string its clusters and their tokens; null for a symbol without token."""
    symbols, ends = merge_strings(table, strings)
    at, stops = pa.array(symbols), pa.array(ends.astype(np.int32))
    return pa.ListArray.from_arrays(stops, table.strings.take(at)), pa.ListArray.from_arrays(stops, table.tokens.take(at))


def text_tokens(table: PairTable, texts: pa.Array) -> pa.Array:
    """Tokens of each text, given as its parts in order. A part is merged once in each run of texts; symbols
    without a token drop."""
    known = np.asarray(table.tokens.is_valid())
    number = table.tokens.fill_null(0).to_numpy()
    lengths = np.asarray(texts.value_lengths().fill_null(0)).astype(np.int64)
    parts, ends = texts.flatten(), np.append(0, np.cumsum(lengths))
    found, stops = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    for lo, hi in slices(ends, SLICE_SYMBOLS):
        coded = parts.slice(ends[lo], ends[hi] - ends[lo]).dictionary_encode()
        symbols, inner = merge_strings(table, coded.dictionary)
        kept = known[symbols]
        tokens, inner = number[symbols[kept]], np.append(0, np.cumsum(kept))[inner]
        at = coded.indices.to_numpy()
        count = np.diff(inner)[at]
        out = np.append(0, np.cumsum(count))
        found.append(tokens[np.repeat(inner[at] - out[:-1], count) + np.arange(out[-1])].astype(np.int32))
        stops.append(out[ends[lo + 1 : hi + 1] - ends[lo]] + stops[-1][-1])
    return pa.ListArray.from_arrays(pa.array(np.concatenate(stops).astype(np.int32)), pa.array(np.concatenate(found)))
