"""Byte-pair encoding and decoding with a given public tokenizer file.

The texts of a batch are cut into words, and each different word is merged once. Short words are rows of one
contiguous array: the parts of a word and, next to them, the rank of each pair of adjacent parts. The lowest
rank of every word is looked for again and again, the boundary inside that pair is deleted, and the ranks of
the pairs on both sides are looked up anew. Scanning costs the square of a word's length, so words of more
than `SHORT` bytes keep their pairs in a heap instead; the result is the same.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftmill.llm.texts import map_slices

# Longest word, in bytes, that is merged by scanning.
SHORT = 256
# Above every rank.
NEVER = 1 << 40

# Fixed values of the byte-level scheme: classes of characters (white space as Unicode has it), the endings
# that an apostrophe takes along, and the bytes that stand for themselves as a character; the others follow
# from code point 256 on.
CLASSES = {1: r"\p{L}", 2: r"\p{N}", 3: "[\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000]"}
LETTER, NUMBER, SPACE = CLASSES
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_characters() -> dict[str, int]:
    """Character of each byte in the vocabulary's strings."""
    others = [b for b in range(256) if b not in set(PRINTED)]
    return {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=1)
def character_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or (0) any other."""
    points = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    every, out = "".join(map(chr, points)), np.zeros(len(points), np.uint8)
    for kind, pattern in CLASSES.items():
        for m in regex.finditer(f"{pattern}+", every):
            out[m.start() : m.end()] = kind
    table = np.zeros(0x110000, np.uint8)
    table[points] = out
    return table


def word_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """At which characters words begin. `points` are the code points of all texts, `first` their begins and
    the end of the last.

    A word is a run of letters, of numbers or of other characters with one blank before it, if there is one;
    or an apostrophe and an ending behind no blank; or white space. White space before a word leaves its last
    character to it: as the blank of the word, or else as a word of its own.
    """
    n = len(points)
    if not n:
        return np.zeros(0, bool)
    kind = character_classes()[points]
    begins = np.zeros(n + 1, bool)
    begins[first] = True
    new = begins[:-1].copy()
    new[1:] |= kind[1:] != kind[:-1]
    blank = points == 32
    starts = new.copy()
    # Behind a blank of the same text the word has begun with the blank.
    starts[1:] &= begins[1:-1] | ~blank[:-1] | (kind[1:] == SPACE)
    last_space = np.zeros(n, bool)
    last_space[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begins[1:-1]
    starts |= last_space
    mark = np.flatnonzero((points == 39) & starts & new)
    for ending in ENDINGS:
        size = 1 + len(ending)
        at = mark[mark + size <= n]
        for k, c in enumerate(ending, 1):
            at = at[(points[at + k] == ord(c)) & ~begins[at + k]]
        starts[at + 1] = False
        behind = at + size
        starts[behind[behind < n]] = True
    return starts


class Codec:
    """A vocabulary with its merges, loaded once per worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, byte_of = spec["model"], byte_characters()
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()], default=0)
        self.shift = max(1, (size - 1).bit_length())
        # A pair of ids, as one integer: its rank, and the id of the merged part.
        self.rank: dict[int, int] = {}
        merged = []
        for at, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[left] << self.shift | vocab[right]] = at
            merged.append(vocab[left + right])
        self.merged = np.array([*merged, 0], np.int64)
        pairs = np.array([*self.rank.keys(), 1 << 62], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], np.array([*self.rank.values(), NEVER], np.int64)[order]
        self.byte_ids = np.array([vocab[c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])], np.int64)
        pieces = [b""] * size
        for string, i in vocab.items():
            pieces[i] = bytes(byte_of[c] for c in string)
        for string, i in self.special.items():
            pieces[i] = string.encode()
        self.bytes_of = pa.array(pieces, pa.large_binary())
        # Of added strings that begin at the same place the longest counts.
        listed = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, listed)) + ")") if listed else None

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << self.shift | right
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.ranks[at], NEVER)

    def merge_words(self, words: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words behind one another, and their number per word."""
        sizes = np.asarray(pc.binary_length(words)).astype(np.int64)
        long = np.flatnonzero(sizes > SHORT)
        groups, counts = [], []
        for i in long:
            groups.append(np.array(self.merge_long(words[i].as_py()), np.int64))
        if len(long):
            counts.append((long, np.array([len(g) for g in groups], np.int64)))
            words = words.filter(pa.array(sizes <= SHORT))
        short = np.flatnonzero(sizes <= SHORT)
        for done, parts, n in self.merge_short(words, short, sizes[short]):
            groups.append(parts)
            counts.append((done, n))
        which = np.concatenate([w for w, _ in counts]) if counts else np.zeros(0, np.int64)
        n = np.concatenate([n for _, n in counts]) if counts else np.zeros(0, np.int64)
        pool = np.concatenate(groups) if groups else np.zeros(0, np.int64)
        # From the order in which words were ready to that of the words.
        begins, order = np.cumsum(n) - n, np.argsort(which, kind="stable")
        return pool[_ranges(begins[order], n[order])], n[order]

    def merge_short(self, words: pa.LargeBinaryArray, which: np.ndarray, sizes: np.ndarray):
        """`(word numbers, their ids, ids per word)` in groups, as words get ready."""
        data, places = words.buffers()[2], np.frombuffer(words.buffers()[1], np.int64)
        places = places[words.offset : words.offset + len(words) + 1]
        blob = np.frombuffer(data, np.uint8)[places[0] : places[-1]] if data else np.zeros(0, np.uint8)
        parts = self.byte_ids[blob]
        ranks = np.full(len(parts), NEVER)
        ranks[:-1] = self.rank_of(parts[:-1], parts[1:])
        ranks[np.cumsum(sizes) - 1] = NEVER
        while len(which):
            starts = np.cumsum(sizes) - sizes
            lowest = np.minimum.reduceat(ranks, starts)
            ready = lowest == NEVER
            if ready.any():
                out = np.repeat(ready, sizes)
                yield which[ready], parts[out], sizes[ready]
                parts, ranks, which, sizes, lowest = parts[~out], ranks[~out], which[~ready], sizes[~ready], lowest[~ready]
                starts = np.cumsum(sizes) - sizes
            if not len(which):
                break
            hits = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            at = hits[np.searchsorted(hits, starts)]
            parts[at] = self.merged[lowest]
            # The right part goes; the pair behind it now begins here.
            has_right, has_left = at + 2 < starts + sizes, at > starts
            here = at[has_right]
            ranks[at] = NEVER
            ranks[here] = self.rank_of(parts[here], parts[here + 2])
            here = at[has_left]
            ranks[here - 1] = self.rank_of(parts[here - 1], parts[here])
            kept = np.ones(len(parts), bool)
            kept[at + 1] = False
            parts, ranks, sizes = parts[kept], ranks[kept], sizes - 1

    def merge_long(self, word: bytes) -> list[int]:
        """One word by a heap of (rank, place); an entry is stale when the parts at its place have changed."""
        parts = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        rank, shift, n = self.rank, self.shift, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank.get(parts[i] << shift | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            lowest, i = heapq.heappop(heap)
            j = after[i] if parts[i] >= 0 else n
            if j >= n or rank.get(parts[i] << shift | parts[j]) != lowest:
                continue
            parts[i], parts[j] = int(self.merged[lowest]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := rank.get(parts[left] << shift | parts[right])) is not None:
                    heapq.heappush(heap, (r, left))
        return [p for p in parts if p >= 0]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all UTF-8 texts behind one another, and where each text begins and ends."""
        blob = b"".join(texts)
        if any(s.encode() in blob for s in self.special):
            return self._encode_with_added(texts)
        try:
            points = blob.decode("utf-8")
        except UnicodeDecodeError:
            return self.encode([t.decode("utf-8", "replace").encode() for t in texts])
        data = np.frombuffer(blob, np.uint8)
        points = np.frombuffer(points.encode("utf-32-le"), np.uint32)
        edges = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        words = lead[word_starts(points, np.searchsorted(lead, edges))]
        offsets = pa.py_buffer(np.append(words, len(data)).astype(np.int64))
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, offsets, pa.py_buffer(blob)])
        coded = parts.dictionary_encode()
        flat, lengths = self.merge_words(coded.dictionary)
        at = np.asarray(coded.indices).astype(np.int64)
        begins, sizes = np.cumsum(lengths) - lengths, lengths[at]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        return flat[_ranges(begins[at], sizes)], stops[np.searchsorted(words, edges)]

    def _encode_with_added(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts that hold added strings, each of which is one id."""
        pieces = [self.split.split(t.decode("utf-8", "replace")) for t in texts]
        ids, ends = self.encode([p.encode() for parts in pieces for p in parts[::2]])
        out, stops, k = [], [0], 0
        for parts in pieces:
            for at, part in enumerate(parts):
                if at % 2:
                    out.append(np.array([self.special[part]], np.int64))
                else:
                    out.append(ids[ends[k] : ends[k + 1]])
                    k += 1
            stops.append(stops[-1] + sum(map(len, out[len(out) - len(parts) :])))
        return np.concatenate(out), np.array(stops)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """UTF-8 of each text; bytes that are none become the replacement character."""
        pieces = self.bytes_of.take(pa.array(ids, pa.int64()))
        data = pieces.buffers()[2]
        blob = memoryview(data) if data else memoryview(b"")
        places = np.frombuffer(pieces.buffers()[1], np.int64)[ends] if len(pieces) else np.zeros(len(ends), np.int64)
        found = (bytes(blob[a:b]) for a, b in zip(places[:-1], places[1:]))
        return [b.decode("utf-8", "replace").encode() for b in found]


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each begin on, as many as its size says, behind one another."""
    stops = np.cumsum(sizes)
    return np.repeat(begins - (stops - sizes), sizes) + np.arange(stops[-1] if len(stops) else 0)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _file(df: DataFrame, path: str) -> str:
    """Ship the tokenizer file to the workers; its name there."""
    df.sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode(docs: DataFrame, path: str, text_col: str = "text", carry: list[Column] | None = None) -> DataFrame:
    """`carry` columns with `ids array<int>`, one row per row of `docs`.

    `path`: a byte-level tokenizer file. Added strings such as end-of-text are single ids wherever they
    stand. A null or empty text has no ids. Repeated rows stay, extra columns aren't read, no rows give none.
    """
    rows, name = _rows(docs, text_col, carry), _file(docs, path)
    kept = [f.name for f in rows.schema.fields[:-1]]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, ends = codec(SparkFiles.get(name)).encode(_texts(batch))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.uint32()).cast(pa.int32()))
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], [*kept, "ids"])

    return map_slices(rows, "_text", run, T.StructType([*rows.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", carry: list[Column] | None = None) -> DataFrame:
    """`carry` columns with `text`, the text of each id array; null ids give a null text.

    An id that the tokenizer doesn't have fails the job.
    """
    rows = encoded.select(*(carry or []), F.col(ids_col).cast("array<int>").alias("_ids"))
    name, kept = _file(encoded, path), [f.name for f in rows.schema.fields[:-1]]

    def run(batches):
        for batch in batches:
            # Tokens are a few bytes each: bounded steps keep the decoded bytes small.
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                lists = part.column(part.num_columns - 1)
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))])
                texts = codec(SparkFiles.get(name)).decode(ids, ends.astype(np.int64))
                found = pa.array([t.decode() if v.is_valid else None for t, v in zip(texts, lists)], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], found], [*kept, "text"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], T.StructField("text", T.StringType())]))


def round_trip(docs: DataFrame, path: str, text_col: str = "text", carry: list[Column] | None = None) -> DataFrame:
    """`carry` columns with `n_tokens`, and lower-case hex SHA-256 of the ids (little-endian unsigned 32 bits
    each) and of the decoded text's UTF-8.

    Encodes and decodes in one pass over the texts, so that neither ids nor decoded texts leave a task.
    """
    rows, name = _rows(docs, text_col, carry), _file(docs, path)
    kept = [f.name for f in rows.schema.fields[:-1]]
    fields = T.StructType.fromDDL("n_tokens long, ids_sha256 string, decoded_sha256 string").fields

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(SparkFiles.get(name))
        ids, ends = own.encode(_texts(batch))
        blob = memoryview(ids.astype("<u4").tobytes())
        hexes = lambda parts: pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())
        found = [
            pa.array(np.diff(ends), pa.int64()),
            hexes(blob[4 * a : 4 * b] for a, b in zip(ends[:-1], ends[1:])),
            hexes(own.decode(ids, ends)),
        ]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], [*kept, *(f.name for f in fields)])

    return map_slices(rows, "_text", run, T.StructType([*rows.schema.fields[:-1], *fields]))


def _rows(docs: DataFrame, text_col: str, carry: list[Column] | None) -> DataFrame:
    return docs.select(*(carry or []), F.coalesce(docs[text_col], F.lit("")).alias("_text"))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column(batch.num_columns - 1).cast(pa.large_binary()).to_pylist()
