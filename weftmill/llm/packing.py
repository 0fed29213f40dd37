"""Packing token pieces into sequences by minimum bin slack.

Bins only see lengths, and there are at most `capacity` different ones. So Spark counts pieces per
length, the bins are made from that table (at most `capacity` rows, whatever the corpus), and pieces
find their bin by their rank among the pieces of the same length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftmill.lineage import cut
from weftmill.llm.texts import Words, map_slices, with_fields

# Pieces of one (length, bucket) group on average, if all had the same length.
BUCKET_ROWS = 5_000
# Words whose ids a worker remembers before it starts anew.
MEMO_WORDS = 300_000

PIECES_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"

# Punctuation that is a pre-token of its own after an ASCII letter.
TAILS = b".,;:!?|#$%&*"


class Encoder:
    """Token ids of whole texts from those of their words, which are remembered per worker.

    The tokenizer folds case, drops white space and never joins across it, nor across a letter and
    punctuation after it. So a text's ids are the ids of its words in lower case, one after the other,
    and only words that are new are tokenized: pure letter words many at a time, since each of them ends
    with its only token that closes a word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.closing = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.closing[number] = token.endswith("</w>")
        self.known: dict[bytes, bytes] = {}

    def ids(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        words = Words(texts, tails=TAILS)
        at, which = words.distinct()
        data = words.data.tobytes()
        different = [data[a:b] for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist())]
        if len(self.known) + len(different) > MEMO_WORDS:
            self.known.clear()
        known = self.known
        self._learn([w for w in different if w not in known])
        parts = [known[w] for w in different]
        size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        pool = np.frombuffer(b"".join(parts), "<u4")
        # The tokens of all words in order: where each word's ids lie in the pool, and where they go.
        n = size[which]
        stops = np.cumsum(n)
        source = np.repeat((np.cumsum(size) - size)[which] - (stops - n), n) + np.arange(n.sum())
        blob = pool[source].tobytes()
        edges = 4 * np.concatenate([[0], stops])[words.first]
        found = [blob[a:b] for a, b in zip(edges.tolist(), edges[1:].tolist())]
        # Texts that may hold a special token, which isn't bound to words and cares for case.
        for i in np.flatnonzero(pc.fill_null(pc.match_substring(texts, "<|"), False)):
            whole = self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False)
            found[i] = np.array(whole.ids, "<u4").tobytes()
        return found

    def _learn(self, words: list[bytes]) -> None:
        strings = [w.decode() for w in words]
        letters = [i for i, w in enumerate(strings) if w.isalpha()]
        other = [i for i, w in enumerate(strings) if not w.isalpha()]
        for start in range(0, len(letters), 2000):
            some = letters[start : start + 2000]
            joined = self.tokenizer.encode("\n".join([strings[i] for i in some]), add_special_tokens=False)
            ids = np.array(joined.ids, "<u4")
            stops = np.flatnonzero(self.closing[ids]) + 1
            if len(stops) != len(some):  # a letter whose lower case isn't letters alone
                other += some
                continue
            blob, begin = ids.tobytes(), 0
            for i, stop in zip(some, (4 * stops).tolist()):
                self.known[words[i]] = blob[begin:stop]
                begin = stop
        for start in range(0, len(other), 2000):
            some = other[start : start + 2000]
            found = self.tokenizer.encode_batch([strings[i] for i in some], add_special_tokens=False)
            self.known.update((words[i], np.array(e.ids, "<u4").tobytes()) for i, e in zip(some, found))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int,
    separator: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """`(doc_id, piece, start, length, ids_crc32[, ids])`: token ids and one separator per document.

    Documents longer than `capacity` tokens are cut into pieces of that length; only the last piece
    may be shorter. A null or empty text is the separator alone. `ids` are bytes, four per token.
    """
    end = np.array([separator], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows: list[list] = [[], [], [], [], [], []]
        all_ids = encoder(tokenizer_path).ids(batch.column("text"))
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), all_ids):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                own = ids[at : at + 4 * capacity]
                for column, value in zip(rows, (doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own), own)):
                    column.append(value)
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        n = 6 if with_ids else 5
        return pa.record_batch([pa.array(c, t) for c, t in zip(rows[:n], types)], names=names[:n])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_slices(rows, "text", run, PIECES_SCHEMA + (", ids binary" if with_ids else ""))


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths (descending, each at most `counts` times) with the largest sum that is at most `room`.

    `reach` has bit s set if some combination sums to s; a length with n copies is added in runs of
    1, 2, 4 ... copies. Stops as soon as `room` itself is reached.
    """
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in lengths:
        if length > room:
            continue
        steps.append((length, reach))
        left, run = min(counts[length], room // length), 1
        while left:
            run = min(run, left)
            reach |= (reach << (length * run)) & mask
            left -= run
            run *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        n = 0
        while not before >> total & 1:
            total -= length
            n += 1
        if n:
            used[length] = n
    return used


def bins(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """`(lengths of a bin with their number, number of such bins)`.

    Each bin takes the longest piece that is left and the fullest combination for the room beside
    it; the bin is repeated as often as the pieces suffice, then taken from the table.
    """
    counts = {length: n for length, n in histogram.items() if n}
    lengths = sorted(counts, reverse=True)
    out = []
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        used = fullest(lengths, counts, capacity - longest)
        counts[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(counts[length] // n for length, n in used.items())
        for length, n in used.items():
            counts[length] -= n * times
            if not counts[length]:
                del counts[length]
        lengths = [length for length in lengths if length in counts]
        out.append((used, times))
    return out


def _places(found: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """Bins as sorted lookup arrays: pieces of a length with ranks from `rank` on fill `each` places
    per bin, from bin `bin` and from offset `offset` on."""
    next_rank: dict[int, int] = {}
    rows, first_bin = [], 0
    for used, times in found:
        offset = 0
        for length in sorted(used, reverse=True):
            n, rank = used[length], next_rank.get(length, 0)
            rows.append((length, rank, n, first_bin, offset))
            next_rank[length] = rank + n * times
            offset += n * length
        first_bin += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "each", "bin", "offset"), table.T))


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """`pieces` (see `cut_pieces`; any further columns stay) with `sequence_id` and `offset`.

    Equal pieces are interchangeable; otherwise the result depends on the rows alone, not on
    partitions. The frequent lengths (full pieces above all) are ranked in buckets by hash.
    """
    n = pieces.count()
    buckets = max(1, -(-n // BUCKET_ROWS))
    names = pieces.columns
    rows = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    sums = cut(rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")))
    histogram = {r["length"]: r["n"] for r in sums.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    table = sums.sparkSession.sparkContext.broadcast(_places(bins(histogram, capacity)))

    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("length", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    group = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = rows.withColumn("_rank", F.row_number().over(group)).join(before, ["length", "_bucket"])
    ranked = ranked.select(*names, (F.col("_rank") - 1 + F.col("_before")).cast("long").alias("_rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        step = np.int64(1) << np.int64(40)
        keys = t["length"] * step + t["rank"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            at = np.searchsorted(keys, length * step + rank, "right") - 1
            inside = rank - t["rank"][at]
            bin_id = t["bin"][at] + inside // t["each"][at]
            offset = t["offset"][at] + inside % t["each"][at] * length
            kept = [batch.column(c) for c in names]
            yield pa.record_batch([*kept, pa.array(bin_id), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(run, with_fields(pieces.schema[:], "sequence_id long, offset long"))
