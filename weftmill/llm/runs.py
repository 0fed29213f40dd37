"""Periodic runs of words: stretches that repeat with some period, found by splitting at rare words.

A word of a run occurs at least twice in it. So a word that occurs once within the current segment can't
belong to a run there and splits the segment; the parts are split again until no segment changes, and only
these surviving segments are scanned, lag by lag. Texts are worked on inside their row.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftmill.llm.texts import map_slices

MIN_LENGTH = 12
# Splitting goes on for all segments at once while a round takes away at least this share of their words,
# and then segment by segment with counts that are kept up.
ROUND_SHARE = 1 / 16
# Anchors that the lag scan looks at together, and words that have to match around one before its stretch
# is followed.
LAG_ANCHORS = 1 << 18
PROBE = 6

Run = tuple[int, int, int]
Segment = tuple[int, int]


def surviving_segments(words: np.ndarray, first: np.ndarray) -> list[Segment]:
    """Segments `(start, end)` in which every word occurs twice or more, of at least `MIN_LENGTH` words.

    `words` are word numbers of all texts, `first` where each text begins, and the end of the last.
    """
    at = np.arange(len(words))
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    done: list[Segment] = []
    while len(at):
        # Segments are runs of `owner`; `at` are the places of the words that are left.
        _, which, counts = np.unique(owner * np.int64(words.max() + 1) + words[at], return_inverse=True, return_counts=True)
        rare = counts[which] < 2
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        ends = np.append(starts[1:], len(at))
        touched = np.add.reduceat(rare, starts) > 0
        done += [(int(at[a]), int(at[b - 1]) + 1) for a, b in zip(starts[~touched], ends[~touched]) if b - a >= MIN_LENGTH]
        sizes = ends - starts
        going = np.repeat(touched, sizes)
        if rare.sum() < ROUND_SHARE * going.sum():
            for a, b in zip(starts[touched], ends[touched]):
                done += _split_one(words, int(at[a]), int(at[b - 1]) + 1)
            break
        # A new segment begins where the segment changes and behind every rare word.
        part = np.cumsum(np.concatenate([[0], (owner[1:] != owner[:-1]) | rare[:-1]]))
        kept = going & ~rare
        at, part = at[kept], part[kept]
        if len(at):
            _, which, counts = np.unique(part, return_inverse=True, return_counts=True)
            long = counts[which] >= MIN_LENGTH
            at, owner = at[long], which[long]
    return sorted(done)


def _split_one(words: np.ndarray, lo: int, hi: int) -> list[Segment]:
    """The same for one segment. When it falls into parts the longest one takes over the counts, less those
    of the others, so a word is looked at only log n times however deep the splitting goes."""
    own = words[lo:hi].tolist()
    places: dict[int, list[int]] = defaultdict(list)
    for i, w in enumerate(own):
        places[w].append(i)
    counts = Counter(own)
    todo = [(0, len(own), counts, [places[w][0] for w, n in counts.items() if n == 1])]
    done = []
    while todo:
        start, end, counts, rare = todo.pop()
        if end - start < MIN_LENGTH:
            continue
        if not rare:
            done.append((lo + start, lo + end))
            continue
        bounds = [start - 1, *sorted(rare), end]
        parts = [(a + 1, b) for a, b in zip(bounds, bounds[1:])]
        longest = max(parts, key=lambda p: p[1] - p[0])
        for a, b in parts:
            if (a, b) != longest:
                some = Counter(own[a:b])
                todo.append((a, b, some, [places[w][bisect_left(places[w], a)] for w, n in some.items() if n == 1]))
                counts.subtract(some)
        a, b = longest
        changed = {own[i] for p, q in parts if (p, q) != longest for i in range(p, q)} | {own[i] for i in rare}
        counts.subtract([own[i] for i in rare])
        left = [places[w][bisect_left(places[w], a)] for w in changed if counts[w] == 1]
        todo.append((a, b, counts, left))
    return done


def _lags(n: int) -> list[tuple[int, int]]:
    """Ranges of lags from 1 to n / 2 with about `LAG_ANCHORS` anchors each."""
    out, lag = [], 1
    while lag <= n // 2:
        end = min(n // 2 + 1, lag + max(1, LAG_ANCHORS * lag // n))
        out.append((lag, end))
        lag = end
    return out


def _anchors(w: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """`(lag, place)` of all lags in [lo, hi) and all multiples of the lag at which w repeats at that lag.

    A run of period q has q or more consecutive places at which it repeats, so it holds a multiple of q.
    """
    n, lags, places = len(w), [], []
    if n // lo < hi - lo:
        for j in range(n // lo):
            # For one multiple j all lags at once: places j * q and (j + 1) * q.
            end = min(hi, (n - 1) // (j + 1) + 1)
            if end > lo:
                here = w[j * lo : j * (end - 1) + 1 : j] if j else np.full(end - lo, w[0])
                q = lo + np.flatnonzero(here == w[(j + 1) * lo : (j + 1) * (end - 1) + 1 : j + 1])
                lags.append(q)
                places.append(j * q)
    else:
        for q in range(lo, hi):
            i = q * np.flatnonzero(w[: n - q : q] == w[q::q])
            lags.append(np.full(len(i), q))
            places.append(i)
    return np.concatenate(lags), np.concatenate(places)


def _probed(w: np.ndarray, lag: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether words repeat before or behind the place as a run needs: it has at least
    max(lag, MIN_LENGTH - lag) places in a row, so half of them, up to `PROBE`, on one side."""
    n = len(w)
    need = np.minimum((np.maximum(lag, MIN_LENGTH - lag) + 1) // 2, PROBE)
    ahead, back = np.ones(len(lag), bool), np.ones(len(lag), bool)
    for k in range(1, PROBE):
        asked = k < need
        i, j = place + k, place - k
        same = (i + lag < n) & (w[np.minimum(i, n - 1)] == w[np.minimum(i + lag, n - 1)])
        ahead &= same | ~asked
        same = (j >= 0) & (w[np.maximum(j, 0)] == w[np.minimum(np.maximum(j, 0) + lag, n - 1)])
        back &= same | ~asked
    return ahead | back


def _follow(w: np.ndarray, i: int, lag: int, step: int) -> int:
    """Number of places from i on (or up to i, with step -1) at which w repeats at the lag."""
    size, total, n = 32, 0, len(w)
    while True:
        if step > 0:
            a, b = i + total, min(i + total + size, n - lag)
            same = w[a:b] == w[a + lag : b + lag]
        else:
            b, a = i - total + 1, max(i - total + 1 - size, 0)
            same = (w[a:b] == w[a + lag : b + lag])[::-1]
        if b <= a:
            return total
        if not same.all():
            return total + int(np.argmin(same))
        total += b - a
        size *= 2


def lag_scan(w: np.ndarray) -> list[Run]:
    """All runs `(start, length, period)` of one segment, by start and period.

    Lags ascend. A stretch that also repeats at a smaller lag is a run of that lag, which divides this one;
    it has been entered for all its multiples and isn't followed again.
    """
    found: list[Run] = []
    entered: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for lo, hi in _lags(len(w)):
        lag, place = _anchors(w, lo, hi)
        good = _probed(w, lag, place)
        lag, place = lag[good], place[good]
        order = np.lexsort((place, lag))
        lag, place = lag[order], place[order]
        at = 0
        for q in np.unique(lag).tolist():
            until = int(np.searchsorted(lag, q, "right"))
            here = place[at:until]
            at = until
            for a, b in entered.pop(q, ()):
                here = here[(here < a) | (here >= b - q)]
            k = 0
            while k < len(here):
                i = int(here[k])
                ahead, back = _follow(w, i, q, 1), _follow(w, i, q, -1)
                start, end = i - back + 1, i + ahead + q
                if end - start >= max(MIN_LENGTH, 2 * q):
                    found.append((start, end - start, q))
                    for multiple in range(2 * q, (end - start) // 2 + 1, q):
                        entered[multiple].append((start, end))
                k = int(np.searchsorted(here, i + ahead))
    return sorted(found, key=lambda r: (r[0], r[2]))


def find_runs(words: np.ndarray, first: np.ndarray) -> list[list[Run]]:
    """Runs of each text; starts count from the text's first word."""
    out: list[list[Run]] = [[] for _ in range(len(first) - 1)]
    for a, b in surviving_segments(words, first):
        text = int(np.searchsorted(first, a, "right")) - 1
        shift = a - int(first[text])
        out[text].extend((shift + s, n, q) for s, n, q in lag_scan(words[a:b]))
    return out


def planted_tail(first: np.ndarray, ids: list[int | None]) -> np.ndarray:
    """Which word stands at each place: in one text of ten, by the CRC-32 of its id, the words from some place
    on repeat the stretch that begins there. A null id leaves its text as it is."""
    import zlib

    places = np.arange(first[-1])
    for a, b, i in zip(first[:-1].tolist(), first[1:].tolist(), ids):
        h = 1 if i is None else zlib.crc32(str(i).encode())
        if h % 10 == 0 and b > a:
            g, n = h // 10, b - a
            start = g % n
            period = 1 + (n - start) // (3 + g % 8)
            places[a + start : b] = a + start + np.arange(n - start) % period
    return places


class TextWords:
    """Words of a batch of texts: numbers (equal words, equal numbers), the different words, and bounds."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        flat = lists.flatten()
        kept = np.asarray(pc.binary_length(flat)) > 0
        ends = np.concatenate([[0], np.cumsum(kept)])
        self.first = ends[np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists)))])]
        coded = flat.filter(pa.array(kept)).dictionary_encode()
        self.words, self.different = np.asarray(coded.indices).astype(np.int64), coded.dictionary

    def joined(self, places: np.ndarray, keep: np.ndarray) -> pa.Array:
        """The kept words of each text, joined by one space."""
        ends = np.concatenate([[0], np.cumsum(keep)])[self.first]
        chosen = self.different.take(pa.array(self.words[places[keep]]))
        return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), chosen), pa.scalar(" ", pa.large_string()))


FIELDS = (
    "n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string,"
    " collapsed_sha256 string"
)


def periodic_runs(
    docs: DataFrame, text_col: str = "text", carry: list[Column] | None = None, plant_by: Column | None = None,
    with_details: bool = False,
) -> DataFrame:
    """`carry` columns with `n_words`, `n_runs`, the longest run's `start`, `length`, `period` and
    `exponent_milli`, `runs_sha256` and `collapsed_sha256`, one row per row of `docs`.

    A run is a stretch of `MIN_LENGTH` or more consecutive words and of two or more of its smallest period
    that can't be made longer. Of the longest ones the first counts, then the one of the smallest period;
    without a run the four are null. The hashes are lower-case hex SHA-256 of `start,length,period` lines
    and of the words that remain when each run keeps its first period only. `with_details` adds the `runs`
    and the `collapsed` text themselves. With `plant_by`, an id, repeated tails are planted first (see
    `planted_tail`).

    Words lie between blanks as in `texts.WORD`. Null and empty texts have no word. Repeated rows stay,
    extra columns aren't read, no rows give none. A text is one task's work, about n log n of its words.
    """
    own = F.lit(None).cast("long") if plant_by is None else plant_by.cast("long")
    rows = docs.select(*(carry or []), own.alias("_id"), docs[text_col].alias("_text"))
    kept = [f.name for f in rows.schema.fields[:-2]]
    more = ", runs array<struct<start: long, length: long, period: long>>, collapsed string" if with_details else ""
    fields = T.StructType.fromDDL(FIELDS + more).fields
    plants = plant_by is not None

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = TextWords(batch.column(batch.num_columns - 1))
        first, ids = texts.first, batch.column(batch.num_columns - 2).to_pylist()
        places = planted_tail(first, ids) if plants else np.arange(first[-1])
        found = find_runs(texts.words[places], first)
        keep = np.ones(len(places), bool)
        for a, runs in zip(first.tolist(), found):
            for s, n, q in runs:
                keep[a + s + q : a + s + n] = False
        collapsed = texts.joined(places, keep)
        columns = summary(found, np.diff(first), collapsed)
        if with_details:
            details = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
            columns += [pa.array(details, pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])))]
            columns += [collapsed.cast(pa.string())]
        return pa.RecordBatch.from_arrays([*batch.columns[:-2], *columns], [*kept, *(f.name for f in fields)])

    return map_slices(rows, "_text", run, T.StructType([*rows.schema.fields[:-2], *fields]))


def summary(found: list[list[Run]], n_words: np.ndarray, collapsed: pa.Array) -> list[pa.Array]:
    """The columns of `FIELDS`."""
    best = [min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None) for runs in found]
    lines = ["".join(f"{s},{n},{q}\n" for s, n, q in runs) for runs in found]
    blob, ends = collapsed.buffers()[2], np.frombuffer(collapsed.buffers()[1], np.int64)[: len(collapsed) + 1]
    data = memoryview(blob) if blob else memoryview(b"")
    hashed = [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])]
    long = lambda values: pa.array(values, pa.int64())
    return [
        long(n_words),
        long(list(map(len, found))),
        *(long([b[k] for b in best]) for k in range(3)),
        long([None if n is None else 1000 * n // q for _, n, q in best]),
        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in lines]),
        pa.array(hashed, pa.string()),
    ]
