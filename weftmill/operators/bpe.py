"""Byte-pair merging of distinct parts.

Rule: among all adjacent symbol pairs whose concatenation is in the vocabulary, take the lowest
token id; merge every occurrence of that string, left to right and without overlap; repeat until
no pair is known.

Spark form: a vocabulary that can be broadcast goes to the tasks as pair table, and all parts of a batch are merged
together there (see `functions.merging`); nothing is exploded or shuffled. Beyond that bound a symbol can still only
become a substring of its part, so all vocabulary hits of a part are found up front by ONE join of its substrings (no
longer than the longest vocabulary entry) with the vocabulary, and the merges run inside the row over that small hit
map, without a driver loop. The trace goes that second way, but for long parts.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftmill.functions import merging
from weftmill.functions.bytesym import encoder_rows, symbols
from weftmill.lineage import fits, salted_join

# Up to this many symbols the boundaries of a part (one more than symbols) fit in the bits of one
# BIGINT, and the merges run as array functions inside the JVM. Longer parts (data URIs, base64,
# unspaced scripts) go through `Merge`, which is n log n. Both ways are exact.
LONG_PART = 62

_BOUNDS = T.ArrayType(T.LongType())
_MERGED = T.StructType(
    [T.StructField("bounds", _BOUNDS), T.StructField("multi", T.ArrayType(T.IntegerType()))]
)
_STEPS = T.ArrayType(
    T.StructType([T.StructField("token", T.IntegerType()), T.StructField("bounds", _BOUNDS)])
)


def _words(vocab: DataFrame) -> tuple[DataFrame, bool]:
    """Vocabulary entries of two or more symbols, and whether they may be broadcast."""
    words = vocab.filter(F.length("cluster") > 1).select("token", "cluster")
    return words, fits(words, F.octet_length("cluster"))


def _hits(parts: DataFrame, vocab: DataFrame, carry: list[str]) -> DataFrame:
    """`(part, carry, s, hits)`: symbol string, and every vocabulary substring of two or more
    symbols as `(token, start, end)`. With a vocabulary that can be broadcast, long parts have no
    hits: their pairs are looked up where they are merged."""
    longest = vocab.agg(F.max(F.length("cluster")).alias("n")).first()["n"] or 1
    words, shared = _words(vocab)
    is_long = f"length(s) > {LONG_PART}" if shared else "false"
    # One span (0, 0) per part survives the join without a hit, so that no part is lost.
    spans = F.expr(
        f"""concat(array(struct(0 AS start, 0 AS end, '' AS cluster)),
              if(length(s) < 2 OR {longest} < 2 OR {is_long}, array(),
                flatten(transform(sequence(0, length(s) - 2), i ->
                  transform(sequence(2, greatest(2, least({longest}, length(s) - i))), k ->
                    struct(i AS start, i + k AS end, substring(s, i + 1, k) AS cluster))))))"""
    )
    # The symbol string is made again after the regrouping instead of travelling in every row.
    keys = ["part", *carry]
    base = parts.filter(F.length("part") > 0).select(*keys)
    exploded = base.withColumn("s", symbols("part")).select(*keys, F.explode(spans).alias("_x")).select(*keys, "_x.*")
    if shared:
        # Most substrings are no token: they go right after the join, before the regrouping.
        joined = exploded.join(F.broadcast(words), "cluster", "left").filter(
            "token IS NOT NULL OR end = 0"
        )
    else:
        found = salted_join(exploded.filter("end > 0"), words, "cluster", ["part", "start"])
        joined = found.select(*keys, "start", "end", "token").unionByName(
            base, allowMissingColumns=True
        )
    hit = F.when(F.col("token").isNotNull(), F.struct("token", "start", "end"))
    grouped = joined.groupBy(*keys).agg(F.collect_list(hit).alias("hits"))
    return grouped.select(*keys, symbols("part").alias("s"), "hits")


def _single_token(vocab: DataFrame, symbol: str) -> str:
    """Array expression: token id of a one-symbol cluster, null if unknown. The symbols are the 256
    of the byte map, so this lookup is a constant of the plan."""
    alphabet = [c for c, _byte in encoder_rows()]
    known = vocab.filter(F.col("cluster").isin(alphabet)).select("cluster", "token").collect()
    token = {r["cluster"]: r["token"] for r in known}
    ids = ",".join(str(token.get(c, "null")) for c in alphabet)
    # The quote and the backslash of the alphabet are escaped for the SQL literal.
    letters = "".join("\\" + c if c in "'\\" else c for c in alphabet)
    return f"get(array({ids}), instr('{letters}', {symbol}) - 1)"


def _merge_sql(trace: bool) -> str:
    """Array expression over `s` and `hits`: the list of symbol boundaries after all merges, or with
    `trace` one `(token, bounds)` entry per step.

    Bit i of `mask` says that a symbol starts at i (or that the part ends there). A hit is an
    adjacent pair when both its ends are boundaries with exactly one boundary between them. One
    step is one pass over the hits by (token, start): the first adjacent pair names the winner,
    and the other hits of that token follow right after it, from left to right; a merge clears
    the boundary inside, which also rules out an overlapping pair.
    """
    by_token = """transform(sort_array(hits), h -> named_struct('token', h.token,
        'ends', shiftleft(1L, h.start) | shiftleft(1L, h.end),
        'inner', shiftleft(1L, h.end) - shiftleft(1L, h.start + 1)))"""
    step = """aggregate(found, named_struct('mask', acc.mask, 'best', cast(null as int)),
        (a, h) -> if((a.best is null or a.best = h.token) and (a.mask & h.ends) = h.ends
                       and bit_count(a.mask & h.inner) = 1,
                     named_struct('mask', a.mask & ~h.inner, 'best', h.token), a))"""
    bounds = "filter(sequence(0L, cast(length(s) as bigint)), i -> getbit({mask}, cast(i as int)) = 1)"
    start = "shiftrightunsigned(-1L, 63 - length(s))"
    no_steps = "cast(array() as array<struct<token:int,mask:bigint>>)"
    first = f"array(named_struct('token', cast(null as int), 'mask', {start}))"
    keep = "array_append(acc.steps, named_struct('token', n.best, 'mask', n.mask))"
    # As many passes as there can be merges; after the last merge a pass costs nothing.
    loop = f"""aggregate(sequence(1, length(s)),
        named_struct('mask', {start}, 'go', size(found) > 0, 'steps', {first if trace else no_steps}),
        (acc, _i) -> if(not acc.go, acc,
          transform(array({step}), n ->
            if(n.best is null, named_struct('mask', acc.mask, 'go', false, 'steps', acc.steps),
               named_struct('mask', n.mask, 'go', true, 'steps', {keep if trace else "acc.steps"})))[0]))"""
    done = (
        "transform(r.steps, t -> named_struct('token', t.token, 'bounds', "
        + bounds.format(mask="t.mask")
        + "))"
        if trace
        else bounds.format(mask="r.mask")
    )
    return f"transform(array({by_token}), found -> transform(array({loop}), r -> {done})[0])[0]"


class Merge:
    """Merges of one long part of `n` symbols. `token_of(i, j)` is the token of symbols i to j - 1,
    null if there is none."""

    def __init__(self, n: int, token_of: Callable[[int, int], int | None]):
        self.n, self.token_of = n, token_of
        self.after = list(range(1, n + 1))
        self.before = list(range(-1, n - 1))
        self.alive = [True] * n

    def bounds(self) -> list[int]:
        return [*(i for i in range(self.n) if self.alive[i]), self.n]

    def _pair(self, i: int) -> int | None:
        middle = self.after[i]
        return self.token_of(i, self.after[middle]) if middle < self.n else None

    def steps(self) -> Iterator[int]:
        """Run the merges; yields the token of every step after it is done."""
        n, after, before, alive, pair = self.n, self.after, self.before, self.alive, self._pair
        queue = [(t, i) for i in range(n) if (t := pair(i)) is not None]
        heapq.heapify(queue)
        while queue:
            # All occurrences of the winner are taken out before any new pair goes in: a merge may
            # create a pair of lower id, which has to wait for the next step.
            token, merged, found = queue[0][0], False, []
            while queue and queue[0][0] == token:
                found.append(heapq.heappop(queue)[1])
            for i in found:
                if not alive[i] or pair(i) != token:
                    continue
                gone = after[i]
                alive[gone], after[i], merged = False, after[gone], True
                if after[i] < n:
                    before[after[i]] = i
                for j in (before[i], i):
                    if j >= 0 and (t := pair(j)) is not None:
                        heapq.heappush(queue, (t, j))
            if merged:
                yield token


def _merged(n: int, token_of: Callable[[int, int], int | None]) -> dict:
    work = Merge(n, token_of)
    for _token in work.steps():
        pass
    bounds = work.bounds()
    return {"bounds": bounds, "multi": [token_of(a, b) if b - a > 1 else None for a, b in zip(bounds, bounds[1:])]}


def _traced(n: int, token_of: Callable[[int, int], int | None]) -> list[dict]:
    work = Merge(n, token_of)
    steps = [{"token": None, "bounds": work.bounds()}]
    return steps + [{"token": t, "bounds": work.bounds()} for t in work.steps()]


_LONG_MERGED = pa.struct([("bounds", pa.list_(pa.int64())), ("multi", pa.list_(pa.int32()))])
_LONG_TRACED = pa.list_(pa.struct([("token", pa.int32()), ("bounds", pa.list_(pa.int64()))]))


def _with_long(found: DataFrame, vocab: DataFrame, kind: T.DataType, arrow: pa.DataType, merge) -> DataFrame:
    """Add `_long`, the result of `merge` for long parts. One branch over all parts, with null
    arguments for the short ones: a union of two filtered branches would scan the text twice."""
    words, shared = _words(vocab)
    is_long = F.length("s") > LONG_PART
    if shared:
        entries = {r["cluster"]: r["token"] for r in words.toLocalIterator()}
        longest = max(map(len, entries), default=0)
        table = found.sparkSession.sparkContext.broadcast(entries)

        @F.arrow_udf(kind)
        def by_vocabulary(strings: pa.Array) -> pa.Array:
            known = table.value

            def one(s: str):
                return merge(len(s), lambda i, j: known.get(s[i:j]) if j - i <= longest else None)

            return pa.array([None if s is None else one(s) for s in strings.to_pylist()], arrow)

        return found.withColumn("_long", by_vocabulary(F.when(is_long, F.col("s"))))

    @F.arrow_udf(kind)
    def by_hits(length: pa.Array, hits: pa.Array) -> pa.Array:
        out = []
        for n, row in zip(length.to_pylist(), hits.to_pylist()):
            spans = {(h["start"], h["end"]): h["token"] for h in row or ()}
            out.append(None if n is None else merge(n, lambda i, j, spans=spans: spans.get((i, j))))
        return pa.array(out, arrow)

    return found.withColumn("_long", by_hits(F.when(is_long, F.length("s")), F.when(is_long, F.col("hits"))))


def _per_cluster(bounds: str, value: str) -> str:
    """Array expression: `value` for every cluster `(lo, hi)` between two boundaries."""
    return f"""transform(array({bounds}), b -> transform(
        transform(sequence(0, size(b) - 2), i -> named_struct('i', i, 'lo', cast(b[i] as int), 'hi', cast(b[i + 1] as int))),
        c -> {value}))[0]"""


_CLUSTER = "substring(s, c.lo + 1, c.hi - c.lo)"


def pair_table(vocab: DataFrame) -> Broadcast | None:
    """The broadcast `merging.PairTable` of a vocabulary; None beyond the broadcast bound."""
    if not _words(vocab)[1]:
        return None
    entries = vocab.select("cluster", "token").collect()
    return vocab.sparkSession.sparkContext.broadcast(merging.PairTable((r["cluster"], r["token"]) for r in entries))


def merged_together(parts: DataFrame, table: Broadcast) -> DataFrame:
    """`parts` with `clusters` and `tokens`. Rows leave the task a slice at a time, whatever the length of parts."""

    def run(batches):
        for batch in batches:
            strings = batch["part"]
            sizes = [0, *np.cumsum(pc.binary_length(strings).to_numpy(zero_copy_only=False))]
            for lo, hi in merging.slices(np.array(sizes), merging.SLICE_SYMBOLS):
                rows = batch.slice(lo, hi - lo)
                found = merging.clusters_and_tokens(table.value, rows["part"])
                yield pa.RecordBatch.from_arrays([*rows.columns, *found], [*rows.schema.names, "clusters", "tokens"])

    added = [T.StructField("clusters", T.ArrayType(T.StringType())), T.StructField("tokens", T.ArrayType(T.IntegerType()))]
    return parts.mapInArrow(run, T.StructType([*parts.schema.fields, *added]))


def merge_parts(parts: DataFrame, vocab: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """One row per distinct part: `(part, carry, clusters, tokens)`.

    `parts` must be unique on `part`. `clusters` are the final symbols in order, `tokens` their
    ids; a symbol without an id stays in `clusters` and is null in `tokens`.
    """
    carry = carry or []
    table = pair_table(vocab)
    if table is not None:
        return merged_together(parts.filter(F.length("part") > 0).select("part", *carry), table)
    found = _with_long(_hits(parts, vocab, carry), vocab, _MERGED, _LONG_MERGED, _merged)
    multi = _per_cluster("bounds", "get(filter(hits, h -> h.start = c.lo and h.end = c.hi), 0).token")
    is_short = f"length(s) <= {LONG_PART}"
    found = found.withColumn("bounds", F.expr(f"if({is_short}, {_merge_sql(False)}, _long.bounds)"))
    found = found.withColumn("multi", F.expr(f"if({is_short}, {multi}, _long.multi)"))
    single = _single_token(vocab, "substring(s, c.lo + 1, 1)")
    # `multi` is bound outside the lambda over the clusters, or it would be built again in each.
    token = _per_cluster("bounds", f"if(c.hi - c.lo = 1, {single}, ids[c.i])")
    token = f"transform(array(multi), ids -> {token})[0]"
    return found.select(
        "part",
        *carry,
        F.expr(_per_cluster("bounds", _CLUSTER)).alias("clusters"),
        F.expr(token).alias("tokens"),
    )


def bpe_merge(parts: DataFrame, vocab: DataFrame) -> DataFrame:
    """`(part, position, cluster)`: final symbols of each distinct part, positions from 1."""
    return (
        merge_parts(parts, vocab)
        .select("part", F.posexplode("clusters").alias("_i", "cluster"))
        .select("part", (F.col("_i") + 1).alias("position"), "cluster")
    )


def bpe_trace(parts: DataFrame, vocab: DataFrame) -> DataFrame:
    """`(part, step, token, combined, symbols)`: the state after every merge; step 1 is the
    unmerged part, with null token and string."""
    found = _with_long(_hits(parts, vocab, []), vocab, _STEPS, _LONG_TRACED, _traced)
    merged = F.expr(f"if(length(s) <= {LONG_PART}, {_merge_sql(True)}, _long)")
    steps = found.select("part", "s", F.posexplode(merged).alias("_i", "_step"))
    steps = steps.select(
        "part", "s", (F.col("_i") + 1).alias("step"), F.col("_step.token").alias("token"),
        F.col("_step.bounds").alias("bounds"),
    )
    named = steps.select("part", "step", "token", F.expr(_per_cluster("bounds", _CLUSTER)).alias("symbols"))
    words = vocab.select("token", F.col("cluster").alias("combined"))
    hint = F.broadcast(words) if fits(words, F.octet_length("combined")) else words
    return named.join(hint, "token", "left").select("part", "step", "token", "combined", "symbols")
