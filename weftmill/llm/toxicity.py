"""Toxicity by class-conditional Kneser-Ney models.

Toxic and ordinary labelled texts each give a Kneser-Ney bigram model. All its counts are counts of
distinct contexts (pairs by the word before them, words by the pair's first word), so what copies
repeat counts once. Both fall back on one shared distribution, so an expression that is rare in both
says nothing. A text's evidence is its log-likelihood ratio per word, over the whole text and over its
most toxic windows of several lengths, calibrated on labelled texts.

Counts of one and two are discounted whole: their mass goes to the lower order. So only what was seen
three times has to be kept, and the model is exact with small tables.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftmill.lineage import cut
from weftmill.llm.texts import Words, id_remainder, map_slices, mix

# Bound of the sample that the models are fitted on: labelled rows per class, the first by hash of id.
MAX_ROWS = 5000
DISCOUNT = 2
WINDOWS = (1, 4, 16)
# A word's ratio above this is strong; what is above it is summed over a text.
STRONG = 1.0
START = np.uint64(0x5354415254)
FEATURES = 4 + len(WINDOWS)


@dataclass
class Table:
    """Sorted 64-bit keys with a value each."""

    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> "Table":
        keys = keys.astype(np.int64).view(np.uint64)
        order = np.argsort(keys)
        return cls(keys[order], values[order].astype(np.float32))

    def get(self, keys: np.ndarray, default: float) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), default, np.float32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], np.float32(default))


@dataclass
class Ratios:
    """Log ratios toxic / ordinary: of a word after a context (where stored), else the context's share
    of mass for the lower order plus the word's own ratio."""

    pairs: Table
    contexts: Table
    words: Table
    unseen: float


@dataclass
class Model:
    ratios: Ratios
    weights: np.ndarray


def pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(context * np.uint64(0x9E3779B97F4A7C15) ^ word)


def _tokens(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words (ASCII punctuation splits too), their hashes, and the hash before each (START at first)."""
    words = Words(texts, punctuation=True)
    own = words.hashes()
    before = np.concatenate([[START], own[:-1]]).astype(np.uint64) if len(own) else own
    before[words.first[:-1][words.counts() > 0]] = START
    return words, own, before


def evidence(ratios: Ratios, texts: pa.Array) -> np.ndarray:
    """Features of each text: 1, ratio per word, log of length, log of the strong ratios' sum, and the
    highest ratio per word of a window of each length."""
    words, own, before = _tokens(texts)
    lower = ratios.contexts.get(before, 0.0) + ratios.words.get(own, ratios.unseen)
    llr = ratios.pairs.get(pair_key(before, own), np.nan)
    llr = np.where(np.isnan(llr), lower, llr).astype(float)
    sums = np.concatenate([[0.0], np.cumsum(llr)])
    n, first = words.counts(), words.first
    out = np.zeros((len(n), FEATURES))
    out[:, 0] = 1
    full = np.flatnonzero(n)
    if len(full):
        owner = np.repeat(np.arange(len(n)), n)
        stop = first[owner + 1]
        at = np.arange(len(llr))
        out[full, 1] = (sums[first[full + 1]] - sums[first[full]]) / n[full]
        out[full, 2] = np.log1p(n[full])
        out[full, 3] = np.log1p(np.add.reduceat(np.maximum(llr - STRONG, 0), first[full]))
        for k, length in enumerate(WINDOWS):
            # Windows that would leave the text are moved back to end with it.
            begin = np.maximum(np.minimum(at, stop - length), first[owner])
            window = (sums[np.minimum(begin + length, stop)] - sums[begin]) / length
            out[full, 4 + k] = np.maximum.reduceat(window, first[full])
    return out


def _sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, train: Column) -> tuple[DataFrame, dict[int, int]]:
    """`(fold, y, text)` of at most `MAX_ROWS` labelled rows per class, different texts once, and the
    labelled rows per class in all. A row with several labels counts as the highest."""
    y = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & train)
    y = y.groupBy(F.col(id_col).alias("id")).agg((F.max(label) > 0).cast("int").alias("y"))
    totals = {r["y"]: r["count"] for r in y.groupBy("y").count().collect()}
    order = F.xxhash64(F.lit("toxicity"), "id")
    picked = None
    for c in (0, 1):
        some = y.filter(F.col("y") == c).orderBy(order, "id").limit(MAX_ROWS)
        picked = some if picked is None else picked.unionByName(some)
    picked = cut(picked)
    rows = docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    found = rows.join(F.broadcast(picked), "id")
    found = found.groupBy(F.sha2("text", 256).alias("digest")).agg(F.max("y").alias("y"), F.min("text").alias("text"))
    fold = F.pmod(F.xxhash64("digest"), F.lit(2)).cast("int")
    return cut(found.select(fold.alias("fold"), "y", "text")), totals


def _pair_counts(sample: DataFrame) -> DataFrame:
    """`(h, w, o0, t0, o1, t1)`: distinct words before each pair by class (ordinary, toxic) and fold,
    and the same over both folds (`o`, `t`)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, own, before = _tokens(batch.column("text"))
        earlier = np.concatenate([before[:1], before[:-1]])
        heads = words.first[:-1][words.counts() > 0]
        earlier[heads] = START
        group = 1 << (2 * batch.column("fold").to_numpy() + batch.column("y").to_numpy())
        columns = [pa.array(x.view(np.int64)) for x in (earlier, before, own)]
        g = np.repeat(group, words.counts()).astype(np.int32)
        return pa.record_batch([*columns, pa.array(g)], names=["v", "h", "w", "g"])

    rows = map_slices(sample, "text", run, "v long, h long, w long, g int")
    seen = rows.groupBy("v", "h", "w").agg(F.bit_or("g").alias("g"))
    one = lambda bits: F.count(F.when(F.col("g").bitwiseAND(F.lit(bits)) > 0, 1))
    names = {"o0": 1, "t0": 2, "o1": 4, "t1": 8, "o": 5, "t": 10}
    return cut(seen.groupBy("h", "w").agg(*(one(bits).alias(name) for name, bits in names.items())))


def _kept(n: Column) -> Column:
    """A count after its discount."""
    return F.greatest(n - F.lit(float(DISCOUNT)), F.lit(0.0))


def _ratios(pairs: DataFrame, t: str, o: str) -> Ratios:
    """Kneser-Ney log ratios from the pair counts of both classes. All tables are bounded by the sample."""
    pairs = pairs.select("h", "w", F.col(t).alias("t"), F.col(o).alias("o")).filter("t + o > 0")
    words = pairs.groupBy("w").agg(
        F.count(F.when(F.col("t") > 0, 1)).alias("kt"), F.count(F.when(F.col("o") > 0, 1)).alias("ko")
    )
    words = cut(words)
    all_ = words.agg(
        F.sum("kt").alias("t"), F.sum("ko").alias("o"), F.count(F.lit(1)).alias("v"),
        F.sum(_kept(F.col("kt"))).alias("dt"), F.sum(_kept(F.col("ko"))).alias("do"),
    ).first()
    n_t, n_o, v = max(all_["t"] or 0, 1), max(all_["o"] or 0, 1), all_["v"]
    left_t, left_o = 1 - (all_["dt"] or 0) / n_t, 1 - (all_["do"] or 0) / n_o
    shared = (F.col("kt") + F.col("ko") + 1) / F.lit(float(n_t + n_o + v + 1))
    p_t = _kept(F.col("kt")) / F.lit(float(n_t)) + F.lit(left_t) * shared
    p_o = _kept(F.col("ko")) / F.lit(float(n_o)) + F.lit(left_o) * shared
    words = words.withColumn("pt", p_t).withColumn("po", p_o)
    contexts = pairs.groupBy("h").agg(
        F.sum("t").alias("ct"), F.sum("o").alias("co"), F.sum(_kept(F.col("t"))).alias("dt"), F.sum(_kept(F.col("o"))).alias("do")
    )
    contexts = cut(contexts.filter("dt > 0 or do > 0"))
    rest = lambda d, c: F.when(F.col(c) > 0, 1 - F.col(d) / F.col(c)).otherwise(F.lit(1.0))
    part = lambda n, c: F.when(F.col(c) > 0, _kept(F.col(n)) / F.col(c)).otherwise(F.lit(0.0))
    found = pairs.filter(f"t > {DISCOUNT} or o > {DISCOUNT}").join(contexts, "h").join(words.select("w", "pt", "po"), "w")
    found = found.select(
        "h", "w",
        F.log((part("t", "ct") + rest("dt", "ct") * F.col("pt")) / (part("o", "co") + rest("do", "co") * F.col("po"))).alias("r"),
    )
    p = _columns(found)
    c = _columns(contexts.select("h", F.log(rest("dt", "ct") / rest("do", "co")).alias("r")))
    w = _columns(words.filter(f"kt > {DISCOUNT} or ko > {DISCOUNT}").select("w", F.log(F.col("pt") / F.col("po")).alias("r")))
    as_key = lambda x: x.astype(np.int64).view(np.uint64)
    keys = pair_key(as_key(p["h"]), as_key(p["w"])).view(np.int64)
    return Ratios(Table.of(keys, p["r"]), Table.of(c["h"], c["r"]), Table.of(w["w"], w["r"]), float(np.log(left_t / left_o)))


def _columns(df: DataFrame) -> dict[str, np.ndarray]:
    found = df.toArrow()
    return {name: found.column(name).to_numpy() for name in found.column_names}


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, with a small ridge."""
    beta = np.zeros(x.shape[1])
    ridge = 1e-2 * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", train: Column | None = None) -> Model | None:
    """Models and calibration from labelled rows; `train` (over the id) says which labels may be read.

    The calibration scores each half of the sample with the model of the other half. None if there is
    no labelled text of one of the classes.
    """
    train = F.lit(True) if train is None else train
    sample, totals = _sample(docs, labels, label, id_col, text_col, train)
    pairs = _pair_counts(sample)
    half = [_ratios(pairs, "t1", "o1"), _ratios(pairs, "t0", "o0")]
    spread = sample.sparkSession.sparkContext.broadcast(half)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.stack([evidence(r, batch.column("text")) for r in spread.value])
        x = x[batch.column("fold").to_numpy(), np.arange(batch.num_rows)]
        names = [f"x{i}" for i in range(FEATURES)]
        return pa.record_batch([batch.column("y"), *(pa.array(c) for c in x.T)], names=["y", *names])

    rows = map_slices(sample, "text", run, "y int, " + ", ".join(f"x{i} double" for i in range(FEATURES)))
    found = np.array([list(r) for r in rows.collect()], float).reshape(-1, FEATURES + 1)
    y, x = found[:, 0], found[:, 1:]
    if not 0 < y.sum() < len(y):
        return None
    # Weights bring the sample back to the share of toxic rows among all labelled ones.
    weight = np.where(y > 0, totals[1] / y.sum(), totals[0] / (len(y) - y.sum()))
    whole = _ratios(pairs, "t", "o")
    return Model(whole, _calibrate(x, y, weight * len(y) / weight.sum()))


def score(docs: DataFrame, model: Model | None, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`(doc_id, score, predicted)`, one row per row of `docs`; the score depends on the text alone.

    Null and empty texts get the calibrated score of no evidence; without a model all scores are 0.
    """
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.zeros(batch.num_rows)
        if spread.value is not None:
            x = evidence(spread.value.ratios, batch.column("text"))
            found = 1 / (1 + np.exp(-np.clip(x @ spread.value.weights, -30, 30)))
        hit = pa.array((found >= threshold).astype(np.int32))
        return pa.record_batch([batch.column("doc_id"), pa.array(found), hit], names=["doc_id", "score", "predicted"])

    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return map_slices(rows, "text", run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double, predicted int")


def held_in(n: int, held_out: int, id_col: str = "doc_id") -> Column:
    return id_remainder(id_col, n) != held_out
