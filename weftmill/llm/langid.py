"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter trigram is bound to one vector: the first
letter's vector rotated twice, times the second's rotated once, times the third's. A text's vector is
the sum (bundle) of its trigram vectors, a language's prototype the sum of its texts' vectors. A text
gets the language whose prototype has the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftmill.llm.texts import map_slices, slices, with_fields

DIMENSIONS = 1024
SEED = 7
# Score: softmax of the cosines at this temperature.
TEMPERATURE = 0.05
# Trigrams whose vectors are made at once, and cells of a text x trigram table.
TRIGRAMS = 4096
CELLS = 1 << 20
# Text bytes of one step; its arrays take about a hundred times as much.
STEP_BYTES = 512 << 10
BOUNDARY = 0
UNKNOWN = "und"

_letters: dict[int, bool] = {}
_vectors: dict[int, np.ndarray] = {}


def _is_letter(codes: np.ndarray) -> np.ndarray:
    for c in codes.tolist():
        if c not in _letters:
            _letters[c] = chr(c).isalpha()
    return np.array([_letters[c] for c in codes.tolist()], bool)


def _letter_vectors(codes: np.ndarray) -> np.ndarray:
    for c in codes.tolist():
        if c not in _vectors:
            bits = np.random.Generator(np.random.PCG64([SEED, c])).integers(0, 2, DIMENSIONS, dtype=np.int8)
            _vectors[c] = 2 * bits - 1
    return np.stack([_vectors[c] for c in codes.tolist()])


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters of all texts as indexes into `letters` (0 is a word boundary, one between
    words and at either end of a text), the text each belongs to, and `letters`."""
    parts = [np.frombuffer((" " + t.lower() + " ").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    codes = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    present = np.flatnonzero(np.bincount(codes))
    letters = present[_is_letter(present)]
    index = np.zeros(int(present[-1]) + 1, np.int64)
    index[letters] = np.arange(1, len(letters) + 1)
    symbols = index[codes]
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] > 0) | (symbols[:-1] > 0) | (owner[1:] != owner[:-1])
    return symbols[keep], owner[keep], np.concatenate([[BOUNDARY], letters])


def text_vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bundled vectors (one row per text) and whether the text has a letter. All sums are exact."""
    symbols, owner, letters = _symbols(texts)
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    has_letter = np.bincount(owner, symbols > 0, len(texts)) > 0
    inside = (owner[2:] == owner[:-2]) & ((symbols[:-2] > 0) | (symbols[1:-1] > 0) | (symbols[2:] > 0))
    a, b, c, who = (x[inside] for x in (symbols[:-2], symbols[1:-1], symbols[2:], owner[:-2]))
    n = len(letters)
    codes, which = np.unique((a * n + b) * n + c, return_inverse=True)
    base = _letter_vectors(letters)
    first, second = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    step = max(1, CELLS // max(1, min(len(codes), TRIGRAMS)))
    for at in range(0, len(codes), TRIGRAMS):
        some = codes[at : at + TRIGRAMS]
        bound = (first[some // (n * n)] * second[some // n % n] * base[some % n]).astype(np.float32)
        mine = (which >= at) & (which < at + TRIGRAMS) if len(codes) > TRIGRAMS else slice(None)
        rows, columns = who[mine], which[mine] - at
        for low in range(0, len(texts), step):
            high = min(low + step, len(texts))
            start, stop = np.searchsorted(rows, [low, high])
            cells = (rows[start:stop] - low) * len(some) + columns[start:stop]
            counts = np.bincount(cells, minlength=(high - low) * len(some)).astype(np.float32)
            out[low:high] += counts.reshape(high - low, len(some)) @ bound
    return out, has_letter


def _strings(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def prototypes(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Prototype vector of each language, from all rows with a language (none: no prototypes).

    Tasks add up whole vectors per language; the sums are combined per (language, dimension) before
    the shuffle. What reaches the driver is one vector per language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text", STEP_BYTES):
                vectors, _ = text_vectors(_strings(part))
                langs = np.array(part.column("lang").to_pylist(), object)
                for lang in set(langs.tolist()):
                    own = vectors[langs == lang].astype(np.int64).sum(axis=0)
                    sums[lang] = sums.get(lang, 0) + own
        for lang, own in sums.items():
            yield pa.record_batch(
                [pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(own)],
                names=["lang", "d", "v"],
            )

    rows = docs.filter(docs[lang_col].isNotNull()).select(docs[lang_col].alias("lang"), docs[text_col].alias("text"))
    parts = rows.mapInArrow(run, "lang string, d int, v long")
    found: dict[str, np.ndarray] = {}
    for r in parts.groupBy("lang", "d").agg(F.sum("v").alias("v")).toLocalIterator():
        found.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["d"]] = r["v"]
    return dict(sorted(found.items()))


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], text_col: str = "text", carry: list[Column] | None = None) -> DataFrame:
    """`carry` columns with `lang_pred`, `score` and `cosine`, one row per row of `docs`.

    Texts that are null, empty or without a letter, and all texts if there is no prototype, get
    `und`, score 0 and cosine 0. Equal cosines: the first language by name. `score` is the softmax of the
    cosines, so it says how clear the choice is; `cosine`, to the language's prototype, how much the text
    is like the language at all.
    """
    names = np.array([*profiles, UNKNOWN], object)
    unit = np.stack([v / max(np.linalg.norm(v), 1e-300) for v in profiles.values()]).astype(np.float32) if profiles else None

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        best, score, near = np.full(n, len(names) - 1), np.zeros(n), np.zeros(n)
        if unit is not None:
            vectors, has_letter = text_vectors(_strings(batch))
            length = np.linalg.norm(vectors, axis=1)
            cosines = (vectors @ unit.T / np.maximum(length, 1e-30)[:, None]).astype(float)
            odds = np.exp((cosines - cosines.max(axis=1, keepdims=True)) / TEMPERATURE)
            best = np.where(has_letter, cosines.argmax(axis=1), best)
            score = np.where(has_letter, 1 / odds.sum(axis=1), 0.0)
            near = np.where(has_letter, cosines.max(axis=1), 0.0)
        kept = [batch.column(i) for i in range(1, batch.num_columns)]
        more = [pa.array(names[best], pa.string()), pa.array(score), pa.array(near)]
        return pa.record_batch([*kept, *more], names=[*batch.schema.names[1:], "lang_pred", "score", "cosine"])

    rows = docs.select(docs[text_col].alias("text"), *(carry or []))
    return map_slices(rows, "text", run, with_fields(rows.schema[1:], "lang_pred string, score double, cosine double"), STEP_BYTES)


def keep_identified(docs: DataFrame, deviations: float = 3.0, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of `docs` that are in one of the languages: not `und`, and closer to the best prototype than
    `deviations` standard deviations of an unrelated vector's cosine (1 / sqrt(DIMENSIONS)). So the bar is the
    same for any number of languages.

    Profiles come from all rows with a language; without any there is nothing to compare with, and only
    texts without a letter go.
    """
    profiles = prototypes(docs, text_col, lang_col)
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("doc")
    if not profiles:
        return docs.filter(F.regexp_like(F.coalesce(docs[text_col], F.lit("")), F.lit("\\p{L}")))
    found = predict(docs, profiles, text_col, carry=[whole])
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("cosine") > deviations / DIMENSIONS**0.5)).select("doc.*")
