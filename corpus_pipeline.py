"""Corpus pipeline over `documents`: language ID, exact dedup, near-dedup, mixing, packing.

Each stage works on all rows its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftmill.lineage import cut
from weftmill.llm import dedup, langid, mixing, packing, queries, simhash
from weftmill.llm.texts import prepare, table


# A document goes if it is no closer to any language than this many standard deviations of an unrelated
# text, as does one without a letter.
LANGUAGE_DEVIATIONS = 3.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    prepare(spark)
    return langid.keep_identified(docs, LANGUAGE_DEVIATIONS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    prepare(spark)
    return dedup.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    prepare(spark)
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, repeated or left out as the mix takes them."""
    prepare(spark)
    whole = F.struct(*[docs[c] for c in docs.columns])
    return mixing.curriculum(mixing.plan_mix(docs, **queries.MIX, payload=whole)).select("payload.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in a sequence."""
    prepare(spark)
    pieces = cut(packing.cut_pieces(docs, public_tokenizers.path(queries.TOKENIZER), queries.CAPACITY))
    return packing.pack(pieces, queries.CAPACITY)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]
# Fingerprints, language profiles and tokenizers aren't SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole `documents` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
