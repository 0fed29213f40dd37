"""Registered queries of the operators over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftmill.lineage import cut
from weftmill.llm import (
    bytebpe,
    dedup,
    html,
    langid,
    lm,
    mixing,
    negatives,
    packing,
    quality,
    runs,
    secrets,
    simhash,
    toxicity,
)
from weftmill.llm.texts import id_remainder, table

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 2048
MIX = {"weights": [3, 1, 2], "share": 1.5, "cap": 2}


def op1_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 7) == 2
    model = lm.train(docs.filter(~held_out))
    found = lm.score(docs, model, carry=[F.col("doc_id"), held_out.alias("held_out")])
    return found.withColumn("train_tokens", F.lit(model.n_tokens).cast("long"))


def op2_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = id_remainder("doc_id", 3) == 1
    model = toxicity.fit(docs, labels, train=~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"), **MIX)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    when = [F.round(F.get("positions", F.lit(i)), 9).alias(name) for i, name in enumerate(("position", "second_position"))]
    rows = plan.select("doc_id", "source", "size", "source_size", "target", taken, "copies", *when)
    # In training order; what the mix leaves out comes last.
    order = [F.asc_nulls_last("position"), F.asc("source"), F.asc("doc_id")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("source")


def op4_decoding_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["depth"] == 0)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.withColumn("base", base).select(
        "doc_id",
        *(count(kind) for kind in secrets.KINDS),
        F.sha2(secrets.span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
        "complete",
    )


def op5_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op6_min_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    pieces = cut(packing.cut_pieces(docs, public_tokenizers.path(TOKENIZER), CAPACITY))
    return packing.pack(pieces, CAPACITY)


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(table(spark, sf_dir, "documents"), F.col("source"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    hexes = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexes.alias("fingerprint"), "component_id")


def op9_cuckoo_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup.duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op10_hyperdimensional_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 3) == 1
    profiles = langid.prototypes(docs.filter(~held_out))
    return langid.predict(docs, profiles, carry=[F.col("doc_id"), held_out.alias("held_out")])


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return runs.periodic_runs(docs, carry=[F.col("doc_id")], plant_by=F.col("doc_id"))


def op12_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows, is_anchor=F.col("id") % 100 == 0, label=moved)


def op13_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bytebpe.round_trip(docs, public_tokenizers.path(BYTE_TOKENIZER), carry=[F.col("doc_id")])


def queries() -> dict[str, Query]:
    return {
        "op1_bloom_lm": op1_bloom_lm,
        "op2_kneser_ney_toxicity": op2_kneser_ney_toxicity,
        "op3_curriculum_mix": op3_curriculum_mix,
        "op4_decoding_secrets": op4_decoding_secrets,
        "op5_site_templates": op5_site_templates,
        "op6_min_slack_packing": op6_min_slack_packing,
        "op7_host_rules": op7_host_rules,
        "op8_simhash_pivots": op8_simhash_pivots,
        "op9_cuckoo_dedup": op9_cuckoo_dedup,
        "op10_hyperdimensional_langid": op10_hyperdimensional_langid,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_threshold_negatives": op12_threshold_negatives,
        "op13_rank_array_bpe": op13_rank_array_bpe,
    }


def oracle_sql() -> dict[str, str]:
    from weftmill.llm import sql

    return sql.statements()
