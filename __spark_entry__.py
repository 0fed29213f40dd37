"""

Every query reads whole tables. The vocabulary and the model parameters are built from the given
tables once per session and folder (see `weftmill.fixtures`) and then serve as input tables.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from weftmill import fixtures  # noqa: E402
from weftmill.functions import vectors as V  # noqa: E402
from weftmill.lineage import checkpoint_root, cut  # noqa: E402
from weftmill.model import Model  # noqa: E402
from weftmill.operators import attention, bpe, dictionary, ingest, layers, matrix, ordering, ranking, text, tokens  # noqa: E402
from weftmill.operators import vectors as vops  # noqa: E402
from weftmill.plans import forward, generation, reports  # noqa: E402
from weftmill.session import configure  # noqa: E402
from weftmill.sources.tables import MODEL_SCHEMAS, read_table  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]
TEMPERATURES = [0.5, 1, 2]
WIDTH = 64
# No token is end-of-text in the small vocabulary; this id is never drawn.
NO_EOS = -1

_inputs: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _inputs:
        _inputs[key] = build()
    return _inputs[key]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(configure(spark), f"{sf_dir}/{name}.parquet")


def _vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "vocab", lambda: fixtures.prefix_vocab(_table(spark, sf_dir, "documents"), "text")
    )


def _model(spark: SparkSession, sf_dir: str) -> Model:
    """Two blocks over the whole vector table as token table."""

    def build() -> Model:
        return fixtures.mini_model(fixtures.embedding_tokens(_table(spark, sf_dir, "embeddings")))

    return _once(spark, sf_dir, "model", build)


def _text_model(spark: SparkSession, sf_dir: str, n_block: int = 0) -> Model:
    """Token vectors for the text vocabulary, places for the longest prompt."""

    def build() -> Model:
        n = _vocab(spark, sf_dir).count()
        wte = fixtures.formula_rows(spark, fixtures.TABLE_CODE_WTE, "token", n, WIDTH, 1.0)
        prompts = _table(spark, sf_dir, "conversations")
        longest = prompts.agg(F.max(F.octet_length("text")).alias("n")).first()["n"] or 0
        return fixtures.mini_model(wte, n_block=n_block, n_place=longest + oracle.PROMPT_STEPS)

    return _once(spark, sf_dir, f"text_model_{n_block}", build)


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.embedding_sequences(_table(spark, sf_dir, "embeddings"))


def _embedded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Model]:
    m = _model(spark, sf_dir)
    return layers.embed(_tokens(spark, sf_dir), m.table("wte"), m.table("wpe")), m


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("v")
    )


def _round(value: str | Column, digits: int = 6) -> Column:
    """Rounded, without negative zero."""
    return F.round(value, digits) + F.lit(0.0)


def _big(*names: str) -> list[Column]:
    return [F.col(n).cast("long").alias(n) for n in names]


def _long(df: DataFrame, keys: list[str], values: str = "values") -> DataFrame:
    """Vectors as `(keys, i, value)`, i from 0."""
    rows = df.select(*keys, F.posexplode(values).alias("i", "value"))
    return rows.select(*_big(*keys, "i"), _round("value").alias("value"))


# --- Ingest ----------------------------------------------------------------------------------


def q_explode_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.explode_dictionary(_table(spark, sf_dir, "events"), "props", ["event_id"])


def q_transpose_row_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten vectors per block, each block transposed."""
    blocks = _vectors(spark, sf_dir).selectExpr("vec_id div 10 AS block", "vec_id % 10 AS r", "v")
    out = ingest.transpose_row_vectors(blocks, "r", "v", ["block"])
    return _long(out, ["block", "place"])


def q_transpose_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ingest.transpose_long(_vectors(spark, sf_dir), "vec_id", "v")
    return out.select(*_big("place", "row_key"), _round("value").alias("value"))


_CHECKS = {
    "lineitem": ingest.TableSpec(("l_orderkey", "l_linenumber"), ("l_shipdate", "l_quantity")),
    "orders": ingest.TableSpec(("o_custkey",), ("o_orderdate",)),
    "documents": ingest.TableSpec(("lang", "n_chars"), ("text",)),
    "embeddings": ingest.TableSpec(("vec_id",), ("embedding",), {"embedding": WIDTH}),
}


def q_validate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for name, spec in _CHECKS.items():
        found = ingest.validate_table(_table(spark, sf_dir, name), spec)
        found = found.select(F.lit(name).alias("table_name"), "rule", "key", "n")
        out = found if out is None else out.unionByName(found)
    return out


def q_load_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parameter tables loaded as one checked job and read back by block."""
    folder = f"{checkpoint_root(spark)}/load-{uuid.uuid4().hex}"
    model = _model(spark, sf_dir)
    model.load(folder)
    loaded = Model.read(spark, folder, model.n_head, model.n_block)
    total = F.sum(F.aggregate("values", F.lit(0.0), lambda a, x: a + x))
    found = []
    for name, schema in MODEL_SCHEMAS.items():
        block = F.col("block") if "block" in schema.names else F.lit(0)
        rows = loaded.table(name).groupBy(block.cast("long").alias("block"))
        found.append(rows.agg(F.count(F.lit(1)).alias("n_rows"), total.alias("total")).withColumn("table_name", F.lit(name)))
    rows = reduce(DataFrame.unionByName, found)
    return rows.select("table_name", "block", "n_rows", _round("total").alias("total"))


# --- Text ------------------------------------------------------------------------------------


def q_pretokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = text.pretokenize(_table(spark, sf_dir, "documents"), "text", ["doc_id"])
    return out.select(*_big("doc_id", "part_position"), "part")


def q_byte_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = text.distinct_parts(_table(spark, sf_dir, "documents"), "text")
    return text.byte_symbols(parts).select("part", *_big("position"), "character")


def q_bpe_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = text.distinct_parts(_table(spark, sf_dir, "documents"), "text")
    return bpe.bpe_merge(parts, _vocab(spark, sf_dir)).select("part", *_big("position"), "cluster")


def q_extend_part_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations tokenised as a second corpus, after their user turns: only unseen parts are merged."""
    turns = _table(spark, sf_dir, "conversations")
    folder = f"{checkpoint_root(spark)}/parts-{uuid.uuid4().hex}"
    kept = dictionary.PartDictionary(spark, folder, fixtures.prefix_vocab(turns, "text"))
    kept.entries(turns.filter("role = 'user'"), "text")
    rows = kept.entries(turns, "text").select("part", F.posexplode("clusters").alias("_i", "cluster"))
    return rows.select("part", (F.col("_i") + 1).cast("long").alias("position"), "cluster")


def q_bpe_merge_long_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its blanks as one part: thousands of symbols each."""
    whole = F.regexp_replace("text", f"[{text.BLANK}]", "").alias("part")
    parts = _table(spark, sf_dir, "documents").select(whole).filter("part <> ''").distinct()
    merged = bpe.merge_parts(parts, _vocab(spark, sf_dir))
    return merged.select(
        F.md5(F.col("part").cast("binary")).alias("part_md5"),
        F.size("clusters").cast("long").alias("n_clusters"),
        F.md5(F.array_join("clusters", " ").cast("binary")).alias("clusters_md5"),
    )


def q_bpe_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = text.distinct_parts(_table(spark, sf_dir, "documents"), "text")
    return bpe.bpe_trace(parts, _vocab(spark, sf_dir)).select(
        "part", *_big("step", "token"), "combined", F.array_join("symbols", " ").alias("symbols")
    )


def q_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tokens.tokenize(
        _table(spark, sf_dir, "conversations"), "text", ["conv_id", "turn"], _vocab(spark, sf_dir)
    )
    return out.select(*_big("conv_id", "turn", "part_position", "position", "token"), "cluster")


def _as_text(df: DataFrame, *ids: str) -> DataFrame:
    listed = F.array_join(F.transform("input", lambda t: t.cast("string")), " ")
    return df.select(*_big(*ids, "n_seq"), listed.alias("input"))


def q_token_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tokens.tokenize(
        _table(spark, sf_dir, "conversations"), "text", ["conv_id", "turn"], _vocab(spark, sf_dir)
    )
    return _as_text(tokens.token_sequences(rows, ["conv_id", "turn"]), "conv_id", "turn")


def q_text_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return _as_text(tokens.text_sequences(docs, "text", ["doc_id"], _vocab(spark, sf_dir)), "doc_id")


def _stats(df: DataFrame, by: str, vocab: DataFrame) -> DataFrame:
    out = tokens.token_stats(df, "text", [by], vocab)
    return out.select(
        by,
        *_big("n_texts", "n_chars", "n_tokens", "n_distinct"),
        _round("tokens_per_char").alias("tokens_per_char"),
    )


def q_token_stats_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(_table(spark, sf_dir, "documents"), "lang", _vocab(spark, sf_dir))


def q_token_stats_by_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(_table(spark, sf_dir, "conversations"), "role", _vocab(spark, sf_dir))


def q_top_tokens_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = tokens.top_tokens(docs, "text", ["source"], _vocab(spark, sf_dir), 10)
    return out.select("source", *_big("rank", "token", "n"))


def q_detokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = _vocab(spark, sf_dir)
    arrays = tokens.text_sequences(_table(spark, sf_dir, "documents"), "text", ["doc_id"], vocab)
    rows = arrays.select("doc_id", F.posexplode("input").alias("ordinality", "token"))
    return tokens.detokenize(rows, vocab, ["doc_id"]).select("doc_id", "response")


def q_decode_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = _vocab(spark, sf_dir)
    rows = tokens.text_sequences(_table(spark, sf_dir, "documents"), "text", ["doc_id"], vocab)
    return tokens.decode_sequences(rows, vocab, "input", ["doc_id"]).select("doc_id", "response")


def q_roundtrip_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return tokens.roundtrip_check(docs, "text", ["doc_id"], ["lang"], _vocab(spark, sf_dir))


# --- Vectors ---------------------------------------------------------------------------------


def _map_query(expr: Callable[[], Column]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _long(_vectors(spark, sf_dir).withColumn("values", expr()), ["vec_id"])

    return run


def q_inner_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with the centroid of its label."""
    v = _vectors(spark, sf_dir)
    c = vops.centroids(v, ["label"], "v", WIDTH)
    product = V.inner_product("v", "values")
    return v.join(c, "label").select(*_big("vec_id"), _round(product).alias("value"))


def q_vec_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(vops.vec_sum(_vectors(spark, sf_dir), ["label"], "v", WIDTH), ["label"])


def q_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(vops.centroids(_vectors(spark, sf_dir), ["label"], "v", WIDTH), ["label"])


def q_unnest_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = vops.unnest_vector(_vectors(spark, sf_dir), ["vec_id"], "v")
    return out.select(*_big("vec_id", "ordinality"), _round("value").alias("value"))


def q_renest_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vops.unnest_vector(_vectors(spark, sf_dir), ["vec_id"], "v")
    return _long(vops.renest_vector(rows, ["vec_id"]), ["vec_id"])


# --- Stages ----------------------------------------------------------------------------------

PLACE = ["seq_id", "place"]


def q_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(_embedded(spark, sf_dir)[0], PLACE)


def q_embed_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens at three times their id: two thirds have no vector."""
    m = _model(spark, sf_dir)
    ids = _table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id div 100 AS seq_id", "cast(vec_id % 100 AS int) AS place", "cast(vec_id * 3 AS int) AS token"
    )
    out = layers.embed_dropped(ids, m.table("wte"), m.table("wpe"))
    return out.select("reason", *_big("n"))


def _normed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Model]:
    x, m = _embedded(spark, sf_dir)
    return layers.layer_norm(x, m.table("ln_1_g", 0), m.table("ln_1_b", 0), m.eps), m


def q_layer_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(_normed(spark, sf_dir)[0], PLACE)


def _linear_query(method: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        x, m = _normed(spark, sf_dir)
        return _long(layers.linear(x, m.table("c_attn_w", 0), m.table("c_attn_b", 0), method), PLACE)

    return run


def q_linear_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and weights in a grid of small blocks."""
    x, m = _normed(spark, sf_dir)
    product = matrix.block_product(x, m.table("c_attn_w", 0), "y", rows=64, out=48, inner=24)
    biased = layers.with_parameter(product, m.table("c_attn_b", 0), "_b")
    return _long(biased.select(*PLACE, V.vec_add("values", "_b").alias("values")), PLACE)


def q_attention_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attention with the softmax merged over tiles of four places."""
    x, m = _normed(spark, sf_dir)
    qkv = layers.linear(x, m.table("c_attn_w", 0), m.table("c_attn_b", 0))
    return _long(attention.tiled_attention(qkv, m.n_head, tile=4), PLACE)


def _heads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Model]:
    x, m = _embedded(spark, sf_dir)
    return forward.attention_heads(x, m, 0), m


def q_split_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = _heads(spark, sf_dir)[0].select(
        "seq_id", "head", "place", F.posexplode(F.arrays_zip("q", "k", "v")).alias("i", "_t")
    )
    return heads.select(
        *_big("seq_id", "head", "place", "i"), *[_round(F.col(f"_t.{c}")).alias(c) for c in "qkv"]
    )


def _scored(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*_big("seq_id", "head", "x", "y"), _round("value", digits).alias("value"))


def q_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(layers.attention_scores(_heads(spark, sf_dir)[0]))


def q_attention_scores_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Next to the addend of -1e10 a double has no more than five decimals.
    return _scored(layers.attention_scores(_heads(spark, sf_dir)[0], mask="full"), 3)


def q_attention_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(forward.attention_weights(_heads(spark, sf_dir)[0]))


def q_attention_softmax_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = layers.attention_scores(_heads(spark, sf_dir)[0], mask="full")
    return _scored(layers.softmax(scores, ["seq_id", "head", "x"]))


def q_attention_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads, m = _heads(spark, sf_dir)
    # Read three times (q, k and v), evaluated once.
    heads = cut(heads)
    out = layers.attention_output(forward.attention_weights(heads), heads, WIDTH // m.n_head)
    return _long(out, PLACE)


def _stage_query(stage: Callable[[DataFrame, Model], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        x, m = _embedded(spark, sf_dir)
        return _long(stage(x, m), PLACE)

    return run


def _encode_query(method: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = _model(spark, sf_dir)
        return _long(forward.encode_sequences(_tokens(spark, sf_dir), m, method), PLACE)

    return run


def q_attention_matrix_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, m = _embedded(spark, sf_dir)
    out = reports.attention_matrix_report(x, m)
    return out.select(*_big(*PLACE), "q", "k", "v", "matrix", "attention")


# --- Ranking and generation ------------------------------------------------------------------


def _last(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Model]:
    m = _model(spark, sf_dir)
    return ranking.last_place(forward.encode_sequences(_tokens(spark, sf_dir), m)), m


def q_last_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(_last(spark, sf_dir)[0], ["seq_id"])


def _nearest(**options) -> Query:
    """Every vector against the whole vector table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        v = _vectors(spark, sf_dir)
        queries_ = v.select(F.col("vec_id").alias("seq_id"), F.col("v").alias("values"))
        items = v.select(F.col("vec_id").alias("token"), F.col("v").alias("values"))
        out = ranking.top_n_by_inner_product(queries_, items, 5, **options)
        return out.select(*_big("seq_id", "token"), _round("value").alias("value"))

    return run


def _logits(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    last, m = _last(spark, sf_dir)
    return ranking.top_n_by_inner_product(last, m.table("wte"), n)


def q_next_token_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _logits(spark, sf_dir)
    return out.select(*_big("seq_id", "token"), _round("value").alias("value"))


def _chances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.temperature_softmax(_logits(spark, sf_dir), TEMPERATURES)


def q_temperature_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chances(spark, sf_dir).select(
        *_big("seq_id", "token"), "temperature", _round("value").alias("value"),
        _round("softmax").alias("softmax"),
    )


def q_temperature_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.temperature_comparison(_chances(spark, sf_dir), _vocab(spark, sf_dir), TEMPERATURES)
    return out.select(*_big("seq_id", "token"), *out.columns[2:])


def _intervals(spark: SparkSession, sf_dir: str, mode: str = "rows") -> DataFrame:
    hot = ranking.temperature_softmax(_logits(spark, sf_dir), [2.0])
    return ranking.cumulative_intervals(hot, mode)


def _interval_query(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _intervals(spark, sf_dir, mode).select(
            *_big("seq_id", "token"), *[_round(c).alias(c) for c in ("softmax", "low", "high")]
        )

    return run


def arithmetic_draw(step: int) -> Column:
    """The draw that SQL can repeat."""
    return F.expr(f"((seq_id * 1103515245 + {step} * 12345 + 20231231) % 2147483648) / 2147483648.0D")


def q_weighted_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ranking.weighted_sample(_intervals(spark, sf_dir), arithmetic_draw(0))
    return out.select(*_big("seq_id", "token"))


def q_weighted_sample_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bare range predicate over shared intervals: ties give several tokens, gaps none."""
    out = ranking.weighted_sample(_intervals(spark, sf_dir, "reference"), arithmetic_draw(0), "reference")
    return out.select(*_big("seq_id", "token"))


def _sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct("place", "token")))
    return _tokens(spark, sf_dir).groupBy("seq_id").agg(rows["token"].alias("input"))


def _generated(df: DataFrame) -> DataFrame:
    rows = df.select("seq_id", "complete", F.posexplode("input").alias("place", "token"))
    return rows.select(*_big("seq_id", "place", "token"), "complete")


def q_generate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three greedy tokens for every sequence through the full model."""
    score = generation.model_scorer(_model(spark, sf_dir), 1)
    return _generated(
        generation.generate(_sequences(spark, sf_dir), score, oracle.GREEDY_STEPS, eos=NO_EOS)
    )


def q_generate_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled among three candidates, with an end-of-text token that does occur."""
    score = generation.model_scorer(_model(spark, sf_dir), 3)
    return _generated(
        generation.generate(
            _sequences(spark, sf_dir), score, oracle.SAMPLED_STEPS, eos=oracle.SAMPLED_EOS, top_n=3,
            temperature=2.0, draw=arithmetic_draw,
        )
    )


def q_generate_relational(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `generate`, by a scorer that joins instead of broadcasting the model."""
    score = generation.RelationalScorer(_model(spark, sf_dir), 1)
    return _generated(
        generation.generate(_sequences(spark, sf_dir), score, oracle.GREEDY_STEPS, eos=NO_EOS)
    )


def q_generate_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `generate_sampled`, with keys and values kept between the steps."""
    out = generation.generate_cached(
        _sequences(spark, sf_dir), _model(spark, sf_dir), candidates=3, threshold=oracle.SAMPLED_STEPS,
        eos=oracle.SAMPLED_EOS, top_n=3, temperature=2.0, draw=arithmetic_draw,
    )
    return _generated(out)


def _with_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences with settings of their own."""
    return _sequences(spark, sf_dir).selectExpr(
        "*", "1 + seq_id % 4 AS threshold", "1 + seq_id % 3 AS top_n",
        "element_at(array(0.5D, 1D, 2D), cast(1 + seq_id % 3 AS int)) AS temperature",
        f"if(seq_id % 2 = 0, {oracle.SAMPLED_EOS}, {NO_EOS}) AS eos",
    )


def q_generate_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold, number of candidates, temperature and end token of each row's own."""
    score = generation.model_scorer(_model(spark, sf_dir), 3)
    return _generated(generation.generate(_with_options(spark, sf_dir), score, draw=arithmetic_draw))


def q_generate_options_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = _model(spark, sf_dir)
    return _generated(generation.generate_cached(_with_options(spark, sf_dir), model, 3, draw=arithmetic_draw))


def q_running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Characters of all documents up to each length; equal lengths share their sum."""
    rows = _table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    out = ordering.running_sum(rows, ["n_chars"], "n_chars")
    return out.select(*_big("doc_id", "running"))


def q_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document for every conversation turn, drawn by length from the running sum over all documents."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    sums = cut(ordering.running_sum(docs, ["n_chars", "doc_id"], "n_chars", "high", frame="rows"))
    total = sums.agg(F.max("high")).first()[0] or 0
    spans = sums.select("doc_id", (F.col("high") - F.col("n_chars")).alias("low"), "high")
    mixed = "((conv_id * 1000 + turn) * 1103515245 + 12345) % 1048573"
    turns = _table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", f"({mixed}) * {total}L div 1048573 AS u")
    return ordering.interval_join(turns, "u", spans).select(*_big("conv_id", "turn", "doc_id", "u", "low", "high"))


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "conversations").selectExpr("conv_id * 100000 + turn AS seq_id", "text")


def q_complete_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten tokens for every conversation turn."""
    score = generation.model_scorer(_text_model(spark, sf_dir), 1)
    out = generation.complete_prompts(
        _prompts(spark, sf_dir), "text", _vocab(spark, sf_dir), score, threshold=oracle.PROMPT_STEPS,
        eos=NO_EOS,
    )
    return out.select("seq_id", F.hex("bytes").alias("bytes_hex"), "response")


def q_complete_prompts_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to text through two blocks: two tokens for every conversation turn."""
    score = generation.model_scorer(_text_model(spark, sf_dir, n_block=2), 1)
    out = generation.complete_prompts(
        _prompts(spark, sf_dir), "text", _vocab(spark, sf_dir), score, threshold=2, eos=NO_EOS
    )
    return out.select("seq_id", F.hex("bytes").alias("bytes_hex"), "response")


def entry(spark: SparkSession) -> DataFrame:
    """Whole forward pass and next-token candidates on the smallest tables."""
    return q_next_token_logits(spark, "/root/testdata/sf0.001")


def _llm():
    """The modules of the training-data operators, or none if they or a library they use can't be imported."""
    try:
        import corpus_pipeline
        from weftmill.llm import queries as operators
    except ImportError:
        return None
    return operators, corpus_pipeline


def queries() -> dict[str, Query]:
    found = own_queries()
    if modules := _llm():
        operators, pipeline = modules
        found |= operators.queries() | {"pipeline": pipeline.run}
    return found


def own_queries() -> dict[str, Query]:
    return {
        "explode_dictionary": q_explode_dictionary,
        "transpose_row_vectors": q_transpose_row_vectors,
        "transpose_long": q_transpose_long,
        "validate_table": q_validate_table,
        "load_parameters": q_load_parameters,
        "pretokenize": q_pretokenize,
        "byte_symbols": q_byte_symbols,
        "bpe_merge": q_bpe_merge,
        "bpe_merge_long_parts": q_bpe_merge_long_parts,
        "extend_part_dictionary": q_extend_part_dictionary,
        "bpe_trace": q_bpe_trace,
        "tokenize": q_tokenize,
        "token_sequences": q_token_sequences,
        "text_sequences": q_text_sequences,
        "token_stats_by_lang": q_token_stats_by_lang,
        "token_stats_by_role": q_token_stats_by_role,
        "top_tokens_by_source": q_top_tokens_by_source,
        "detokenize": q_detokenize,
        "decode_sequences": q_decode_sequences,
        "roundtrip_check": q_roundtrip_check,
        "vec_add": _map_query(lambda: V.vec_add("v", F.reverse("v"))),
        "vec_mul": _map_query(lambda: V.vec_mul("v", F.reverse("v"))),
        "vec_scale": _map_query(lambda: V.vec_scale("v", 0.125)),
        "vec_slice": _map_query(lambda: V.vec_slice("v", 17, 16)),
        "vec_preview": _map_query(lambda: V.vec_preview("v")),
        "gelu": _map_query(lambda: V.gelu("v")),
        "inner_product": q_inner_product,
        "vec_sum": q_vec_sum,
        "centroids": q_centroids,
        "unnest_vector": q_unnest_vector,
        "renest_vector": q_renest_vector,
        "embed": q_embed,
        "embed_dropped": q_embed_dropped,
        "layer_norm": q_layer_norm,
        "linear": _linear_query("auto"),
        "linear_packed": _linear_query("packed"),
        "linear_shuffle": _linear_query("shuffle"),
        "linear_blocks": q_linear_blocks,
        "split_heads": q_split_heads,
        "attention_scores": q_attention_scores,
        "attention_scores_full": q_attention_scores_full,
        "attention_softmax": q_attention_softmax,
        "attention_softmax_full": q_attention_softmax_full,
        "attention_output": q_attention_output,
        "attention_merged": q_attention_merged,
        "multi_head_attention": _stage_query(lambda x, m: forward.multi_head_attention(x, m, 0)),
        "multi_head_attention_no_residual": _stage_query(
            lambda x, m: forward.multi_head_attention(x, m, 0, residual=False)
        ),
        "multi_head_attention_relational": _stage_query(
            lambda x, m: forward.multi_head_attention(x, m, 0, method="relational")
        ),
        "multi_head_attention_tiled": _stage_query(
            lambda x, m: forward.multi_head_attention(x, m, 0, method="relational", tile=4)
        ),
        "feed_forward": _stage_query(lambda x, m: forward.feed_forward(x, m, 0)),
        "feed_forward_relational": _stage_query(
            lambda x, m: forward.feed_forward(x, m, 0, method="relational")
        ),
        "transformer_block": _stage_query(lambda x, m: forward.transformer_block(x, m, 0)),
        "transformer_block_relational": _stage_query(
            lambda x, m: forward.transformer_block(x, m, 0, method="relational")
        ),
        "transform": _stage_query(forward.transform),
        "transform_relational": _stage_query(lambda x, m: forward.transform(x, m, "relational")),
        "encode_sequences": _encode_query("arrow"),
        "encode_sequences_relational": _encode_query("relational"),
        "attention_matrix_report": q_attention_matrix_report,
        "last_place": q_last_place,
        "top_n_by_inner_product": _nearest(),
        "top_n_by_inner_product_tiled": _nearest(max_item_bytes=0, tile_rows=128),
        "next_token_logits": q_next_token_logits,
        "temperature_softmax": q_temperature_softmax,
        "temperature_comparison": q_temperature_comparison,
        "cumulative_intervals": _interval_query("rows"),
        "cumulative_intervals_range": _interval_query("reference"),
        "weighted_sample": q_weighted_sample,
        "weighted_sample_reference": q_weighted_sample_reference,
        "generate": q_generate,
        "generate_relational": q_generate_relational,
        "generate_sampled": q_generate_sampled,
        "generate_cached": q_generate_cached,
        "generate_options": q_generate_options,
        "generate_options_cached": q_generate_options_cached,
        "running_sum": q_running_sum,
        "interval_join": q_interval_join,
        "complete_prompts": q_complete_prompts,
        "complete_prompts_blocks": q_complete_prompts_blocks,
    }


def oracle_sql() -> dict[str, str]:
    found = oracle.statements()
    if modules := _llm():
        operators, pipeline = modules
        found |= operators.oracle_sql()
        if pipeline.ORACLE_SQL:
            found["pipeline"] = pipeline.ORACLE_SQL
    return found
