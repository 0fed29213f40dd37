"""Batch generation: all sequences advance one token per step."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from weftmill.functions import kernels
from weftmill.lineage import cut, remove_cut
from weftmill.model import Model
from weftmill.operators.layers import embed, pack_sequences, sequence_rows
from weftmill.operators.ranking import draw_token, last_place, top_n_by_inner_product, uniform
from weftmill.operators.tokens import decode_sequences, text_sequences
from weftmill.plans.forward import encode_sequences
from weftmill.sources.bucketed import BucketedTable

# Fixed id of the end-of-text token.
END_OF_TEXT = 50256
# A state row is a few hundred bytes but minutes of work with a large model, so tasks are sized by
# sequences and not by bytes.
SEQUENCES_PER_TASK = 1000
# Steps that a scorer goes ahead at most.
STEPS_AHEAD = 16

ScoreFn = Callable[[Column], Column]


def model_scorer(model: Model, top_n: int) -> ScoreFn | RelationalScorer:
    """Token-array column to its `top_n` next-token candidates, best first.

    Embedding, blocks, final norm and scoring are one Python function, a slice of sequences at a time, without a
    shuffle. Only the last place is normed and scored. A sequence whose last token has no vector
    gets no candidates. `score.ahead(tokens, steps)` gives the candidates of further steps as well, as they are if each
    time the best one is appended: a step more costs one place and not the whole sequence again. With a token table beyond its bound it is a `RelationalScorer` with broadcast blocks.
    """
    if not model.shares_tokens():
        return RelationalScorer(model, top_n, "arrow")
    params = model.shared()
    # Made once: a function is serialised when it is first used and not again in each step.
    candidates = kernels.prompt_candidates_column(params, model.n_block, model.n_head, model.eps, top_n)

    def ahead(tokens: Column, steps: Column) -> Column:
        # Past the place table a sequence has no last vector: nothing of it is computed.
        return candidates(F.when(F.size(tokens) <= len(params.of("wpe")), tokens), steps)

    def score(tokens: Column) -> Column:
        found = ahead(tokens, F.lit(1))
        none = F.array().cast("array<struct<token:bigint,value:double>>")
        return F.when(found.isNotNull(), F.coalesce(F.get(found, F.lit(0)), none))

    score.top_n, score.ahead = top_n, ahead
    return score


class RelationalScorer:
    """`(seq_id, input)` rows to `(seq_id, token, value)` candidates by joins and aggregations, for
    models of any size. Every place is scored again in each step. `method`: see `forward.encode_sequences`."""

    def __init__(self, model: Model, top_n: int, method: str = "relational"):
        self.model, self.top_n, self.method = model, top_n, method

    def __call__(self, states: DataFrame) -> DataFrame:
        encoded = encode_sequences(sequence_rows(states), self.model, self.method)
        # The written state is read again for the lengths; the encoded rows are used once.
        last = last_place(encoded, states.select("seq_id", F.size("input").alias("n_seq")))
        return top_n_by_inner_product(last, self.model.table("wte"), self.top_n)


OPTIONS = {"threshold": "int", "top_n": "int", "temperature": "double", "eos": "long"}


def _first_state(prompts: DataFrame, defaults: dict) -> DataFrame:
    """`(seq_id, input, original_length, options, active)`: options are the prompt's own columns where it has
    them (a null means the default), else the run's."""
    settings = []
    for name, kind in OPTIONS.items():
        default = F.lit(defaults[name]).cast(kind)
        own = F.coalesce(F.col(name).cast(kind), default) if name in prompts.columns else default
        settings.append(own.alias(name))
    rows = prompts.select("seq_id", "input", F.size("input").alias("original_length"), *settings)
    return rows.withColumn("active", F.col("threshold") > 0)


def _spread(written: DataFrame) -> tuple[DataFrame, dict]:
    """The written first state dealt out over tasks, and what all sequences together ask for."""
    asked = written.agg(
        F.count(F.lit(1)).alias("n"), F.max("threshold").alias("steps"), F.max("top_n").alias("top_n"),
        F.coalesce(F.count_if("active"), F.lit(0)).alias("active"),
    ).first().asDict()
    cores = written.sparkSession.sparkContext.defaultParallelism
    asked["tasks"] = max(cores, math.ceil(asked["n"] / SEQUENCES_PER_TASK))
    return written.repartition(asked["tasks"]), asked


def _lists(rows: DataFrame) -> DataFrame:
    """Candidate rows as one array per sequence, best first: `(seq_id, _c)`."""
    best = F.sort_array(F.collect_list(F.struct((-F.col("value")).alias("low"), "token", "value")))
    return rows.groupBy("seq_id").agg(F.transform(best, lambda c: F.struct(c["token"], c["value"])).alias("_c"))


def _check_scorer(score: object, asked: dict) -> None:
    held = getattr(score, "top_n", None)
    if held is not None and (asked["top_n"] or 0) > held:
        raise ValueError(f"a prompt asks for {asked['top_n']} candidates, the scorer gives {held}")


def _advanced(scored: DataFrame, u: Column, *more: str) -> tuple[DataFrame, int]:
    """The next state from one with `_c`, the candidates of the active sequences: written, with the number of
    sequences that are still active (counted while writing)."""
    drawn = scored.withColumn("_u", u).withColumn("_token", draw_token("_c", "top_n", "temperature", "_u"))
    goes_on = F.col("active") & F.coalesce(F.col("_token") != F.col("eos"), F.lit(False))
    grown = F.when(goes_on, F.array_append("input", F.col("_token").cast("int"))).otherwise(F.col("input"))
    if "ahead" in more:
        best = F.get("_c", F.lit(0))["token"]
        drawn = drawn.withColumn("ahead", F.when(F.col("_token") == best, F.col("ahead")))
    state = drawn.select("seq_id", grown.alias("input"), "original_length", *OPTIONS, goes_on.alias("_on"), *more)
    short = F.size("input") < F.col("original_length") + F.col("threshold")
    state = state.withColumn("active", F.col("_on") & short).drop("_on")
    seen = Observation()
    written = cut(state.observe(seen, F.coalesce(F.count_if("active"), F.lit(0)).alias("active")))
    return written, seen.get["active"]


def _scored_ahead(state: DataFrame, score: ScoreFn) -> DataFrame:
    """`state` with `_c`: the candidates that an earlier step found ahead, else scored now. Only a sequence that takes
    the best candidate each time is scored ahead; where another token is drawn `_advanced` drops what is ahead."""
    left = F.col("original_length") + F.col("threshold") - F.size("input")
    steps = F.when(F.col("top_n") == 1, F.least(left, F.lit(STEPS_AHEAD))).otherwise(1).cast("int")
    unknown = F.when(F.col("active") & F.col("ahead").isNull(), F.col("input"))
    found = state.withColumn("_a", F.coalesce("ahead", score.ahead(unknown, steps))).withColumn("_c", F.get("_a", F.lit(0)))
    rest = F.when(F.size("_a") > 1, F.expr("slice(_a, 2, size(_a) - 1)"))
    return found.withColumn("ahead", rest).drop("_a")


def _finished(state: DataFrame, *more: str) -> DataFrame:
    full = F.size("input") == F.col("original_length") + F.col("threshold")
    return state.select("seq_id", "input", "original_length", full.alias("complete"), *more)


def generate(
    prompts: DataFrame,
    score: ScoreFn | RelationalScorer,
    threshold: int = 10,
    eos: int = END_OF_TEXT,
    top_n: int = 1,
    temperature: float = 2.0,
    seed: int = 20231231,
    draw: Callable[[int], Column] | None = None,
) -> DataFrame:
    """`(seq_id, input[, options])` to `(seq_id, input, original_length, complete)`.

    Each step scores the unfinished sequences, draws one token for each and appends it. A scorer that looks ahead
    scores sequences that take the best candidate for up to `STEPS_AHEAD` steps at once. A
    sequence ends early on the end-of-text token (which is not appended) or without candidates;
    `complete` says that all `threshold` tokens were added. The state is written after every step,
    so a lost executor repeats at most one step; the state before is deleted then.

    `threshold`, `eos`, `top_n` and `temperature` hold for the sequences whose row has no column of that name
    (or a null in it), so one run may mix settings; sequences end at steps of their own. The scorer has to give
    as many candidates as any row asks for. A `top_n` below one gives no candidate.

    `draw(step)` gives the uniform number of a sequence; by default a hash of seed, sequence and
    step. Drawing happens inside the row, from its candidate array.
    """
    draw = draw or (lambda step: uniform(seed, "seq_id", F.lit(step)))
    defaults = {"threshold": threshold, "top_n": top_n, "temperature": temperature, "eos": eos}
    written = cut(_first_state(prompts, defaults))
    state, asked = _spread(written)
    _check_scorer(score, asked)
    active, looks = asked["active"], hasattr(score, "ahead")
    if looks:
        state = state.withColumn("ahead", F.lit(None).cast("array<array<struct<token:bigint,value:double>>>"))
    for step in range(asked["steps"] or 0):
        if not active:
            break
        if isinstance(score, RelationalScorer):
            rows = score(state.filter("active").select("seq_id", "input"))
            scored = state.join(_lists(rows), "seq_id", "left")
        else:
            scored = _scored_ahead(state, score) if looks else state.withColumn("_c", score(F.when(F.col("active"), F.col("input"))))
        spent = written
        written, active = _advanced(scored, draw(step), *(["ahead"] if looks else []))
        state = written
        remove_cut(spent)
    return _finished(state)


def _prompt_vectors(state: DataFrame, model: Model, tasks: int) -> DataFrame:
    """`(seq_id, _rows)` of the sequences whose last place has a vector: token vectors joined, place by place."""
    rows = embed(sequence_rows(state), model.table("wte"), model.table("wpe")).repartition(tasks, "seq_id")
    packed = pack_sequences(rows).join(state.select("seq_id", F.size("input").alias("_n")), "seq_id")
    return packed.filter(F.element_at("places", -1) == F.col("_n") - 1).select("seq_id", F.col("rows").alias("_rows"))


def _newest_vectors(state: DataFrame, model: Model) -> DataFrame:
    """`(seq_id, _vector)` of the last place of each active sequence."""
    last = state.filter("active").select(
        "seq_id", (F.size("input") - 1).alias("place"), F.element_at("input", -1).alias("token")
    )
    rows = embed(last, model.table("wte"), model.table("wpe"))
    return rows.select("seq_id", F.col("values").alias("_vector"))


def generate_cached(
    prompts: DataFrame,
    model: Model,
    candidates: int = 1,
    threshold: int = 10,
    eos: int = END_OF_TEXT,
    top_n: int = 1,
    temperature: float = 2.0,
    seed: int = 20231231,
    draw: Callable[[int], Column] | None = None,
) -> DataFrame:
    """As `generate` with the model as scorer (`candidates` of them), but a step only sends the newest place of
    each sequence through the blocks. `(seq_id, input, original_length, complete, n_scored)`, `n_scored` being
    the places that went through the blocks for the sequence.

    Keys and values of all places and blocks are kept in a table of their own, bucketed by sequence, to which a step
    appends its one new place per sequence: nothing kept is ever rewritten, and a step reads it without a
    shuffle. What a sequence keeps is bounded by the place table. The first pass scores the whole prompt.
    """
    draw = draw or (lambda step: uniform(seed, "seq_id", F.lit(step)))
    defaults = {"threshold": threshold, "top_n": top_n, "temperature": temperature, "eos": eos}
    written = cut(_first_state(prompts, defaults))
    state, asked = _spread(written)
    if (asked["top_n"] or 0) > candidates:
        raise ValueError(f"a prompt asks for {asked['top_n']} candidates, the scorer is set to {candidates}")
    active, params = asked["active"], model.shared()
    shape = (params, model.n_block, model.n_head, model.eps)
    joined_tokens = not model.shares_tokens()
    if joined_tokens:
        first, later = kernels.scored_rows_column(*shape), kernels.scored_vector_column(*shape)
    else:
        first, later = kernels.scored_prompt_column(*shape, candidates), kernels.scored_place_column(*shape, candidates)
    kept = BucketedTable(state.sparkSession, "seq_id", "place", asked["tasks"])
    # Past the place table a sequence has no last vector: nothing of it is computed.
    fits = F.when(F.col("active") & (F.size("input") <= len(params.of("wpe"))), F.col("input"))
    newest = [F.when(F.col("active"), c) for c in (F.element_at("input", -1), F.size("input") - 1)]
    in_order = F.expr("transform(sort_array(collect_list(struct(place, kv))), r -> r.kv)").alias("_kept")
    state = state.withColumn("n_scored", F.lit(0).cast("long"))
    try:
        for step in range(asked["steps"] or 0):
            if not active:
                break
            if step == 0:
                held = _prompt_vectors(state.withColumn("input", fits), model, asked["tasks"]) if joined_tokens else None
                scored = state.join(held, "seq_id", "left") if joined_tokens else state
                scored = scored.withColumn("_s", first("_rows" if joined_tokens else fits)).withColumn("kv", F.col("_s.kv"))
            else:
                held = _newest_vectors(state, model) if joined_tokens else None
                joined = state.drop("kv").join(kept.table.groupBy("seq_id").agg(in_order), "seq_id", "left")
                joined = joined.join(held, "seq_id", "left") if joined_tokens else joined
                scored = joined.withColumn("_s", later(*(["_vector"] if joined_tokens else newest), "_kept"))
                scored = scored.withColumn("kv", F.when(F.col("_s.kv").isNotNull(), F.array("_s.kv")))
            scored = scored.withColumn("n_scored", F.col("n_scored") + F.greatest(F.coalesce(F.size("kv"), F.lit(0)), F.lit(0)))
            scored = scored.withColumn("place", F.lit(0) if step == 0 else F.size("input") - 1)
            ran = None
            if joined_tokens:
                # Read for the candidates and for the state.
                ran = cut(scored.withColumn("_last", F.col("_s.last")).drop("_s", "_rows", "_vector", "_kept"))
                last = ran.filter("_last IS NOT NULL").select("seq_id", F.col("_last").alias("values"))
                best = top_n_by_inner_product(last, model.table("wte"), candidates)
                scored = ran.drop("_last").join(_lists(best), "seq_id", "left")
            else:
                scored = scored.withColumn("_c", F.col("_s.candidates"))
            spent = written
            # Written once with the new keys and values, which only the append below reads.
            written, active = _advanced(scored, draw(step), "n_scored", "place", "kv")
            state = written
            if active:
                places = written.filter("active").select("seq_id", "place", F.posexplode("kv").alias("_at", "kv"))
                kept.append(places.select("seq_id", (F.col("place") + F.col("_at")).alias("place"), "kv"))
            remove_cut(spent)
            if ran is not None:
                remove_cut(ran)
    finally:
        kept.drop()
    return _finished(state, "n_scored")


def complete_prompts(
    prompts: DataFrame,
    text_col: str,
    vocab: DataFrame,
    score: ScoreFn | RelationalScorer | Model,
    partial: bool = False,
    **options,
) -> DataFrame:
    """`(seq_id, text[, options])` to `(seq_id, bytes, response)`: prompt and generated text.

    One row per prompt. A sequence that ended early has null `bytes` and `response`, unless
    `partial` is set. With a scorer `options` go to `generate`, with a model to `generate_cached`; a prompt's
    own columns `threshold`, `eos`, `top_n` and `temperature` go before them.
    """
    start = text_sequences(prompts, text_col, ["seq_id"], vocab)
    own = [c for c in OPTIONS if c in prompts.columns]
    if own:
        start = start.join(prompts.select("seq_id", *own), "seq_id")
    grown = (generate_cached if isinstance(score, Model) else generate)(start, score, **options)
    kept = grown if partial else grown.filter("complete")
    decoded = decode_sequences(kept, vocab, "input", ["seq_id"])
    return prompts.select("seq_id").join(decoded, "seq_id", "left")
