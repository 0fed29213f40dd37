from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftmill import fixtures
from weftmill.functions.bytesym import encoder_rows
from weftmill.operators import layers, ranking
from weftmill.plans import forward, generation


def prompts(spark, rows):
    return spark.createDataFrame(rows, "seq_id long, input array<int>")


def fixed(*candidates):
    """A scorer with the same candidates everywhere."""
    rows = [F.struct(F.lit(t).cast("long").alias("token"), F.lit(float(v)).alias("value")) for t, v in candidates]
    return lambda tokens: F.when(tokens.isNotNull(), F.array(*rows))


def state(df):
    return {r["seq_id"]: (list(r["input"]), r["complete"]) for r in df.collect()}


def test_greedy(spark):
    out = generation.generate(prompts(spark, [(1, [5]), (2, [6, 7])]), fixed((9, 1.0)), threshold=3)
    assert state(out) == {1: ([5, 9, 9, 9], True), 2: ([6, 7, 9, 9, 9], True)}


def test_end_of_text_at_first_step(spark):
    out = generation.generate(prompts(spark, [(1, [5])]), fixed((50256, 1.0)), threshold=3)
    assert state(out) == {1: ([5], False)}


def test_no_candidates_ends_the_sequence(spark):
    out = generation.generate(prompts(spark, [(1, [5])]), lambda t: F.lit(None).cast("array<struct<token:bigint,value:double>>"), threshold=3)
    assert state(out) == {1: ([5], False)}


def test_sampled_draws_follow_u(spark):
    score = fixed((3, 0.0), (4, 0.0))
    low = generation.generate(prompts(spark, [(1, [5])]), score, threshold=2, top_n=2, draw=lambda s: F.lit(0.1))
    high = generation.generate(prompts(spark, [(1, [5])]), score, threshold=2, top_n=2, draw=lambda s: F.lit(0.9))
    assert state(low) == {1: ([5, 3, 3], True)} and state(high) == {1: ([5, 4, 4], True)}


def test_sampling_is_reproducible(spark, model, token_rows):
    start = token_rows.filter("place < 3").groupBy("seq_id").agg(
        F.sort_array(F.collect_list(F.struct("place", "token")))["token"].alias("input")
    )
    score = generation.model_scorer(model, 4)
    run = lambda df: state(generation.generate(df, score, threshold=3, top_n=4))
    assert run(start.repartition(5)) == run(start.coalesce(1))


def test_batch_equals_single_runs(spark, model):
    score = generation.model_scorer(model, 1)
    rows = [(1, [5, 6, 7]), (2, [400]), (3, [1, 2])]
    batch = state(generation.generate(prompts(spark, rows), score, threshold=2))
    for row in rows:
        assert state(generation.generate(prompts(spark, [row]), score, threshold=2)) == {row[0]: batch[row[0]]}


def test_scorer_equals_whole_forward_pass(spark, model):
    long = list(range(65))
    df = prompts(spark, [(1, [5, 6, 7]), (2, [400]), (3, [1, 99999, 2]), (4, [1, 99999]), (5, long), (6, long[:64])])
    found = df.select("seq_id", F.inline(generation.model_scorer(model, 3)(F.col("input"))))
    encoded = forward.encode_sequences(layers.sequence_rows(df), model, "relational")
    last = ranking.last_place(encoded, df.select("seq_id", F.size("input").alias("n_seq")))
    expected = ranking.top_n_by_inner_product(last, model.table("wte"), 3)
    key = lambda d: sorted((r["seq_id"], r["token"], round(r["value"], 9)) for r in d.collect())
    assert key(found) == key(expected)
    assert {r[0] for r in key(found)} == {1, 2, 3, 6}


@pytest.fixture(scope="module")
def text_case(spark):
    vocab = spark.createDataFrame([(b, c) for c, b in encoder_rows()], "token int, cluster string")
    return vocab, spark.createDataFrame([(1, "ab"), (2, ""), (3, "c")], "seq_id long, text string")


def test_complete_prompts(spark, text_case):
    vocab, df = text_case
    out = generation.complete_prompts(df, "text", vocab, fixed((33, 1.0)), threshold=2)
    assert {r["seq_id"]: r["response"] for r in out.collect()} == {1: "ab!!", 2: None, 3: "c!!"}


def test_early_stop_gives_null_or_partial_text(spark, text_case):
    vocab, df = text_case
    stop = fixed((33, 1.0))
    strict = generation.complete_prompts(df, "text", vocab, stop, threshold=2, eos=33)
    assert {r["response"] for r in strict.collect()} == {None}
    partial = generation.complete_prompts(df, "text", vocab, stop, partial=True, threshold=2, eos=33)
    assert {r["seq_id"]: r["response"] for r in partial.collect()} == {1: "ab", 2: None, 3: "c"}


def test_generated_model_is_deterministic_over_fixtures(spark, embeddings):
    again = fixtures.mini_model(fixtures.embedding_tokens(embeddings))
    w = {r["y"]: r["values"][:2] for r in again.table("c_attn_w", 0).filter("y < 2").collect()}
    f = lambda i, j: 0.1 * (((7919 + i * 104729 + j * 1299709 + i * j * 8191) % 2003) - 1001) / 1001.0
    for i in (0, 1):
        assert all(abs(w[i][j] - f(i, j)) < 1e-15 for j in (0, 1))


def test_prompts_through_blocks_equal_the_relational_way(spark, sf_dir):
    """Both generated tokens of every prompt, from tokenising to decoding, with a scorer that shares
    nothing with the registered one."""
    import __spark_entry__ as entry_module
    from pyspark.sql import functions as F

    found = {r["seq_id"]: r["bytes_hex"] for r in entry_module.q_complete_prompts_blocks(spark, sf_dir).collect()}
    some = entry_module._prompts(spark, sf_dir).filter(F.length("text") < 60)
    model = entry_module._text_model(spark, sf_dir, n_block=2)
    out = generation.complete_prompts(
        some, "text", entry_module._vocab(spark, sf_dir), generation.RelationalScorer(model, 1), threshold=2, eos=-1
    )
    expected = {r["seq_id"]: None if r["bytes"] is None else bytes(r["bytes"]).hex().upper() for r in out.collect()}
    assert expected and {k: found[k] for k in expected} == expected
    assert len(found) == entry_module._prompts(spark, sf_dir).count()


@pytest.mark.parametrize("name", ["generate", "generate_cached"])
def test_token_table_beyond_its_bound(spark, sf_dir, model, monkeypatch, name):
    """It is joined instead of broadcast, with equal results, and no worker is given it."""
    import __spark_entry__ as entry
    import weftmill.model as models

    rows = lambda m: sorted(map(tuple, made(m).select("seq_id", "input", "complete").collect()))
    start = entry._sequences(spark, sf_dir)
    options = {"threshold": 2, "eos": -1, "top_n": 2, "draw": entry.arithmetic_draw}
    if name == "generate":
        made = lambda m: generation.generate(start, generation.model_scorer(m, 2), **options)
    else:
        made = lambda m: generation.generate_cached(start, m, 2, **options)
    expected = rows(model)
    monkeypatch.setattr(models, "MAX_TOKEN_BYTES", 1000)
    large = models.Model(model.tables, model.n_head, model.n_block)
    assert rows(large) == expected
    assert "wte" not in large.shared()._parts


def test_steps_ahead_equal_single_steps(spark, model):
    """Further candidates come from one new place each; they are those of the sequence with the best one appended, and
    end with the place table."""
    rows = [(1, [5, 6, 7]), (2, [400]), (3, [1, 99999, 2]), (4, [1, 99999]), (5, list(range(62))), (6, list(range(65)))]
    score = generation.model_scorer(model, 3)
    df = prompts(spark, [*rows, (7, None)])
    found = {r["seq_id"]: r["a"] for r in df.select("seq_id", score.ahead(F.col("input"), F.lit(4)).alias("a")).collect()}
    assert {k: None if v is None else len(v) for k, v in found.items()} == {1: 4, 2: 4, 3: 4, 4: 0, 5: 3, 6: None, 7: None}
    for step in range(4):
        now = {r["seq_id"]: r["c"] for r in prompts(spark, rows).select("seq_id", score(F.col("input")).alias("c")).collect()}
        for seq, _ in rows:
            if found[seq] and step < len(found[seq]):
                assert [c["token"] for c in found[seq][step]] == [c["token"] for c in now[seq]]
                assert [c["value"] for c in found[seq][step]] == pytest.approx([c["value"] for c in now[seq]], abs=1e-9)
            else:
                assert not now[seq]
        rows = [(seq, [*tokens, now[seq][0]["token"]] if now[seq] else tokens) for seq, tokens in rows]


@pytest.mark.parametrize("top_n", [1, 2])
def test_looking_ahead_changes_no_sequence(spark, model, top_n):
    """With settings of their own, an end token that occurs and sequences that meet the end of the place table."""
    rows = [(i, list(range(i, 3 * i + 1)), 1 + i % 4, 1 + i % top_n) for i in range(1, 32)]
    df = spark.createDataFrame(rows, "seq_id long, input array<int>, threshold int, top_n int")
    score = generation.model_scorer(model, 2)
    alone = lambda tokens: score(tokens)
    scored = []
    score.ahead, ahead = (lambda tokens, steps: scored.append(1) or ahead(tokens, steps)), score.ahead
    found = state(generation.generate(df, score, eos=300))
    assert scored and found == state(generation.generate(df, alone, eos=300))
