"""Generation with kept keys and values, settings per row, and the bucketed table behind it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weftmill.plans import generation
from weftmill.sources.bucketed import BucketedTable


def prompts(spark, rows):
    return spark.createDataFrame(rows, "seq_id long, input array<int>")


def state(df):
    return {r["seq_id"]: (list(r["input"]), r["complete"]) for r in df.collect()}


ROWS = [(1, [5, 6, 7]), (2, [400]), (3, [1, 99999, 2]), (4, [1, 99999]), (5, list(range(65))), (6, list(range(63))), (7, [3] * 20)]


def test_cached_equals_scoring_again(spark, model):
    """Unknown tokens inside and at the end, prompts past the place table and up to its last place."""
    df = prompts(spark, ROWS)
    options = {"threshold": 4, "eos": -1, "top_n": 3}
    again = generation.generate(df, generation.model_scorer(model, 3), **options)
    cached = generation.generate_cached(df, model, 3, **options)
    assert state(cached) == state(again)
    assert {k for k, (_, complete) in state(cached).items() if complete} == {1, 2, 3, 7}


def test_one_place_per_step(spark, model):
    """Whatever the length, a step sends one place of a sequence through the blocks."""
    found = {r["seq_id"]: r for r in generation.generate_cached(prompts(spark, ROWS), model, 1, threshold=5, eos=-1).collect()}
    for k in (1, 2, 7):
        assert found[k]["n_scored"] == found[k]["original_length"] + 4
    assert found[3]["n_scored"] == 2 + 4  # one of its three tokens has no vector
    assert found[4]["n_scored"] == found[5]["n_scored"] == 0
    assert found[6]["n_scored"] == 63 + 1  # the place table ends at 64


def test_early_end_keeps_the_prompt(spark, model):
    first = state(generation.generate_cached(prompts(spark, ROWS[:2]), model, 1, threshold=1, eos=-1))
    token = first[1][0][-1]
    found = state(generation.generate_cached(prompts(spark, ROWS[:2]), model, 1, threshold=3, eos=token))
    assert found[1] == ([5, 6, 7], False)


def test_nothing_to_do(spark, model):
    assert state(generation.generate_cached(prompts(spark, []), model)) == {}
    assert state(generation.generate_cached(prompts(spark, ROWS[:1]), model, threshold=0)) == {1: ([5, 6, 7], True)}


@pytest.mark.parametrize("cached", [False, True])
def test_settings_per_row(spark, model, cached):
    """A run that mixes settings gives each row what a run of its own gives."""
    mixed = [(1, [5, 6, 7], 3, 1, 2.0, -1), (2, [400], 1, 3, 0.5, None), (3, [1, 2], 0, 2, 1.0, -1), (4, [9], None, None, None, -1)]
    df = spark.createDataFrame(mixed, "seq_id long, input array<int>, threshold int, top_n int, temperature double, eos long")

    def run(rows, **options):
        if cached:
            return state(generation.generate_cached(rows, model, 3, **options))
        return state(generation.generate(rows, generation.model_scorer(model, 3), **options))

    defaults = {"threshold": 2, "top_n": 2, "temperature": 1.5, "eos": 7}
    together = run(df, **defaults)
    for i, tokens, *own in mixed:
        options = {k: d if v is None else v for (k, d), v in zip(defaults.items(), own)}
        assert run(prompts(spark, [(i, tokens)]), **options) == {i: together[i]}
    assert len(together[1][0]) == 6 and len(together[3][0]) == 2


def test_more_candidates_than_the_scorer_gives(spark, model):
    with pytest.raises(ValueError, match="candidates"):
        generation.generate(prompts(spark, ROWS), generation.model_scorer(model, 2), top_n=3)
    with pytest.raises(ValueError, match="candidates"):
        generation.generate_cached(prompts(spark, ROWS), model, 2, top_n=3)


def test_spent_states_are_deleted(spark, model):
    from weftmill import lineage

    before = len(lineage._written)
    generation.generate(prompts(spark, ROWS), generation.model_scorer(model, 1), threshold=3).collect()
    generation.generate_cached(prompts(spark, ROWS), model, threshold=3).collect()
    assert len(lineage._written) - before == 2
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("weftmill_")] == []


def test_bucketed_table_needs_no_exchange(spark):
    table = BucketedTable(spark, "k", "i", 4)
    for part in range(3):
        table.append(spark.range(40).select((F.col("id") % 7).alias("k"), (F.col("id") + 40 * part).alias("i")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        grouped = table.table.groupBy("k").agg(F.count("*").alias("n"))
        few = spark.range(5).withColumnRenamed("id", "k")
        joined = few.join(grouped, "k", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, plan
        assert grouped._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0
        assert sum(r["n"] for r in grouped.collect()) == 120
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        table.drop()
