"""Stage by stage on the smallest tables, and the whole run."""

from __future__ import annotations

from collections import Counter

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from weftmill.lineage import cut
from weftmill.llm import mixing, queries, simhash


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _name, stage in corpus_pipeline.STAGES:
        found = cut(stage(spark, docs, sf_dir))
        out.append((docs, found))
        docs = found
    return out


def test_stages(stages, sf_dir, spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mix_sources", "pack"]
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert all(found.columns == columns for _, found in stages[:-1])
    before, after = stages[0]
    assert after.count() >= 0.99 * before.count()
    before, after = stages[1]
    best: dict = {}
    for r in before.collect():
        best[r["text"] or ""] = max(best.get(r["text"] or "", r), r, key=lambda x: x["doc_id"])
    assert sorted(after.collect()) == sorted(best.values())
    before, after = stages[2]
    groups = {r["component_id"] for r in simhash.near_duplicates(before).collect()}
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(groups)
    before, after = stages[3]
    copies = {r["doc_id"]: r["copies"] for r in mixing.plan_mix(before, **queries.MIX).collect()}
    assert Counter(r["doc_id"] for r in after.collect()) == Counter({i: n for i, n in copies.items() if n})
    before, after = stages[4]
    assert after.filter("piece = 0").count() == before.count()


def test_run_equals_stages(spark, sf_dir, stages):
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found = entry_module.queries()["pipeline"](spark, sf_dir).select(*keys)
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, stages[-1][1].select(*keys).collect()))


def test_odd_and_empty_tables(spark, odd_tables, empty_tables):
    assert corpus_pipeline.run(spark, odd_tables).count() > 0
    assert corpus_pipeline.run(spark, empty_tables).count() == 0
