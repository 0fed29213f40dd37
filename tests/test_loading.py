"""The checked load of parameter tables."""

from __future__ import annotations

import pytest

from weftmill.model import Model
from weftmill.operators.ingest import TableSpec
from weftmill.sources import loading

SPECS = {"c_proj_b": TableSpec(("block",), ("values",), {"values": 2}), "words": TableSpec(("token",), ("token",))}


def tables(spark, *vectors):
    rows = spark.createDataFrame(list(enumerate(vectors)), "block int, values array<double>")
    return {"c_proj_b": rows, "words": spark.createDataFrame([(1, "a"), (2, "b")], "token int, cluster string")}


def loaded(spark, folder):
    return sorted(tuple(r) for r in loading.loaded_table(spark, folder, "c_proj_b").collect())


def test_bad_table_leaves_the_old_one(spark, tmp_path):
    folder = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError):
        loading.loaded_table(spark, folder, "words")
    first = loading.load_tables(tables(spark, [1.0, 2.0], [3.0, 4.0]), folder, SPECS)
    assert loaded(spark, folder) == [(0, [1.0, 2.0]), (1, [3.0, 4.0])]
    for bad, rule in (([1.0], "width:values"), ([1.0, float("nan")], "nan:values"), (None, "null:values")):
        with pytest.raises(loading.LoadError) as error:
            loading.load_tables(tables(spark, [9.0, 9.0], bad), folder, SPECS)
        assert error.value.violations == [("c_proj_b", rule, 1)]
        assert loaded(spark, folder) == [(0, [1.0, 2.0]), (1, [3.0, 4.0])]
    # What failed is gone, what is current stays.
    assert loading.current_version(spark, folder) == first
    assert loading.remove_old_versions(spark, folder) == 0
    second = loading.load_tables(tables(spark, [5.0, 6.0]), folder, SPECS)
    assert second != first and loaded(spark, folder) == [(0, [5.0, 6.0])]
    assert loading.remove_old_versions(spark, folder) == 1
    assert loaded(spark, folder) == [(0, [5.0, 6.0])]


def test_a_failed_write_leaves_the_old_one(spark, tmp_path):
    folder = str(tmp_path / "model")
    loading.load_tables(tables(spark, [1.0, 2.0]), folder, SPECS)
    broken = tables(spark, [3.0, 4.0])
    broken["words"] = broken["words"].selectExpr("token", "raise_error('no') AS cluster")
    with pytest.raises(Exception, match="no"):
        loading.load_tables(broken, folder, SPECS)
    assert loaded(spark, folder) == [(0, [1.0, 2.0])]


def test_a_block_is_read_from_its_own_files(spark, model, tmp_path):
    folder = str(tmp_path / "model")
    model.load(folder)
    again = Model.read(spark, folder, model.n_head, model.n_block)
    plan = again.table("c_attn_w", 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(block" in plan
    assert again.table("c_attn_w", 1).count() == 192
    assert len({f.rsplit("block=")[1][0] for f in again.table("c_attn_w", 1).inputFiles()}) >= 1
    same = lambda m: sorted(map(str, m.table("mlp_c_fc_w", 0).select("place", "values").collect()))
    assert same(again) == same(model)
