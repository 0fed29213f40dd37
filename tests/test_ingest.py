from __future__ import annotations

from types import SimpleNamespace

import pytest

from weftmill import lineage
from weftmill.operators import ingest
from weftmill.sources import tables


def test_explode_dictionary(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": "x"}'), (2, "{}"), (3, None)], "id int, j string")
    out = ingest.explode_dictionary(df, "j", ["id"])
    assert out.columns == ["id", "value", "key"]
    assert sorted(map(tuple, out.collect())) == [(1, "1", "a"), (1, "x", "b")]


def test_json_dictionary_files(spark, tmp_path):
    (tmp_path / "vocab.json").write_text('{"Ġthe": 262,\n "a": 64}', encoding="utf-8")
    out = tables.read_json_dictionary(spark, str(tmp_path / "vocab.json"), "token", "cluster")
    assert sorted(map(tuple, out.collect())) == [(64, "a"), (262, "Ġthe")]


def test_transpose(spark):
    df = spark.createDataFrame([(0, 1, [3.0, 4.0]), (0, 0, [1.0, 2.0]), (1, 0, [5.0, 6.0])], "b int, r int, v array<double>")
    out = {(r["b"], r["place"]): r["values"] for r in ingest.transpose_row_vectors(df, "r", "v", ["b"]).collect()}
    assert out == {(0, 0): [1.0, 3.0], (0, 1): [2.0, 4.0], (1, 0): [5.0], (1, 1): [6.0]}


def test_validate(spark):
    rows = [(1, "a", [1.0, 2.0]), (1, "b", [1.0]), (2, None, None), (3, "c", [1.0, float("nan")])]
    df = spark.createDataFrame(rows, "k int, t string, v array<double>")
    spec = ingest.TableSpec(key=("k",), not_null=("t", "v"), widths={"v": 2})
    out = sorted(map(tuple, ingest.validate_table(df, spec).collect()))
    assert out == [("duplicate", "1", 2), ("nan:v", "3", 1), ("null:t", "2", 1), ("null:v", "2", 1), ("width:v", "1", 1)]


def _session(folder, master):
    conf = SimpleNamespace(get=lambda key, default=None: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_checkpoint_folder_comes_from_the_session(spark):
    assert lineage.checkpoint_root(_session("hdfs:///shared/", "spark://host")) == "hdfs:///shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        lineage.checkpoint_root(_session(None, "spark://host"))
    written = lineage.cut(spark.range(3))
    assert written.count() == 3
    assert all(lineage.checkpoint_root(spark) in f for f in written.inputFiles())


def test_fits(spark):
    from pyspark.sql import functions as F

    df = spark.range(10)
    assert lineage.fits(df, max_rows=10) and not lineage.fits(df, max_rows=9)
    assert lineage.fits(df, F.lit(8), max_bytes=80) and not lineage.fits(df, F.lit(8), max_bytes=79)


@pytest.mark.parametrize("bound", [{}, {"max_rows": 0}])
def test_lookup_of_one_hot_key(spark, bound):
    from pyspark.sql import functions as F

    facts = spark.range(3000).withColumn("key", (F.col("id") % 3 * (F.col("id") % 7)).cast("int"))
    table = spark.range(5).select(F.col("id").cast("int").alias("key"), (F.col("id") * 10).alias("v"))
    out = lineage.lookup(facts, table, "key", ["id"], **bound)
    expected = facts.filter("key < 5").count()
    assert out.count() == expected and out.filter("v <> key * 10").isEmpty()
    assert out.select("id").distinct().count() == expected


def test_malformed_dictionary_fails_and_is_counted(spark):
    df = spark.createDataFrame([(1, '{"a": 1}'), (2, "{bad"), (3, None)], "id int, j string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        ingest.explode_dictionary(df, "j", ["id"]).collect()
    assert [r["id"] for r in ingest.malformed_dictionaries(df, "j", ["id"]).collect()] == [2]


def test_infinity_and_null_keys(spark):
    rows = [("a", None, [1.0, float("inf")]), (None, "a", [1.0, 2.0]), (None, "a", [1.0, 2.0]), ("x|y", "z", None), ("x|y", "z", None)]
    df = spark.createDataFrame(rows, "k string, l string, v array<double>")
    found = ingest.validate_table(df, ingest.TableSpec(("k", "l"), ("v",), {"v": 2}))
    assert sorted(map(tuple, found.collect())) == [
        ("duplicate", "x\\|y|z", 2), ("infinite:v", "a|\\N", 1), ("null:v", "x\\|y|z", 2),
    ]


def test_remove_cuts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lineage, "_written", [])
    monkeypatch.setattr(lineage, "checkpoint_root", lambda s: str(tmp_path))
    assert lineage.cut(spark.range(5)).count() == 5
    assert len(list(tmp_path.iterdir())) == 1
    assert lineage.remove_cuts(spark) == 1 and not list(tmp_path.iterdir())
