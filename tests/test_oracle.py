"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from check_oracle import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


# Merging whole documents symbol by symbol and attention over whole prompts are too slow in SQL; see
# `test_text.py` and `test_generation.py`.
WITHOUT_SQL = {"bpe_merge_long_parts", "complete_prompts_blocks"}


def test_every_query_has_sql():
    assert set(entry_module.own_queries()) - WITHOUT_SQL == set(entry_module.oracle.statements())


@pytest.mark.parametrize("name", sorted(set(entry_module.own_queries()) - WITHOUT_SQL))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert difference(spark, con, sf_dir, name) == ""


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["seq_id", "token", "value"]
