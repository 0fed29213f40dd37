from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from weftmill.session import build_session

    session = build_session(
        "weftmill-tests",
        "local[8]",
        spark__driver__memory="12g",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def embeddings(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


@pytest.fixture(scope="session")
def model(embeddings):
    from weftmill import fixtures

    return fixtures.mini_model(fixtures.embedding_tokens(embeddings))


@pytest.fixture(scope="session")
def token_rows(embeddings):
    from weftmill import fixtures

    return fixtures.embedding_sequences(embeddings)
