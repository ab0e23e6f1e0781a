"""Every registered query against its SQL, as rows sorted by column name and value."""

import os

import duckdb
import pandas as pd
import pytest

import registry

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    texts = frame.map(lambda v: "" if v is None else f"{v}")
    for column in frame.columns:
        texts[column] = [
            "<null>" if v is None else f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
            for v in frame[column]
        ]
    return texts.sort_values(list(texts.columns)).reset_index(drop=True)


def test_every_query_has_sql():
    assert registry.QUERIES.keys() == registry.ORACLE.keys()


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query_equals_sql(spark, duck, name):
    got = canonical(registry.QUERIES[name](spark, FOLDER).toPandas())
    want = canonical(duck.sql(registry.ORACLE[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(want) > 0
    pd.testing.assert_frame_equal(got, want)
