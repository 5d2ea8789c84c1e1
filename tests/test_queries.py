"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry
from fieldloom.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


@pytest.fixture(scope="module")
def con(data):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    return c


def plain(rows, columns):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted([tuple(str(r[i])[:26] if hasattr(r[i], "isoformat") else r[i] for i in at) for r in rows], key=repr)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, (int, float)):
        return (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)
    return a == b or str(a) == str(b)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, data, con, name):
    df = registry.queries()[name](spark, data)
    want = con.sql(registry.oracle_sql()[name])
    kinds = {c: TYPES.get(str(t), str(t)) for c, t in zip(want.columns, want.types, strict=True)}
    assert kinds == dict(df.dtypes)
    a, b = plain(want.fetchall(), want.columns), plain(df.collect(), df.columns)
    assert len(a) == len(b)
    assert [(x, y) for x, y in zip(a, b, strict=True) if not all(map(same, x, y))] == []


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_query_runs(spark, data, name):
    assert registry.queries()[name](spark, data).count() > 0


def test_path_template_keeps_long_ids(spark, tmp_path):
    spark.createDataFrame([(7, "u", "h"), (123456, "u", "h")], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.path for r in registry.queries()["k18_path_template"](spark, str(tmp_path)).collect()}
    assert got == {7: "out/2/chip_00007.tif", 123456: "out/1/chip_123456.tif"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
