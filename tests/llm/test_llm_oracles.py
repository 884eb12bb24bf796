"""Every training-data query with a SQL form against DuckDB on the smallest tables, and the registry."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001
from lakeward.llm.oracles import ORACLE
from lakeward.llm.queries import QUERIES


def test_all_are_registered():
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    df = QUERIES[name](spark, SF001)
    got = con.execute(ORACLE[name])
    names = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    assert Counter(tuple(str(r[c]) for c in order) for r in df.collect()) == \
        Counter(tuple(str(r[names.index(c)]) for c in order) for r in got.fetchall())
