"""Queries on vectors against their SQL."""

import duckdb
import pytest

from mercato.llm import queries


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
@pytest.mark.parametrize("name", ["op3_top_k", "op13_hard_negatives"])
def test_query_is_its_sql(spark, name, sf):
    folder = f"/root/testdata/sf{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    found = con.execute(queries.all_oracles()[name])
    columns = [c[0] for c in found.description]
    got = queries.all_queries()[name](spark, folder)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(found.fetchall())
