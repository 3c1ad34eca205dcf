"""Swaps of relays against lists in plain Python."""

import math

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from eventide.operators import relays as re
from eventide.plans import relay_queries


def test_share_of_many_relays(spark):
    """A share of over 100 pairs is whole where no number of candidates is given."""
    rows = [(f"r{i:04}", "seed" if i % 5 == 0 else "discovered", "active" if i % 2 else "idle", i * 37 % 1000 / 100) for i in range(1200)]
    named = spark.createDataFrame(rows, "url string, tier string, status string, score double")
    scored = named.selectExpr("url AS relay_url", "score").where("relay_url <> 'r0001'")
    score = {u: 0.0 if u == "r0001" else x for u, _, _, x in rows}
    worst = sorted((math.inf if tier == "seed" else score[u], u) for u, tier, status, _ in rows if status == "active")
    best = sorted((-score[u], u) for u, _, status, _ in rows if status == "idle")
    for candidates, most in ((None, 150), (100, 100), (7, 7)):
        want = [(u, v) for (low, u), (high, v) in zip(worst[:most], best, strict=False) if -high > low + 0.1]
        got = re.swaps(named.select("url", "tier", "status"), scored, named.where("status = 'active'").select("url"), share=0.25, candidates=candidates)
        assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) == most


@pytest.mark.parametrize("n", [40, 4000])
def test_query_is_its_sql(spark, tmp_path, n):
    lines = [(i, i * 7 % n, i % 11, i % 4 + 1, i * i % 50) for i in range(4 * n)]
    tables = {
        "supplier": {"s_suppkey": pa.array(range(n), pa.int64())},
        "lineitem": {c: pa.array(x, pa.int64()) for c, x in zip(("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_quantity"), zip(*lines, strict=True), strict=True)},
    }
    con = duckdb.connect()
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), str(tmp_path / f"{name}.parquet"))
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path / name}.parquet'")
    want = con.sql(relay_queries.SQL["t07_swaps"]).fetchall()
    got = relay_queries.QUERIES["t07_swaps"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > (100 if n > 1000 else 0)
