import glob
import os

import duckdb
import pytest

from quoin.plans import catalog, problems

SF = "/root/testdata/sf0.001"
QUERIES = {**problems.QUERIES, **catalog.QUERIES}
ORACLE = {**problems.ORACLE, **catalog.ORACLE}


def rows(pdf):
    def plain(v):
        return "nan" if v != v else repr(round(v, 5) + 0.0) if isinstance(v, float) else str(v)

    return sorted(tuple(plain(v) for v in r) for r in pdf[sorted(pdf.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    got, want = QUERIES[name](spark, SF).toPandas(), con.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_no_cross_join(spark):
    for name in ("geo_radius_join", "hamming_self_join", "p6_found"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
