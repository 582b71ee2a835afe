import datetime
import glob
import os

import duckdb
import pytest

from quillspark import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def rounded(v):
    return round(v, 6) if isinstance(v, float) else str(v) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = catalogue.QUERIES[name](spark, SF)
    want = con.sql(catalogue.ORACLE_SQL[name])
    order = sorted(df.columns)
    assert order == sorted(want.columns)
    at = [want.columns.index(c) for c in order]
    got = sorted((tuple(rounded(r[c]) for c in order) for r in df.collect()), key=repr)
    assert got == sorted((tuple(rounded(r[i]) for i in at) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", ["combine_left_join", "combine_merge_join", "combined_tsv_lines", "combined_jsonl_lines", "nfkc_fold_roundtrip", "sara_am_equal"])
def test_queries_that_normalize_start_no_python_workers(spark, name):
    plan = catalogue.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "InArrow" not in plan and "InPandas" not in plan
