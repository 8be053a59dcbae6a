"""Plan checks (pushdown, no Python evaluation) and the DuckDB oracle for
every registered query at sf0.001."""

import hashlib
import math

import pytest

import __spark_entry__ as E
from tessera import jobs
from testdata_dirs import SF_SMALL
from tools.plan_summary import final_lines

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF",
            "MapInArrow", "FlatMapCoGroupsInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_filter_pushed_and_pruned(spark):
    plan = _plan(jobs.q_range_filter(spark, SF_SMALL))
    assert "GreaterThanOrEqual(c_nationkey,13)" in plan and "LessThanOrEqual(c_nationkey,19)" in plan
    assert "ReadSchema: struct<c_name:string,c_nationkey:int>" in plan


def test_year_filter_pushed(spark):
    plan = _plan(jobs.q_year_text_filter(spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_top20_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(jobs.q_word_count_top20(spark, SF_SMALL))


@pytest.mark.parametrize("query", [jobs.q_tfidf, jobs.q_doc_keyword, jobs.q_tfidf_hashed])
def test_one_plan_for_split_and_unsplit_input(spark, tmp_path, query):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    docs.repartition(40).write.parquet(str(tmp_path / "documents.parquet"))
    for sf_dir in (SF_SMALL, str(tmp_path)):
        df = query(spark, sf_dir)
        df.collect()
        final = final_lines(_plan(df))
        tokenising = [ln for ln in final if "Generate explode(" in ln and "regexp_extract_all" in ln]
        scans = [ln for ln in final if "FileScan parquet" in ln]
        assert len(tokenising) == 1 and any("ReusedExchange" in ln for ln in final)
        # the tokens move once; the document count is a guarded scan of its own
        moves = [ln for ln in final if "REPARTITION_BY_NUM" in ln and "ReusedExchange" not in ln]
        assert len(moves) == 1 and len(scans) <= 2


def test_json_is_parsed_once(spark):
    for query, call in ((jobs.q_trail_events, "parse_json"), (jobs.q_json_required_fields, "json_tuple")):
        plan = _plan(query(spark, SF_SMALL)).lower().replace("parsejson", "parse_json")
        assert plan.count(call) == 1, plan
    js = jobs._json_trails(spark, SF_SMALL)
    from tessera.operators.trails import path_to_target_json
    for strict in (False, True):
        plan = _plan(path_to_target_json(js, "feet", strict=strict)).lower().replace("parsejson", "parse_json")
        assert plan.count("parse_json") == 1, plan


@pytest.mark.parametrize("name", sorted(jobs.QUERIES))
def test_no_python_in_plans(spark, name):
    plan = _plan(jobs.QUERIES[name](spark, SF_SMALL))
    assert not any(n in plan for n in PY_NODES), name


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["items", "freq", "size"]
    assert df.count() >= 0
    assert set(E.oracle_sql()) <= set(E.queries())
