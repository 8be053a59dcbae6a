"""Path to target: the hand-made trails, both input forms, invariance."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators.trails import path_to_target, path_to_target_json, trail_events
from testdata_dirs import SF_SMALL

H = {"h": 1}


def p(page, t=True, typ="pageshow"):
    e = {"feet": {"page": page, "type": typ}}
    if t:
        e["t"] = 1
    return e


TRAILS = [
    (1, json.dumps([H, p("home"), p("x", typ="click"), p("home"), p("list"), p("recommend"), p("z")])),
    (2, json.dumps([H, p("recommend")])),
    (3, json.dumps([H, p("homepage"), p("home"), p("recommend")])),
    (4, json.dumps([H, p("homepage", t=False), p("recommend")])),
    (5, '[{"h": 1}, {"feet": '),
    (6, json.dumps([H, p("a")])),
    (7, json.dumps([H, p("a"), p("recommend")])[:-1] + ', {"feet": 5}]'),
    (8, json.dumps([0, p("home"), p("list"), p("recommend")])),
]


def _run(spark, **kw):
    df = spark.createDataFrame(TRAILS, "id int, feet string")
    out = path_to_target_json(df, "feet", keep=["id"], **kw).collect()
    return {r.id: r.path for r in out}


def test_exact(spark):
    assert _run(spark) == {1: ["home", "list"], 3: ["homepage", "home"], 4: ["homepage"], 7: ["a"],
                           8: ["home", "list"]}


def test_substring_compat(spark):
    assert _run(spark, dedup="substring") == {1: ["home", "list"], 3: ["homepage"], 4: ["homepage"], 7: ["a"],
                                              8: ["home", "list"]}


def test_strict(spark):
    got = _run(spark, strict=True)
    assert 4 not in got and got[7] == ["a"] and got[1] == ["home", "list"]


def test_trail_events(spark):
    df = spark.createDataFrame(TRAILS[:1], "id int, feet string")
    rows = trail_events(df, "feet", keep=["id"]).collect()
    assert [(r.step, r.page, r.type) for r in rows][:3] == [(0, "home", "pageshow"), (1, "x", "click"),
                                                            (2, "home", "pageshow")]


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("day", F.to_date("ts"))


def test_event_form_equals_json_form(spark):
    ev = _events(spark)
    table_form = path_to_target(ev, ["user_id", "day"], "ts", "event_type", "purchase", order_col="event_id")
    # the same trails as JSON arrays (small fixture only: this builds whole trails per row)
    steps = F.array_sort(F.collect_list(F.struct("ts", "event_id", F.struct(
        F.lit(1).alias("t"), F.struct(F.col("event_type").alias("page"), F.lit("pageshow").alias("type")).alias("feet")
    ).alias("e"))))
    js = (ev.groupBy("user_id", "day").agg(steps.alias("s"))
          .select("user_id", "day", F.concat(F.lit("[0,"), F.array_join(F.transform("s", lambda x: F.to_json(x["e"])), ","),
                                             F.lit("]")).alias("feet")))
    json_form = path_to_target_json(js, "feet", target="purchase", keep=["user_id", "day"])
    a = sorted((r.user_id, r.day, tuple(r.path)) for r in table_form.collect())
    b = sorted((r.user_id, r.day, tuple(r.path)) for r in json_form.collect())
    assert a == b and len(a) > 0


@pytest.mark.parametrize("parts", [1, 17])
def test_event_form_invariant_to_partitioning(spark, parts):
    ev = _events(spark)
    base = path_to_target(ev, ["user_id", "day"], "ts", "event_type", "purchase", order_col="event_id")
    other = path_to_target(ev.repartition(parts), ["user_id", "day"], "ts", "event_type", "purchase",
                           order_col="event_id")
    norm = lambda df: sorted((r.user_id, r.day, tuple(r.path)) for r in df.collect())
    assert norm(base) == norm(other)


def test_event_form_type_filter_and_ties(spark):
    rows = [("u", 1, 1, "home", "pageshow"), ("u", 2, 2, "ad", "click"), ("u", 2, 3, "list", "pageshow"),
            ("u", 2, 4, "recommend", "pageshow"), ("v", 1, 1, "recommend", "pageshow")]
    df = spark.createDataFrame(rows, "u string, ts int, id int, page string, type string")
    out = path_to_target(df, ["u"], "ts", "page", "recommend", order_col="id", type_col="type", type_value="pageshow")
    assert [(r.u, r.path) for r in out.collect()] == [("u", ["home", "list"])]


def test_page_with_comma_stays_one_item(spark):
    from tessera.operators.itemsets import frequent_itemsets

    trails = [(i, json.dumps([H, p("a,b"), p("c"), p("recommend")])) for i in range(3)]
    df = spark.createDataFrame(trails, "id int, feet string")
    paths = path_to_target_json(df, "feet", keep=["id"])
    assert {tuple(r.path) for r in paths.collect()} == {("a,b", "c")}
    items = {tuple(r.items): r.freq for r in frequent_itemsets(paths, "path", 0.5).collect()}
    assert items == {("a,b",): 3, ("c",): 3, ("a,b", "c"): 3}


def test_events_without_a_time_are_dropped(spark):
    rows = [("u", None, "lost"), ("u", 1, "home"), ("u", 2, "recommend"), ("v", None, "recommend"), ("v", 1, "a")]
    df = spark.createDataFrame(rows, "u string, ts int, page string")
    assert [(r.u, r.path) for r in path_to_target(df, ["u"], "ts", "page", "recommend").collect()] == [("u", ["home"])]
