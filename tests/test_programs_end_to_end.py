"""Each reference program's flow, end to end, on small hand-made inputs."""

import json

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions import labeled_line
from tessera.operators import categories, itemsets, keywords, relational, svm
from tessera.operators.trails import path_to_target_json
from tessera.sources import (map_to_json, parse_delimited, read_json_column, read_json_lines, read_lines,
                             read_parquet, required_json_fields, write_parquet)


def test_one_table_from_text_parquet_and_json(spark, tmp_path):
    rooms = tmp_path / "rooms.txt"
    rooms.write_text("attic; 4\nhall; 31\ncellar; 17\n")
    parsed = parse_delimited(read_lines(spark, str(rooms)), [("room", "string", False), ("area", "int", True)], sep=";")
    parsed.createOrReplaceTempView("rooms")
    medium = spark.sql("SELECT room, area FROM rooms WHERE area BETWEEN 10 AND 20")
    assert [r.line for r in medium.select(labeled_line(("Room", "room"), ("Area", "area")).alias("line")).collect()] == [
        "Room: cellar, Area: 17"]

    write_parquet(parsed, str(tmp_path / "rooms.parquet"))
    read_parquet(spark, str(tmp_path / "rooms.parquet")).createOrReplaceTempView("stored_rooms")
    assert spark.sql("SELECT sum(area) AS total FROM stored_rooms WHERE room <> 'hall'").first().total == 21

    js = tmp_path / "rooms.json"
    js.write_text('{"room":"loft","area":12}\n{"room":"porch"}\n{"area":3}\n')
    read_json_lines(spark, str(js)).createOrReplaceTempView("rooms")          # the name is re-bound
    assert [tuple(r) for r in spark.sql("SELECT room, area FROM rooms WHERE area IS NULL OR room IS NULL ORDER BY area NULLS FIRST").collect()] == [
        ("porch", None), (None, 3)]

    docs = spark.createDataFrame([('{"room":"study","desk":{"drawers":[{"key":"brass"}]}}',), ("{}",)], "json string")
    read_json_column(docs, "json").createOrReplaceTempView("desks")
    out = spark.sql("SELECT room, desk.drawers[0].key AS key FROM desks ORDER BY room NULLS LAST")
    assert [r.l for r in out.select(labeled_line(("Room", "room"), ("Key", "key")).alias("l")).collect()] == [
        "Room: study, Key: brass", "Room: null, Key: null"]


def test_document_index_to_json_to_inferred_table(spark):
    idx = spark.createDataFrame([("1", {"message": "Scheduling job 1", "host": "a"}),
                                 ("2", {"message": "done", "host": "b"})], "doc_id string, doc map<string,string>")
    as_json = idx.select("doc_id", map_to_json("doc").alias("json"))
    read_json_column(as_json, "json", keep=["doc_id"]).createOrReplaceTempView("json")
    msgs = spark.sql("SELECT message FROM json")
    assert sorted(r.message for r in msgs.collect()) == ["Scheduling job 1", "done"]
    assert [r.message for r in relational.contains_filter(msgs, "message", "Scheduling").collect()] == ["Scheduling job 1"]


def _trail(pages):
    return json.dumps([{"h": 1}] + [{"t": i, "feet": {"page": p, "type": "pageshow"}} for i, p in enumerate(pages)])


def test_trails_to_frequent_itemsets(spark):
    rows = [(i, _trail(t)) for i, t in enumerate(
        [["home", "list", "recommend"], ["home", "recommend"], ["list", "home", "recommend"], ["a", "recommend"],
         ["home", "list", "x"]])]
    df = spark.createDataFrame(rows, "uid int, feet string")
    paths = path_to_target_json(relational.contains_filter(df, "feet", "recommend"), "feet", keep=["uid"])
    got = {tuple(r.items): r.freq for r in itemsets.frequent_itemsets(paths, "path", 0.2, 10).collect()}
    # 4 baskets reach the target; min count = ceil(0.2 * 4) = 1
    assert got == {("home",): 3, ("list",): 2, ("home", "list"): 2, ("a",): 1}


def test_news_programmatic_schema_to_top_words_and_tfidf(spark):
    schema = StructType([StructField("text", StringType(), True)])
    news = spark.createDataFrame([("Big news: big deal",), ("",), ("deal or no deal",)], schema)
    news = news.withColumn("id", F.monotonically_increasing_id())
    prep = keywords.prepare_documents(news.where(F.length(F.trim("text")) > 0), "id", "text")
    top = [(r.word, r.n) for r in keywords.top_words(keywords.word_counts(prep), 20).collect()]
    assert top == [("deal", 3), ("big", 2), ("news", 1), ("no", 1), ("or", 1)]
    hashed = keywords.tfidf(keywords.term_rows(prep, 10000), keywords.document_count(prep))
    assert hashed.count() == 6 and hashed.where("word < 0 OR word >= 10000").count() == 0


def test_buyers_users_labels_split_encode_svm(spark):
    buyers = spark.createDataFrame([("2",), ("2",), ("5",), ("x",)], "create_user string")
    users = spark.createDataFrame(
        [(i, f"10.0.0.{i % 3}", json.dumps({"email": f"u{i}@x", "link": "l", "gender": "fm"[i % 2], "name": f"n{i}"}))
         for i in range(1, 9)] + [(9, "10.0.0.9", '{"email": "e"}'), (10, "10.0.0.1", "not json"), (11, "10.0.0.2", None)],
        "uid int, create_ip string, account string")
    acc = required_json_fields(users, "account", ["email", "link", "gender", "name"], keep=["uid", "create_ip"])
    assert acc.count() == 8
    ids = buyers.select(F.col("create_user").try_cast("int").alias("k"))
    labeled = relational.membership_label(acc, "uid", ids, "k")
    assert {r.uid for r in labeled.where("label = 1.0").collect()} == {2, 5}
    assert labeled.limit(1).count() == 1
    tr, te = relational.train_test_split(labeled, "uid")
    assert tr.count() + te.count() == 8
    pv = categories.position_values(labeled, "uid", ["create_ip", "gender"], keep=["label"])
    d = categories.category_index(pv)
    enc = categories.category_encode(pv, d, "uid", keep=["label"])
    w = svm.svm_sgd(enc, num_features=2, iterations=10)
    rate = svm.svm_error_rate(svm.svm_scores(enc, w)).first()
    assert len(w) == 2 and rate.n == 8 and 0.0 <= rate.error_rate <= 1.0
