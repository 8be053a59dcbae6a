"""Sources on temporary files: delimited text, Parquet, JSON, catalog tables,
embedded JDBC (in-memory Derby inside the Spark JVM, no network port)."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tessera.operators.relational import range_filter
from tessera.sources import (create_table, infer_json_schema, load_delimited_into_table, map_to_json,
                             parse_delimited, parse_json_column, read_jdbc, read_json_column, read_json_lines,
                             read_lines, read_parquet, read_table, required_json_fields, write_parquet,
                             write_text_lines)
from tessera.sources.jdbc import bucket_predicates, require_range_key

PEOPLE = [("name", "string", False), ("age", "int", True)]


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_delimited_parse_and_range(spark, tmp_path):
    p = _write(tmp_path / "people.txt", "Ann, 29\nBo, 30\nCy, 19\n")
    people = parse_delimited(read_lines(spark, p), PEOPLE)
    assert people.dtypes == [("name", "string"), ("age", "int")]
    teens = range_filter(people, "age", 13, 19, select=["name"])
    assert [r.name for r in teens.collect()] == ["Cy"]


@pytest.mark.parametrize("line", ["Dee, x", "Eve", "Flo,"])
def test_delimited_strict_raises_lenient_nulls(spark, tmp_path, line):
    p = _write(tmp_path / "bad.txt", f"Ann, 29\n{line}\n")
    with pytest.raises(Exception):
        parse_delimited(read_lines(spark, p), PEOPLE, strict=True).collect()
    strict = parse_delimited(read_lines(spark, p), PEOPLE, strict=True)
    for pruned in (strict.select("name"), strict.groupBy().count(), strict.select(F.lit(1))):
        with pytest.raises(Exception):
            pruned.collect()
    rows = parse_delimited(read_lines(spark, p), PEOPLE, strict=False).collect()
    assert rows[0].age == 29 and rows[1].age is None


def test_parquet_roundtrip_keeps_schema_and_refuses_existing(spark, tmp_path):
    df = spark.createDataFrame([("Ann", 29), ("Cy", 19)], "name string, age int")
    out = str(tmp_path / "people.parquet")
    write_parquet(df, out)
    back = read_parquet(spark, out)
    assert back.schema == df.schema
    assert sorted(back.collect()) == sorted(df.collect())
    with pytest.raises(AnalysisException):
        write_parquet(df, out)


def test_json_lines_inferred(spark, tmp_path):
    p = _write(tmp_path / "boxes.json", '{"box":"r1","weight":7}\n{"box":"r2"}\n{"weight":12,"box":"r3"}\n\n')
    boxes = read_json_lines(spark, p)
    assert dict(boxes.dtypes) == {"box": "string", "weight": "bigint"}
    boxes.createOrReplaceTempView("boxes")
    heavy = spark.sql("SELECT box, weight * 2 AS twice FROM boxes WHERE weight > 10 OR weight IS NULL ORDER BY box")
    assert [tuple(r) for r in heavy.collect()] == [("r2", None), ("r3", 24)]


def test_nested_json_strings(spark):
    docs = spark.createDataFrame([('{"ship":{"port":{"name":"Oslo","berths":[3,5]}},"id":4}',),
                                  ('{"ship":{"port":null},"id":5}',), ('{"id":6}',)], "json string")
    flat = read_json_column(docs, "json")
    got = sorted(tuple(r) for r in flat.select("id", F.col("ship.port.name"), F.col("ship.port.berths")[1]).collect())
    assert got == [(4, "Oslo", 5), (5, None, None), (6, None, None)]
    parsed = parse_json_column(docs, "json", "id int, ship struct<port: struct<name: string>>")
    assert [r[0] for r in parsed.orderBy("doc.id").select("doc.ship.port.name").collect()] == ["Oslo", None, None]


def test_json_inference_of_objects_only(spark):
    rows = [("5",), ('"text"',), ("[1]",), ('{"VOID": 1, "DECIMAL(2, 1)": "x", "n": null, "OBJECT": {"VARIANT": 2.5}}',),
            ("broken {",), (None,)]
    df = spark.createDataFrame(rows, "j string")
    kind = infer_json_schema(df, "j")
    assert {f.name: f.dataType.simpleString() for f in kind.fields} == {
        "VOID": "bigint", "DECIMAL(2, 1)": "string", "n": "string", "OBJECT": "struct<VARIANT:double>"}
    assert sorted(r.VOID for r in read_json_column(df, "j").collect() if r.VOID is not None) == [1]
    none = spark.createDataFrame([("5", 1), (None, 2)], "j string, k int")
    assert read_json_column(none, "j", keep=["k"]).columns == ["k"]


def test_json_inference_types(spark):
    docs = spark.createDataFrame([('{"a": 1, "b": 1.5, "c": "x", "d": [1, 2]}',), ('{"a": 2, "e": null}',), ("not json",)],
                                 "j string")
    flat = read_json_column(docs, "j")
    types = dict(flat.dtypes)
    assert types["a"] == "bigint" and types["b"] == "double" and types["c"] == "string"
    assert types["d"] == "array<bigint>"
    assert flat.count() == 3


def test_required_json_fields(spark):
    rows = [(1, '{"email": "a@x", "link": "l", "gender": "f", "name": "A"}'),
            (2, '{"email": "b@x", "gender": "m", "name": "B"}'),
            (3, "not json"),
            (4, None),
            (5, '{"email": "e@x", "link": null, "gender": "m", "name": "E"}')]
    df = spark.createDataFrame(rows, "id int, account string")
    out = required_json_fields(df, "account", ["email", "link", "gender", "name"], keep=["id"]).collect()
    assert [(r.id, r.email, r.link) for r in out] == [(1, "a@x", "l")]


def test_map_to_json(spark):
    df = spark.createDataFrame([(1, "click", "8")], "id int, t string, u string")
    got = df.select(map_to_json(F.create_map(F.lit("message"), "t", F.lit("user"), "u")).alias("j")).first().j
    assert got == '{"message":"click","user":"8"}'


def test_catalog_table_load_twice(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tdb LOCATION '{tmp_path / 'wh'}'")
    create_table(spark, "tdb.kv")
    create_table(spark, "tdb.kv")  # IF NOT EXISTS
    p = _write(tmp_path / "kv.txt", "1\x01a\nx\x01b\n3\x01c\n")
    load_delimited_into_table(spark, p, "tdb.kv")
    rows = sorted(read_table(spark, "tdb.kv").collect(), key=lambda r: r.value)
    assert [(r.key, r.value) for r in rows] == [(1, "a"), (None, "b"), (3, "c")]
    load_delimited_into_table(spark, p, "tdb.kv")
    assert read_table(spark, "tdb.kv").count() == 6
    assert (tmp_path / "kv.txt").exists()


def test_catalog_load_keeps_text_as_it_is(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS tdb2 LOCATION '{tmp_path / 'wh2'}'")
    create_table(spark, "tdb2.kv")
    p = _write(tmp_path / "raw.txt", '1\x01"a\n2\x01\n3\x01\\N\n4\x01a,"b" \\t\n\\N\x01x\n6\n')
    load_delimited_into_table(spark, p, "tdb2.kv")
    rows = {r.key: r.value for r in read_table(spark, "tdb2.kv").collect()}
    assert rows == {1: '"a', 2: "", 3: None, 4: 'a,"b" \\t', None: "x", 6: None}


def test_jdbc_buckets_hold_every_row_once(duck):
    predicates = bucket_predicates("k % 4", 4)
    keys = "SELECT unnest([NULL, -7, -4, -1, 0, 1, 2, 3, 4, 9]) AS k"
    held = [duck.execute(f"SELECT count(*) FROM ({keys}) WHERE {p}").fetchone()[0] for p in predicates]
    assert len(predicates) == 4 and sum(held) == 10
    with pytest.raises(ValueError, match="bucket_expr"):
        require_range_key("uid", "string")


def test_text_lines_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    out = str(tmp_path / "out")
    write_text_lines(df, out)
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert lines == ['{"id":1,"s":"a"}', '{"id":2,"s":"b"}']


def test_jdbc_partitioned_read_bounds_from_data(spark):
    url = "jdbc:derby:memory:tessera_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    src = spark.range(500).select(F.col("id").cast("int").alias("UID"), (F.col("id") % 7).cast("string").alias("FEET"))
    src.write.jdbc(url, "FEET", mode="overwrite", properties=props)
    df = read_jdbc(spark, url, "SELECT UID, FEET FROM FEET WHERE UID >= 100", partition_column="UID",
                   num_partitions=10, properties=props)
    sizes = df.rdd.glom().map(len).collect()
    assert len(sizes) == 10 and sum(sizes) == 400
    assert max(sizes) <= 50  # bounds came from the data, not a fixed 0..10
    fixed = read_jdbc(spark, url, "FEET", partition_column="UID", num_partitions=10, lower_bound=0,
                      upper_bound=10, properties=props)
    fsizes = fixed.rdd.glom().map(len).collect()
    assert sum(fsizes) == 500 and max(fsizes) == 491  # bounds set the stride only
    with pytest.raises(ValueError, match="bucket_expr"):
        read_jdbc(spark, url, "FEET", partition_column="FEET", num_partitions=7, properties=props)
    buckets = read_jdbc(spark, url, "FEET", num_partitions=7, bucket_expr="MOD(UID, {n})", properties=props)
    bsizes = buckets.rdd.glom().map(len).collect()
    assert len(bsizes) == 7 and sum(bsizes) == 500 and max(bsizes) - min(bsizes) <= 1


def test_equi_depth_ranges_of_a_skewed_key(spark):
    from tessera.sources import depth_cuts, depth_predicates

    # most keys crowd at the low end; a few are huge, some are NULL
    keys = spark.range(20_000).select(F.when(F.col("id") % 100 == 0, None).when(F.col("id") % 1000 == 1, F.col("id") * 10**9)
                                      .otherwise(F.floor(F.pow(F.col("id") / 20_000, 6) * 10**7)).cast("bigint").alias("k"))
    cuts = depth_cuts(keys, "k", 8)
    parts = depth_predicates("k", cuts)
    sizes = [keys.where(p).count() for p in parts]
    assert len(parts) == 8 and sum(sizes) == keys.count() and max(sizes) <= 2 * min(sizes)
    # equal strides would put nearly all rows into the first part
    top = keys.agg(F.max("k")).first()[0]
    assert keys.where(f"k < {top // 8}").count() > 0.95 * keys.where("k IS NOT NULL").count()


def test_equi_depth_ranges_at_the_edges(spark):
    from tessera.sources import depth_cuts, depth_predicates

    hot = spark.range(1000).select(F.when(F.col("id") < 700, 5).otherwise(F.col("id")).alias("k"))
    parts = depth_predicates("k", depth_cuts(hot, "k", 6))
    assert sum(hot.where(p).count() for p in parts) == 1000
    assert depth_predicates("k", depth_cuts(hot.limit(0), "k", 4)) == ["1 = 1"] == depth_predicates("k", depth_cuts(hot, "k", 1))
    days = spark.range(400).select(F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    parts = depth_predicates("d", depth_cuts(days, "d", 4))
    assert len(parts) == 4 and sum(days.where(p).count() for p in parts) == 400


def test_bucketed_tables_are_joined_without_a_shuffle(spark):
    from tessera.sources import write_bucketed

    facts = spark.range(5000).select((F.col("id") % 700).alias("k"), "id")
    names = spark.range(700).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    try:
        write_bucketed(facts, "bucket_facts", "k", 8)
        write_bucketed(names, "bucket_names", "k", 8)
        joined = spark.table("bucket_facts").hint("merge").join(spark.table("bucket_names"), "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 5000
        grouped = spark.table("bucket_facts").groupBy("k").count()
        assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString() and grouped.count() == 700
    finally:
        spark.sql("DROP TABLE IF EXISTS bucket_facts")
        spark.sql("DROP TABLE IF EXISTS bucket_names")
