"""A key holding a third of all rows: results stay whole, the trail job has
no join at all, lookup joins are split by AQE, and a word of every document
is spread by its salt."""

from pyspark.sql import functions as F

from tessera import jobs
from tessera.operators import categories, keywords, relational
from tessera.operators.trails import path_to_target


def _hot_events(spark, n=30000):
    # trail "hot" has a third of all events; the rest spread over 2000 trails
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), (F.col("id") % 2000).cast("string"))).alias("trail"),
        F.col("id").alias("ts"),
        F.when(F.col("id") % 97 == 50, F.lit("buy")).otherwise(F.concat(F.lit("p"), (F.col("id") % 13).cast("string"))).alias("page"))


class _Confs:
    def __init__(self, spark, **kv):
        self.spark, self.kv = spark, kv

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k, None) for k in self.kv}
        for k, v in self.kv.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)


SKEWY = {"spark.sql.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
         "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
         "spark.sql.adaptive.coalescePartitions.enabled": "false"}


def test_hot_trail_whole_and_joinless(spark):
    ev = _hot_events(spark)
    out = path_to_target(ev, ["trail"], "ts", "page", "buy")
    rows = {r.trail: r.path for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    data = sorted((r.trail, r.ts, r.page) for r in ev.collect())   # brute force on a small fixture
    expect = {}
    for trail in {t for t, _, _ in data}:
        seq = [p for t, _, p in data if t == trail]
        if "buy" in seq and seq.index("buy") > 0:
            expect[trail] = list(dict.fromkeys(seq[:seq.index("buy")]))
    assert rows == expect and "hot" in rows


def test_hot_category_value_is_skew_split(spark):
    with _Confs(spark, **SKEWY):
        users = spark.range(30000).select(
            F.col("id").alias("k"),
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 5000).cast("string")).alias("v"))
        pv = categories.position_values(users, "k", ["v"])
        d = categories.category_index(pv)
        codes = categories.category_codes(pv, d)
        n = codes.where(F.col("code") > 0).count() + codes.where(F.col("code") == 0).count()
        assert n == 30000
        codes.collect()
        plan = codes._jdf.queryExecution().executedPlan().toString()
        assert "isSkewJoin=true" in plan or "skew=true" in plan


def test_hot_member_key_is_skew_split(spark):
    with _Confs(spark, **SKEWY):
        # a third of the labelled table is one key; sizes are measured after compression, so the rows differ
        df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                       F.md5(F.col("id").cast("string")).alias("v"))
        members = spark.range(0, 30000, 7).select(F.col("id").alias("m"))
        for out in (relational.membership_label(df, "k", members, "m"), relational.semi_members(df, "k", members, "m")):
            assert sum(r.k == 7 for r in out.collect()) == 10001
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "isSkewJoin=true" in plan or "skew=true" in plan


def _tasks_of(df, word):
    spread = df.where(F.col("word") == word).select(F.spark_partition_id().alias("p"))
    return spread.distinct().count()


def test_word_of_every_document_is_spread(spark):
    with _Confs(spark, **{"spark.sql.shuffle.partitions": "24"}):
        docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(
            F.lit("the word"), (F.col("id") % 900).cast("string")).alias("text"))
        terms = keywords.term_rows(keywords.prepare_documents(docs, "doc_id", "text"))
        assert _tasks_of(keywords.term_counts(terms), "the") > 8


def test_hot_user_of_the_registered_trail_job(spark, tmp_path):
    n = 30000
    ev = spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") + 1_700_000_000).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 2000).cast("bigint").alias("user_id"),
        F.when(F.col("id") % 97 == 50, F.lit("purchase")).otherwise(F.concat(F.lit("p"), (F.col("id") % 13).cast("string")))
        .alias("event_type"))
    ev.write.parquet(str(tmp_path / "events.parquet"))
    out = jobs.q_path_to_target(spark, str(tmp_path))
    assert out.where("user_id = 1").count() >= 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.rindex("Exchange"):]
    assert "partial_min" in below and "Join" not in plan   # first sights merge before anything moves
