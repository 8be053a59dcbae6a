"""The registered queries: each job of the library run over the driver's
test tables (``<sf_dir>/<table>.parquet``).  Every callable takes
``(spark, sf_dir)`` and returns a DataFrame over the whole tables.

Arrays in results are rendered as joined strings and floating values rounded
to 6 digits, so the outputs compare value by value with the SQL in
:mod:`tessera.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.records import composite_record, labeled_line, parse_composite_record
from .functions.text import CJK_LANGS, join_tokens, whitespace_tokens
from .operators import categories, itemsets, keywords, relational, sparse_svm, svm, trails
from .plans.checkpoint import write_through
from .sources.delimited import lines_from_columns, parse_delimited
from .sources.json_docs import map_to_json, parse_json_column, read_json_column, required_json_fields

# Fixed values of the fixtures.
TEEN_LOW, TEEN_HIGH = 13, 19
NEEDLE = "license"
YEAR = 1995
BUYER_STATUS = "F"
TARGET_PAGE = "purchase"
JSON_TARGET, JSON_SHOW = "recommend", "pageshow"
PATH_SUPPORT = 0.2
PATH_PARTITIONS = 10
BRAND_SUPPORT = 0.02
HASH_BUCKETS = 10_000
TOP_K = 20
SVM_ITERATIONS = 10
FEATURES = ["c_mktsegment", "c_nationkey"]
BALANCE_STEP = 10  # of the wide feature: account balances in tens


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- people / SQL

def q_range_filter(spark, sf_dir):
    return relational.range_filter(table(spark, sf_dir, "customer"), "c_nationkey", TEEN_LOW, TEEN_HIGH,
                                   select=["c_name"])


def q_format_row(spark, sf_dir):
    teens = relational.range_filter(table(spark, sf_dir, "customer"), "c_nationkey", TEEN_LOW, TEEN_HIGH)
    return teens.select("c_custkey", labeled_line(("Name", "c_name"), ("Segment", "c_mktsegment")).alias("line"))


def q_delimited_parse(spark, sf_dir):
    lines = lines_from_columns(table(spark, sf_dir, "customer"), ["c_name", "c_nationkey"], sep=", ")
    return parse_delimited(lines, [("name", "string", False), ("age", "int", True)], sep=",", strict=True)


def q_nested_field(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    docs = ev.select("event_id", F.to_json(F.struct(
        F.col("user_id").cast("string").alias("name"),
        F.struct(F.col("event_type").alias("city"), F.col("props").alias("state")).alias("address"),
    )).alias("json"))
    parsed = parse_json_column(docs, "json", "name string, address struct<city: string, state: string>")
    return parsed.select("event_id", F.col("doc.name").alias("name"), F.col("doc.address.city").alias("city"))


def q_json_schema_infer(spark, sf_dir):
    return read_json_column(table(spark, sf_dir, "events"), "props", keep=["event_id"])


def q_map_to_json(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    m = F.create_map(F.lit("message"), F.col("event_type"), F.lit("user"), F.col("user_id").cast("string"))
    return ev.select("event_id", map_to_json(m).alias("json"))


def q_json_required_fields(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    # accounts as JSON; `link` is absent where the balance is not positive
    acc = c.select("c_custkey", F.to_json(F.struct(
        F.col("c_name").alias("email"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("u/"), F.col("c_custkey").cast("string"))).alias("link"),
        F.col("c_mktsegment").alias("gender"),
        F.col("c_name").alias("name"))).alias("account"))
    return required_json_fields(acc, "account", ["email", "link", "gender", "name"], keep=["c_custkey"])


def q_contains_filter(spark, sf_dir):
    return relational.contains_filter(table(spark, sf_dir, "documents"), "text", NEEDLE).select("doc_id")


def q_year_text_filter(spark, sf_dir):
    return relational.year_filter(table(spark, sf_dir, "orders"), "o_orderdate", YEAR).select(
        "o_orderkey", "o_custkey", "o_orderdate")


def q_year_locate_filter(spark, sf_dir):
    return relational.year_filter(table(spark, sf_dir, "orders"), "o_orderdate", YEAR, mode="text").select(
        "o_orderkey", "o_custkey", "o_orderdate")


# ---------------------------------------------------------------- text

def _cjk():
    return F.col("lang").isin(*CJK_LANGS)


def _doc_tokens(spark, sf_dir):
    return keywords.prepare_documents(table(spark, sf_dir, "documents"), "doc_id", "text", cjk_bigrams=_cjk())


def _terms(spark, sf_dir, buckets=None):
    return keywords.term_rows(_doc_tokens(spark, sf_dir), buckets)


def q_word_count_top20(spark, sf_dir):
    return keywords.top_words(keywords.word_counts(_doc_tokens(spark, sf_dir)), TOP_K)


def q_idf(spark, sf_dir):
    idf = keywords.inverse_document_frequency(_terms(spark, sf_dir))
    return idf.select("word", "df", F.round("idf", 6).alias("idf"))


def q_tfidf(spark, sf_dir):
    return keywords.tfidf(_terms(spark, sf_dir)).select(F.col("doc").alias("doc_id"), "word", "tf",
                                                        F.round("tfidf", 6).alias("tfidf"))


def q_doc_keyword(spark, sf_dir):
    scores = keywords.tfidf(_terms(spark, sf_dir))
    return keywords.doc_keyword(scores).select(F.col("doc").alias("doc_id"), "word", "score")


def q_tfidf_hashed(spark, sf_dir):
    scores = keywords.tfidf(_terms(spark, sf_dir, HASH_BUCKETS))
    return scores.select(F.col("doc").alias("doc_id"), F.col("word").alias("bucket"), "tf",
                         F.round("tfidf", 6).alias("tfidf"))


def q_text_tokens(spark, sf_dir):
    return keywords.token_stream(_doc_tokens(spark, sf_dir)).withColumnRenamed("doc", "doc_id")


def q_tokens_joined(spark, sf_dir):
    return keywords.joined_tokens(_doc_tokens(spark, sf_dir)).withColumnRenamed("doc", "doc_id")


def q_whitespace_tokens(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where(F.col("text").isNotNull())
    words = d.select("doc_id", whitespace_tokens("text").alias("words"))
    return words.select("doc_id", join_tokens("words").alias("words"), F.size("words").alias("n_words"))


# ---------------------------------------------------------------- trails and itemsets

def _paths(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    ev = ev.withColumn("day", F.to_date("ts"))
    return trails.path_to_target(ev, ["user_id", "day"], "ts", "event_type", TARGET_PAGE, order_col="event_id")


def q_path_to_target(spark, sf_dir):
    return _paths(spark, sf_dir).select("user_id", "day", F.array_join("path", ",").alias("path"),
                                        F.size("path").alias("n_pages"))


def _json_trails(spark, sf_dir):
    """A short JSON trail per event row, built from its own columns: a header, two page shows around an
    event whose type varies, then the target or another page; one row in ten is cut off in the middle."""
    ev = table(spark, sf_dir, "events")
    n = F.col("event_id")

    def step(page, kind):
        feet = F.struct(page.alias("page"), kind.alias("type"))
        return F.to_json(F.struct(F.col("ts").cast("string").alias("t"), feet.alias("feet")))

    show = F.lit(JSON_SHOW)
    last = F.when(n % 4 == 0, F.lit("end")).otherwise(F.lit(JSON_TARGET))
    steps = [step(F.col("event_type"), show),
             step(F.concat(F.lit("p"), (n % 3).cast("string")), F.when(n % 3 == 0, F.lit("click")).otherwise(show)),
             step(F.when(n % 2 == 0, F.substring("event_type", 1, 4)).otherwise(F.col("event_type")), show),
             step(last, show), step(F.lit("after"), show)]
    whole = F.concat(F.lit('[{"uid":0},'), F.concat_ws(",", *steps), F.lit("]"))
    text = F.when(n % 10 == 9, F.substring(whole, 1, 60)).otherwise(whole)
    return ev.select("event_id", "user_id", text.alias("feet"))


def q_trail_events(spark, sf_dir):
    return trails.trail_events(_json_trails(spark, sf_dir), "feet", keep=["event_id"]).select(
        "event_id", "step", "page", "type", F.col("t").isNotNull().alias("timed"))


def q_path_to_target_json(spark, sf_dir):
    paths = trails.path_to_target_json(_json_trails(spark, sf_dir), "feet", JSON_TARGET, JSON_SHOW, keep=["event_id"],
                                       dedup=("exact", "substring"))
    return paths.select("event_id", "dedup", F.array_join("path", ",").alias("path"))


def _fp_partitions(spark):
    # the reference's 10 is a floor: the partition count of the tree-growing
    # stage changes no result, and 10 tasks would hold every conditional tree
    # of a large input
    return max(PATH_PARTITIONS, spark.sparkContext.defaultParallelism)


def _itemsets_out(df):
    return df.select(F.array_join("items", ",").alias("items"), F.col("freq"), F.size("items").alias("size"))


def q_path_itemsets(spark, sf_dir):
    fis = itemsets.frequent_itemsets(_paths(spark, sf_dir), "path", PATH_SUPPORT, _fp_partitions(spark))
    return _itemsets_out(fis)


def q_frequent_itemsets(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = li.join(part, li.l_partkey == part.p_partkey)
    baskets = itemsets.baskets_of(lines, "l_orderkey", "p_brand")
    return _itemsets_out(itemsets.frequent_itemsets(baskets, "items", BRAND_SUPPORT, _fp_partitions(spark)))


# ---------------------------------------------------------------- labels, split, categories, SVM

def _buyers(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == BUYER_STATUS)
    return relational.year_filter(o, "o_orderdate", YEAR)


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", *FEATURES)


def q_distinct_keys(spark, sf_dir):
    return relational.distinct_keys(_buyers(spark, sf_dir), "o_custkey")


def _labeled(spark, sf_dir):
    return relational.membership_label(_customers(spark, sf_dir), "c_custkey", _buyers(spark, sf_dir), "o_custkey")


def q_membership_label(spark, sf_dir):
    return _labeled(spark, sf_dir).select("c_custkey", "label")


def q_semi_members(spark, sf_dir):
    return relational.semi_members(_customers(spark, sf_dir), "c_custkey", _buyers(spark, sf_dir),
                                   "o_custkey").select("c_custkey", "c_name")


def q_anti_members(spark, sf_dir):
    return relational.anti_members(_customers(spark, sf_dir), "c_custkey", _buyers(spark, sf_dir),
                                   "o_custkey").select("c_custkey", "c_name")


def q_union_labeled(spark, sf_dir):
    # one label pass gives both halves; they are read back, not joined again
    labeled = write_through(_labeled(spark, sf_dir).select("c_custkey", "label"), "labeled")
    return relational.union_labeled(labeled.where("label = 1.0").drop("label"), labeled.where("label = 0.0").drop("label"))


def _users(spark, sf_dir):
    return _labeled(spark, sf_dir).withColumn("split", relational.split_column("c_custkey"))


def q_train_test_split(spark, sf_dir):
    return _users(spark, sf_dir).select("c_custkey", "split")


def _position_values(spark, sf_dir):
    return categories.position_values(_users(spark, sf_dir), "c_custkey", FEATURES, keep=["label", "split"])


def q_position_values(spark, sf_dir):
    return _position_values(spark, sf_dir).select("c_custkey", "pos", "value")


def _dictionary(pv):
    return categories.category_index(pv.where(F.col("split") == "train"))


def q_category_index(spark, sf_dir):
    return _dictionary(_position_values(spark, sf_dir))


def _encoded(spark, sf_dir):
    # written once: the label join feeds the dictionary and the encoding, the encoded rows training and scoring
    pv = write_through(_position_values(spark, sf_dir), "values")
    encoded = categories.category_encode(pv, _dictionary(pv), "c_custkey", keep=["label", "split"])
    return write_through(encoded, "encoded")


def q_category_encode(spark, sf_dir):
    e = _encoded(spark, sf_dir)
    return e.select("c_custkey", "label", "split", *[F.get("features", j).alias(f"f{j}") for j in range(len(FEATURES))])


def q_category_onehot(spark, sf_dir):
    vectors = categories.one_hot(_encoded(spark, sf_dir), len(FEATURES))
    return vectors.select("c_custkey", "label", "split", categories.set_slots("vector").alias("slots"))


def q_composite_record(spark, sf_dir):
    u = _users(spark, sf_dir)
    feats = F.array(*[F.col(c).cast("string") for c in FEATURES])
    rec = u.select("c_custkey", composite_record("c_custkey", feats, "label").alias("record"))
    key, features, label = parse_composite_record("record")
    return rec.select("c_custkey", "record", key.alias("key"), F.array_join(features, "|").alias("features"),
                      label.alias("label"))


def _svm_weights(spark, sf_dir, enc):
    train = enc.where(F.col("split") == "train")
    return svm.svm_sgd(train, num_features=len(FEATURES), iterations=SVM_ITERATIONS)


def q_svm_weights(spark, sf_dir):
    w = _svm_weights(spark, sf_dir, _encoded(spark, sf_dir))
    return svm.weights_frame(spark, w).select("j", F.round("weight", 6).alias("weight"))


def _scored_test(spark, sf_dir):
    enc = _encoded(spark, sf_dir)
    w = _svm_weights(spark, sf_dir, enc)
    return svm.svm_scores(enc.where(F.col("split") == "test"), w)


def q_svm_scores(spark, sf_dir):
    return _scored_test(spark, sf_dir).select("c_custkey", "label", F.round("score", 6).alias("score"))


def q_svm_error_rate(spark, sf_dir):
    er = svm.svm_error_rate(_scored_test(spark, sf_dir))
    return er.select("n", F.round("error_rate", 6).alias("error_rate"))


def _wide_slots(spark, sf_dir):
    """``slots`` and the rows over them: the two features and a wide one, many of whose values are not in the training
    rows.  Written once: the label join feeds the dictionary, the training and the scoring."""
    balance = F.floor(F.col("c_acctbal") / BALANCE_STEP).cast("string")
    people = table(spark, sf_dir, "customer").select("c_custkey", *FEATURES, balance.alias("balance"))
    users = relational.membership_label(people, "c_custkey", _buyers(spark, sf_dir), "o_custkey")
    users = users.withColumn("split", relational.split_column("c_custkey"))
    pv = write_through(categories.position_values(users, "c_custkey", [*FEATURES, "balance"], keep=["label", "split"]), "values")
    slots = write_through(categories.feature_slots(_dictionary(pv), len(FEATURES) + 1), "slots")
    return slots, write_through(categories.slot_rows(pv, slots, "c_custkey", keep=["label", "split"]), "encoded")


def _wide_model(spark, sf_dir):
    slots, rows = _wide_slots(spark, sf_dir)
    weights = sparse_svm.train(rows.where(F.col("split") == "train"), iterations=SVM_ITERATIONS)
    return slots, rows, weights


def q_category_slots(spark, sf_dir):
    _, rows = _wide_slots(spark, sf_dir)
    return rows.select("c_custkey", "label", "split", F.array_join("slots", ",").alias("slots"))


def q_svm_onehot_weights(spark, sf_dir):
    slots, _, weights = _wide_model(spark, sf_dir)
    return slots.join(weights, "slot").select("slot", "pos", "value", F.round("weight", 6).alias("weight"))


def _wide_scores(spark, sf_dir):
    _, rows, weights = _wide_model(spark, sf_dir)
    return sparse_svm.scores(rows.where(F.col("split") == "test"), weights, "c_custkey", keep=["label"])


def q_svm_onehot_scores(spark, sf_dir):
    return _wide_scores(spark, sf_dir).select("c_custkey", "label", F.round("score", 6).alias("score"))


def q_svm_onehot_error_rate(spark, sf_dir):
    er = svm.svm_error_rate(_wide_scores(spark, sf_dir))
    return er.select("n", F.round("error_rate", 6).alias("error_rate"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
