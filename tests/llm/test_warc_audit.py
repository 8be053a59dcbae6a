"""Layout of records, and the tree audit against a plain comparison of all records."""

from pyspark.sql import functions as F
from tessera.llm.warc_audit import audit, lay_out

PAGES = "page_id bigint, url string, html string, digest string, node int"


def pages(spark, n):
    rows = [(i if i % 17 else None, f"http://h{i % 5}.example/{i}", "é<p>" * (i % 40), "x", 1) for i in range(n)]
    return spark.createDataFrame(rows + [(None, None, None, None, None)] * 3 + rows[5:6] * 4, PAGES)


def test_layout_has_no_gaps(spark):
    rows = lay_out(pages(spark, 300), file_bytes=20_000).collect()
    assert len(rows) == 307
    for f in {r.file for r in rows}:
        own, at = sorted((r for r in rows if r.file == f), key=lambda r: r.record_offset), 0
        for r in own:
            assert r.record_offset == at
            at += r.n_bytes
    assert len({r.file for r in rows}) > 2


def test_audit_finds_every_difference(spark):
    laid = lay_out(pages(spark, 400), file_bytes=30_000).select("file", "record_offset", "n_bytes", "digest").cache()
    n = F.pmod(F.xxhash64("file", "record_offset"), F.lit(19))
    other = laid.where(n != 1).withColumn("digest", F.when(n == 2, F.lit("bad")).otherwise(F.col("digest")))
    other = other.unionByName(laid.limit(1).select("file", (F.col("record_offset") + 1).alias("record_offset"),
                                                   "n_bytes", "digest"))
    want = {(r.file, r.record_offset): "changed" if r.n == 2 else "missing"
            for r in laid.withColumn("n", n).where("n IN (1, 2)").collect()}
    got = {(r.file, r.record_offset): r.status for r in audit(laid, other, leaf_bytes=700, fanout=3).collect()}
    extra = [k for k, v in got.items() if v == "extra"]
    assert len(extra) == 1 and {k: v for k, v in got.items() if v != "extra"} == want
    assert audit(laid, laid, leaf_bytes=700, fanout=3).count() == 0


def test_empty_replicas(spark):
    laid = lay_out(pages(spark, 5))
    none = lay_out(spark.createDataFrame([], PAGES))
    assert none.count() == 0 and audit(none, none).count() == 0
    assert audit(laid, none).where("status = 'missing'").count() == laid.count()
    assert audit(none, laid).where("status = 'extra'").count() == laid.count()
