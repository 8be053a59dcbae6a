"""WARC records and a Merkle audit of two replicas of them.

Records are laid out in files: a record's file comes from a hash of it, its
offset is the sum of the lengths before it in the order of ids.  Each replica
gets a tree of hashes per file: a leaf hashes the ordered records (offset,
length, SHA-256) that start in one range of ``leaf_bytes`` offsets, a node
hashes its ``fanout`` children in order, up to one root per file.  The audit
compares the roots and walks down, level by level, into the children of
mismatching nodes only; under mismatching leaves it compares the records.

A group of the tree has at most ``fanout`` children, or the records that start
in one leaf range, so no group grows with the data; the number of files follows
the number of bytes.  Each level is written once and read back.

Edge cases: NULL ids, urls and contents are written as empty fields; repeated
rows are records of their own, in the order of their hashes; a record that one
replica lacks is missing or extra; an empty replica lacks every record; two
empty ones agree.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import write_through

PLACE = ["file", "record_offset"]


def record_text(key: Column, url: Column, body: Column) -> Column:
    """One WARC resource record: header lines, a blank line, the body, two line ends."""
    body = F.coalesce(body, F.lit(""))
    header = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
                      F.coalesce(key.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "),
                      F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                      F.octet_length(body).cast("string"))
    return F.concat(header, F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def _bucket(text: Column, buckets: int) -> Column:
    return (F.conv(F.substr(F.md5(text.cast("binary")), F.lit(1), F.lit(8)), 16, 10).cast("bigint") % buckets).cast("int")


def lay_out(pages: DataFrame, file_bytes: int = 16 << 20, id_col: str = "page_id", url_col: str = "url",
            body_col: str = "html", extra: dict[str, Column] | None = None) -> DataFrame:
    """``id, file, record_offset, n_bytes, digest`` of every page's record, in files of about ``file_bytes``,
    and the ``extra`` columns computed from the page."""
    record = record_text(F.col(id_col), F.col(url_col), F.col(body_col))
    rows = write_through(pages.select(F.col(id_col).alias("id"), F.octet_length(record).cast("bigint").alias("n_bytes"),
                                      F.sha2(record.cast("binary"), 256).alias("digest"),
                                      *[c.alias(n) for n, c in (extra or {}).items()]), "records")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    files = max(1, -(-total // file_bytes))
    # narrow rows: a file's window holds lengths and digests, not contents
    return (rows.withColumn("file", _bucket(F.col("digest"), files))
            .selectExpr("*", "coalesce(sum(n_bytes) OVER (PARTITION BY file ORDER BY id NULLS FIRST, digest "
                             "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS record_offset")
            .select(F.col("id").alias(id_col), *PLACE, "n_bytes", "digest", *(extra or {})))


def _hash_of(children: list[str]) -> Column:
    """The hash of a group's children in the order of their first column."""
    ordered = F.array_sort(F.collect_list(F.struct(*children)))
    lines = F.transform(ordered, lambda x: F.concat_ws(":", *[x[c].cast("string") for c in children]))
    return F.sha2(F.array_join(lines, "\n").cast("binary"), 256)


def hash_tree(records: DataFrame, height: int, leaf_bytes: int, fanout: int) -> list[DataFrame]:
    """The levels of the replica's trees from the leaves up; each has ``file, node, digest``."""
    node = F.floor(F.col("record_offset") / leaf_bytes).cast("bigint")
    levels = [write_through(records.groupBy("file", node.alias("node")).agg(
        _hash_of(["record_offset", "n_bytes", "digest"]).alias("digest")), "tree")]
    for _ in range(height):
        up = F.floor(F.col("node") / fanout).cast("bigint")
        levels.append(write_through(levels[-1].groupBy("file", up.alias("up")).agg(
            _hash_of(["node", "digest"]).alias("digest")).withColumnRenamed("up", "node"), "tree"))
    return levels


def _differing(one: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows of either side whose digest the other lacks or has otherwise."""
    both = one.select(*on, F.col("digest").alias("here")).join(
        other.select(*on, F.col("digest").alias("there")), on, "full_outer")
    return both.where(~F.col("here").eqNullSafe(F.col("there")))


def audit(replica: DataFrame, other: DataFrame, leaf_bytes: int = 64 << 10, fanout: int = 16) -> DataFrame:
    """``file, record_offset, here, there, status`` of every record in which the replicas differ.

    Both hold ``file, record_offset, n_bytes, digest``; ``status`` is changed, missing (in the other) or extra."""
    ends = [r.agg(F.max("record_offset")).first()[0] or 0 for r in (replica, other)]
    height, span = 0, leaf_bytes
    while span <= max(ends):
        height, span = height + 1, span * fanout
    trees = [hash_tree(r, height, leaf_bytes, fanout) for r in (replica, other)]
    suspects = _differing(trees[0][-1], trees[1][-1], ["file", "node"]).select("file", "node")
    for level in reversed(range(height)):
        up = F.floor(F.col("node") / fanout).cast("bigint")
        parents = suspects.withColumnRenamed("node", "up")
        under = [t[level].withColumn("up", up).join(parents, ["file", "up"], "left_semi") for t in trees]
        suspects = write_through(_differing(*under, ["file", "node"]).select("file", "node"), "suspects")
    node = F.floor(F.col("record_offset") / leaf_bytes).cast("bigint")
    under = [r.withColumn("node", node).join(suspects, ["file", "node"], "left_semi") for r in (replica, other)]
    status = F.when(F.col("there").isNull(), "missing").when(F.col("here").isNull(), "extra").otherwise("changed")
    return _differing(*under, PLACE).withColumn("status", status)
