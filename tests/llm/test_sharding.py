"""Shards: sizes, slots, and how much of the linked groups stays together."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tessera.llm import queries, sharding
from tessera.llm.sharding import _quotas, shard_documents


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    counts = Counter(r.shard for r in rows)
    assert set(counts) <= set(range(shards))
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in range(shards):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts.get(s, 0)))
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want


def kept_together(rows):
    """Share of the pairs of equal texts that are in one shard."""
    groups = Counter((r.text_crc32, r.size) for r in rows)
    inside = Counter((r.text_crc32, r.size, r.shard) for r in rows)
    pairs = lambda c: sum(n * (n - 1) // 2 for n in c.values())
    return pairs(inside) / pairs(groups) if pairs(groups) else 1.0


def test_documents(documents):
    rows = shard_documents(documents, 8).collect()
    check(rows, [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()], 8)
    assert kept_together(rows) > 0.95


@pytest.mark.parametrize("hot,pairs", [(0.1, 0.3), (0.34, 0.3), (0.1, 0.9), (0, 1)])
def test_hot_group(spark, hot, pairs):
    n = 3000
    texts = [(i, "hot" if i < hot * n else f"pair {i // 2}" if i < (hot + pairs) * n else f"single {i}") for i in range(n)]
    rows = shard_documents(spark.createDataFrame(texts, "doc_id bigint, text string"), 8).collect()
    check(rows, texts, 8)
    assert kept_together([r for r in rows if r.size > 4]) > 0.9
    found = Counter(r.shard for r in rows if r.size == 4)
    # random shards would hold an eighth each
    assert not hot or max(found.values()) > 0.2 * sum(found.values())


def test_awkward_rows(spark, awkward, no_docs):
    out = shard_documents(awkward, 8)
    assert out.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    check(out.collect(), [(r.doc_id, r.text) for r in awkward.collect()], 8)
    assert shard_documents(no_docs, 8).count() == 0
    one = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    check(shard_documents(one, 8).collect(), [(1, "a")], 8)


def test_quotas_stay_in_the_free_room():
    demand = [[0, 10, 4], [2, 0, 0], [4, 8, 0]]
    granted = _quotas(demand, [0, 3, 0])
    moved = [[granted[i][j] * demand[i][j] for j in range(3)] for i in range(3)]
    for j, free in enumerate([0, 3, 0]):
        arrive, leave = sum(moved[i][j] for i in range(3)), sum(moved[j])
        assert arrive <= leave + free + 1e-9


@pytest.mark.parametrize("hot,pairs,most", [(0.34, 0.1, 3), (0.1, 0.6, 1), (0, 1, 0)])
def test_settled_labels_keep_groups_whole(spark, hot, pairs, most):
    n = 4000
    texts = [(i, "hot" if i < hot * n else f"pair {i // 2}" if i < (hot + pairs) * n else f"single {i}") for i in range(n)]
    rows = shard_documents(spark.createDataFrame(texts, "doc_id bigint, text string"), 8).collect()
    check(rows, texts, 8)
    names, lying = dict(texts), {}
    for r in rows:
        lying.setdefault(names[r.doc_id], set()).add(r.shard)
    assert not hot or len(lying["hot"]) == most
    # no room is left at all where all documents are in pairs
    assert sum(len(x) > 1 for t, x in lying.items() if t.startswith("pair")) <= (7 if pairs == 1 else 0)


def test_every_linked_group_is_propagated(spark, monkeypatch):
    from testdata_dirs import SF_ORACLE

    entered = {}
    propagate = sharding.propagate_labels

    def counted(groups, claims, room, shards):
        entered.update(groups=groups.count(), claims=claims.count(), start=groups.agg(
            F.sum(sharding._whole("held") - F.array_max("held"))).first()[0])
        return propagate(groups, claims, room, shards)

    monkeypatch.setattr(sharding, "propagate_labels", counted)
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    rows = shard_documents(docs, 8).collect()
    linked = docs.groupBy(F.coalesce("text", F.lit(""))).count().where("count > 1").count()
    assert entered["groups"] == linked > 50 and entered["claims"] <= 16
    lying = {}
    for r in rows:
        lying.setdefault((r.text_crc32, r.size), Counter())[r.shard] += 1
    cut = sum(sum(c.values()) - max(c.values()) for c in lying.values())
    assert entered["start"] > 50 and cut == 0


def test_query_columns(spark):
    from testdata_dirs import SF_SMALL

    out = queries.op2_sharding(spark, SF_SMALL)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = out.collect()
    check(rows, [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()], 8)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
