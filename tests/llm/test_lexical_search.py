"""The ranked search against a plain version that scores every document."""

import math
import random
import re

import numpy as np
import pytest
from tessera.llm import lexical_search as S
from tessera.plans import write_through

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(rows, items, k=50):
    docs = [(d, terms(t)) for d, t in rows]
    docs = [(d, w) for d, w in docs if w]
    n, total = len(docs), sum(len(w) for _, w in docs)
    out = []
    for item, text in items:
        found = []
        weights = {}
        for t in set(terms(text)):
            df = sum(t in w for _, w in docs)
            weights[t] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
        for d, w in docs:
            m = 100 - 50 + (50 * len(w) * n) // total
            score = sum(weight * ((1000000000 * w.count(t)) // (1000 * w.count(t) + 20 * m))
                        for t, weight in weights.items() if t in w)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out, key=repr)


def got(docs, items, k=50, shard_chars=4_000_000, **options):
    index = write_through(S.build_index(docs, shard_chars=shard_chars), "index")
    return sorted((tuple(r) for r in S.search(index, items, k, **options).collect()), key=repr)


def frames(spark, rows, items):
    return (spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, id string, n int"),
            spark.createDataFrame([(*i, 2) for i in items], "item_id bigint, text string, item int"))


@pytest.fixture(scope="module")
def random_rows():
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(120)]
    share = [1 / (i + 1) for i in range(120)]
    rows = [(i, " ".join(rnd.choices(words, share, k=rnd.choice([0, 1, 3, 20, 90])))) for i in range(900)]
    rows += [(2000 + i, "w5 " * 400 + "W7") for i in range(70)] + [(9007199254740993, "w100 w101 w102"), (None, "w100 w101 w102")]
    items = [(i, " ".join(rnd.choices(words, k=rnd.choice([1, 2, 6, 25])))) for i in range(25)]
    return rows, [*items, (7, "w100 w101"), (None, "w3, W5!"), (100, None), (101, "unheard of")]


def test_against_every_document(spark, random_rows):
    rows, items = random_rows
    docs, benchmark = frames(spark, rows, items)
    want = brute(rows, items, 10)
    assert got(docs, benchmark, 10) == want
    assert got(docs.repartition(3), benchmark, 10, shard_chars=4000, block_terms=20) == want


def test_awkward_rows(spark, awkward, no_docs):
    items = [(1, "The CAT, the mat"), (2, "lorem tail é日本"), (3, "one"), (4, "")]
    benchmark = frames(spark, [(1, "x")], items)[1]
    assert got(awkward, benchmark) == brute([(r.doc_id, r.text) for r in awkward.collect()], items)
    assert got(no_docs, benchmark) == [] and got(awkward, benchmark.limit(0)) == []


def test_blocks_are_rejected_before_they_are_unpacked():
    rnd = random.Random(1)
    texts = [" ".join(["the"] * rnd.randrange(1, 4) + rnd.choices([f"x{i}" for i in range(400)], k=30)) for _ in range(20_000)]
    texts[5] = "rare words the the the"
    hashes, n = S.text_terms(texts)
    ids = np.arange(len(texts))
    packed = S.pack_shard(ids, np.zeros(len(texts), bool), hashes, n)
    row = type("Row", (), packed)
    documents, length = packed["docs"], packed["length"]
    shard = S.Shard(row, documents, length)
    asked, _ = S.text_terms(["rare words the"])
    weight = np.array([10_000, 10_000, 1], np.int64)
    item = S.Item(0, asked, weight, weight * S.MOST)
    best = S.Best(1)
    unpacked = S.rank_shard(shard, item, best, documents, length)
    assert best.ids.tolist() == [5] and len(shard.lists(asked)[0]) == 3
    assert unpacked < len(texts) // S.BLOCK  # the common word has more blocks than that alone
