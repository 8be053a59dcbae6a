"""Wu-Manber search against a plain scan for every test string."""

import re

import numpy as np
from pyspark.sql import functions as F
from tessera.llm import decontaminate
from tessera.llm.decontaminate import search_documents

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "item_id bigint, text string, id string, n_hit int"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    strings = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            strings.setdefault(tuple(w[i:i + window]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(s) for s in strings}:
            for i in range(len(w) - size + 1):
                if (s := tuple(w[i:i + size])) in strings:
                    hit |= set(range(i, i + size))
                    found |= strings[s]
        out.append((doc, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in df.collect()), key=repr)


def test_matches_plain_scan(spark, documents, awkward):
    texts = [r.text for r in awkward.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    items += [(900, "one"), (901, "AND the, cat"), (902, None), (903, "?!"), (None, "sit amet"), (901, "and THE cat"),
              (904, texts[7][:300]), (905, "two"), (906, texts[5])]
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in items], SCHEMA)
    both = documents.select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))
    expect = brute([(r.doc_id, r.text) for r in both.collect()], items)
    assert got(search_documents(both, bench, batch_chars=50_000)) == expect
    assert got(search_documents(both, bench, block_chars=2000)) == expect
    assert sum(1 for r in expect if r[2]) > 5


def test_empty_tables(spark, awkward, no_docs):
    none = spark.createDataFrame([], SCHEMA)
    assert search_documents(no_docs, none).count() == 0
    out = search_documents(awkward, none)
    assert out.where("contaminated OR n_hit > 0 OR size(items) > 0").count() == 0
    assert out.count() == awkward.count()
    kept = search_documents(awkward, none, keep=awkward.columns)
    assert kept.select("kept.*").columns == awkward.columns and kept.where(F.col("kept._text") == "x").count() > 5


def test_words_of_equal_hash_are_told_apart(monkeypatch):
    """With a hash of a word's length alone, only the bytes can tell words apart."""
    monkeypatch.setattr(decontaminate, "range_hashes", lambda data, begin, end: (end - begin).astype(np.uint64))
    items = [(1, "one two six ten"), (2, "ten six two one"), (2, "ten six two one"), (3, "abc"), (4, "two two two two two two")]
    tables, ids = decontaminate.compile_items(items, 3)
    docs = ["one two six ten one two", "xyz one two six", "xyz six two one", "", "two two two", "abd abc", "six two ten", None]
    words = decontaminate.words_of(docs)
    found = set()
    for strings in tables:
        last, item = strings.search(words)
        d = np.searchsorted(words.bounds, last, side="right") - 1
        found |= {(int(a), int(b - words.bounds[a]), ids[i]) for a, b, i in zip(d, last, item, strict=True)}
    # document, last word and item of each occurrence
    assert found == {(0, 2, "1"), (0, 3, "1"), (1, 3, "1"), (2, 3, "2"), (4, 2, "4"), (5, 1, "3")}


def test_blocks_are_compiled_in_tasks(spark):
    items = spark.createDataFrame([(i, f"word{i} " * 40) for i in range(50)] + [(None, "x"), (7, None)], "id int, text string")
    paths = decontaminate.write_blocks(items, 10, 1000)
    assert len(paths) > 5
    ids = [i for p in paths for i in decontaminate.read_block(p)[1]]
    assert sorted(ids, key=repr) == sorted([str(i) for i in range(50)] + [None], key=repr)
