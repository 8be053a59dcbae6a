"""Near duplicates against all pairs on small tables."""

import random
import re
from math import comb

import numpy as np
import pytest
from tessera.llm import bottom_k as B

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, size, part, whole):
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and whole * both >= part * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = [(d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]
    return sorted([(*r, r[0] == r[2]) for r in out], key=repr)


def got(df, **options):
    out = B.near_duplicates(df, **options)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def family_rows(changes, seed=4):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(14):
        text = rnd.choices(words, k=rnd.choice([1, 2, 3, 9, 14, 22, 40, 60, 75, 90, 150, 400]))
        for _ in range(rnd.choice([1, 5, 25])):
            copy = list(text)
            for _ in range(rnd.choice(changes)):
                copy[rnd.randrange(len(copy))] = rnd.choice(words)
            rows.append((len(rows), " ".join(copy)))
    # a chain: each differs a little from the one before it, the ends share nothing
    chain = [f"c{i}" for i in range(200)]
    for step in range(0, 100, 5):
        rows.append((len(rows), " ".join(chain[step:step + 100])))
    # a passage that many share, in texts that are otherwise their own
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(len(rows) + i, passage + " " + " ".join(f"q{i}x{j}" for j in range(50))) for i in range(30)]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("size", [2, 5])
def test_against_all_pairs(spark, size):
    rows = family_rows([0, 0, 1, 1, 2, 4, 8])
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(df, shingle=size) == brute(rows, size, 80, 100)


def test_documents(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert got(documents, shingle=2) == brute(rows, 2, 80, 100)


def test_sketches_smaller_than_the_sets(spark):
    rows = family_rows([0, 1, 2, 5, 9], seed=8)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(df, shingle=3, part=90, k=48, together=2, batch_chars=5000) == brute(rows, 3, 90, 100)


def test_awkward_rows(spark, awkward, no_docs):
    rows = [(r.doc_id, r.text) for r in awkward.collect()] + [(9007199254740993, "one two three"), (9007199254740992, "one  TWO three")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id bigint, text string, n int, node string")
    assert got(df, shingle=2) == brute(rows, 2, 80, 100)
    assert got(no_docs) == []


def test_least_shared_is_the_binomial_tail():
    c = B.least_shared(64, 80, 100)
    tail = [sum(comb(64, i) * .8 ** i * .2 ** (64 - i) for i in range(n)) for n in (c, c + 1)]
    assert tail[0] <= 1e-11 < tail[1]
    assert B.least_shared(8, 100, 100) == 8


def test_near_copies_just_under_the_threshold_make_no_row_per_pair(spark, monkeypatch):
    rnd = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(600):
        copy = list(base)
        for place in rnd.sample(range(200), rnd.choice([6, 7, 7, 7])):
            copy[place] = f"x{i}y{place}"
        rows.append((i, " ".join(copy)))
    written = {}

    def counted(df, label="cut", write=B.write_through):
        out = write(df, label)
        written[label] = max(written.get(label, 0), out.count())
        return out

    monkeypatch.setattr(B, "write_through", counted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(df, shingle=2) == brute(rows, 2, 80, 100)
    assert max(written.values()) < 110 * len(rows) < 600 * 599 // 2 // 2, written


def test_linked_sets_share_a_key_and_a_set_has_few():
    rnd = random.Random(6)
    for size in (4, 5, 9, 17, 40, 100, 300, 3000):
        whole = [rnd.getrandbits(64) for _ in range(size + size // 4)]
        sets = [np.array(sorted(x), np.uint64) for x in (whole[:size], whole)]  # exactly at the threshold, or above
        sizes = np.array([len(x) for x in sets])
        keys, owner = B.tie_keys(np.concatenate(sets), sizes, 80, 100)
        assert set(keys[owner == 0].tolist()) & set(keys[owner == 1].tolist()), size
        assert len(keys) <= 2 * 2 * B.MOST_KEYS


def test_blocks_of_a_family_and_the_union_sketch(spark):
    rows = family_rows([0, 1, 2, 4, 8], seed=11)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(df, shingle=2, block_sets=5) == brute(rows, 2, 80, 100)
    a, b = sorted(random.Random(1).sample(range(100), 20)), sorted(random.Random(2).sample(range(100), 20))
    least = sorted(set(a) | set(b))[:20]
    both = B.union_shared(np.array([a, b], np.uint64), np.array([0]), np.array([1]))
    assert both.tolist() == [len(set(a) & set(b) & set(least))]
