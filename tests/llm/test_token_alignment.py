"""Alignment of two tokenizers against a plain version with the libraries' own tokens."""

import collections
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from conftest import AWKWARD
from tessera.llm import queries
from tessera.llm import token_alignment as T
from tokenizers import Tokenizer

FILES = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
         public_tokenizers.path("piece_bpe_32k.model"))


def byte_of():
    """Bytes of the characters that stand for them in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES[2])


def brute(rows, libraries):
    lib_a, lib_b = libraries
    table, counts, found = byte_of(), collections.Counter(), []
    for d, text in rows:
        ids_a = lib_a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = lib_b.encode(text) if text else []
        a = [bytes(table[c] for c in lib_a.id_to_token(i)) for i in ids_a]
        b = [bytes([int(lib_b.id_to_piece(i)[3:5], 16)]) if lib_b.is_byte(i)
             else lib_b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or b"".join(a) != (" " + text).encode() or b"".join(b) != (" " + text).encode():
            found.append((d, 0, 0, [], [], ""))
            continue
        at, place = 0, {}
        for i, token in enumerate(a):
            at += len(token)
            place[at] = i
        at = done_a = done_b = 0
        groups, links = [], []
        for j, token in enumerate(b):
            at += len(token)
            if at in place:
                i = place[at]
                groups.append(",".join(map(str, ids_a[done_a:i + 1])) + "|" + ",".join(map(str, ids_b[done_b:j + 1])))
                links.append((ids_a[i], ids_b[j]))
                done_a, done_b = i + 1, j + 1
        counts.update(links)
        found.append((d, len(a), len(b), groups, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = collections.defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted([(d, a, b, len(g), len(x), sum(counts[p] == best[p[1]] for p in x), sum(counts[p] for p in x), s)
                   for d, a, b, g, x, s in found], key=repr)


def got(df, **options):
    out = T.align_tokenizers(df, *FILES, **options)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


ROWS = [(r[0], r[1]) for r in AWKWARD] + [
    (100, "x" * 3000 + " " + "abc def " * 500 + "é日本😀" * 400), (101, " leading blanks  and   more\n\n tabs\t"),
    (102, "a▁b"), (103, " "), (104, "the cat sat " * 9000), (9007199254740993, "a large id"), (None, "none beside it")]


@pytest.mark.parametrize("options", [{}, {"chunk_bytes": 100, "fan_in": 3}, {"chunk_bytes": 500, "broadcast_pairs": 1}])
def test_against_the_libraries(spark, libraries, options):
    df = spark.createDataFrame([(*r, 1, "z") for r in ROWS], "doc_id bigint, text string, id int, part string")
    assert got(df, **options) == brute(ROWS, libraries)


def test_query(spark, libraries, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    out = queries.op12_token_alignment(spark, "/root/testdata/sf0.001").collect()
    assert sorted((tuple(r) for r in out), key=repr) == brute(rows, libraries)


def test_empty_table(no_docs):
    assert got(no_docs) == [] and got(no_docs, broadcast_pairs=-1) == []


def test_fragments_of_any_cut_compose_to_the_whole():
    pair, rnd = T.load_pair(*FILES), random.Random(2)
    text = "The quick brown fox, and then some; naïve 日本 words " * 6 + "zz9 1234 end"
    n = len(text.encode()) + 1
    whole = T.Aligned(pair, [text]).digests().iloc[0].to_dict()
    import numpy as np
    for _ in range(40):
        edges = [0, *sorted(rnd.sample(range(1, n), rnd.randrange(0, 30))), n]
        parts = T.Aligned(pair, [text] * (len(edges) - 1), np.array(edges[:-1]), np.array(edges[1:])).fragments()
        assert T.finish(T.join(parts)) == whole
        cut = rnd.randrange(len(parts) + 1)
        other = rnd.randrange(cut + 1)
        left = T.join([T.join([T.join(parts[:other]), T.join(parts[other:cut])]), T.join(parts[cut:])])
        right = T.join([T.join(parts[:other]), T.join([T.join(parts[other:cut]), T.join(parts[cut:]), T.EMPTY])])
        assert left == right and T.finish(left) == whole


def test_memory_of_long_frames(spark):
    """A frame of 2 MB is aligned in batches whose arrays are small, and batches on their way are bounded by bytes."""
    import tracemalloc

    import pandas as pd
    from tessera.plans.batches import BATCH_BYTES

    rnd, pair = random.Random(4), T.load_pair(*FILES)
    words = ["the", "cat", "naïve", "sat", "on", "zebra", "12345", "mat,", "日本"]
    texts = [" ".join(rnd.choices(words, k=400)) for _ in range(1000)]
    frame = pd.DataFrame({"id": range(1000), "missing": False, "text": texts})
    tracemalloc.start()
    # without the links, so that the results themselves take next to nothing
    parts = [out.drop(columns="links") for out in T.digests_of(pair, [frame])]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100_000_000
    whole = T.Aligned(pair, texts).digests().drop(columns="links")
    assert pd.concat(parts, ignore_index=True).drop(columns=["id", "missing"]).equals(whole)
    own = spark.newSession()
    got(own.createDataFrame([(1, "one two")], "doc_id bigint, text string"))
    assert int(own.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= BATCH_BYTES
