"""Token files: encoding against the tokenizers library, order, positions and the files themselves."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tessera.llm import queries
from tessera.llm._words import WordCodes
from tessera.llm.token_files import TokenizerWords, read_token_files, split_words, write_token_files
from tokenizers import Tokenizer

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def test_words_encode_as_whole_texts(library):
    rnd = random.Random(2)
    parts = list("a e t'sTh1.!\n\t é日😀-=à") + ["  ", "\n\n", "<|endoftext|>", "'s", "\u2000", "\xa0", "\x1c", "\x85", "\u3000",
                                              "\u200b", "\x0b", "don't", " à", "\x00"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 30))) for _ in range(6000)] + ["", None]
    words = TokenizerWords(FILE)
    flat, counts = WordCodes(words.encode, np.uint16).encode(*split_words(texts))
    got = [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    assert got == [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_files_hold_the_sequence(spark, documents, awkward, library, tmp_path):
    docs = documents.select("doc_id", "text").unionByName(awkward.select("doc_id", "text"))
    manifest = write_token_files(docs, FILE, 2, folder=f"file://{tmp_path}", batch_chars=30_000)
    parts = sorted(manifest.collect(), key=lambda r: r.part)
    assert len(parts) > 2 and all(p.width == 2 for p in parts)
    whole = np.concatenate([np.fromfile(tmp_path / f"part-{p.part:05d}.tok", "<u2") for p in parts])
    rows = sorted(read_token_files(spark, manifest, batch_tokens=5000).collect(), key=lambda r: r.start)
    source = docs.collect()
    assert len(rows) == len(source) and [r.doc_id is not None for r in rows] == sorted(r.doc_id is not None for r in rows)
    ids = [r.doc_id for r in rows if r.doc_id is not None]
    assert ids == sorted(ids)
    at, found = 0, []
    for r in rows:
        own = np.frombuffer(r["ids"], "<u4")
        assert r.start == at and len(own) == r.n_tokens and np.array_equal(whole[at:at + r.n_tokens], own) and own[-1] == 2
        found.append((r.doc_id, own[:-1].tolist()))
        at += r.n_tokens
    assert at == len(whole)
    want = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in source]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def test_empty_table(spark, no_docs):
    manifest = write_token_files(no_docs, FILE, 2)
    assert manifest.count() == 0 and read_token_files(spark, manifest).count() == 0


def test_query_against_the_library(spark, library):
    """Every column of the registered query over the whole small table."""
    from testdata_dirs import SF_SMALL

    rows = queries.op8_token_files(spark, SF_SMALL).collect()
    source = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect()
    want, at = [], 0
    for r in source:
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in rows) == want and len(want) > 100
    assert rows[0].asDict().keys() == {"doc_id", "start", "n_tokens", "ids_crc32"}


def test_words_stay_known_and_are_forgotten_as_a_whole(library):
    words = TokenizerWords(FILE)
    codes = WordCodes(words.encode, np.uint16, max_words=40)
    rnd = random.Random(5)
    for _ in range(30):
        texts = [" ".join(rnd.choice("abcdefgh") * rnd.randint(1, 6) for _ in range(20)) for _ in range(3)]
        flat, counts = codes.encode(*split_words(texts))
        got = [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
        assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
