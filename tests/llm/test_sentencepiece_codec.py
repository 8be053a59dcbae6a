"""Ids and texts against the sentencepiece library."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tessera.llm._words import WordCodes
from tessera.llm.sentencepiece_codec import encode_decode, load_model

FILE = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


def own_ids(texts, max_words=600_000):
    model = load_model(FILE)
    flat, counts = WordCodes(model.encode_words, np.int32, max_words).encode(*model.words(texts))
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]


def test_random_texts(library):
    rnd = random.Random(4)
    parts = ["a", " ", "▁", "e", "t", "h", "\n", "é", "日", "aa", "  ", "😀", "́", "the", "ing", "==", "--", "\t", "Ⅷ",
             "<0x0A>", "<s>", "\x00", "ａ"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 60))) for _ in range(4000)]
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    texts += ["".join(rnd.choices(pieces, k=rnd.randint(1, 12))) for _ in range(6000)]
    texts += [" " * k + "a" for k in range(70)] + ["a" + " " * k for k in range(70)]
    texts += [c * k for c in "ab-=*/.0 e" for k in (1, 2, 3, 7, 50, 333)]
    want = library.encode(texts)
    assert own_ids(texts) == want
    assert own_ids(texts, max_words=500) == want
    model = load_model(FILE)
    assert [model.decode(i) for i in want] == library.decode(want)


def test_long_texts_without_blanks(library):
    rnd = random.Random(1)
    for text in ("".join(rnd.choices("日本語abcdeaaa", k=50_000)), "a" * 100_000, " " * 100_000):
        assert own_ids([text]) == [library.encode(text)]


def test_documents_and_awkward_rows(documents, awkward, no_docs, library):
    for docs in (documents, awkward):
        want = sorted(((r.doc_id, library.encode(r.text or "")) for r in docs.collect()), key=repr)
        got = encode_decode(docs, FILE, batch_chars=30_000).collect()
        assert sorted(((r.doc_id, r["ids"]) for r in got), key=repr) == want
        assert all(r.decoded == library.decode(r["ids"]) for r in got)
    assert encode_decode(no_docs, FILE).count() == 0


def test_query_against_the_library(spark, library):
    """Every column of the registered query over the whole small table."""
    import hashlib

    from tessera.llm import queries
    from testdata_dirs import SF_SMALL

    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        ids = library.encode(r.text or "")
        want.append((r.doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids))))
    out = queries.op5_sentencepiece(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(tuple(r) for r in out.collect()) == sorted(want) and len(want) > 100
