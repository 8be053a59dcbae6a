"""Word helpers: hashes and codes do not depend on how a batch is cut."""

import inspect
import tracemalloc

import numpy as np
import pytest
from tessera.llm import _words
from tessera.llm._words import WordCodes, range_hashes


def test_hashes_of_pieces_are_those_of_the_whole(monkeypatch):
    rnd = np.random.default_rng(1)
    data = rnd.integers(0, 4, 5000).astype(np.uint8)
    starts = np.sort(rnd.integers(0, 5000, 900))
    ends = np.minimum(starts + rnd.integers(0, 700, 900), 5000)
    order = rnd.permutation(900)
    whole = range_hashes(data, starts, ends)
    monkeypatch.setattr(_words, "_HASHED_AT_ONCE", 64)
    assert range_hashes(data, starts, ends).tolist() == whole.tolist()
    assert range_hashes(data, starts[order], ends[order]).tolist() == whole[order].tolist()
    assert range_hashes(data, starts[:0], ends[:0]).tolist() == []


def test_hashing_a_large_batch_needs_little_beside_it():
    data = np.full(8_000_000, 97, np.uint8)
    starts = np.arange(0, len(data), 8000)
    _words._power_table.cache_clear()
    tracemalloc.start()
    try:
        range_hashes(data, starts, starts + 7000)
        assert tracemalloc.get_traced_memory()[1] < 40_000_000
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("most", [3, 600_000])
def test_codes_of_words_seen_before(most):
    codes = WordCodes(lambda words: (np.array([len(w) for w in words]), np.ones(len(words), np.int64)), np.int32, most)
    for text in ("a bb ccc", "bb a a", "dddd a ccc", "eeeee"):
        words = text.split()
        data = np.frombuffer("".join(words).encode(), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        flat, counts = codes.encode(data, np.append(0, ends[:-1]), ends, np.array([len(words)]))
        assert flat.tolist() == [len(w) for w in words] and counts.tolist() == [len(words)]


def _traced(work, texts):
    """Peak of the memory that ``work`` takes for texts of one batch, in MB."""
    work(texts[:1])  # tables that stay
    tracemalloc.start()
    try:
        work(texts)
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def _texts(operator):
    chars = inspect.signature(operator).parameters["batch_chars"].default
    rnd = np.random.default_rng(2)
    words = np.array([f"日{x:x}" for x in rnd.integers(0, 1 << 20, chars // 7)])
    return [" ".join(part) for part in np.array_split(words, 50)]


def test_a_batch_of_op5_fits_beside_the_executor():
    from tessera.llm import sentencepiece_codec as codec

    model = codec.load_model(codec_file())
    codes = WordCodes(model.encode_words, np.int32)
    assert _traced(lambda texts: codes.encode(*model.words(texts)), _texts(codec.encode_decode)) < 100


def codec_file():
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def test_a_batch_of_op4_fits_beside_the_executor():
    from tessera.llm import decontaminate

    tables, _ = decontaminate.compile_items([("a", " ".join(f"日{x:x}" for x in range(400)))], 10)

    def search(texts):
        words = decontaminate.words_of(texts)
        for strings in tables:
            strings.search(words)

    assert _traced(search, _texts(decontaminate.search_documents)) < 60
