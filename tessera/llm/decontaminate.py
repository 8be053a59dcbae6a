"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every run of ``window`` consecutive words of a benchmark item is a test string;
an item of fewer words is one test string.  Test strings of one length share a
shift table over blocks of consecutive words (how far the search may move on
when a block ends at the current word) and buckets of test strings by the hash
of their last block.  The search stands on the last word of a possible
occurrence: a positive shift skips ahead, a zero shift selects a bucket, whose
members are compared word by word: their hashes, then the bytes of the words
themselves.  Many stretches of the documents advance in step, one array element
each.

The benchmark is dealt into blocks of about ``block_chars`` characters, which
tasks compile and write into the shared folder; the driver sees their names
only.  Every document is searched against one block after the other within the
same task, which holds one block at a time, so there is no shuffle of documents.

Edge cases: NULL texts and texts without words have no hits; items without
words are ignored; items without id mark words but are not listed; repeated
items count once; repeated documents are judged each; empty tables give no
hits or no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import scratch_path, small_batches
from ._rows import beside_text, identity
from ._words import LOWER, batches_of, joined_ranges, mix, range_hashes, text_bytes, word_ranges

# fixed values: bytes of words after A-Z are lower-cased
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = True
IS_WORD[0x61:0x7B] = True
IS_WORD[0x80:] = True


class Words(NamedTuple):
    """The words of some texts one after the other: bytes of the texts, start, end and hash of each word, and where
    each text's words begin."""

    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray


def words_of(texts) -> Words:
    data, starts = text_bytes(texts)
    data = LOWER[data]
    begin, end = word_ranges(data, IS_WORD)
    return Words(data, begin, end, range_hashes(data, begin, end), np.searchsorted(begin, starts))


def same_words(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether the words ``i`` of ``a`` have the bytes of the words ``j`` of ``b``."""
    size = a.end[i] - a.begin[i]
    same = size == b.end[j] - b.begin[j]
    at = np.flatnonzero(same)
    differ = a.data[joined_ranges(a.begin[i[at]], size[at])] != b.data[joined_ranges(b.begin[j[at]], size[at])]
    same[np.repeat(at, size[at])[differ]] = False
    return same


def _block_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words that end at each position (0 where there are fewer)."""
    out = np.zeros(len(words), np.uint64)
    if len(words) >= size:
        total = words[size - 1:].copy()
        for k in range(1, size):
            total = mix(total) + words[size - 1 - k:len(words) - k]
        out[size - 1:] = mix(total)
    return out


class TestStrings:
    """Shift table and suffix buckets of test strings with the same number of words."""

    def __init__(self, source: Words, starts: np.ndarray, length: int, items: np.ndarray):
        """Test strings are the ``length`` words of ``source`` from each of ``starts`` on."""
        self.source, self.length = source, length
        strings = source.hashes[starts[:, None] + np.arange(length)]
        count = len(strings)
        self.block = 3 if self.length >= 6 else min(2, self.length)
        bits = max(12, int(count * self.length).bit_length() + 3)
        self.right = np.uint64(64 - min(bits, 22))
        self.shift = np.full(1 << (64 - int(self.right)), self.length - self.block + 1, np.int64)
        last = None
        for end in range(self.block - 1, self.length):  # later blocks leave smaller shifts
            last = _block_hashes(strings[:, end - self.block + 1:end + 1].reshape(-1), self.block)[self.block - 1::self.block]
            np.minimum.at(self.shift, last >> self.right, self.length - 1 - end)
        order = np.argsort(last, kind="stable")
        self.suffix, self.starts, self.items = last[order], starts[order], items[order]

    def search(self, words: Words, stretch: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """Last word and item of every occurrence inside the texts."""
        bounds = words.bounds
        first, stop = bounds[:-1] + self.length - 1, bounds[1:]
        lanes = np.maximum(0, -(-(stop - first) // stretch))
        at = joined_ranges(np.zeros(len(lanes), np.int64), lanes) * stretch + np.repeat(first, lanes)
        end = np.minimum(at + stretch, np.repeat(stop, lanes))
        hashes = _block_hashes(words.hashes, self.block)
        slot = (hashes >> self.right).astype(np.int64)
        stops = []
        while len(at):
            move = self.shift[slot[at]]
            stops.append(at[move == 0])
            at = at + np.maximum(move, 1)
            left = at < end
            at, end = at[left], end[left]
        where = np.concatenate([np.empty(0, np.int64), *stops])
        low = np.searchsorted(self.suffix, hashes[where], side="left")
        members = np.searchsorted(self.suffix, hashes[where], side="right") - low
        found_at, found = [], []
        step = 200_000  # members of buckets compared at a time
        part = np.cumsum(members) // step
        for group in np.split(np.arange(len(where)), np.flatnonzero(np.diff(part)) + 1):
            candidate = joined_ranges(low[group], members[group])
            place = np.repeat(where[group], members[group])
            begin = place - self.length + 1
            same = np.arange(len(candidate))
            for k in range(self.length):
                own = self.starts[candidate[same]] + k
                same = same[self.source.hashes[own] == words.hashes[begin[same] + k]]
            for k in range(self.length):
                same = same[same_words(self.source, self.starts[candidate[same]] + k, words, begin[same] + k)]
            found_at.append(place[same])
            found.append(self.items[candidate[same]])
        return np.concatenate([np.empty(0, np.int64), *found_at]), np.concatenate([np.empty(0, np.int64), *found])


def _distinct(words: Words) -> np.ndarray:
    """A number for each word, the same for equal words and no others."""
    names: dict[bytes, int] = {}
    raw = words.data.tobytes()
    return np.array([names.setdefault(raw[a:b], len(names)) for a, b in zip(words.begin.tolist(), words.end.tolist(),
                                                                           strict=True)], dtype=np.int64)


def compile_items(items: list[tuple], window: int) -> tuple[list[TestStrings], list[str | None]]:
    """The tables of one block of benchmark items ``(id, text)``."""
    words = words_of([text for _, text in items])
    names = _distinct(words)
    sizes = np.diff(words.bounds)
    out = []
    for length in sorted({int(min(n, window)) for n in sizes if n}):
        own = np.flatnonzero(np.minimum(sizes, window) == length)
        starts = joined_ranges(words.bounds[own], sizes[own] - length + 1)
        item = np.repeat(own, sizes[own] - length + 1)
        strings = names[starts[:, None] + np.arange(length)]
        _, first = np.unique(np.column_stack([strings, item]), axis=0, return_index=True)
        out.append(TestStrings(words, starts[first], length, item[first]))
    return out, [None if i is None else str(i) for i, _ in items]


def write_blocks(items: DataFrame, window: int, block_chars: int) -> list[str]:
    """Compile the items ``id, text`` in tasks; the paths of the blocks' tables in the shared folder."""
    spark = items.sparkSession
    items = items.where(F.col("text").isNotNull()).select(F.col("id").cast("string").alias("id"), "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    folder = scratch_path(spark, "blocks")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for block in _blocks(frames, block_chars):
            # a name of its own: a task that runs again writes other files, and only the names it returns are read
            name = uuid.uuid4().hex
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(pickle.dumps(compile_items(block, window), protocol=5))
            yield pd.DataFrame({"name": [name]})

    dealt = items.repartition(max(1, -(-total // block_chars)), F.xxhash64("id", "text"))
    # one name per block
    return [f"{folder}/{r.name}" for r in dealt.mapInPandas(run, "name string").collect()]


def _blocks(frames: Iterator[pd.DataFrame], block_chars: int) -> Iterator[list[tuple]]:
    block, chars = [], 0
    for frame in frames:
        for i, text in zip(frame["id"], frame["text"], strict=True):
            block.append((i if isinstance(i, str) else None, text))
            chars += len(text)
            if chars >= block_chars:
                yield block
                block, chars = [], 0
    if block:
        yield block


@lru_cache(maxsize=1)
def read_block(path: str) -> tuple[list[TestStrings], list[str | None]]:
    """The tables of one block; a worker keeps the last one it read."""
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(path)
    with store.open_input_file(at) as f:
        return pickle.loads(f.read())


def search_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                     text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                     keep: list[str] | None = None, block_chars: int = 4_000_000,
                     batch_chars: int = 500_000) -> DataFrame:
    """``id, n_words, n_hit, items, contaminated`` for every document: its words, those inside an occurrence of
    a test string, and the sorted ids of the items whose test strings occur.  ``keep`` names columns of the
    documents to carry along as a struct ``kept`` instead of the id alone."""
    small_batches(docs.sparkSession)
    items = benchmark.select(F.col(f"`{item_col}`").alias("id"), F.col(f"`{item_text_col}`").cast("string").alias("text"))
    blocks = write_blocks(items, window, block_chars)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, "_text", batch_chars):
            words = words_of(frame["_text"])
            bounds = words.bounds
            edges = np.zeros(len(words.hashes) + 1, np.int64)
            listed: list[set[str]] = [set() for _ in range(len(frame))]
            for block in blocks:
                tables, ids = read_block(block)
                for strings in tables:
                    last, item = strings.search(words)
                    np.add.at(edges, last - strings.length + 1, 1)
                    np.add.at(edges, last + 1, -1)
                    document = np.searchsorted(bounds, last, side="right") - 1
                    for d, i in set(zip(document.tolist(), item.tolist(), strict=True)):
                        if ids[i] is not None:
                            listed[d].add(ids[i])
            hit = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
            out = frame.drop(columns="_text")
            out["n_words"], out["n_hit"] = np.diff(bounds), hit[bounds[1:]] - hit[bounds[:-1]]
            out["items"] = [sorted(x) for x in listed]
            out["contaminated"] = out["n_hit"] > 0
            yield out

    return beside_text(docs, [identity(docs, id_col, keep)], text_col, run,
                       "n_words bigint, n_hit bigint, items array<string>, contaminated boolean")
