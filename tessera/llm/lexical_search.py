"""Ranked lexical search with Block-Max MaxScore over sharded inverted lists.

Index.  The tasks of the scan cut their documents into shards of bounded text.
A shard is one row of flat arrays: the hashes of its terms in order, and for
each term a list of blocks, one for every 256 documents that hold it.  A block
stores its number, its number of postings, the largest term frequency and the
least document length in it (its maximum score follows from these for any
corpus), and its postings in two bytes each: the place of the document in the
block and the term frequency (255 and more: kept aside).  No row moves.

Search.  The items are taken in blocks with a bounded number of terms; a block
is broadcast.  A first pass over the shards sums the document frequencies of
its terms and takes their bounds, a second one ranks.  For each item the lists
are put in the order of their global bounds; those whose bounds together stay
under the score of the k-th best document so far are non-essential.  Only the
essential lists' blocks are read as they come; a document found there is
rejected if its score and the block maxima of the non-essential lists do not
reach that score, before a block of these is unpacked, and again after each
list.  The k best of a task pass from shard to shard; Spark merges the tasks'.

Terms are compared by 64-bit hashes.  Scores are 64-bit integers.

Edge cases: NULL texts and texts without a term are in no list and count for
nothing; a NULL id ranks after the others of the same score; repeated documents
are ranked each; items are ranked row by row, so repeated or NULL item ids keep
rows of their own; items without terms, or without documents, give no rows;
empty tables give an empty result.  Documents are not cut, so a text's length is
bounded by memory alone.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans import release, write_through
from ._words import LOWER, batches_of, joined_ranges, range_hashes, text_bytes, word_ranges

BLOCK = 256
ASIDE = 255  # term frequencies from here on are kept aside
MOST = 1_000_000  # no impact is larger
# fixed values: bytes of terms, once A-Z are lower-cased
_TERM = np.zeros(256, bool)
_TERM[48:58] = _TERM[97:123] = _TERM[128:] = True

_PARTS = ("ids", "missing", "n", "terms", "first_block", "block", "postings", "max_tf", "min_n", "place", "tf", "aside")
INDEX = "docs bigint, length bigint, " + ", ".join(f"{p} binary" for p in _PARTS)


def text_terms(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts one after the other, and the number of terms of each text."""
    data, starts = text_bytes(texts)
    data = LOWER[data]
    begin, end = word_ranges(data, _TERM)
    return range_hashes(data, begin, end), np.diff(np.searchsorted(begin, starts))


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def pack_shard(ids: np.ndarray, missing: np.ndarray, hashes: np.ndarray, n: np.ndarray) -> dict:
    """The arrays of one shard (see the module's text) from the documents' ids and terms."""
    doc = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((doc, hashes))
    hashes, doc = hashes[order], doc[order]
    at = _heads(hashes, doc)
    tf = np.diff(np.append(at, len(doc)))
    hashes, doc = hashes[at], doc[at]
    block_at = _heads(hashes, doc // BLOCK)
    term_at = _heads(hashes[block_at])
    none = not len(doc)
    return {
        "docs": int((n > 0).sum()), "length": int(n.sum()), "ids": ids.astype("<i8").tobytes(),
        "missing": missing.astype("u1").tobytes(), "n": n.astype("<i8").tobytes(),
        "terms": hashes[block_at][term_at].astype("<u8").tobytes(),
        "first_block": np.append(term_at, len(block_at)).astype("<u4").tobytes(),
        "block": (doc[block_at] // BLOCK).astype("<u4").tobytes(),
        "postings": (np.diff(np.append(block_at, len(doc))) - 1).astype("u1").tobytes(),
        "max_tf": b"" if none else np.minimum(np.maximum.reduceat(tf, block_at), ASIDE).astype("u1").tobytes(),
        "min_n": b"" if none else np.minimum.reduceat(n[doc], block_at).astype("<i8").tobytes(),
        "place": (doc % BLOCK).astype("u1").tobytes(), "tf": np.minimum(tf, ASIDE).astype("u1").tobytes(),
        "aside": tf[tf >= ASIDE].astype("<i8").tobytes(),
    }


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                shard_chars: int = 4_000_000) -> DataFrame:
    """The index of ``docs``, one row a shard of at most ``shard_chars`` characters (or one document)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, "text", shard_chars):
            hashes, n = text_terms(frame["text"])
            yield pd.DataFrame([pack_shard(frame["id"].to_numpy(), frame["missing"].to_numpy(), hashes, n)])

    ident = F.col(f"`{id_col}`").cast("bigint")
    rows = docs.select(F.coalesce(ident, F.lit(0)).alias("id"), ident.isNull().alias("missing"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInPandas(run, INDEX)


class Shard:
    """One row of the index, read."""

    def __init__(self, row, documents: int = 1, length: int = 1):
        view = lambda part, kind: np.frombuffer(getattr(row, part), dtype=kind)
        self.ids, self.missing = view("ids", "<i8"), view("missing", "u1").astype(bool)
        self.terms, self.first_block = view("terms", "<u8"), view("first_block", "<u4").astype(np.int64)
        self.block, self.count = view("block", "<u4").astype(np.int64), view("postings", "u1").astype(np.int64) + 1
        self.max_tf, self.min_n = view("max_tf", "u1"), view("min_n", "<i8")
        self.start = np.cumsum(self.count) - self.count
        self.place, self.tf, self.aside = view("place", "u1"), view("tf", "u1"), view("aside", "<i8")
        self.aside_at = np.flatnonzero(self.tf == ASIDE)
        self.m = middle(view("n", "<i8"), documents, length)

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the terms occur here, and the places of these in ``self.terms``."""
        if not len(self.terms):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        here = np.flatnonzero(self.terms[at] == terms)
        return here, at[here]

    def unpack(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents and term frequencies of the postings of these blocks, and the number of postings of each."""
        count = self.count[blocks]
        at = joined_ranges(self.start[blocks], count)
        tf = self.tf[at].astype(np.int64)
        large = np.flatnonzero(tf == ASIDE)
        tf[large] = self.aside[np.searchsorted(self.aside_at, at[large])]
        return np.repeat(self.block[blocks] * BLOCK, count) + self.place[at], tf, count


def middle(n, documents: int, length: int):
    return 100 - 50 + (50 * n * documents) // max(1, length)


def impact(tf, m):
    """What a term with weight 1 adds to a document's score."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def block_bound(max_tf: np.ndarray, min_n: np.ndarray, documents: int, length: int) -> np.ndarray:
    at_least = np.maximum(max_tf.astype(np.int64), 1)
    return np.where(max_tf == ASIDE, MOST, impact(at_least, middle(min_n, documents, length)))


@dataclass
class Item:
    """The terms of an item that occur in the corpus, their weights and global bounds."""

    number: int
    terms: np.ndarray
    weight: np.ndarray
    bound: np.ndarray


class Best:
    """The k best documents so far: highest score first, then the smallest id, NULL ids last."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.ids, self.missing = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """A document below this score does not come in."""
        return max(1, int(self.score[-1])) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.ids, ids])
        missing = np.concatenate([self.missing, missing])
        order = np.lexsort((ids, missing, -score))[:self.k]
        self.score, self.ids, self.missing = score[order], ids[order], missing[order]


def rank_shard(shard: Shard, item: Item, best: Best, documents: int, length: int, window: int = 16) -> int:
    """Put the shard's documents for ``item`` into ``best``; returns the number of blocks that were unpacked."""
    order = np.argsort(item.bound, kind="stable")
    present, place = shard.lists(item.terms[order])
    if not len(present):
        return 0
    weight, bound = item.weight[order][present], item.bound[order][present]
    under = np.cumsum(bound)  # of a list and those of smaller bounds
    many = shard.first_block[place + 1] - shard.first_block[place]
    rows = joined_ranges(shard.first_block[place], many)
    of = np.repeat(np.arange(len(place)), many)
    n_blocks = len(shard.m) // BLOCK + 1
    row_of = np.full((len(place), n_blocks), -1, np.int64)
    row_of[of, shard.block[rows]] = rows
    top = np.zeros((len(place), n_blocks), np.int64)
    top[of, shard.block[rows]] = weight[of] * block_bound(shard.max_tf[rows], shard.min_n[rows], documents, length)
    unpacked = 0
    for lo in range(0, n_blocks, window):
        hi, base = min(lo + window, n_blocks), lo * BLOCK
        score = np.zeros((hi - lo) * BLOCK, np.int64)

        def take(wanted: np.ndarray, of_list: np.ndarray) -> int:
            doc, tf, count = shard.unpack(wanted)
            np.add.at(score, doc - base, np.repeat(weight[of_list], count) * impact(tf, shard.m[doc]))
            return len(wanted)

        least = best.least
        split = int(np.searchsorted(under, least))  # the lists before it together stay under the k-th score
        essential = row_of[split:, lo:hi]
        lists, blocks = np.nonzero(essential >= 0)
        if not len(lists):
            continue
        unpacked += take(essential[lists, blocks], lists + split)
        # what the non-essential lists up to each one can add in each block
        rest = np.cumsum(top[:split, lo:hi], axis=0)
        found = np.flatnonzero(score)
        for j in range(split - 1, -1, -1):
            found = found[score[found] + rest[j][found // BLOCK] >= least]
            if not len(found):
                break
            wanted = row_of[j, lo:hi][np.unique(found // BLOCK)]
            wanted = wanted[wanted >= 0]
            if len(wanted):
                unpacked += take(wanted, np.full(len(wanted), j))
        found = found[score[found] >= least]
        if len(found):
            best.add(score[found], shard.ids[base + found], shard.missing[base + found])
    return unpacked


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The items with a number for each row, and ``item, term`` of their distinct terms."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, "text", 4_000_000):
            hashes, n = text_terms(frame["text"])
            item = np.repeat(frame["item"].to_numpy(), n)
            yield pd.DataFrame({"item": item, "term": hashes.view(np.int64)}).drop_duplicates()

    items = write_through(benchmark.select(
        F.monotonically_increasing_id().alias("item"), F.col(f"`{id_col}`").alias("item_id"),
        F.col(f"`{text_col}`").cast("string").alias("text")), "items")
    return items, write_through(items.select("item", "text").mapInPandas(run, "item bigint, term bigint"), "terms")


def _statistics(index: DataFrame, terms: np.ndarray) -> dict[int, tuple[int, int, int]]:
    """Document frequency, largest term frequency and least document length of each term of a block."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = sent.value
        for row in (r for frame in frames for r in frame.itertuples(index=False)):
            shard = Shard(row)
            here, place = shard.lists(wanted)
            if not len(here):
                continue
            heads = shard.first_block[place]
            ends = shard.first_block[place + 1]
            rows = joined_ranges(heads, ends - heads)
            cut = np.cumsum(ends - heads) - (ends - heads)
            yield pd.DataFrame({"term": wanted[here].view(np.int64), "df": np.add.reduceat(shard.count[rows], cut),
                                "max_tf": np.maximum.reduceat(shard.max_tf[rows], cut).astype(np.int64),
                                "min_n": np.minimum.reduceat(shard.min_n[rows], cut)})

    sent = index.sparkSession.sparkContext.broadcast(terms)
    found = (index.mapInPandas(run, "term bigint, df bigint, max_tf bigint, min_n bigint").groupBy("term")
             .agg(F.sum("df").alias("df"), F.max("max_tf").alias("max_tf"), F.min("min_n").alias("min_n")).collect())
    sent.unpersist()
    return {r.term: (r.df, r.max_tf, r.min_n) for r in found}


def _rank(index: DataFrame, items: list[Item], k: int, documents: int, length: int) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = sent.value
        best = [Best(k) for _ in asked]
        for row in (r for frame in frames for r in frame.itertuples(index=False)):
            shard = Shard(row, documents, length)
            for item, so_far in zip(asked, best, strict=True):
                rank_shard(shard, item, so_far, documents, length)
        for item, so_far in zip(asked, best, strict=True):
            yield pd.DataFrame({"item": item.number, "id": so_far.ids, "missing": so_far.missing, "score": so_far.score})

    sent = index.sparkSession.sparkContext.broadcast(items)
    return index.mapInPandas(run, "item bigint, id bigint, missing boolean, score bigint")


def search(index: DataFrame, benchmark: DataFrame, k: int = 50, item_col: str = "item_id", text_col: str = "text",
           block_terms: int = 200_000) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item.

    ``block_terms`` bounds (on average) the terms of the items that are broadcast at once."""
    items, terms = _items(benchmark, item_col, text_col)
    documents, length = index.agg(F.sum("docs"), F.sum("length")).first()
    documents, length = documents or 0, length or 0
    blocks = max(1, -(-terms.count() // block_terms))
    heaps = None
    for b in range(blocks):
        mine = terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).orderBy("item").toPandas()
        wanted = np.unique(mine["term"].to_numpy(dtype=np.int64).view(np.uint64))
        known = _statistics(index, wanted)
        asked = []
        for number, group in mine.groupby("item"):
            own = [t for t in dict.fromkeys(group["term"].tolist()) if t in known]
            weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * known[t][0] + 1))) for t in own], np.int64)
            top = block_bound(np.array([known[t][1] for t in own], np.int64), np.array([known[t][2] for t in own], np.int64),
                              documents, length)
            asked.append(Item(int(number), np.array(own, np.int64).view(np.uint64), weight, weight * top))
        found = write_through(_rank(index, asked, k, documents, length), "heaps")
        heaps = found if heaps is None else heaps.unionByName(found)
    of_item = Window.partitionBy("item").orderBy(F.col("score").desc(), "missing", "id")
    ranked = heaps.withColumn("rank", F.row_number().over(of_item)).where(F.col("rank") <= k)
    release(terms)
    return ranked.join(items.select("item", "item_id"), "item").select(
        F.col("item_id").alias(item_col), "rank", F.when(~F.col("missing"), F.col("id")).alias("doc_id"), "score")
