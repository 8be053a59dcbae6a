"""Near duplicates by bottom-k sketches from one hash function.

A document's set holds the 64-bit hashes of its distinct ``shingle``-word
shingles.  Equal sets are one class from the start.  A class's sketch is its
``k`` least hashes; all sketches come from that one hash function.

Families.  Which sketches meet in one task is decided by keys.  The hashes are
cut into ranges, as many for all sets of one band of sizes, and a key stands for
all shingles of a set in one range, if they are a few at least: two sets that
share a passage or some frequent shingles rarely agree in a whole range.  A band
has so many keys (the lowest ranges, and those of further orders of the same
hashes for small sets) that a pair right at the threshold agrees in none with
probability ``MISS`` (1e-11).  Sets that meet at a key are tied where their sizes
allow a link, and what is tied together is a family.  A set sends a bounded
number of keys, whatever its size, and sets that many others resemble send no
more than others.

Candidates.  A family's sets are cut into blocks of bounded size, and each pair
of blocks is one group; small families share a group.  There the inverted lists
of the retained values generate the overlaps.  The sketch of the union (the k
least of both sketches) estimates the similarity of a pair; pairs that can reach
the threshold are confirmed on their full sets.  For sets that lie whole in the
sketches the overlap is exact; for others a pair right at the threshold falls
short of the count asked for with probability ``MISS``, by the binomial tail.

Groups.  Pairs stay inside the task; what leaves it is one row per set, with the
least set it is connected to.

Edge cases: NULL texts and texts without words have empty sets, linked with
nothing; repeated rows and copies have one component; NULL ids do not count for
the component's id, which is NULL, like theirs, if no member has one (such rows
are kept); an empty table gives an empty result.  Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import ceil, comb, log

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import release, write_through
from ..plans.bloom import bloom_table, may_be_in
from ._components import connected_components
from ._words import batches_of, joined_ranges, mix
from .jaccard_join import (_SENT, Threshold, _met, _sent, least_connected, linked_sets, partial_overlaps, set_keys,
                           shingle_sets)

MISS = 1e-11
MOST_KEYS = 160
_TOP = np.uint64(1 << 63)  # between the order of unsigned hashes and that of signed values
_PAIRS = 20_000  # whose sketches are merged at once


@lru_cache(maxsize=8)
def least_shared(k: int, part: int, whole: int, miss: float = MISS) -> int:
    """The number of ``k`` retained values that a pair at the threshold falls short of with probability ``miss``."""
    j, total = part / whole, 0.0
    for c in range(k + 1):
        total += comb(k, c) * j ** c * (1 - j) ** (k - c)
        if total > miss:
            return max(1, c)
    return k


@dataclass(frozen=True)
class Band:
    """Sets of ``least`` to ``most`` shingles: ``keys`` ranges, ``ranges`` in each order, of ``few`` shingles at least."""

    least: int
    most: int
    ranges: int
    few: int
    keys: int


def _agrees(differ: int, shared: int, ranges: int, few: int) -> float:
    """The probability that two sets agree in a range and have ``few`` shingles there."""
    p = 1 / ranges
    fewer = sum(comb(shared, c) * p ** c * (1 - p) ** (shared - c) for c in range(min(few, shared + 1)))
    return (1 - p) ** differ * (1 - fewer)


@lru_cache(maxsize=512)
def band(number: int, part: int, whole: int) -> Band | None:
    """The band whose smaller sets have ``2 ** number`` shingles or more, below twice as many; None if only equal sets
    link there."""
    low, high = 1 << number, 2 << number
    most = (high - 1) * whole // part
    hardest = set()
    for a in sorted({*range(low, min(high, low + 16)), *range(low, high, max(1, low // 8)), high - 1}):
        top = a * whole // part
        for b in range(a, top + 1) if a < 32 else (a, (a + top) // 2, top):
            differ = (a + b) * (whole - part) // (whole + part)
            differ -= (a + b - differ) % 2  # the sizes tell whether it is odd
            if differ > 0:
                hardest.add((differ, (a + b - differ) // 2))
    if not hardest:
        return None
    best = None
    for few in (3, 2, 1):
        for ranges in sorted({max(2, round(low / x)) for x in (0.5, 1, 1.5, 2, 2.5, 3, 3.5, 4, 5, 6, 8)}):
            worst = min(_agrees(d, s, ranges, few) for d, s in hardest)
            keys = ceil(log(MISS) / log(1 - worst)) if 0 < worst < 1 else 1 << 20
            if best is None or keys < best.keys:
                best = Band(low, most, ranges, few, keys)
        if best.keys <= MOST_KEYS:
            break
    return best


def tie_keys(hashes: np.ndarray, sizes: np.ndarray, part: int, whole: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of which linked sets share one (but for ``MISS``), and their set's number."""
    starts = np.cumsum(sizes) - sizes
    keys, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for number in range(int(sizes.max(initial=0)).bit_length()):
        own = band(number, part, whole)
        if own is None:
            continue
        sets = np.flatnonzero((sizes >= own.least) & (sizes <= own.most))
        if not len(sets):
            continue
        held = hashes[joined_ranges(starts[sets], sizes[sets])]
        by = np.repeat(np.arange(len(sets)), sizes[sets])
        spread = mix(held ^ np.uint64(0x5851F42D4C957F2D))
        for turn in range(ceil(own.keys / own.ranges)):
            order = held if turn == 0 else mix(held + np.uint64(turn * 0xD1342543DE82EF95 & (1 << 64) - 1))
            count = min(own.ranges, own.keys - turn * own.ranges)
            place = (((order >> np.uint64(32)) * np.uint64(own.ranges)) >> np.uint64(32)).astype(np.int64)
            inside = place < count
            slot = by[inside] * count + place[inside]
            total = np.zeros(len(sets) * count, np.uint64)
            np.add.at(total, slot, spread[inside])
            kept = np.flatnonzero(np.bincount(slot, minlength=len(total)) >= own.few)
            mark = (np.uint64(number) << np.uint64(56)) + (np.uint64(turn) << np.uint64(32)) + (kept % count).astype(np.uint64)
            keys.append(mix(total[kept] + mix(mark)))
            owners.append(sets[kept // count])
    return np.concatenate(keys), np.concatenate(owners)


def union_shared(sketches: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the least values of the union of sketches ``a`` and ``b``, as many as a sketch has, are in both."""
    k = sketches.shape[1]
    both = np.sort(np.concatenate([sketches[a], sketches[b]], axis=1), axis=1)
    same = both[:, 1:] == both[:, :-1]
    rank = np.arange(1, 2 * k) - np.cumsum(same, axis=1)
    return (same & (rank < k)).sum(axis=1)


def near_sets(hashes: np.ndarray, sizes: np.ndarray, block: np.ndarray | None, k: int, part: int, whole: int,
              together: int) -> np.ndarray:
    """For every two sets, given by their sorted hashes one after the other, whether they link; with ``block`` those
    of different blocks only."""
    n, threshold = len(sizes), Threshold(part, whole)
    starts, held = np.cumsum(sizes) - sizes, np.minimum(sizes, k)
    values, owner = hashes[joined_ranges(starts, held)], np.repeat(np.arange(n), held)
    order = np.argsort(values, kind="stable")
    shared = partial_overlaps(values[order], owner[order], n)
    pairs = []
    for at in range(0, n, 256):
        rows = slice(at, at + 256)
        less, more = np.minimum(sizes[rows, None], sizes[None, :]), np.maximum(sizes[rows, None], sizes[None, :])
        own = shared[rows].astype(np.int64)
        # sets that lie whole in their sketches are known
        may = np.where(more <= k, threshold.holds(own, less, more),
                       threshold.near(less, more) & (own >= least_shared(k, part, whole)))
        may &= own >= np.minimum(together, -(-less * part // whole))
        may &= np.arange(at, at + len(own))[:, None] < np.arange(n)[None, :]
        if block is not None:
            may &= block[rows, None] != block[None, :]
        a, b = np.nonzero(may)
        pairs.append((a + at, b))
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    sketches = np.full((n, k), np.iinfo(np.uint64).max, np.uint64)
    sketches[owner, joined_ranges(np.zeros(n, np.int64), held)] = values
    estimated = np.flatnonzero(np.maximum(sizes[a], sizes[b]) > k)
    gone = np.zeros(len(a), bool)
    for at in range(0, len(estimated), _PAIRS):
        some = estimated[at:at + _PAIRS]
        gone[some] = union_shared(sketches, a[some], b[some]) < least_shared(k, part, whole)
    a, b = a[~gone], b[~gone]
    linked = np.zeros((n, n), bool)
    used = np.unique(np.concatenate([a, b]))
    if len(used):
        full = linked_sets(hashes[joined_ranges(starts[used], sizes[used])], sizes[used], threshold)
        holds = full[np.searchsorted(used, a), np.searchsorted(used, b)]
        linked[a[holds], b[holds]] = linked[b[holds], a[holds]] = True
    return linked


def _hashes(column) -> np.ndarray:
    return (np.concatenate([np.asarray(x, np.int64) for x in column]).view(np.uint64) ^ _TOP if len(column)
            else np.empty(0, np.uint64))


def _sets(docs: DataFrame, shingle: int, id_col: str, text_col: str, batch_chars: int) -> DataFrame:
    """``id, missing, n, k1, k2, hashes`` of each document, the array once for equal sets of a batch."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, "text", batch_chars):
            hashes, sizes = shingle_sets(frame["text"], shingle)
            k1, k2 = set_keys(hashes, sizes)
            _, first = np.unique(np.column_stack([k1, k2]), axis=0, return_index=True)
            own = np.zeros(len(frame), bool)
            own[first] = True
            # the order of unsigned hashes, as signed values
            parts = np.split((hashes ^ _TOP).view(np.int64), np.cumsum(sizes)[:-1])
            yield pd.DataFrame({
                "id": frame["id"], "missing": frame["missing"], "n": sizes, "k1": k1, "k2": k2,
                "hashes": [p if o and len(p) else None for p, o in zip(parts, own, strict=True)]})

    ident = F.col(f"`{id_col}`").cast("bigint")
    rows = docs.select(F.coalesce(ident, F.lit(0)).alias("id"), ident.isNull().alias("missing"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    return write_through(rows.mapInPandas(run, "id bigint, missing boolean, n bigint, k1 bigint, k2 bigint, "
                                               "hashes array<bigint>"), "sets")


def _ties(sets: DataFrame, part: int, whole: int, most_hashes: int = 500_000) -> DataFrame:
    """``a, b``: ties between sets (by their first key) that agree in a range and may link by their sizes."""
    threshold = Threshold(part, whole)

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole_frame in frames:
            at = np.cumsum(whole_frame["n"].to_numpy(dtype=np.int64)) // most_hashes
            for _, frame in whole_frame.groupby(at, sort=False):
                sizes = frame["n"].to_numpy(dtype=np.int64)
                keys, owner = tie_keys(_hashes(frame["hashes"]), sizes, part, whole)
                yield from _sent(keys, frame["k1"].to_numpy(dtype=np.int64)[owner], sizes[owner], threshold)

    return _met(sets.where("hashes IS NOT NULL").select("k1", "n", "hashes").mapInPandas(send, _SENT), threshold)


def _links(sets: DataFrame, classes: DataFrame, k: int, part: int, whole: int, together: int, block_shingles: int,
           block_sets: int) -> DataFrame:
    """``a, b``: the confirmed links, one row for each set of a group, enough of them to connect every component."""
    ties = write_through(_ties(sets, part, whole).distinct(), "ties")
    families = write_through(connected_components(ties), "families")
    release(ties)
    members = write_through(classes.select("k1", "node", "row", "n").join(
        families.withColumnRenamed("node", "k1"), "k1").drop("k1"), "members")
    release(families)
    blocks = write_through(members.groupBy("root").agg(F.greatest(
        F.ceil(F.sum("n") / block_shingles), F.ceil(F.count(F.lit(1)) / block_sets)).cast("int").alias("blocks")), "blocks")
    sets_there, shingles = members.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    bins = 1 + 2 * sets_there // block_sets + 2 * shingles // block_shingles
    large = F.col("blocks") > 1
    placed = members.join(blocks, "root").select(
        "node", "row", F.when(large, F.col("root")).otherwise(F.pmod(F.xxhash64("root"), F.lit(bins))).alias("place"), "blocks",
        F.when(large, F.pmod(F.xxhash64("node"), F.col("blocks"))).otherwise(F.lit(0)).cast("int").alias("block"))
    rows = may_be_in(sets.where("hashes IS NOT NULL").select("row", "hashes"), bloom_table(members, "row"), "row")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    groups = rows.join(placed, "row").select("*", other.alias("other")).select(
        "node", "hashes", "place", (F.col("blocks") > 1).alias("large"), "block", F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"))

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node", ignore_index=True)
        sizes = np.array([len(x) for x in frame["hashes"]], dtype=np.int64)
        block = frame["block"].to_numpy() if frame["i"].iloc[0] != frame["j"].iloc[0] else None
        linked = near_sets(_hashes(frame["hashes"]), sizes, block, k, part, whole, together)
        root = least_connected(linked)
        joined = np.flatnonzero(root != np.arange(len(root)))
        node = frame["node"].to_numpy(dtype=np.int64)
        return pd.DataFrame({"a": node[joined], "b": node[root[joined]]})

    out = write_through(groups.groupBy("large", "place", "i", "j").applyInPandas(link, "a bigint, b bigint"), "links")
    release(members)
    release(blocks)
    return out


def near_duplicates(docs: DataFrame, shingle: int = 5, part: int = 80, whole: int = 100, k: int = 64, together: int = 3,
                    id_col: str = "doc_id", text_col: str = "text", batch_chars: int = 4_000_000,
                    block_shingles: int = 1_000_000, block_sets: int = 1024) -> DataFrame:
    """``id, n_shingles, component_id, kept`` of every document: the size of its set, the least id reachable by
    links (``whole * intersection >= part * union``), and whether it is the one with that id."""
    sets = _sets(docs, shingle, id_col, text_col, batch_chars)
    numbered = sets.withColumn("row", F.monotonically_increasing_id())
    classes = write_through(numbered.where("n > 0").groupBy("k1", "k2").agg(
        F.min("n").alias("n"), F.min(F.when(~F.col("missing"), F.col("id"))).alias("first"),
        F.min(F.when(F.col("hashes").isNotNull(), F.col("row"))).alias("row"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    links = _links(numbered, classes, k, part, whole, together, block_shingles, block_sets)
    roots = write_through(connected_components(links), "roots")
    named = classes.select("node", "k1", "k2", "first").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    named = write_through(named.select("k1", "k2", "first", "root"), "named")
    least = write_through(named.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    classes = write_through(named.join(least, "root").select("k1", "k2", "component_id"), "named")
    own = F.when(~F.col("missing"), F.col("id"))
    component = F.when(F.col("n") == 0, own).otherwise(F.col("component_id"))
    return sets.select("id", "missing", "n", "k1", "k2").join(classes, ["k1", "k2"], "left").select(
        own.alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        own.eqNullSafe(component).alias("kept"))
