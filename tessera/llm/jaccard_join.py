"""N-gram Jaccard join by vertical partitioning of the n-gram order.

A document's set holds the 64-bit hashes of its distinct ``n``-word shingles.
Equal sets are one node from the start.

Order.  The global n-gram order goes from rare to frequent shingles, by hash
among equals.  How frequent a shingle is, is read from a table of ``SLOTS``
counters filled from all documents (one byte each when sent out), so its size
does not grow with the corpus; shingles that share a counter only make the order
less sharp, any order gives the same links.

Candidates.  Two sets that link share one of the first shingles of each: as many
as a set may lack of another, and one.  Each set sends these shingles; sets that
meet at one are sorted by size and tied where their sizes allow a link, and what
is tied together is a family.  Passages that many documents share stand late in
the order and do not tie them.  A task sends a shingle once for each run of
sizes, with ties among its own sets beside it, so a shingle that a third of all
documents hold is a few rows per task.

Long sets send many first shingles, and chance ties grow with the corpus.  So a
family of more than one block is tied again: the hashes are cut into so many
ranges that linked sets agree in more whole ranges than each may leave out as
short ones; sets that agree in a range, all its shingles, are tied.

Where linked sets may differ in so much that such ranges are too short, sets are
left out before the order is made.  Of each set the shingles below a bound of
the hash are looked at, more of them than it may lack of another; one is alone
if no other set that may link by its size holds it.  A set with more of them
alone than it may lack is linked with none.  Counters, order and ties are then
those of the sets that are left, and some more first shingles are sent: linked
sets meet at so many more of them.  Every two sets that meet at a shingle of few
sets are counted, and tied if they meet often enough; a shingle of many sets ties
them all.  So what unrelated sets share by chance does not tie them.

Counting.  A family's sets are cut into blocks of bounded size, and each pair
of blocks is one group.  There the shingles are cut into ``FRAGMENTS`` ranges of
hashes; the overlaps of every two sets are counted in each fragment and
summed per pair.  After a fragment, sets that cannot reach the threshold with
any other by what is left are not counted further.  Pairs stay inside the task;
what leaves it is one row per set, with its number of links and the least set it
is connected to.

Edge cases: NULL texts and texts without words have empty sets, linked with
nothing; repeated rows and copies are linked with each other; NULL ids do not
count for the component's id, which is NULL if no member has one; an empty
table gives an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import release, small_batches, write_through
from ..plans.bloom import bloom_table, marked_by, may_be_in
from ._components import connected_components
from ._rows import beside_text
from ._words import LOWER, batches_of, joined_ranges, mix, range_hashes, text_bytes, word_ranges

SLOTS = 1 << 22
FRAGMENTS = 8
_PIECE = 1 << 16  # counters in a row
_MOST = (1 << 32) - 1

# fixed values: bytes between words
_WORD = np.ones(256, bool)
_WORD[[32, 9, 10, 11, 12, 13]] = False


def shingle_sets(texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of all texts one after the other, and the size of each text's set."""
    data, starts = text_bytes(texts)
    data = LOWER[data]
    data[starts[1:] - 1] = 32  # the byte after a text, which may hold zero bytes itself
    begin, end = word_ranges(data, _WORD)
    words = range_hashes(data, begin, end)
    bounds = np.searchsorted(begin, starts)
    count = np.diff(bounds)
    shingles = np.where(count == 0, 0, np.maximum(1, count - size + 1))
    at = joined_ranges(bounds[:-1], shingles)
    owner = np.repeat(np.arange(len(count)), shingles)
    width = np.minimum(count[owner], size)
    hashes = width.astype(np.uint64)
    for k in range(size):
        inside = k < width
        hashes[inside] = mix(hashes[inside]) + words[at[inside] + k]
    hashes = mix(hashes)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.bincount(owner[new], minlength=len(count))


def set_keys(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys of each set, the same for equal sets (0 for the empty one)."""
    full = sizes > 0
    keys = []
    for seed in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        key = np.zeros(len(sizes), np.uint64)
        if full.any():
            heads = (np.cumsum(sizes) - sizes)[full]
            key[full] = mix(np.add.reduceat(mix(hashes ^ np.uint64(seed)), heads) + sizes[full].astype(np.uint64))
        keys.append(key.view(np.int64))
    return keys[0], keys[1]


@dataclass(frozen=True)
class Threshold:
    """Sets link when ``whole * shared >= part * united``."""

    part: int
    whole: int

    def first(self, sizes: np.ndarray) -> np.ndarray:
        """How many shingles of a set hold one of any set linked with it, whatever the order."""
        return sizes * (self.whole - self.part) // self.whole + 1

    def looked_at(self, sizes: np.ndarray) -> np.ndarray:
        """Below which upper half of a hash the shingles of a set are looked at: a quarter more of them than a set may
        lack, and what a small set's share may fall short by chance.  No higher for larger sets."""
        share = 1.25 * (self.whole - self.part) / self.whole + 1 / np.sqrt(np.maximum(sizes, 1))
        return (np.minimum(share, 1) * (1 << 32)).astype(np.uint64)

    def meetings(self, sizes: np.ndarray) -> np.ndarray:
        """In how many of their first shingles linked sets meet, the less of the two, if so many less one are added."""
        return 1 + np.minimum(7, sizes * self.part // (16 * self.whole))

    def parted(self) -> bool:
        """Whether the ranges of :func:`range_keys` hold some eight shingles, so that few agree by chance."""
        return self.part * self.part >= 8 * self.whole * (self.whole - self.part)

    def classes(self, most: int) -> np.ndarray:
        """Least sizes of the size classes up to ``most`` and the two beyond; linked sets are in one or in neighbours."""
        least = [1]
        while least[-1] <= most or len(least) < 3:
            least.append(least[-1] * self.whole // self.part + 1)
        return np.array([*least, least[-1] * self.whole // self.part + 1], dtype=np.int64)

    def near(self, less, more):
        """Whether sets of these sizes may link."""
        return self.whole * less >= self.part * more

    def holds(self, shared, one, other):
        return self.whole * shared >= self.part * (one + other - shared)


def shingle_levels(docs: DataFrame, size: int, batch_chars: int) -> np.ndarray:
    """The level of each counter, higher the more shingles of ``docs`` fall on it."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(SLOTS, np.uint32)
        for frame in batches_of(frames, "text", batch_chars):
            hashes, _ = shingle_sets(frame["text"], size)
            slots, found = np.unique(_slot(hashes), return_counts=True)
            counts[slots] = np.minimum(counts[slots] + found, _MOST)
        if counts.any():
            pieces = [_packed(part) for part in counts.reshape(-1, _PIECE)]
            yield pd.DataFrame({"piece": np.arange(len(pieces)), "salt": TaskContext.get().partitionId() % 64,
                                "counts": pieces})

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {}
        for frame in frames:
            for row in frame.itertuples(index=False):
                key = (row.piece, row.salt)
                total[key] = np.minimum(total.get(key, 0) + _unpacked(row.counts), _MOST).astype(np.uint32)
        for (piece, salt), counts in total.items():
            yield pd.DataFrame({"piece": [piece], "salt": [salt], "counts": [_packed(counts)]})

    def level(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in add(frames):
            frame["counts"] = [np.minimum(8 * np.log2(_unpacked(c) + 1), 255).astype(np.uint8).tobytes()
                               for c in frame["counts"]]
            yield frame

    schema = "piece int, salt int, counts binary"
    counted = docs.select("text").mapInPandas(count, schema)
    # some of the tasks' counters at a time, then the sums: no task adds up those of all tasks
    summed = counted.repartition("piece", "salt").mapInPandas(add, schema).withColumn("salt", F.lit(0))
    levels = np.zeros(SLOTS, np.uint8)
    # one byte a counter reaches the driver
    for row in summed.repartition("piece").mapInPandas(level, schema).collect():
        levels[row.piece * _PIECE:(row.piece + 1) * _PIECE] = np.frombuffer(row.counts, np.uint8)
    return levels


def _packed(counts: np.ndarray) -> bytes:
    # the low bytes of all counters, then the next ones: most of those are 0
    return zlib.compress(np.minimum(counts, _MOST).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    low_first = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T
    return np.ascontiguousarray(low_first).view("<u4").ravel().astype(np.int64)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(SLOTS - 1)).astype(np.int64)


def first_shingles(hashes: np.ndarray, sizes: np.ndarray, threshold: Threshold, levels: np.ndarray,
                   more: int | np.ndarray = 0) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of each set in the global order, of which linked sets share one, and their set's number.

    Of ``more`` shingles of each set linked ones share so many more."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((hashes, levels[_slot(hashes)], owner))
    length = np.where(sizes > 0, threshold.first(sizes) + more, 0)
    at = joined_ranges(np.cumsum(sizes) - sizes, length)
    return hashes[order[at]], np.repeat(np.arange(len(sizes)), length)


def range_keys(hashes: np.ndarray, sizes: np.ndarray, threshold: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """Keys of which linked sets share one, and their set's number.

    Sets of one size class and the next cut the hashes into the same ranges: so many that two linked ones differ in
    all but ``spare + 1`` at most.  A key stands for all shingles of a set in one range.  Ranges of two shingles or
    less are left out of sets that have no more than ``spare`` of them: one that linked sets agree in is left."""
    least = threshold.classes(int(sizes.max(initial=1)))
    own_class = np.searchsorted(least, sizes, side="right") - 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    mixed, high = mix(hashes), hashes >> np.uint64(32)
    keys, owners = [], []
    for back in (0, 1):  # with the next class, with the one before
        group = own_class - back
        most = least[np.maximum(group, 0) + 1] + least[np.maximum(group, 0) + 2] - 2  # the sizes of two sets together
        differ = most * (threshold.whole - threshold.part) // (threshold.whole + threshold.part)
        spare = 1 + differ // 16
        ranges = np.where((group >= 0) & (sizes > 0), differ + 1 + spare, 0)
        inside = ranges[owner] > 0
        base = np.cumsum(ranges) - ranges
        held, by = high[inside], owner[inside]
        # the hashes of a set are sorted, so those of a range stand together
        slot = base[by] + ((held * ranges[by].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        total, count = np.zeros(int(ranges.sum()), np.uint64), np.bincount(slot, minlength=int(ranges.sum()))
        heads = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])) if len(slot) else slot
        if len(heads):
            total[slot[heads]] = np.add.reduceat(mixed[inside], heads)
        sets = np.repeat(np.arange(len(sizes)), ranges)
        place = np.arange(len(total)) - base[sets]
        key = mix(total + mix((group[sets].astype(np.uint64) << np.uint64(40)) + place.astype(np.uint64)))
        short = np.bincount(sets[count <= 2], minlength=len(sizes))
        kept = (count > 2) | (short > spare)[sets]
        keys.append(key[kept])
        owners.append(sets[kept])
    return np.concatenate(keys), np.concatenate(owners)


def tie_runs(keys: np.ndarray, nodes: np.ndarray, least: np.ndarray, most: np.ndarray,
             threshold: Threshold) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of rows of one key, sorted by key and least size, without a gap in size that a link cannot cross.

    The first row of each run, the greatest size in it, and for each row its run."""
    number = np.cumsum(np.append([0], keys[1:] != keys[:-1])) << 40 if len(keys) else np.empty(0, np.int64)
    reach = np.maximum.accumulate(number + most) - number
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | ~threshold.near(reach[:-1], least[1:])
    first = np.flatnonzero(new)
    return first, np.maximum.reduceat(most, first) if len(first) else most, np.cumsum(new) - 1


def _looked_at(hashes: np.ndarray, sizes: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Whether each shingle lies below its set's limit."""
    return (hashes >> np.uint64(32)) < np.repeat(limits, sizes)


def count_looked_at(hashes: np.ndarray, sizes: np.ndarray, threshold: Threshold) -> np.ndarray:
    """How many shingles of each set are looked at."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return np.bincount(owner[_looked_at(hashes, sizes, threshold.looked_at(sizes))], minlength=len(sizes))


def _shared(docs: DataFrame, size: int, threshold: Threshold, batch_chars: int) -> DataFrame:
    """``node, shared``: how many of the shingles looked at of a set (by its first key) are not alone, or a few more;
    sets that have none are not in it."""

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, "text", batch_chars):
            hashes, sizes = shingle_sets(frame["text"], size)
            node, _ = set_keys(hashes, sizes)
            _, own = np.unique(node, return_index=True)
            own = own[sizes[own] > 0]
            hashes = hashes[joined_ranges((np.cumsum(sizes) - sizes)[own], sizes[own])]
            node, sizes = node[own], sizes[own]
            # all that the smallest set that may link looks at
            sent = _looked_at(hashes, sizes, threshold.looked_at(sizes * threshold.part // threshold.whole))
            looked = _looked_at(hashes, sizes, threshold.looked_at(sizes))[sent]
            owner = np.repeat(np.arange(len(sizes)), sizes)[sent]
            order = np.lexsort((sizes[owner], hashes[sent]))
            keys, looked, owner = hashes[sent][order].view(np.int64), looked[order], owner[order]
            length = sizes[owner]
            first, most, run = tie_runs(keys, node[owner], length, length, threshold)
            many = np.bincount(run, minlength=len(first)) > 1
            yield pd.DataFrame(dict(zip(_LOOKED, [keys[first], node[owner[first]], length[first],
                                                  4 * most + 2 * (looked[first] & ~many) + many], strict=True)))
            # shared with a set of the same batch: no size, and their number in the column after it
            found = np.bincount(owner[many[run] & looked], minlength=len(sizes))
            some = np.flatnonzero(found)
            yield pd.DataFrame(dict(zip(_LOOKED, [node[some], node[some], -1, found[some]], strict=True)))

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried = np.empty((0, len(_LOOKED)), np.int64)
        for frame in frames:
            rows = frame[_LOOKED].to_numpy(dtype=np.int64)
            ready = rows[:, 2] < 0
            nodes, counts = rows[ready, 1], rows[ready, 3]
            rows = np.concatenate([carried, rows[~ready]])
            if len(rows):
                key, node, least, rest = rows.T
                first, most, run = tie_runs(key, node, least, rest >> 2, threshold)
                shared = np.logical_or.reduceat(((rest & 1) > 0) | (node != node[first][run]), first)
                hit = shared[run] & ((rest & 2) > 0)
                hits = _distinct_rows(np.column_stack([run[hit], node[hit]]))[:, 1]
                nodes, counts = np.append(nodes, hits), np.append(counts, np.ones(len(hits), np.int64))
                carried = rows[first[-1:]].copy()  # the run may go on in the next frame
                carried[:, 3] = 4 * most[-1] + (1 if shared[-1] else carried[:, 3] & 2)
            yield pd.DataFrame({"node": nodes, "found": counts})

    sent = docs.select("text").mapInPandas(send, _LOOKED_TYPES)
    met = sent.repartition("key").sortWithinPartitions("key", "least").mapInPandas(meet, "node bigint, found bigint")
    return met.groupBy("node").agg(F.sum("found").alias("shared"))


# rest: four times the greatest size, two if the row's set looks at the shingle, one if the row stands for several sets
_LOOKED = ["key", "node", "least", "rest"]
_LOOKED_TYPES = "key bigint, node bigint, least bigint, rest bigint"


def _distinct_rows(pairs: np.ndarray) -> np.ndarray:
    order = np.lexsort(pairs.T[::-1])
    pairs = pairs[order]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
    return pairs[new]


def _ties(docs: DataFrame, size: int, threshold: Threshold, batch_chars: int) -> DataFrame:
    """``a, b``: ties between sets (by their first key) that share a first shingle and may link by their sizes."""
    sent_levels = docs.sparkSession.sparkContext.broadcast(shingle_levels(docs, size, batch_chars))

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, "text", batch_chars):
            hashes, sizes = shingle_sets(frame["text"], size)
            node, _ = set_keys(hashes, sizes)
            _, own = np.unique(node, return_index=True)
            own = own[sizes[own] > 0]
            starts = np.cumsum(sizes) - sizes
            keys, owner = first_shingles(hashes[joined_ranges(starts[own], sizes[own])], sizes[own], threshold,
                                         sent_levels.value)
            nodes, length = node[own][owner], sizes[own][owner]
            yield from _sent(keys, nodes, length, threshold)

    return _met(docs.select("text").mapInPandas(send, _SENT), threshold)


def _ties_counted(docs: DataFrame, size: int, threshold: Threshold, batch_chars: int) -> DataFrame:
    """``a, b``: ties between sets that meet in as many first shingles as linked ones do and may link by their sizes.

    Sets that meet at a shingle of more than ``_FEW`` sets are tied by that one."""
    sent_levels = docs.sparkSession.sparkContext.broadcast(shingle_levels(docs, size, batch_chars))

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, "text", batch_chars):
            hashes, sizes = shingle_sets(frame["text"], size)
            node, _ = set_keys(hashes, sizes)
            _, own = np.unique(node, return_index=True)
            own = own[sizes[own] > 0]
            hashes = hashes[joined_ranges((np.cumsum(sizes) - sizes)[own], sizes[own])]
            node, sizes = node[own], sizes[own]
            keys, owner = first_shingles(hashes, sizes, threshold, sent_levels.value, threshold.meetings(sizes) - 1)
            order = np.lexsort((sizes[owner], keys))
            keys, nodes, length = keys[order].view(np.int64), node[owner[order]], sizes[owner[order]]
            first, most, run = tie_runs(keys, nodes, length, length, threshold)
            many = np.bincount(run, minlength=len(first)) > _FEW
            kept = ~many[run]
            kept[first] = True
            # of many sets one row, and the ties that are made already: no size, and the other set in the last column
            rest = 2 * np.where(many[run], most[run], length) + many[run]
            yield pd.DataFrame(dict(zip(_MET, [keys[kept], nodes[kept], length[kept], rest[kept]], strict=True)))
            tied = _pairs(nodes[many[run]], nodes[first][run][many[run]])
            yield pd.DataFrame(dict(zip(_MET, [tied[:, 0], tied[:, 0], -1, tied[:, 1]], strict=True)))

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def made(tied: np.ndarray, pairs: np.ndarray, need: np.ndarray) -> pd.DataFrame:
            tied = np.sort(tied, axis=1)
            out = {"a": np.append(tied[:, 0], pairs[:, 0]), "b": np.append(tied[:, 1], pairs[:, 1]),
                   "met": np.append(np.full(len(tied), _ENOUGH), np.ones(len(pairs), np.int64)),
                   "need": np.append(np.ones(len(tied), np.int64), need)}
            return pd.DataFrame(out)

        carried = np.empty((0, len(_MET)), np.int64)
        for frame in frames:
            rows = frame[_MET].to_numpy(dtype=np.int64)
            ready = rows[:, 2] < 0
            tied, rows = rows[ready][:, [1, 3]], np.concatenate([carried, rows[~ready]])
            pairs, need = np.empty((0, 2), np.int64), np.empty(0, np.int64)
            if len(rows):
                first, most, run = tie_runs(*rows[:, :3].T, rows[:, 3] >> 1, threshold)
                count = np.diff(np.append(first, len(rows)))
                many = np.logical_or.reduceat((rows[:, 3] & 1) > 0, first) | (count > _FEW)
                tied = np.concatenate([tied, _pairs(rows[many[run], 1], rows[first][run, 1][many[run]])])
                # the last run may go on in the next frame
                if many[-1]:
                    carried = rows[first[-1:]].copy()
                    carried[:, 3] = 2 * most[-1] + 1
                else:
                    carried = rows[first[-1]:]
                few = ~many
                few[-1] = False
                pairs, need = _meetings(rows, first[few], count[few], threshold)
            yield made(tied, pairs, need)
        if len(carried) > 1:
            yield made(np.empty((0, 2), np.int64),
                       *_meetings(carried, np.zeros(1, np.int64), np.array([len(carried)]), threshold))

    sent = docs.select("text").mapInPandas(send, "key bigint, node bigint, least bigint, rest bigint")
    met = sent.repartition("key").sortWithinPartitions("key", "least").mapInPandas(
        meet, "a bigint, b bigint, met bigint, need bigint")
    # few pairs: what is summed grows with the sets, not with their squares
    return met.groupBy("a", "b").agg(F.sum("met").alias("met"), F.min("need").alias("need")).where(
        "met >= need").select("a", "b")


# rest: twice the greatest size, and one if the row stands for many sets
_MET = ["key", "node", "least", "rest"]
_FEW = 16
_ENOUGH = 1 << 20


def _meetings(rows: np.ndarray, first: np.ndarray, count: np.ndarray,
              threshold: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """Every two rows within the runs that may link by their sizes, and in how many shingles they have to meet."""
    node, length = rows[:, 1], rows[:, 2]
    one, other = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for ahead in range(1, int(count.max(initial=1))):
        longer = count > ahead
        at = joined_ranges(first[longer], count[longer] - ahead)
        one.append(at)
        other.append(at + ahead)
    one, other = np.concatenate(one), np.concatenate(other)
    kept = (node[one] != node[other]) & threshold.near(length[one], length[other])
    one, other = one[kept], other[kept]
    need = np.minimum(threshold.meetings(length[one]), threshold.meetings(length[other]))
    return np.sort(np.column_stack([node[one], node[other]]), axis=1), need


def _ties_again(texts: DataFrame, size: int, threshold: Threshold, batch_chars: int) -> DataFrame:
    """``a, b``: ties between sets of one ``root`` that agree in a range of hashes and may link by their sizes."""

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, "text", batch_chars):
            hashes, sizes = shingle_sets(frame["text"], size)
            node, _ = set_keys(hashes, sizes)
            keys, owner = range_keys(hashes, sizes, threshold)
            family = mix(frame["root"].to_numpy(dtype=np.int64).view(np.uint64))
            yield from _sent(mix(keys + family[owner]), node[owner], sizes[owner], threshold)

    return _met(texts.select("text", "root").mapInPandas(send, _SENT), threshold)


_COLUMNS = ["key", "node", "least", "most"]
_SENT = "key bigint, node bigint, least bigint, most bigint"


def _sent(keys: np.ndarray, nodes: np.ndarray, length: np.ndarray, threshold: Threshold) -> Iterator[pd.DataFrame]:
    """Rows of a batch's keys, one for each run of sizes, and the ties that are made already."""
    order = np.lexsort((length, keys))
    keys, nodes, length = keys[order].view(np.int64), nodes[order], length[order]
    first, most, run = tie_runs(keys, nodes, length, length, threshold)
    yield pd.DataFrame(dict(zip(_COLUMNS, [keys[first], nodes[first], length[first], most], strict=True)))
    tied = _pairs(nodes, nodes[first][run])
    # a tie that is made already: no size, and the other set in the last column
    yield pd.DataFrame(dict(zip(_COLUMNS, [tied[:, 0], tied[:, 0], -1, tied[:, 1]], strict=True)))


def _met(sent: DataFrame, threshold: Threshold) -> DataFrame:
    """``a, b``: the ties of rows with equal keys."""

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried = np.empty((0, 4), np.int64)
        for frame in frames:
            rows = frame[_COLUMNS].to_numpy(dtype=np.int64)
            ready = rows[:, 2] < 0
            rows, made = np.concatenate([carried, rows[~ready]]), rows[ready][:, [1, 3]]
            if len(rows):
                first, most, run = tie_runs(*rows.T, threshold)
                made = np.concatenate([made, _pairs(rows[:, 1], rows[first][run, 1])])
                carried = rows[first[-1:]].copy()  # the run may go on in the next frame
                carried[:, 3] = most[-1]
            yield pd.DataFrame(np.unique(made, axis=0), columns=["a", "b"])

    met = sent.repartition("key").sortWithinPartitions("key", "least")
    return met.mapInPandas(meet, "a bigint, b bigint")


def _pairs(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.unique(np.column_stack([one, other])[one != other], axis=0)


def partial_overlaps(hashes: np.ndarray, owner: np.ndarray, count: int, pairs_at_once: int = 1_000_000,
                     columns: int = 1024) -> np.ndarray:
    """Shared shingles of every two sets within a fragment, given in the order of the hashes.

    Shingles of an eighth of the sets are counted as a product of 0/1 columns, the others by their pairs."""
    total = np.zeros((count, count), np.int32)
    heads = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.empty(0, int)
    run = np.diff(np.append(heads, len(hashes)))
    wide = np.flatnonzero((run > 1) & (8 * run > count))
    for at in range(0, len(wide), columns):
        part = wide[at:at + columns]
        held = np.zeros((count, len(part)), np.float32)
        held[owner[joined_ranges(heads[part], run[part])], np.repeat(np.arange(len(part)), run[part])] = 1
        np.add(total, held @ held.T, out=total, casting="unsafe")
    few = np.flatnonzero((run > 1) & (8 * run <= count))
    mine = joined_ranges(heads[few], run[few])
    start, length = np.repeat(heads[few], run[few]), np.repeat(run[few], run[few])
    for part in np.split(np.arange(len(mine)), np.flatnonzero(np.diff(np.cumsum(length) // pairs_at_once)) + 1):
        if len(part):
            other = owner[joined_ranges(start[part], length[part])]
            pair = np.repeat(owner[mine[part]], length[part]) * count + other
            np.add(total, np.bincount(pair, minlength=count * count).reshape(count, count), out=total, casting="unsafe")
    return total


def linked_sets(hashes: np.ndarray, sizes: np.ndarray, threshold: Threshold) -> np.ndarray:
    """For every two sets, one after the other in ``hashes``, whether they link (no set with itself)."""
    n = len(sizes)
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], np.repeat(np.arange(n), sizes)[order]
    cuts = np.searchsorted(hashes, np.arange(1, FRAGMENTS, dtype=np.uint64) * np.uint64((1 << 64) // FRAGMENTS))
    total, left, open_ = np.zeros((n, n), np.int32), sizes.astype(np.int64), np.ones(n, bool)

    def holds(still: np.ndarray) -> np.ndarray:
        linked = np.empty((n, n), bool)
        for at in range(0, n, 256):
            rows = slice(at, at + 256)
            shared = total[rows] + np.minimum(still[rows, None], still[None, :])
            linked[rows] = threshold.holds(shared, sizes[rows, None], sizes[None, :])
        np.fill_diagonal(linked, False)
        return linked

    for fragment, own in zip(np.split(hashes, cuts), np.split(owner, cuts), strict=True):
        left = left - np.bincount(own, minlength=n)
        counted = open_[own]
        total += partial_overlaps(fragment[counted], own[counted], n)
        open_ = holds(left).any(axis=1)
        if not open_.any():
            break
    return holds(np.zeros(n, np.int64))


def least_connected(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric table of links the least row that can be reached."""
    one, other = np.nonzero(linked)
    label = np.arange(len(linked))
    while True:
        new = label.copy()
        np.minimum.at(new, one, label[other])
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _count_links(size: int, threshold: Threshold, batch_chars: int):
    def count(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["k1", "k2"]).sort_values(["k1", "k2"], ignore_index=True)
        parts = [shingle_sets(part["text"], size) for part in batches_of([frame], "text", batch_chars)]
        hashes, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        linked = linked_sets(hashes, sizes, threshold)
        block = frame["block"].to_numpy()
        if frame["i"].iloc[0] != frame["j"].iloc[0]:
            linked &= block[:, None] != block[None, :]  # pairs within a block have a group of their own
        root = least_connected(linked)
        links = linked @ frame["copies"].to_numpy(dtype=np.int64)
        return pd.DataFrame({"k1": frame["k1"], "k2": frame["k2"], "r1": frame["k1"].to_numpy()[root],
                             "r2": frame["k2"].to_numpy()[root], "links": links})

    return count


def join_documents(docs: DataFrame, shingle: int = 3, part: int = 90, whole: int = 100, id_col: str = "doc_id",
                   text_col: str = "text", block_shingles: int = 1_000_000, block_sets: int = 1024,
                   batch_chars: int = 500_000) -> DataFrame:
    """``id, n_shingles, component_id, n_links`` of every document: the size of its set, the least id reachable
    by links, and the number of documents it is linked with; also ``row``, a hash of its id and text, and
    ``component``, a key of its component (NULL for an empty set)."""
    threshold = Threshold(part, whole)
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                       _row_hash(id_col, text_col).alias("row"))

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, "_text", batch_chars):
            hashes, sizes = shingle_sets(frame["_text"], shingle)
            k1, k2 = set_keys(hashes, sizes)
            yield pd.DataFrame({"n": sizes, "looked": count_looked_at(hashes, sizes, threshold), "k1": k1, "k2": k2})

    narrow = write_through(beside_text(rows, [F.col("id"), F.col("row")], "text", keys,
                                       "n bigint, looked bigint, k1 bigint, k2 bigint"), "sets")
    count = narrow.count()  # from the files' footers; the tables of sets below have no more rows
    sets = write_through(narrow.where("n > 0").groupBy("k1", "k2").agg(
        F.min("row").alias("row"), F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"),
        F.first("n").alias("n"), F.first("looked").alias("looked")), "sets", count)
    texts_of = rows.select("row", "text")
    if not threshold.parted():
        alone = F.col("looked") - F.coalesce("shared", F.lit(0))
        left = write_through(sets.join(_shared(rows, shingle, threshold, batch_chars).withColumnRenamed("node", "k1"), "k1", "left")
                             .where(alone <= F.floor(F.col("n") * (whole - part) / whole)).select("row"),
                             "left", count)
        # one text of each set that is left, not moved before the filter
        texts_of = write_through(may_be_in(texts_of, bloom_table(left, "row"), "row").join(left, "row", "left_semi"), "texts")
        release(left)

    def blocks_of(members: DataFrame) -> DataFrame:
        return write_through(members.groupBy("root").agg(F.greatest(
            F.ceil(F.sum("n") / block_shingles), F.ceil(F.count(F.lit(1)) / block_sets)).cast("int").alias("blocks")),
            "blocks", count)

    ties = _ties if threshold.parted() else _ties_counted
    families = connected_components(ties(texts_of, shingle, threshold, batch_chars), count)
    members = write_through(sets.join(families.withColumnRenamed("node", "k1"), "k1")
                            .select("k1", "k2", "row", "copies", "n", "root"), "members", count)
    blocks = blocks_of(members)
    if threshold.parted() and blocks.where("blocks > 1").limit(1).count():
        marked = write_through(members.join(blocks, "root").select(*members.columns, (F.col("blocks") > 1).alias("large")),
                               "members", count)
        release(members)
        release(blocks)
        large = write_through(marked.where("large").drop("large"), "large", count)
        texts = may_be_in(texts_of, bloom_table(large, "row"), "row").join(large.select("row", "root"), "row")
        again = connected_components(_ties_again(texts, shingle, threshold, batch_chars), count)
        members = write_through(marked.where("NOT large").drop("large").unionByName(
            large.drop("root").join(again.withColumnRenamed("node", "k1"), "k1")), "members", count)
        release(marked)
        release(large)
        blocks = blocks_of(members)
    placed = members.join(blocks, "root").withColumn(
        "block", F.pmod(F.xxhash64("k1", "k2"), F.col("blocks")).cast("int"))
    # most texts are in no family: the filter keeps them from being moved
    texts = may_be_in(texts_of, bloom_table(members, "row"), "row").join(placed.drop("n"), "row")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = texts.select("*", other.alias("other")).select(
        "text", "k1", "k2", "copies", "root", "block", F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"))
    counted = write_through(pairs.groupBy("root", "i", "j").applyInPandas(
        _count_links(shingle, threshold, batch_chars), "k1 bigint, k2 bigint, r1 bigint, r2 bigint, links bigint"), "links")
    release(members)
    release(blocks)
    if not threshold.parted():
        release(texts_of)

    node = lambda a, b: F.concat_ws(":", F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0"))
    joined = connected_components(counted.select(node("k1", "k2").alias("a"), node("r1", "r2").alias("b")), count)
    links = counted.groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    own = write_through(sets.withColumn("node", node("k1", "k2")).join(joined, "node", "left")
                        .join(links, ["k1", "k2"], "left")
                        .select("k1", "k2", "first", F.coalesce("root", "node").alias("root"),
                                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "components", count)
    release(counted)
    least = own.groupBy("root").agg(F.min("first").alias("component_id"))
    named = write_through(own.join(least, "root").select("k1", "k2", "root", "component_id", "n_links"), "components", count)
    release(own)
    empty = F.col("n") == 0
    return narrow.join(named, ["k1", "k2"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(empty, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), "row", F.col("root").alias("component"))


def _row_hash(id_col: str, text_col: str):
    return F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string"))


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with one of each component: the smallest id, then the smallest hash of id and text."""
    found = write_through(join_documents(docs, id_col=id_col, text_col=text_col, **options)
                          .select(F.col(f"`{id_col}`").alias("id"), "row", "component"), "found")
    linked = found.where("component IS NOT NULL").groupBy("component").agg(
        F.min_by("row", F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))).alias("row"))
    # written: a plain table on both sides of the joins below
    chosen = write_through(linked.select("row").unionByName(found.where("component IS NULL").select("row")).distinct(),
                           "chosen")
    # rows that go, or of which one goes; those the filter does not know stay where they are scanned
    touched = write_through(found.groupBy("row").agg(F.count(F.lit(1)).alias("rows")).join(
        chosen.withColumn("stays", F.lit(True)), "row", "left").where("rows > 1 OR stays IS NULL").select("row"), "touched")
    release(found)
    wrapped = docs.select(_row_hash(id_col, text_col).alias("row"), F.struct(*[F.col(f"`{c}`") for c in docs.columns])
                          .alias("columns"))
    marked = marked_by(wrapped, bloom_table(touched, "row"), "row", "maybe")
    # rows equal in id and text are one document here
    judged = marked.where("maybe").join(chosen, "row").dropDuplicates(["row"])
    return marked.where("NOT maybe").select("columns.*").unionByName(judged.select("columns.*"))
