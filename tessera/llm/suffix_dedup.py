"""Removal of repeated byte strings by bounded interval expansion on a
Burrows-Wheeler transform.

A byte goes if a string of ``length`` bytes covers it that also starts in a
document with a smaller id; strings are judged on the input.  Each distinct
text is taken once, with its smallest id: in a copy with a larger id every byte
goes as soon as it is long enough.

Distribution.  The anchor of a string is the least hash of its 24-byte
substrings, so equal strings have equal anchors.  Texts are dealt into blocks
of bounded size.  Each block sends its anchors, cut to 32 bits within a bucket,
and gets back those that other texts have too.  Consecutive strings with such
an anchor form a segment; segments of one anchor meet in one task.  Of equal
segments in a block only those with the smallest id are sent, the others are
removed on the spot.  Segments of an anchor that more than ``hot_blocks`` blocks
share are cut further by anchors of 40 bytes, and into single strings if more
than the square of that number share it: what a third of all documents have in
common then meets as one row per block.

Transform.  In a task the distinct segments of some anchors are joined into
one string, each ended by a symbol that no segment holds; its positions are
sorted by what follows them, which gives the transform.  Breadth first, from the
rows where a whole string ends, each step extends all prefixes backwards by one
byte, or by two at once: rows whose last bytes are the same stay in one interval
of the longer prefix exactly if they were in one interval of the shorter, and
intervals of one row are dropped.  So the intervals of common prefixes come out
by increasing value; at ``length`` the expansion stops, and each interval is one
string with all the places where it occurs.
The least id of an interval removes the string everywhere else.

Edge cases: NULL texts are empty; texts shorter than ``length`` lose nothing;
rows with equal ids do not remove from each other; a row without id counts as
last, loses to all numbered rows and not to other such rows; an empty table
gives an empty result.  A removed span may cut a character: ``kept`` drops the
broken rest, the digests are of the bytes.  Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import small_batches, write_through
from ..plans.bloom import bloom_table, marked_by
from ._words import _SYMBOL, batches_of, joined_ranges, mix, range_hashes, text_bytes

# bytes whose hashes are anchors; the long ones cut segments of hot anchors further
GRAM, LONG_GRAM = 24, 40
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# strings looked at together: their 64-bit hashes stay in the processor's cache
STEP = 1 << 14
LAST = (1 << 63) - 1
TEXT = "block int, t1 bigint, t2 bigint, ord bigint, last bigint, text string"
# source: the block, and the text's place among the block's texts
SEGMENT = "key bigint, source bigint, ord bigint, start bigint, bytes binary"
# of copies of a text
_COPIES = {"ord": "min", "last": "max", "text": "first"}
SPAN = "block int, place int, start bigint, stop bigint"


def _grams(symbols: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` symbols, put together from runs of powers of two."""
    part, width, out, have = symbols, 1, None, 0
    while width <= size:
        if size & width:
            n = len(symbols) - have - width + 1
            out = part if out is None else out[:n] * _FACTOR + part[have:have + n]
            have += width
        if 2 * width <= size:
            part = part[:-width] * (_FACTOR ^ np.uint64(width << 1)) + part[width:]
        width *= 2
    return out


def _anchors(data: np.ndarray, length: int, gram: int) -> np.ndarray:
    """The anchor of the string of ``length`` bytes at each position: its least hash of ``gram`` bytes."""
    least, span, wanted = mix(_grams(_SYMBOL[data], gram)), 1, length - gram + 1
    while 2 * span <= wanted:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    return np.minimum(least[:len(least) - (wanted - span)], least[wanted - span:]) if span < wanted else least


def segments(data: np.ndarray, starts: np.ndarray, length: int, longest: int = 64):
    """Runs of consecutive strings with one anchor: document, first position, number of strings, anchor."""
    found = []
    for a in range(0, len(data), STEP):
        piece = data[a:a + STEP + length - 1]
        if len(piece) < length:
            break
        anchor = _anchors(piece, length, min(GRAM, length))
        n = len(anchor)
        low, high = np.searchsorted(starts, a, side="right") - 1, np.searchsorted(starts, a + n)
        begin = np.maximum(starts[low:high], a) - a
        stop = np.minimum(starts[low + 1:high + 1] - length, a + n) - a
        owner = low + np.flatnonzero(stop > begin)
        begin, stop = begin[owner - low], stop[owner - low]
        if not len(owner):
            continue
        head = np.ones(n + 1, bool)
        np.not_equal(anchor[1:], anchor[:-1], out=head[1:-1])
        head[begin] = head[stop] = True
        heads = np.flatnonzero(head)
        heads, count = heads[:-1], np.diff(heads)
        document = np.searchsorted(begin, heads, side="right") - 1
        inside = (document >= 0) & (heads < stop[document])
        heads, count, document = heads[inside], count[inside], document[inside]
        parts = -(-count // longest)
        run = np.repeat(np.arange(len(heads)), parts)
        passed = longest * (np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts))
        heads, count = heads[run] + passed, np.minimum(count[run] - passed, longest)
        found.append((owner[document[run]], a + heads, count, anchor[heads]))
    if not found:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def transform(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of what follows them, and the symbol before each (the transform)."""
    bits = 8 if text.dtype == np.uint8 else 9
    n, width = len(text), 64 // bits
    padded = np.concatenate([text, np.zeros(width, text.dtype)])
    value = np.zeros(n, np.uint64)
    for k in range(width):
        value = (value << np.uint64(bits)) | padded[k:k + n]
    order = np.argsort(value)
    ranked = value[order]
    first = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    rank = np.empty(n, np.int64)
    while True:
        # a rank is the first row of those that agree so far, so it stays when others are told apart
        rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        tied = np.flatnonzero(~(first & np.append(first[1:], True)))
        if not len(tied):  # parts are distinct, so no two positions agree for longer than two parts
            return order, text[order - 1]
        at = order[tied]
        later = np.where(at + width < n, rank[np.minimum(at + width, n - 1)] + 1, 0)
        value = (rank[at].astype(np.uint64) << np.uint64(32)) | later.astype(np.uint64)
        sorting = np.argsort(value)
        order[tied], ranked = at[sorting], value[sorting]
        first[tied] = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        width *= 2


def expand_intervals(before: np.ndarray, rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted ``rows`` of the transform followed ``length`` symbols back, and the interval of each.

    Rows of one interval have these symbols in common.  An interval of one row stays one, so it is dropped."""
    by_symbol = np.argsort(before, kind="stable")  # row j of the longer prefixes comes from row by_symbol[j]
    longer = np.empty(len(before), np.int32)
    longer[by_symbol] = np.arange(len(before), dtype=np.int32)
    interval, steps = np.zeros(len(rows), np.int32), [(before, longer)] * length
    if before.dtype == np.uint8:  # two steps in one: both symbols as one number, the one further back first
        two = (before[longer].astype(np.uint16) << np.uint16(8)) | before, longer[longer]
        steps = [two] * (length // 2) + steps[:length % 2]
    for symbols, following in steps:
        symbol = symbols[rows]
        # rows of an interval follow each other, so the stable order by symbol keeps them in order
        order = np.argsort(symbol, kind="stable")
        rows, interval, symbol = following[rows[order]], interval[order], symbol[order]
        head = np.ones(len(rows) + 1, bool)
        head[1:-1] = (interval[1:] != interval[:-1]) | (symbol[1:] != symbol[:-1])
        live = np.flatnonzero(~(head[:-1] & head[1:]))
        rows, interval = rows[live], np.cumsum(head[:-1], dtype=np.int32)[live]
    return rows, interval


def repeated_strings(parts: list[bytes], owners: np.ndarray, length: int) -> np.ndarray:
    """For every string of ``length`` bytes of each part, one part after the other, the least owner of a part that
    has it; ``owners`` holds one number per part."""
    sizes = _lengths(parts)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    text = np.frombuffer(b"\0".join(parts) + b"\0", dtype=np.uint8)
    # the symbol 0 ends a part and is in no string: where strings hold zero bytes, bytes are the symbols 1 to 256
    if np.count_nonzero(text == 0) > len(parts):
        text = text.astype(np.uint16) + np.uint16(1)
        text[ends] = 0
    order, before = transform(text)
    row = np.empty(len(text), np.int64)
    row[order] = np.arange(len(text))
    strings = sizes - length + 1
    at = joined_ranges(starts, strings)
    owner = np.full(len(text), LAST, np.int64)
    owner[at] = np.repeat(owners, strings)
    # only what a whole string begins with is followed, from the string's end
    rows, interval = expand_intervals(before, np.sort(row[at + length]), length)
    if len(rows):
        place = order[rows]
        heads = np.flatnonzero(np.diff(interval, prepend=-1))
        owner[place] = np.repeat(np.minimum.reduceat(owner[place], heads), np.diff(np.append(heads, len(place))))
    return owner[at]


def _spans(flags: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of flagged places within each of consecutive groups: group, first place in it, number of places."""
    group = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flags)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.flatnonzero(flags)
    head = np.ones(len(at), bool)
    head[1:] = (at[1:] != at[:-1] + 1) | (group[at[1:]] != group[at[:-1]])
    heads = np.flatnonzero(head)
    return group[at[heads]], place[at[heads]], np.diff(np.append(heads, len(at)))


def _judge(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """Removed spans of the segments of some anchors."""
    codes, parts = pd.factorize(frame["bytes"])
    ord_ = frame["ord"].to_numpy(dtype=np.int64)
    own = np.full(len(parts), LAST, np.int64)
    np.minimum.at(own, codes, ord_)
    least = repeated_strings(list(parts), own, length)
    strings = _lengths(parts) - length + 1
    mine = strings[codes]
    smallest = least[joined_ranges((np.cumsum(strings) - strings)[codes], mine)]
    row, first, count = _spans(smallest < np.repeat(ord_, mine), mine)
    source = frame["source"].to_numpy(dtype=np.int64)[row]
    start = frame["start"].to_numpy(dtype=np.int64)[row] + first
    return _span_rows(source, start, start + count - 1 + length)


def _span_rows(source, start, stop) -> pd.DataFrame:
    return pd.DataFrame({"block": source >> 32, "place": source & 0xFFFFFFFF, "start": start, "stop": stop})


class _Plan:
    """Steps of one run, as functions of pandas frames."""

    def __init__(self, length: int, bucket_bits: int, hot_blocks: int, batch_chars: int, task_bytes: int,
                 with_copies: bool):
        self.length, self.bits, self.hot, self.chars = length, bucket_bits, hot_blocks, batch_chars
        self.task_bytes, self.with_copies = task_bytes, with_copies

    def distinct(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each text of the task once; later copies send their id without the text."""
        seen: set[tuple[int, int]] = set()
        for frame in frames:
            least = frame.assign(last=frame["ord"]).groupby(["block", "t1", "t2"], sort=False, as_index=False).agg(_COPIES)
            names = list(zip(least["t1"].tolist(), least["t2"].tolist(), strict=True))
            least.loc[[n in seen for n in names], "text"] = None
            seen.update(names)
            yield least

    def _short(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = anchor >> np.uint64(32 - self.bits)
        return (cut >> np.uint64(32)).astype(np.int64), cut

    def send_anchors(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[tuple[int, int]] = set()
        once: dict[int, list[np.ndarray]] = {}
        for frame in frames:
            frame = frame[frame["text"].notna()]
            new = [n not in seen for n in zip(frame["t1"].tolist(), frame["t2"].tolist(), strict=True)]
            frame = frame[new]
            seen.update(zip(frame["t1"].tolist(), frame["t2"].tolist(), strict=True))
            for block, own in frame.groupby("block", sort=False):
                for piece in batches_of([own], "text", self.chars):
                    owner, _, _, anchor = segments(*text_bytes(piece["text"]), self.length)
                    short = self._short(anchor)[1]
                    order = np.argsort(short)
                    short, owner = short[order], owner[order]
                    new = np.diff(short, prepend=~short[:1]) != 0
                    # an anchor that several of these texts have is listed twice
                    again = short[1:][~new[1:] & (owner[1:] != owner[:-1])]
                    once.setdefault(int(block), []).append(np.concatenate([short[new], np.unique(again)]))
        for block, found in once.items():
            short, n = np.unique(np.concatenate(found), return_counts=True)
            bucket = (short >> np.uint64(32)).astype(np.int64)
            low = short.astype(np.uint32)
            at = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(at[1:], len(bucket))
            if len(at):
                yield pd.DataFrame({
                    "block": block, "bucket": bucket[at],
                    "anchors": [low[a:b].tobytes() for a, b in zip(at, ends, strict=True)],
                    "several": [low[a:b][n[a:b] > 1].tobytes() for a, b in zip(at, ends, strict=True)]})

    def shared_anchors(self, frame: pd.DataFrame) -> pd.DataFrame:
        """For each block the anchors of this bucket that several texts have, and those that very many blocks have."""
        sent = [np.frombuffer(x, dtype=np.uint32) for x in frame["anchors"]]
        anchors, blocks = np.unique(np.concatenate(sent), return_counts=True)
        several = np.unique(np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in frame["several"]]))
        shared = anchors[(blocks > 1) | np.isin(anchors, several, assume_unique=True)]
        hot, common = anchors[blocks > self.hot], anchors[blocks > self.hot * self.hot]
        pick = lambda own, of: own[np.isin(own, of, assume_unique=True)].tobytes()
        return pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"],
                             "shared": [pick(x, shared) for x in sent], "hot": [pick(x, hot) for x in sent],
                             "common": [pick(x, common) for x in sent]})

    def send_segments(self, texts: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in SEGMENT.split(", ")]
        if not len(texts) or not len(shared):
            return pd.DataFrame(columns=columns)
        whole = lambda c: np.sort(np.concatenate([
            (np.uint64(b) << np.uint64(32)) | np.frombuffer(x, dtype=np.uint32).astype(np.uint64)
            for b, x in zip(shared["bucket"].tolist(), shared[c], strict=True)]))
        known, hot, common = whole("shared"), whole("hot"), whole("common")
        texts = _one_each(texts)
        texts["source"] = (texts["block"].to_numpy(dtype=np.int64) << 32) + np.arange(len(texts))
        out = []
        for piece in batches_of([texts], "text", self.chars):
            data, starts = text_bytes(piece["text"])
            owner, at, count, anchor = segments(data, starts, self.length)
            short = self._short(anchor)[1]
            kept = _among(short, known)
            owner, at, count, anchor, short = owner[kept], at[kept], count[kept], anchor[kept], short[kept]
            key = anchor
            for level, many in ((0, hot), (1, common)):
                marked = _among(short, many)
                if marked.any():
                    owner, at, count, key, short = self._cut_hot(data, (owner, at, count, key, short), marked, level)
            raw = data.tobytes()
            stop = at + count + self.length - 1
            out.append(pd.DataFrame({
                "key": key.view(np.int64), "source": piece["source"].to_numpy()[owner],
                "ord": piece["ord"].to_numpy()[owner], "start": at - starts[owner],
                "bytes": [raw[a:b] for a, b in zip(at.tolist(), stop.tolist(), strict=True)]}))
        rows = pd.concat(out, ignore_index=True)
        least = rows["ord"].to_numpy(copy=True)
        several = np.flatnonzero(rows["key"].duplicated(keep=False))  # the others have no equal one here
        least[several] = rows.iloc[several].groupby(["key", "bytes"], sort=False)["ord"].transform("min").to_numpy()
        gone = rows["ord"].to_numpy() > least
        # removed here: of these only their spans are sent, with the end in place of the id
        done = rows[gone]
        start = done["start"].to_numpy(dtype=np.int64)
        source, start, stop = _merged(done["source"].to_numpy(dtype=np.int64), start, start + _lengths(done["bytes"]))
        spans = pd.DataFrame({"key": mix(source.view(np.uint64)).view(np.int64), "source": source, "ord": stop,
                              "start": start, "bytes": None})
        return pd.concat([rows[~gone][columns], spans[columns]], ignore_index=True)

    def _cut_hot(self, data: np.ndarray, rows: tuple, many: np.ndarray, level: int) -> tuple:
        """The segments marked in ``many`` cut by anchors of longer grams (level 0) or into single strings (1)."""
        owner, at, count, key, short = (column[many] for column in rows)
        place = joined_ranges(at, count)
        run = np.repeat(np.arange(len(at)), count)
        if level == 0:
            long = [_anchors(data[a:a + STEP + self.length - 1], self.length, min(LONG_GRAM, self.length))
                    for a in range(0, len(data) - self.length + 1, STEP)]
            finer = np.concatenate(long)[place]
        else:
            finer = range_hashes(data, place, place + self.length)
        finer = mix(finer ^ key[run])
        head = np.ones(len(place), bool)
        head[1:] = (run[1:] != run[:-1]) | (finer[1:] != finer[:-1])
        heads = np.flatnonzero(head)
        source = run[heads]
        cut = (owner[source], place[heads], np.diff(np.append(heads, len(place))), finer[heads], short[source])
        return tuple(np.concatenate([old[~many], new]) for old, new in zip(rows, cut, strict=True))

    def judge(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, size = [], 0
        for frame in frames:
            done = frame["bytes"].isna()
            ready = frame[done]
            yield _span_rows(ready["source"].to_numpy(dtype=np.int64), ready["start"].to_numpy(), ready["ord"].to_numpy())
            frame = frame[~done]
            while len(frame):
                ends = np.cumsum(_lengths(frame["bytes"])) + size
                key = frame["key"].to_numpy()
                last = np.append(key[1:] != key[:-1], False)  # the frame's last key may go on in the next
                stop = np.flatnonzero(last & (ends >= self.task_bytes))
                if not len(stop):
                    waiting.append(frame)
                    size = int(ends[-1])
                    break
                waiting.append(frame.iloc[:stop[0] + 1])
                yield _judge(pd.concat(waiting, ignore_index=True), self.length)
                frame, waiting, size = frame.iloc[stop[0] + 1:], [], 0
        if waiting:
            yield _judge(pd.concat(waiting, ignore_index=True), self.length)

    def cut(self, texts: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
        """What goes of each text of a block that loses any, or has copies, if these are asked for: ``cuts`` holds
        where removed runs begin and end."""
        place, start, stop = _merged(*(spans[c].to_numpy(dtype=np.int64) for c in ("place", "start", "stop")))
        once = _one_each(texts)
        first, end = (np.searchsorted(place, np.arange(len(once)), side=side) for side in ("left", "right"))
        loses = end > first
        listed = np.flatnonzero(loses | (once["last"] > once["ord"]).to_numpy()) if self.with_copies else np.flatnonzero(loses)
        out = []
        for row, a, b in zip(once.iloc[listed].itertuples(), first[listed].tolist(), end[listed].tolist(), strict=True):
            data, cuts = row.text.encode(), np.column_stack([start[a:b], stop[a:b]]).ravel()
            bounds = [0, *cuts.tolist(), None]
            kept = b"".join([data[x:y] for x, y in zip(bounds[::2], bounds[1::2], strict=True)])
            out.append((row.t1, row.t2, row.ord, len(data) - len(kept), b - a, hashlib.sha256(kept).hexdigest(),
                        cuts if self.with_copies and a < b else None))
        return pd.DataFrame(out, columns=["t1", "t2", "first", "n_removed", "n_spans", "kept_sha256", "cuts"])


def _lengths(parts) -> np.ndarray:
    return np.fromiter(map(len, parts), np.int64, len(parts))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is one of the sorted ``known`` ones."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _merged(source: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The spans of each source in order; those that overlap or touch are one."""
    order = np.lexsort((start, source))
    source, start, stop = source[order], start[order], stop[order]
    if not len(source):
        return source, start, stop
    # ends grow from source to source, so that the greatest end so far is one of the same source
    base = np.cumsum(np.append(False, source[1:] != source[:-1])) * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(base + stop)
    heads = np.flatnonzero(np.append(True, base[1:] + start[1:] > reach[:-1]))
    return source[heads], start[heads], np.maximum.reduceat(stop, heads)


def _one_each(texts: pd.DataFrame) -> pd.DataFrame:
    """One row per text of a block, with its smallest id, in an order that depends on the texts only."""
    return texts.groupby(["block", "t1", "t2"], sort=True, as_index=False).agg(_COPIES)


def left_of(text: str, cuts: list[int]) -> str:
    """The text without the bytes between each two of ``cuts``; the broken rest of a character goes too."""
    data, bounds = text.encode(), [0, *cuts, None]
    return b"".join(data[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)).decode("utf-8", "ignore")


def _left(text: Column, cuts: Column) -> Column:
    def left(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        return pd.Series([t if c is None else left_of(t, c) for t, c in zip(texts, cuts, strict=True)], dtype=object)

    return F.pandas_udf(left, "string")(text, cuts)


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   keep: list[str] | None = None, block_bytes: int = 8 << 20, hot_blocks: int = 256,
                   batch_chars: int = 1_000_000, task_bytes: int = 1 << 18) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    With ``keep`` those columns come along as a struct ``kept_columns`` instead of the id, and ``kept`` holds the
    remaining text."""
    spark = docs.sparkSession
    small_batches(spark)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    marks = [F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(LAST)).alias("ord"), F.xxhash64(text).alias("t1"),
             F.xxhash64(F.lit("second"), text).alias("t2"), F.octet_length(text).cast("bigint").alias("n_bytes")]
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(partitions, -(-total // block_bytes))
    bits = max(4, min(31, (blocks - 1).bit_length()))  # a short anchor has 32 bits more
    plan = _Plan(length, bits, hot_blocks, batch_chars, task_bytes, keep is not None)

    long = docs.select(*marks, text.alias("text")).where(F.col("n_bytes") >= length)
    texts = (long.select(F.pmod("t2", F.lit(blocks)).cast("int").alias("block"), "t1", "t2", "ord", "text")
             .mapInPandas(plan.distinct, TEXT).repartition(blocks, "block"))
    anchors = texts.mapInPandas(plan.send_anchors, "block int, bucket bigint, anchors binary, several binary")
    shared = anchors.groupBy("bucket").applyInPandas(lambda frame: plan.shared_anchors(frame),
                                                     "block int, bucket bigint, shared binary, hot binary, common binary")
    sent = texts.groupBy("block").cogroup(shared.groupBy("block")).applyInPandas(
        lambda left, right: plan.send_segments(left, right), SEGMENT)
    spans = sent.repartition(blocks, "key").sortWithinPartitions("key").mapInPandas(plan.judge, SPAN)
    cut = write_through(texts.groupBy("block").cogroup(spans.groupBy("block")).applyInPandas(
        lambda left, right: plan.cut(left, right),
        "t1 bigint, t2 bigint, first bigint, n_removed bigint, n_spans bigint, kept_sha256 string, cuts array<bigint>"),
        "cut")

    whole = F.col("n_bytes") >= length
    copy = whole & (F.col("ord") > F.col("first"))
    if keep is None:
        own = [F.col(f"`{id_col}`").alias("id"), F.sha2(text.cast("binary"), 256).alias("own_sha256")]
        # every copy of a cut or copied text needs the text's first id
        first = F.min("ord").alias("first")
        rows = write_through(docs.select(*own, *marks), "rows")
        firsts = rows.where(whole).groupBy("t1", "t2").agg(first)
        found = write_through(firsts.join(cut.drop("first"), ["t1", "t2"], "left"), "texts")
        joined = rows.join(found, ["t1", "t2"], "left")  # two plain tables: AQE can split a text of many copies
        return joined.select(
            F.col("id").alias(id_col), "n_bytes",
            F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(copy, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
            F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).otherwise(
                F.coalesce("kept_sha256", "own_sha256")).alias("kept_sha256"))
    # texts that lose nothing stay where they are scanned; of the others only where they are cut was written
    columns = [F.col(f"`{c}`").cast("string").alias(c) if c == text_col else F.col(f"`{c}`") for c in keep]
    rows = docs.select(F.struct(*columns).alias("columns"), *marks)
    marked = marked_by(rows, bloom_table(cut, "t1"), "t1", "maybe")
    joined = marked.where("maybe").join(cut, ["t1", "t2"], "left")
    own = F.col("columns")[text_col]
    kept = F.when(copy, F.lit("")).when(F.col("cuts").isNull(), own).otherwise(_left(own, F.col("cuts")))
    columns = F.struct(*[kept.alias(c) if c == text_col else F.col("columns")[c].alias(c) for c in keep])
    return joined.select(
        columns.alias("kept_columns"), "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed")).unionByName(
        marked.where("NOT maybe").select(F.col("columns").alias("kept_columns"), "n_bytes",
                                         F.lit(0).cast("bigint").alias("n_removed")))
