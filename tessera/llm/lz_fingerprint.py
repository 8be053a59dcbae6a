"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed left to right into phrases: each is the shortest string from
the current place on that is not in the dictionary yet, and joins it.  Texts
that share much content share many phrases, much as one helps to compress the
other.  The fingerprint is the minimum-hash signature of the phrase set: for
each of ``PARTS`` hash functions the least hash, cut to one byte.  The likeness
of two fingerprints is their share of equal parts, an estimate of the Jaccard
similarity of the phrase sets (unrelated parts agree by chance once in 256).

``compare_with_edits`` sets each document against the next one by descending id
and against its own edit, in which the second half is replaced by the start of
that next document.  Documents are range-partitioned and sorted once; a task
walks its rows in order, and only the last document of each partition waits for
the first of the next one, a join of one row per partition.

Edge cases: NULL texts are empty; an empty text has the all-zero fingerprint,
which is like itself alone; NULL ids come last; rows with equal ids follow in
the order of a hash of their texts; a single document is its own next; an empty
table gives an empty result.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans import write_through
from ._words import batches_of, mix, range_hashes

PARTS = 128
_FACTORS = (mix(np.arange(1, PARTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(
    np.uint32) | np.uint32(1)


def parse(text: str, ends: list[int], start: int = 0) -> list[int]:
    """The ends of the text's phrases; ``ends`` holds those up to ``start`` already."""
    known = {text[a:b] for a, b in zip([0, *ends], ends)}  # noqa: B905 - one start more than ends
    for end in range(start + 1, len(text) + 1):
        if (phrase := text[start:end]) not in known:
            known.add(phrase)
            ends.append(end)
            start = end
    if start < len(text):
        ends.append(len(text))  # what is left is a phrase of the dictionary
    return ends


def signatures(texts: list[str], ends: list[list[int]], step: int = 512) -> np.ndarray:
    """One row of ``PARTS`` bytes for each text, given the ends of its phrases."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    base = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    counts = np.array([len(e) for e in ends], dtype=np.int64)
    stop = np.fromiter((x for e in ends for x in e), dtype=np.int64, count=int(counts.sum())) + np.repeat(base[:-1], counts)
    begin = np.concatenate([[0], stop[:-1]]).astype(np.int64)[:len(stop)]
    hashes = range_hashes(mix(codes.astype(np.uint64) + np.uint64(1)), begin, stop)
    hashes = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full((len(texts), PARTS), np.iinfo(np.uint32).max, np.uint32)
    room = np.empty((PARTS, step), np.uint32)  # stays in the processor's cache
    first = np.concatenate([[0], np.cumsum(counts)]).tolist()
    for own, lo, hi in zip(least, first, first[1:]):  # noqa: B905 - one start more than texts
        for at in range(lo, hi, step):
            some = hashes[at:min(at + step, hi)]
            products = np.multiply(_FACTORS[:, None], some, out=room[:, :len(some)])
            np.minimum(own, products.min(axis=1), out=own)
    out = (mix(least.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8)
    out[counts == 0] = 0
    return out


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return (one == other).mean(axis=1)


def edited(text: str, following: str) -> tuple[str, int]:
    """The text with its second half replaced from the following one, and how much of it stays."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half], len(text) - half


class _Walk:
    """Compares each text of a sequence with its successor."""

    def __init__(self):
        self.ids, self.texts, self.ends = [], [], []
        self.signs = np.empty((0, PARTS), np.uint8)

    def step(self, ids: list, texts: list[str]) -> pd.DataFrame:
        ends = [parse(t, []) for t in texts]
        self.ids, self.texts, self.ends = self.ids + ids, self.texts + texts, self.ends + ends
        self.signs = np.concatenate([self.signs, signatures(texts, ends)])
        edits, phrases = [], []
        for text, own, following in zip(self.texts, self.ends, self.texts[1:]):  # noqa: B905 - pairs
            edit, same = edited(text, following)
            # the phrases that end in the part that stays are those of the text itself
            shared = own[:np.searchsorted(own, same, side="right")] if own else []
            if shared and len(shared) == len(own):
                shared = shared[:-1]
            edits.append(edit)
            phrases.append(parse(edit, list(shared), shared[-1] if shared else 0))
        signs = signatures(edits, phrases)
        out = pd.DataFrame({
            "id": pd.array(self.ids[:-1], dtype=object), "text": None, "n_chars": [len(t) for t in self.texts[:-1]],
            "edited": edits, "fingerprint": [s.tobytes() for s in self.signs[:-1]],
            "edited_fingerprint": [s.tobytes() for s in signs],
            "near_edited": likeness(self.signs[:-1], signs), "near_next": likeness(self.signs[:-1], self.signs[1:])})
        self.ids, self.texts, self.ends, self.signs = self.ids[-1:], self.texts[-1:], self.ends[-1:], self.signs[-1:]
        return out


def _digest(out: pd.DataFrame) -> pd.DataFrame:
    import hashlib

    out["edited_sha256"] = [hashlib.sha256(t.encode()).digest() for t in out.pop("edited")]
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 batch_chars: int = 500_000) -> DataFrame:
    """``id, fingerprint`` (hex) of every document, without a shuffle."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, "text", batch_chars):
            texts = frame["text"].tolist()
            signs = signatures(texts, [parse(t, []) for t in texts])
            yield pd.DataFrame({"id": frame["id"], "fingerprint": [s.tobytes().hex() for s in signs]})

    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return plain.mapInPandas(run, f"id {kind}, fingerprint string").withColumnRenamed("id", id_col)


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       batch_chars: int = 500_000) -> DataFrame:
    """``id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every document."""
    kind = docs.schema[id_col].dataType.simpleString()
    result = (f"id {kind}, text string, n_chars bigint, fingerprint binary, edited_fingerprint binary, "
              "near_edited double, near_next double, edited_sha256 binary")
    names = [c.split()[0] for c in result.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, walk = TaskContext.get().partitionId(), _Walk()
        for frame in batches_of(frames, "text", batch_chars):
            ids = [None if pd.isna(i) else i for i in frame["id"].tolist()]
            if not walk.texts:
                yield _marked(pd.DataFrame({"id": [None], "text": frame["text"].iloc[:1]}), part, "head")
            yield _marked(_digest(walk.step(ids, frame["text"].tolist())), part, "pair")
        if walk.texts:
            yield _marked(pd.DataFrame({"id": pd.array(walk.ids, dtype=object), "text": walk.texts}), part, "tail")

    def _marked(out: pd.DataFrame, part: int, role: str) -> pd.DataFrame:
        out["part"], out["role"] = part, role
        return out.reindex(columns=[*names, "part", "role"])

    def run_pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, "following", batch_chars):
            for row in frame.itertuples(index=False):
                walk = _Walk()
                yield _digest(walk.step([None if pd.isna(row.id) else row.id, None],
                                        [row.text, row.following])).reindex(columns=names)

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    order = [F.col("id").desc_nulls_last(), F.xxhash64("text")]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    walked = write_through(rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
                           .mapInPandas(run, f"{result}, part int, role string"), "fingerprints")
    # one row per partition from here on, until the union
    heads = walked.where("role = 'head'").select("part", F.col("text").alias("following"))
    parts = heads.select("part")
    after = parts.select("part", F.lead("part").over(Window.orderBy("part")).alias("after"))
    after = after.select("part", F.coalesce("after", parts.select(F.min("part")).scalar()).alias("after"))
    tails = walked.where("role = 'tail'").select("part", "id", "text").join(after, "part")
    last = tails.join(heads.withColumnRenamed("part", "after"), "after").select("id", "text", "following")
    both = walked.where("role = 'pair'").select(*names).unionByName(last.mapInPandas(run_pairs, result))
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return both.select(F.col("id").alias(id_col), "n_chars", text("edited_sha256"), text("fingerprint"),
                       text("edited_fingerprint"), "near_edited", "near_next")
