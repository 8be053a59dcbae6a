"""Language identification by rank-order profiles.

A text is lower-cased, runs of non-letters become one blank, and its 1- to
3-grams inside words (a blank marks a word's end) are counted.  A language's
profile is the ``size`` most frequent n-grams of all its training documents;
a document is compared by the out-of-place distance: for each of its own most
frequent n-grams, how far its rank is from the profile's rank, or ``size`` if
the profile lacks it.  The language with the least sum wins, ties by name.

Profiles are learned from all training documents: n-gram counts are summed in
each batch, then by a map-side aggregate, and only the counts shuffle.  What
returns to the driver and is broadcast is ``size`` rows per language.

Edge cases: NULL texts and texts without a letter are ``und`` with score 0;
documents without a language are not learned from; without any learned language
every document is ``und``; equal counts rank in the order of the n-grams;
repeated rows are judged each; an empty table gives an empty result.  Other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans import small_batches
from ._rows import beside_text, identity
from ._words import batches_of

UNKNOWN = "und"
BITS = 21  # of a code point


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or a blank if it is no letter."""
    table = np.full(0x110000, 32, np.int64)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def ngrams(text: str) -> np.ndarray:
    """All 1- to 3-grams of the text as integers (three code points of 21 bits); empty without letters."""
    codes = _letters()[np.frombuffer((" " + text + " ").encode("utf-32-le"), dtype=np.uint32)]
    letter = codes != 32
    # of a run of blanks the one after a letter stays, and one at the start
    codes = codes[letter | np.concatenate([[True], letter[:-1]])]
    letter = codes != 32
    if not letter.any():
        return np.empty(0, np.int64)
    pairs = (codes[:-1] << BITS) | codes[1:]
    triples = (pairs[:-1] << BITS) | codes[2:]
    return np.concatenate([codes[letter], pairs[letter[:-1] | letter[1:]], triples[letter[1:-1]]])


def top_ngrams(text: str, size: int) -> np.ndarray:
    """The text's most frequent n-grams, most frequent first."""
    grams, counts = np.unique(ngrams(text), return_counts=True)
    return grams[np.argsort(-counts, kind="stable")[:size]]


def learn_profiles(training: DataFrame, lang_col: str, text_col: str, size: int,
                   batch_chars: int = 2_000_000) -> DataFrame:
    """``lang, gram, place``: the profile of each language, ``place`` from 0."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, "text", batch_chars):
            for lang, own in frame.groupby("lang", sort=False):
                grams, n = np.unique(np.concatenate([ngrams(t) for t in own["text"]]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": grams, "n": n})

    rows = training.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = (rows.where("lang IS NOT NULL AND text IS NOT NULL").mapInPandas(count, "lang string, gram bigint, n bigint")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    return counts.withColumn("place", place).where(F.col("place") <= size).select(
        "lang", "gram", (F.col("place") - 1).alias("place"))


class Profiles:
    """Ranks of the learned n-grams: one row per n-gram, one column per language."""

    def __init__(self, rows: list, size: int):
        self.size = size
        self.langs = sorted({r.lang for r in rows})
        column = {lang: i for i, lang in enumerate(self.langs)}
        self.grams = np.unique(np.array([r.gram for r in rows], dtype=np.int64))
        # the last row is of n-grams that no profile has
        self.place = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        for r in rows:
            self.place[np.searchsorted(self.grams, r.gram), column[r.lang]] = r.place

    def judge(self, text: str | None) -> tuple[str, float]:
        own = top_ngrams(text, self.size) if isinstance(text, str) and self.langs else ()
        if not len(own):
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, own)
        known = self.grams[np.minimum(at, len(self.grams) - 1)] == own
        place = self.place[np.where(known, at, len(self.grams))]
        off = np.where(place < 0, self.size, np.abs(place - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(off.argmin())
        return self.langs[best], 1.0 - float(off[best]) / (self.size * len(own))


def held_out(id_col: str) -> Column:
    """True for the fifth of the documents that is never learned from (an absent id is held out)."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def predict_languages(docs: DataFrame, size: int = 300, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang", keep: list[str] | None = None) -> DataFrame:
    """``id, held_out, lang_pred, score`` for every document, learned from those not held out.

    ``keep`` names columns of the documents to carry along as a struct ``kept`` instead of the id alone."""
    small_batches(docs.sparkSession)
    rows = learn_profiles(docs.where(~held_out(id_col)), lang_col, text_col, size).collect()
    profiles = docs.sparkSession.sparkContext.broadcast(Profiles(rows, size))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            judged = [profiles.value.judge(t) for t in frame["_text"]]
            out = frame.drop(columns="_text")
            out["lang_pred"], out["score"] = [j[0] for j in judged], [j[1] for j in judged]
            yield out

    return beside_text(docs, [identity(docs, id_col, keep), held_out(id_col).alias("held_out")], text_col, run,
                       "lang_pred string, score double")
