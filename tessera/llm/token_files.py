"""Token-id output: flat unsigned integer files plus 64-bit document offsets.

Documents are range-partitioned and sorted by id; each task encodes its
documents and writes two files of its partition into the shared folder:

``part-00000.tok``  the ids of its documents one after the other, little-endian,
                    two bytes each where the vocabulary allows it, else four;
``part-00000.idx``  magic, number of documents, their offsets into the .tok file
                    (uint64, one more than documents), ids (int64), NULL marks.

A file is written under a name of its own attempt and renamed when it is
complete, so a task that runs again after a lost executor replaces it as a
whole.  One manifest row per partition comes back; prefix sums over it give the
position of each partition in the whole sequence.  Readers map the files into
memory where the folder is a mounted one and read them through the file system
otherwise.

Ids of equal words are computed once and kept by the Python worker for its later
batches and tasks (a bounded number of words): the pre-tokenizer of byte-level
models never joins a character with a blank that follows it, so a text may be
cut before each run of white space.

Edge cases: NULL and empty texts have the end id only; NULL ids come first;
rows with equal ids follow each other in the order of a hash of their texts; an
empty table writes no files and reads back as no rows.  Other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import scratch_path
from ._words import WordCodes, batches_of, cut_documents, joined_ranges, text_bytes

MAGIC = b"TOKIDX01"
MANIFEST = "part int, folder string, width int, n_docs bigint, n_tokens bigint"
KNOWN_WORDS = 1_500_000
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def split_words(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts as bytes, cut before each run of white space into words that
    encode independently; start and end of each word, and the words of each text.

    A run that may begin with white space outside ASCII is not cut off."""
    data, starts = text_bytes(texts)
    padded = np.concatenate([np.zeros(3, np.uint8), data])
    last, second, third = padded[2:-1], padded[1:-2], padded[:-3]
    wide = (last >= 0x80) & ((second == 0xC2) | ((third >= 0xE1) & (third <= 0xE3)))
    return data, *cut_documents(_BLANK[data] & ~_BLANK[last] & ~wide, starts)


class TokenizerWords:
    """Ids of words by the tokenizers library.

    Words that begin with a blank and end in ASCII are joined into a few
    strings, since the pre-tokenizer parts them again; the lengths of the
    tokens in bytes tell which belong to which word."""

    def __init__(self, tokenizer_file: str, run: int = 200):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer, self._run = Tokenizer.from_file(tokenizer_file), run
        self.vocabulary = self._tokenizer.get_vocab_size()
        special = {i: len(t.content.encode()) for i, t in self._tokenizer.get_added_tokens_decoder().items()}
        # a character of a byte-level token stands for one byte
        self._bytes = np.array([special.get(i, len(self._tokenizer.id_to_token(i) or ""))
                                for i in range(self.vocabulary)], dtype=np.int64)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.int64)
                for e in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words as one flat array, and the number of ids of each word."""
        joined = np.array([_BLANK[w[0]] and w[-1] < 0x80 and not _BLANK[w[-1]] for w in words], dtype=bool)
        easy = [w for w, j in zip(words, joined, strict=True) if j]
        runs = [easy[i:i + self._run] for i in range(0, len(easy), self._run)]
        flat = np.concatenate([np.empty(0, np.int64), *self._ids([b"".join(r).decode() for r in runs])])
        ends = np.cumsum([len(w) for w in easy], dtype=np.int64)
        at = np.cumsum(self._bytes[flat])
        cuts = np.searchsorted(at, ends)
        if len(easy) and not np.array_equal(at[cuts], ends):
            raise ValueError("this tokenizer joins a word with the blank after it")
        others = self._ids([w.decode() for w, j in zip(words, joined, strict=True) if not j])
        counts = np.zeros(len(words), np.int64)
        counts[joined] = np.diff(cuts, prepend=-1)
        counts[~joined] = [len(x) for x in others]
        # the joined words' ids come first in ``flat``, then the others'
        starts = np.zeros(len(words), np.int64)
        starts[joined] = np.cumsum(counts[joined]) - counts[joined]
        starts[~joined] = len(flat) + np.cumsum(counts[~joined]) - counts[~joined]
        return np.concatenate([flat, *others])[joined_ranges(starts, counts)], counts


@lru_cache(maxsize=1)
def word_codes(tokenizer_file: str, end_id: int) -> tuple[WordCodes, int]:
    """The words known so far to this Python worker, which serves many tasks, and the bytes of an id.

    At most ``KNOWN_WORDS`` words are kept, some 40 bytes each."""
    words = TokenizerWords(tokenizer_file)
    width = 2 if max(words.vocabulary - 1, end_id) < 1 << 16 else 4
    return WordCodes(words.encode, np.dtype(f"<u{width}"), KNOWN_WORDS), width


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_token_files(docs: DataFrame, tokenizer_file: str, end_id: int, folder: str | None = None,
                      id_col: str = "doc_id", text_col: str = "text", batch_chars: int = 2_000_000) -> DataFrame:
    """Write the files; returns the manifest with ``first_doc`` and ``first_token`` of each partition."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "tokens")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        codes, width = word_codes(tokenizer_file, end_id)
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        counts, ids, missing = [], [], []
        own, final = f"{base}/.attempt-{attempt}", f"{base}/part-{part:05d}"
        stream = None
        for frame in batches_of(frames, "text", batch_chars):
            stream = stream or store.open_output_stream(f"{own}.tok")
            flat, n = codes.encode(*split_words(frame["text"]))
            ends = np.cumsum(n)
            stream.write(np.insert(flat, ends, end_id).astype(f"<u{width}").tobytes())
            counts.append(n + 1)
            missing.append(frame["id"].isna().to_numpy())
            ids.append(frame["id"].fillna(0).to_numpy(dtype=np.int64))
        if stream is None:
            return
        stream.close()
        counts = np.concatenate(counts)
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
        with store.open_output_stream(f"{own}.idx") as out:
            out.write(MAGIC + np.array([len(counts)], "<u8").tobytes() + offsets.tobytes())
            out.write(np.concatenate(ids).astype("<i8").tobytes() + np.concatenate(missing).astype("u1").tobytes())
        for kind in ("tok", "idx"):
            store.move(f"{own}.{kind}", f"{final}.{kind}")
        yield pd.DataFrame([[part, folder, width, len(counts), int(offsets[-1])]],
                           columns=["part", "folder", "width", "n_docs", "n_tokens"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ranged = rows.repartitionByRange(n, "id", "tie").sortWithinPartitions("id", "tie").drop("tie")
    # one row per partition
    written = sorted(ranged.mapInPandas(run, MANIFEST).collect(), key=lambda r: r.part)
    base, docs_before = 0, 0
    manifest = []
    for r in written:
        manifest.append((*r, docs_before, base))
        base, docs_before = base + r.n_tokens, docs_before + r.n_docs
    return spark.createDataFrame(manifest, f"{MANIFEST}, first_doc bigint, first_token bigint")


def _read(store, path: str):
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=np.uint8, mode="r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype=np.uint8)


def read_token_files(spark: SparkSession, manifest: DataFrame, batch_tokens: int = 1_000_000) -> DataFrame:
    """``doc_id, start, n_tokens, ids``: every document of the files, its first position in the whole
    sequence, and its ids as little-endian unsigned 32-bit integers."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for row in (r for frame in frames for r in frame.itertuples(index=False)):
            store, base = _open(row.folder)
            name = f"{base}/part-{row.part:05d}"
            index, tokens = _read(store, f"{name}.idx"), _read(store, f"{name}.tok")
            if bytes(index[:8]) != MAGIC:
                raise ValueError(f"{name}.idx is not an index of token files")
            n = int(index[8:16].view("<u8")[0])
            offsets = index[16:16 + 8 * (n + 1)].view("<u8").astype(np.int64)
            ids = index[16 + 8 * (n + 1):16 + 8 * (2 * n + 1)].view("<i8")
            missing = index[16 + 8 * (2 * n + 1):].astype(bool)
            tokens = tokens.view(f"<u{row.width}")
            part = offsets[:-1] // batch_tokens
            for lo, hi in zip(np.flatnonzero(np.diff(part, prepend=-1)),
                              np.append(np.flatnonzero(np.diff(part)) + 1, n), strict=True):
                yield pd.DataFrame({
                    "doc_id": pd.array(np.where(missing[lo:hi], 0, ids[lo:hi]), dtype="Int64").copy(),
                    "start": row.first_token + offsets[lo:hi],
                    "n_tokens": np.diff(offsets[lo:hi + 1]),
                    "ids": [tokens[a:b].astype("<u4").tobytes()
                            for a, b in zip(offsets[lo:hi], offsets[lo + 1:hi + 1], strict=True)],
                    "missing": missing[lo:hi]})

    out = manifest.mapInPandas(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary, missing boolean")
    return out.select(F.when(~F.col("missing"), F.col("doc_id")).alias("doc_id"), "start", "n_tokens", "ids")
