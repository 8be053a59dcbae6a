"""Alignment of the tokens of two tokenizers, by a monoid of fragments.

Tokenizer A is a byte-level one, B a sentencepiece model.  Both cut the same
bytes, a blank and the text; where a token of A and one of B end together, a
group ends.  A fragment is what a range of bytes knows of this: the tokens up to
the first common end (open prefix, whose beginning lies further left), the
groups closed after it, and the tokens after the last common end (open suffix).
``join`` composes the fragments of two adjoining ranges: the suffix of one and
the prefix of the other make one group, or stay open.  It is associative, so
fragments may be composed in any tree.

Texts of up to ``chunk_bytes`` are one range each and are done where they are
scanned, a batch at a time in flat arrays.  Longer texts are cut into ranges of
that many bytes, at any byte; a range takes along the bytes around it up to the
next place where both tokenizers cut anyway (a single blank between ASCII
letters), so its tokens are those of the whole text, and it keeps those that end
inside it.  The ranges are dealt to all tasks, and the fragments of a text are
composed in groups of ``fan_in``, round after round, until one is left.  A range
is longer where the text has no such place.

A link is an A and a B token that end together.  The links of each text are
written as numbers, counted over all texts, and looked up again: by a broadcast
of the counted pairs if these are at most ``broadcast_pairs``, else by a join.

Edge cases: NULL and empty texts, and texts that one of the tokenizers does not
give back byte by byte (B turns U+2581 into a blank), have no tokens and an
empty digest; NULL ids and repeated rows are kept; an empty table gives an empty
result; a text's group string has to fit one row.  Other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import release, small_batches, write_through
from ._words import batches_of, joined_ranges

MARK = "▁"
# of texts that are aligned at once: the flat arrays of a batch take some hundred times its characters
BATCH_CHARS = 250_000
DIGEST = "id bigint, missing boolean, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links binary"
FRAGMENT = ("row bigint, id bigint, missing boolean, part bigint, sound boolean, open boolean, n_a bigint, n_b bigint, "
            "a_prefix binary, b_prefix binary, groups binary, links binary, a_suffix binary, b_suffix binary")


def _flat(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' bytes one after the other, and start and length of each."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    return np.frombuffer(b"".join(words), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths


class TokenizerPair:
    """Ids of texts by both tokenizers, and tables over the ids."""

    def __init__(self, ranks_file: str, pattern: str, piece_file: str):
        import sentencepiece
        import tiktoken

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
        # without special tokens their strings are plain text
        self._a = tiktoken.Encoding("pair", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            a_bytes[rank] = token
        b_bytes = []
        for i in range(self._b.get_piece_size()):
            piece = self._b.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace(MARK, " ").encode())
            if MARK in piece.lstrip(MARK) and not self._b.is_unused(i):
                raise ValueError("a piece of this model holds a space mark after another character")
        self.a, self.b = _flat(a_bytes), _flat(b_bytes)
        if max(len(a_bytes), len(b_bytes)) > 1 << 16:
            raise ValueError("a link holds two ids of 16 bits")
        # decimal ids with each of the three separators
        self.written = _flat([b"%d%c" % (i, c) for i in range(max(len(a_bytes), len(b_bytes))) for c in b",|;"])

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of blank + text by A, and of the text by B: flat, with the number of each text."""
        a = [np.array(self._a.encode_ordinary(" " + t), dtype=np.int64) for t in texts]
        b = [np.array(x, dtype=np.int64) for x in self._b.encode(texts, num_threads=1)] if texts else []
        none = np.empty(0, np.int64)
        count = lambda parts: np.array([len(p) for p in parts], dtype=np.int64)
        return np.concatenate([none, *a]), count(a), np.concatenate([none, *b]), count(b)


@lru_cache(maxsize=2)
def load_pair(ranks_file: str, pattern: str, piece_file: str) -> TokenizerPair:
    return TokenizerPair(ranks_file, pattern, piece_file)


def _ends(table, ids: np.ndarray, counts: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the tokens end within their text, and whether each text's tokens are its bytes."""
    content, start, length = table
    sizes = length[ids]
    text = np.repeat(np.arange(len(counts)), counts)
    total = np.concatenate([[0], np.cumsum(sizes)])
    first = np.concatenate([[0], np.cumsum(counts)])
    ends = total[1:] - total[first[:-1]][text]
    same = np.diff(total[first]) == np.diff(bounds)
    kept = same[text]
    made = content[joined_ranges(start[ids[kept]], sizes[kept])]
    there = data[joined_ranges(bounds[:-1][same], np.diff(bounds)[same])]
    wrong = np.flatnonzero(made != there)
    if len(wrong):
        limits = np.cumsum(np.diff(bounds)[same])
        same[np.flatnonzero(same)[np.unique(np.searchsorted(limits, wrong, side="right"))]] = False
    return ends, same


class Aligned:
    """Tokens and groups of a batch of byte ranges.

    Of each text (whose blank stands before it) the tokens that end in ``begin < end <= stop`` are kept."""

    def __init__(self, pair: TokenizerPair, texts: list[str], begin: np.ndarray | None = None,
                 stop: np.ndarray | None = None):
        raw = [b" " + t.encode() for t in texts]
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)]).astype(np.int64)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        begin = np.zeros(len(texts), np.int64) if begin is None else begin
        stop = np.diff(bounds) if stop is None else stop
        ids_a, count_a, ids_b, count_b = pair.ids(texts)
        ends_a, sound_a = _ends(pair.a, ids_a, count_a, data, bounds)
        ends_b, sound_b = _ends(pair.b, ids_b, count_b, data, bounds)
        self.sound = sound_a & sound_b

        def kept(ids, ends, counts):
            text = np.repeat(np.arange(len(texts)), counts)
            chosen = self.sound[text] & (ends > begin[text]) & (ends <= stop[text])
            text = text[chosen]
            return ids[chosen], ends[chosen] + bounds[text], text

        self.a, at_a, text_a = kept(ids_a, ends_a, count_a)
        self.b, at_b, text_b = kept(ids_b, ends_b, count_b)
        # groups end at common ends and, open, at the end of a range with tokens after its last common end
        place = np.searchsorted(at_b, at_a)
        place[place == len(at_b)] = 0
        common = at_a[at_b[place] == at_a] if len(at_b) else at_a[:0]
        tails = (bounds[:-1] + stop)[self.sound]
        limits = np.union1d(common, tails)
        self.group_a, self.group_b = np.searchsorted(limits, at_a), np.searchsorted(limits, at_b)
        closed = np.isin(limits, common, assume_unique=True)
        # a range's last limit with no token of its own is no group
        n = len(limits)
        self.count_a, self.count_b = np.bincount(self.group_a, minlength=n), np.bincount(self.group_b, minlength=n)
        self.closed = closed
        self.filled = (self.count_a + self.count_b) > 0
        self.text = np.searchsorted(bounds[:-1] + begin, limits) - 1  # of each group
        self.first_a = np.concatenate([[0], np.cumsum(self.count_a)])
        self.first_b = np.concatenate([[0], np.cumsum(self.count_b)])
        self._write(pair)
        last_a, last_b = self.first_a[1:][closed] - 1, self.first_b[1:][closed] - 1
        self.links = (self.a[last_a] << 16 | self.b[last_b]).astype("<u4")
        self.link_of = np.concatenate([[0], np.cumsum(closed)])
        self.tokens_a = np.bincount(text_a, minlength=len(texts))
        self.tokens_b = np.bincount(text_b, minlength=len(texts))

    def _write(self, pair: TokenizerPair) -> None:
        """``a1,a2|b1;`` of all groups one after the other, and where each group's begins."""
        n = len(self.a) + len(self.b)
        order, sep = np.empty(n, np.int64), np.zeros(n, np.int64)
        at_a = np.arange(len(self.a)) + self.first_b[self.group_a]
        at_b = np.arange(len(self.b)) + self.first_a[self.group_b + 1]
        order[at_a], order[at_b] = self.a, self.b
        sep[at_a[self.first_a[1:][self.count_a > 0] - 1]] = 1
        sep[at_b[self.first_b[1:][self.count_b > 0] - 1]] = 2
        content, start, length = pair.written
        entry = 3 * order + sep
        self.string = content[joined_ranges(start[entry], length[entry])].tobytes()
        total = np.concatenate([[0], np.cumsum(length[entry])])
        self.string_at = total[self.first_a + self.first_b]

    def groups_of(self) -> np.ndarray:
        """The first group of each text (one more entry than texts)."""
        return np.searchsorted(self.text, np.arange(len(self.sound) + 1))

    def digests(self) -> pd.DataFrame:
        """One row for each whole text."""
        first, rows = self.groups_of(), []
        for i, sound in enumerate(self.sound.tolist()):
            lo, hi = first[i], first[i + 1]
            if not sound or lo == hi:
                rows.append((0, 0, 0, "", b""))
                continue
            string = self.string[self.string_at[lo]:self.string_at[hi] - 1]
            rows.append((self.tokens_a[i], self.tokens_b[i], hi - lo, hashlib.sha256(string).hexdigest(),
                         self.links[self.link_of[lo]:self.link_of[hi]].tobytes()))
        return pd.DataFrame(rows, columns=["n_a", "n_b", "n_groups", "groups_sha256", "links"])

    def fragments(self) -> list[dict]:
        """One fragment for each range."""
        first, out = self.groups_of(), []
        for i, sound in enumerate(self.sound.tolist()):
            lo, hi = first[i], first[i + 1]
            part = lambda g, h: {"a": self.a[self.first_a[g]:self.first_a[h]].astype("<u4").tobytes(),  # noqa: B023, E731
                                 "b": self.b[self.first_b[g]:self.first_b[h]].astype("<u4").tobytes()}
            # only the last group may be open
            shut = hi - lo - (1 if hi > lo and not self.closed[hi - 1] else 0)
            prefix, suffix = part(lo, lo + 1 if hi > lo else lo), part(lo + shut, hi) if shut else part(hi, hi)
            out.append({"sound": sound, "open": shut == 0, "n_a": int(self.tokens_a[i]), "n_b": int(self.tokens_b[i]),
                        "a_prefix": prefix["a"], "b_prefix": prefix["b"],
                        "groups": self.string[self.string_at[lo + 1]:self.string_at[lo + shut]] if shut > 1 else b"",
                        "links": self.links[self.link_of[lo + 1]:self.link_of[lo + shut]].tobytes() if shut > 1 else b"",
                        "a_suffix": suffix["a"], "b_suffix": suffix["b"]})
        return out


def digests_of(pair: TokenizerPair, frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``id, missing`` and the digests of whole texts, a bounded batch at a time."""
    for frame in batches_of(frames, "text", BATCH_CHARS):
        own = frame[["id", "missing"]].reset_index(drop=True)
        # a missing text is an empty one, whose blank B does not give back
        texts = [t if isinstance(t, str) else "" for t in frame["text"]]
        yield pd.concat([own, Aligned(pair, texts).digests()], axis=1)


EMPTY = {"sound": True, "open": True, "n_a": 0, "n_b": 0, "a_prefix": b"", "b_prefix": b"", "groups": b"", "links": b"",
         "a_suffix": b"", "b_suffix": b""}


def group_string(a: bytes, b: bytes) -> tuple[bytes, bytes]:
    """The string of a closed group, and its link."""
    a, b = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
    string = ",".join(map(str, a.tolist())) + "|" + ",".join(map(str, b.tolist())) + ";"
    return string.encode(), np.array([a[-1] << 16 | b[-1]], "<u4").tobytes()


def join(fragments: Iterable[dict]) -> dict:
    """The fragments of adjoining ranges, from left to right, as one fragment (associative; EMPTY is neutral)."""
    whole, groups, links = dict(EMPTY), [], []
    for f in fragments:
        whole["sound"] = whole["sound"] and f["sound"]
        whole["n_a"] += f["n_a"]
        whole["n_b"] += f["n_b"]
        if f["open"]:
            side = "prefix" if whole["open"] else "suffix"
            whole[f"a_{side}"] += f["a_prefix"]
            whole[f"b_{side}"] += f["b_prefix"]
            continue
        if whole["open"]:
            whole["open"] = False
            whole["a_prefix"] += f["a_prefix"]
            whole["b_prefix"] += f["b_prefix"]
        else:
            string, link = group_string(whole["a_suffix"] + f["a_prefix"], whole["b_suffix"] + f["b_prefix"])
            groups.append(string)
            links.append(link)
        groups.append(f["groups"])
        links.append(f["links"])
        whole["a_suffix"], whole["b_suffix"] = f["a_suffix"], f["b_suffix"]
    return whole | {"groups": b"".join(groups), "links": b"".join(links)}


def finish(fragment: dict) -> dict:
    """The digest of a whole text, whose prefix is its first group."""
    if not fragment["sound"] or fragment["open"] or fragment["a_suffix"] or fragment["b_suffix"]:
        return {"n_a": 0, "n_b": 0, "n_groups": 0, "groups_sha256": "", "links": b""}
    string, link = group_string(fragment["a_prefix"], fragment["b_prefix"])
    links = link + fragment["links"]
    return {"n_a": fragment["n_a"], "n_b": fragment["n_b"], "n_groups": len(links) // 4, "links": links,
            "groups_sha256": hashlib.sha256((string + fragment["groups"])[:-1]).hexdigest()}


def _class_table(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo:hi] = True
    return table


_LETTER = _class_table((65, 91), (97, 123))


def byte_ranges(data: np.ndarray, size: int) -> list[tuple[int, int, int, int]]:
    """Ranges of about ``size`` bytes of a blank and a text, as ``begin, stop, from, to``: the bytes
    ``from .. to`` around ``begin .. stop`` begin and end where both tokenizers cut anyway."""
    n = len(data)
    inner = np.flatnonzero((data[1:-1] == 32) & _LETTER[data[:-2]] & _LETTER[data[2:]]) + 1
    cuts = np.concatenate([[0], inner, [n]])
    at = np.arange(size, n, size)
    after = np.searchsorted(cuts, at)
    before = cuts[np.searchsorted(cuts, at, side="right") - 1]
    # where the next cuts are far apart there is no boundary, so a piece is not coded again and again
    at = at[cuts[after] - before <= size]
    edges = np.concatenate([[0], at, [n]])
    begin, stop = edges[:-1], edges[1:]
    lo = cuts[np.searchsorted(cuts, begin, side="right") - 1]
    hi = cuts[np.searchsorted(cuts, stop)]
    return list(zip(begin.tolist(), stop.tolist(), lo.tolist(), hi.tolist(), strict=True))


def _long_texts(docs: DataFrame, load, chunk_bytes: int, fan_in: int) -> DataFrame:
    """The digests of texts that are cut into ranges."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                data = b" " + row.text.encode()
                ranges = byte_ranges(np.frombuffer(data, np.uint8), chunk_bytes)
                for part in range(0, len(ranges), 64):
                    yield pd.DataFrame([(row.row, row.id, row.missing, part + i, b - lo, e - lo, data[lo + 1:hi].decode())
                                        for i, (b, e, lo, hi) in enumerate(ranges[part:part + 64])],
                                       columns=["row", "id", "missing", "part", "begin", "stop", "text"])

    def align(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = load()
        for frame in batches_of(frames, "text", BATCH_CHARS):
            aligned = Aligned(pair, frame["text"].tolist(), frame["begin"].to_numpy(), frame["stop"].to_numpy())
            own = frame[["row", "id", "missing", "part"]].reset_index(drop=True)
            yield pd.concat([own, pd.DataFrame(aligned.fragments())], axis=1)

    def compose(frame: pd.DataFrame) -> pd.DataFrame:
        parts = frame.sort_values("part").to_dict("records")
        first = {k: parts[0][k] for k in ("row", "id", "missing")} | {"part": parts[0]["part"] // fan_in}
        return pd.DataFrame([first | join(parts)])

    def digest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for f in frame.to_dict("records"):
                yield pd.DataFrame([{"id": f["id"], "missing": f["missing"]} | finish(f)])

    ranges = docs.withColumn("row", F.monotonically_increasing_id()).mapInPandas(
        cut, "row bigint, id bigint, missing boolean, part bigint, begin bigint, stop bigint, text string")
    state = write_through(ranges.repartition("row", "part").mapInPandas(align, FRAGMENT), "fragments")
    while (state.agg(F.max("part")).first()[0] or 0) > 0:
        higher = write_through(state.withColumn("above", F.floor(F.col("part") / fan_in)).groupBy("row", "above")
                               .applyInPandas(lambda f: compose(f.drop(columns="above")), FRAGMENT), "fragments")
        release(state)
        state = higher
    return state.mapInPandas(digest, DIGEST)


def _count(aligned: DataFrame) -> DataFrame:
    """``pair, n``: how many links hold each pair of ids."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for frame in frames:
            new, n = np.unique(np.frombuffer(b"".join(frame["links"]), "<u4"), return_counts=True)
            pairs, at = np.unique(np.concatenate([pairs, new.astype(np.int64)]), return_inverse=True)
            counts = np.bincount(at, weights=np.concatenate([counts, n]), minlength=len(pairs)).astype(np.int64)
            if len(pairs) > 2_000_000:
                yield pd.DataFrame({"pair": pairs, "n": counts})
                pairs, counts = pairs[:0], counts[:0]
        yield pd.DataFrame({"pair": pairs, "n": counts})

    return (aligned.select("links").mapInPandas(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n")))


def _by_broadcast(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``aligned`` with ``n_best, count_sum``, the counted pairs in every task."""
    known = counts.orderBy("pair").toPandas()
    pairs, n = known["pair"].to_numpy(), known["n"].to_numpy()
    highest = np.zeros(1 << 16, np.int64)
    np.maximum.at(highest, pairs & 0xFFFF, n)
    sent = aligned.sparkSession.sparkContext.broadcast((pairs, n, n == highest[pairs & 0xFFFF]))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs, n, best = sent.value
        for frame in frames:
            links = frame.pop("links")
            at = np.searchsorted(pairs, np.frombuffer(b"".join(links), "<u4").astype(np.int64))
            bounds = np.concatenate([[0], np.cumsum([len(x) // 4 for x in links], dtype=np.int64)])
            for name, values in (("n_best", best[at]), ("count_sum", n[at])):
                total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
                frame[name] = np.diff(total[bounds])
            yield frame

    return aligned.mapInPandas(run, DIGEST.replace("links binary", "n_best bigint, count_sum bigint"))


def _by_join(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The same with a join on the pairs, for counted pairs of any number."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            links = np.frombuffer(b"".join(frame["links"]), "<u4").astype(np.int64)
            row = np.repeat(frame["row"].to_numpy(), [len(x) // 4 for x in frame["links"]])
            yield pd.DataFrame({"row": row, "pair": links}).value_counts().rename("times").reset_index()

    rows = write_through(aligned.withColumn("row", F.monotonically_increasing_id()), "rows")
    low = F.col("pair").bitwiseAND(F.lit(0xFFFF))
    highest = counts.groupBy(low.alias("b")).agg(F.max("n").alias("highest"))  # at most 65,536 rows
    judged = write_through(counts.withColumn("b", low).join(F.broadcast(highest), "b")
                           .select("pair", "n", (F.col("n") == F.col("highest")).alias("best")), "pairs")
    held = rows.select("row", "links").mapInPandas(run, "row bigint, pair bigint, times bigint").join(judged, "pair")
    sums = held.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                   F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return rows.drop("links").join(sums, "row", "left").select(
        *[c for c in rows.columns if c not in ("row", "links")], zero("n_best"), zero("count_sum"))


def align_tokenizers(docs: DataFrame, ranks_file: str, pattern: str, piece_file: str, id_col: str = "doc_id",
                     text_col: str = "text", chunk_bytes: int = 1 << 16, fan_in: int = 16,
                     broadcast_pairs: int = 4_000_000) -> DataFrame:
    """``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document.

    ``ranks_file`` and ``pattern`` are the byte-level vocabulary as ranks and its splitting pattern."""
    load = lambda: load_pair(ranks_file, pattern, piece_file)
    # the texts, and the links that are read again
    small_batches(docs.sparkSession)

    ident = F.col(f"`{id_col}`").cast("bigint")
    rows = docs.select(F.coalesce(ident, F.lit(0)).alias("id"), ident.isNull().alias("missing"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    long = F.coalesce(F.octet_length("text"), F.lit(0)) > chunk_bytes
    aligned = write_through(rows.where(~long).mapInPandas(lambda frames: digests_of(load(), frames), DIGEST).unionByName(
        _long_texts(rows.where(long), load, chunk_bytes, fan_in)), "aligned")
    counts = write_through(_count(aligned), "pairs")
    fits = counts.count() <= broadcast_pairs
    out = _by_broadcast(aligned, counts) if fits else _by_join(aligned, counts)
    return out.select(F.when(~F.col("missing"), F.col("id")).alias(id_col), "n_a", "n_b", "n_groups",
                      F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
