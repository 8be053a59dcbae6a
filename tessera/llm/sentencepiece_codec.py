"""SentencePiece encoding and decoding by vectorised merge rounds.

A text gets a leading space mark, its blanks become space marks, and it is cut
into words: a run of marks and what follows it.  No piece of the vocabulary
holds a mark after another character (checked when the model is loaded), so no
merge crosses a word.  Each distinct word of a batch is encoded once: all its
symbols stand in flat numpy arrays; a round looks up the merged piece of every
adjacent pair, finds the best rank in each word (segmented minimum), merges all
leftmost non-overlapping pairs of that rank at once, and compacts the arrays;
words without a pair left leave.

Merging at once equals merging one by one as long as no merge makes a new
neighbour pair of the same or a better rank; the first merge of a word that
would is the last of its round.  Characters without a piece become byte pieces.

Decoding joins the pieces' bytes, blanks for marks, without the leading one.

Edge cases: NULL and empty texts have no ids and decode to an empty text; NULL
ids and repeated rows are kept; an empty table gives an empty result; a text's
length is bounded by memory alone, and long runs of marks are cut into blocks
of the longest mark piece, as merging from the left does.  Other columns of the
input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..plans import small_batches
from ._rows import beside_text, identity
from ._words import WordCodes, batches_of, cut_documents, joined_ranges, text_bytes

MARK = "▁"
NO_RANK = np.iinfo(np.int32).max


class PieceModel:
    """Tables of a model: symbols of characters, merges of symbol pairs, bytes of pieces."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        size = sp.get_piece_size()
        normal = [i for i in range(size)
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = {sp.id_to_piece(i): i for i in normal}
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece of this model holds a space mark after another character")
        scores = sorted({sp.get_score(i) for i in pieces.values()}, reverse=True)
        rank_of = {s: r for r, s in enumerate(scores)}
        ids = dict(pieces)
        for char in sorted({c for p in pieces for c in p} - pieces.keys()):
            ids[char] = size + len(ids) - len(pieces)  # a character that is no piece but part of one
        merges = {(ids[p[:k]] << 32) | ids[p[k:]]: (i, rank_of[sp.get_score(i)])
                  for p, i in pieces.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids}
        keys = sorted(merges)
        self.pair_keys = np.array(keys, dtype=np.int64)
        self.pair_piece = np.array([merges[k][0] for k in keys], dtype=np.int64)
        self.pair_rank = np.array([merges[k][1] for k in keys], dtype=np.int32)
        chars = sorted((ord(c), i) for c, i in ids.items() if len(c) == 1)
        self.char_codes = np.array([c for c, _ in chars], dtype=np.int64)
        self.char_ids = np.array([i for _, i in chars], dtype=np.int64)
        self.size = size
        self.byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int64)
        self.first_unlisted = size + len(ids) - len(pieces)
        self.mark_block = max((len(p) for p in pieces if not p.strip(MARK)), default=1)
        self.surface = [b""] * size
        for i in range(size):
            if sp.is_byte(i):
                self.surface[i] = bytes([int(sp.id_to_piece(i)[3:5], 16)])
            elif sp.is_unknown(i):
                self.surface[i] = " ⁇ ".encode()
            elif not sp.is_control(i):
                self.surface[i] = sp.id_to_piece(i).replace(MARK, " ").encode()
        self.opens = {i for p, i in pieces.items() if p.startswith(MARK)}

    def words(self, texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The texts with blanks for marks as bytes; start and end of each word, and the words of each text."""
        data, starts = text_bytes(" " + t.replace(MARK, " ") if isinstance(t, str) and t else "" for t in texts)
        blank = data == 32
        ix = np.arange(len(data))
        run = np.maximum.accumulate(np.where(blank & ~np.concatenate([[False], blank[:-1]]), ix, 0))
        return data, *cut_documents(blank & ((ix - run) % self.mark_block == 0), starts)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged piece of symbol pairs; NO_RANK where there is no merge."""
        keys = (left << 32) | right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        hit = self.pair_keys[at] == keys
        return np.where(hit, self.pair_rank[at], NO_RANK), self.pair_piece[at]

    def encode_words(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words as one flat array, and the number of ids of each word."""
        words = [w.decode() for w in raw]
        codes = np.frombuffer("".join(words).replace(" ", MARK).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        at = np.searchsorted(self.char_codes, codes)
        at[at == len(self.char_codes)] = 0
        known = self.char_codes[at] == codes
        # a character outside the vocabulary keeps its code point above all ids
        symbol = np.where(known, self.char_ids[at], self.first_unlisted + codes)
        done_symbol, done_word = [], []
        while len(symbol):
            symbol, word, over = self._round(symbol, word)
            done_symbol.append(symbol[over])
            done_word.append(word[over])
            symbol, word = symbol[~over], word[~over]
        if not done_symbol:
            return np.empty(0, np.int64), np.zeros(len(words), np.int64)
        symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return self._with_bytes(symbol[order], word[order], len(words))

    def _round(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One round of merges; over: the symbols of words that had no pair to merge."""
        n = len(symbol)
        rank = np.full(n, NO_RANK, np.int32)
        merged = np.zeros(n, np.int64)
        if n > 1:
            rank[:-1], merged[:-1] = self._pairs(symbol[:-1], symbol[1:])
            rank[:-1][word[1:] != word[:-1]] = NO_RANK
        heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        best = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.concatenate([heads, [n]])))
        over = best == NO_RANK
        chosen = (rank == best) & ~over
        # of pairs that overlap in a row, every other one from the left
        ix = np.arange(n)
        begins = chosen & ~np.concatenate([[False], chosen[:-1]])
        chosen &= ((ix - np.maximum.accumulate(np.where(begins, ix, 0))) & 1) == 0
        chosen = self._before_conflict(symbol, word, chosen, best, merged)
        symbol = np.where(chosen, merged, symbol)
        keep = ~np.concatenate([[False], chosen[:-1]])
        return symbol[keep], word[keep], over[keep]

    def _before_conflict(self, symbol, word, chosen, best, merged):
        """The chosen pairs of each word up to the first whose merge makes a pair of no worse rank."""
        at = np.flatnonzero(chosen)
        if not len(at):
            return chosen
        n, made = len(symbol), merged[at]
        conflict = np.zeros(len(at), bool)
        left = np.maximum(at - 1, 0)
        has_left = (at > 0) & (word[left] == word[at])
        right = np.minimum(at + 2, n - 1)
        has_right = (at + 2 < n) & (word[right] == word[at])
        limit = best[at]
        conflict |= has_left & (self._pairs(symbol[left], made)[0] <= limit)
        conflict |= has_right & (self._pairs(made, symbol[right])[0] <= limit)
        # the next or the last chosen pair may stand right beside this one
        beside = np.zeros(len(at), bool)
        beside[1:] = (at[1:] == at[:-1] + 2) & (word[at[1:]] == word[at[:-1]])
        previous = np.concatenate([made[:1], made[:-1]])
        conflict |= beside & (self._pairs(previous, made)[0] <= limit)
        if not conflict.any():
            return chosen
        seen = np.cumsum(conflict) - conflict
        heads = np.concatenate([[True], word[at[1:]] != word[at[:-1]]])
        base = np.maximum.accumulate(np.where(heads, seen, 0))
        out = np.zeros(n, bool)
        out[at[seen == base]] = True
        return out

    def _with_bytes(self, symbol: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no pieces replaced by the byte pieces of their characters."""
        odd = np.flatnonzero(symbol >= self.size)
        lengths = np.ones(len(symbol), np.int64)
        if len(odd):
            listed = {int(i): int(c) for c, i in zip(self.char_codes, self.char_ids, strict=True) if i >= self.size}
            chars = [chr(listed[s] if s in listed else s - self.first_unlisted) for s in symbol[odd].tolist()]
            data = [c.encode() for c in chars]
            lengths[odd] = [len(d) for d in data]
            out = np.repeat(symbol, lengths)
            starts = (np.cumsum(lengths) - lengths)[odd]
            out[joined_ranges(starts, lengths[odd])] = self.byte_id[np.frombuffer(b"".join(data), dtype=np.uint8)]
            symbol = out
        return symbol, np.bincount(np.repeat(word, lengths), minlength=n)

    def decode(self, ids: list[int]) -> str:
        data = b"".join([self.surface[i] for i in ids])
        if ids and ids[0] in self.opens:
            data = data[1:]
        return data.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def load_model(model_file: str) -> PieceModel:
    return PieceModel(model_file)


def encode_decode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
                  batch_chars: int = 500_000) -> DataFrame:
    """``id, ids array<int>, decoded``: the ids of each whole text and the text they decode to."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model(model_file)
        codes = WordCodes(model.encode_words, np.int32)
        for frame in batches_of(frames, "_text", batch_chars):
            flat, counts = codes.encode(*model.words(frame["_text"]))
            ids = np.split(flat, np.cumsum(counts)[:-1])
            yield pd.DataFrame({"ids": ids, "decoded": [model.decode(x.tolist()) for x in ids]})

    small_batches(docs.sparkSession)
    return beside_text(docs, [identity(docs, id_col, None)], text_col, run, "ids array<int>, decoded string")
