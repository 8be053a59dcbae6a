"""Tokenising expressions.

The segmenter of the original news job is a per-row dictionary library; it is
re-aimed here as a regular expression that Java's engine and RE2 read alike:
a word is a run of at least two letters or digits of the lower-cased text.
Runs of Han, Kana or Hangul characters have no blanks between words, so for
texts flagged as such they are cut into overlapping two-character pieces.

The flag is a per-row predicate (typically on a language column) rather than
a scan of every text: a character-class scan over the whole corpus costs as
much as the tokenising itself.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word pattern, and the code-point blocks treated as CJK
# (Hangul Jamo, Hiragana + Katakana, Hangul Compatibility Jamo, Katakana
# Phonetic Extensions, CJK Extension A, CJK Unified Ideographs, Hangul
# Syllables, CJK Compatibility Ideographs).
WORD_PATTERN = r"[\p{L}\p{N}]{2,}"
CJK_RANGES = "ᄀ-ᇿ぀-ヿ㄰-㆏ㇰ-ㇿ㐀-䶿一-鿿가-힯豈-﫿"
CJK_LANGS = ("zh", "ja", "ko")

_RUNS = rf"[{CJK_RANGES}]{{2,}}|[\p{{L}}\p{{N}}&&[^{CJK_RANGES}]]{{2,}}"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _cjk_tokens(t: Column) -> Column:
    runs = F.regexp_extract_all(t, F.lit(_RUNS), 0)
    return F.flatten(F.transform(runs, lambda r: F.when(
        F.substring(r, 1, 1).rlike(f"[{CJK_RANGES}]"),
        F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, 2)),
    ).otherwise(F.array(r))))


def _per_row(cjk_bigrams: bool | Column, cjk: Column, plain: Column) -> Column:
    if isinstance(cjk_bigrams, Column):
        return F.when(cjk_bigrams, cjk).otherwise(plain)
    return cjk if cjk_bigrams else plain


def word_tokens(text: Column | str, cjk_bigrams: bool | Column = False) -> Column:
    """Ordered array of lower-case word tokens (length >= 2) of ``text``.

    ``cjk_bigrams``: ``True`` for every row, or a boolean column choosing the
    rows whose Han/Kana/Hangul runs become overlapping bigrams.
    """
    t = F.lower(_col(text))
    return _per_row(cjk_bigrams, _cjk_tokens(t), F.regexp_extract_all(t, F.lit(WORD_PATTERN), 0))


def has_word(text: Column | str, cjk_bigrams: bool | Column = False) -> Column:
    """True when :func:`word_tokens` gives at least one token.  A regex
    ``find`` stops at the first word, so this guard is far cheaper than the
    tokens themselves and keeps the token expression out of filters (where
    it would be evaluated once more)."""
    t = F.lower(_col(text))
    return _per_row(cjk_bigrams, t.rlike(_RUNS), t.rlike(WORD_PATTERN))


# The white space that the tokenizer of the ML library splits at.
WHITE_SPACE = r"[ \t\n\x0B\f\r]"


def whitespace_tokens(text: Column | str) -> Column:
    """Lower-case and split at every white-space character, as ``pyspark.ml.feature.Tokenizer`` does: words of one
    letter and empty words between or before blanks are kept, empty words at the end are not."""
    t = F.lower(_col(text))
    body = F.regexp_replace(t, WHITE_SPACE + r"+$", "")
    return (F.when(t == "", F.array(F.lit(""))).when(body == "", F.array().cast("array<string>"))
            .otherwise(F.split(body, WHITE_SPACE)))


def join_tokens(tokens: Column | str, sep: str = " ") -> Column:
    return F.array_join(_col(tokens), sep)
