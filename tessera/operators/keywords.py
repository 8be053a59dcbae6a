"""Word counts, document frequency, exact TF-IDF and per-document keywords.

Plan shape for a document table (one row per document), the same for any size
and any number of input splits:

1. tokens are produced inside ``explode``/``posexplode`` of the tokenising
   expression itself, in the tasks of the scan.  An empty token array explodes
   to no rows, so generators need no "has a word" filter; that guard (a regex
   ``find``) is paid only by the per-document outputs;
2. a document is one row, so its words are counted inside that row, before
   anything moves: :func:`term_rows` gives (document, word, count), and a mark,
   the empty word with count 0, for each document that has a word;
3. TF-IDF shuffles these rows once, by (word, salt) with the salt a hash of
   the document: the term counts per (word, salt, document), the documents per
   (word, salt) and the join below all use that partitioning.  The number of
   salts is the number of shuffle partitions, so a word found in every document
   is spread over as many tasks as there are;
4. the lookup side holds only the (word, salt) pairs that occur, each with the
   document frequency of its word (a sum over at most ``salts`` rows), so a
   rare word costs a few rows there and no word is copied to every salt;
5. the document count is the number of marks, an aggregate of the same
   exchange; the text is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.records import hash_bucket
from ..functions.text import has_word, join_tokens, word_tokens


def prepare_documents(docs: DataFrame, id_col: str, text_col: str, cjk_bigrams: bool | Column = False) -> DataFrame:
    """``doc, text, cjk``: the documents with a text."""
    cjk = cjk_bigrams if isinstance(cjk_bigrams, Column) else F.lit(bool(cjk_bigrams))
    kept = docs.where(F.col(text_col).isNotNull())
    return kept.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), cjk.alias("cjk"))


def _with_words(prepared: DataFrame) -> DataFrame:
    """Documents that yield at least one token (cheap guard, see :func:`has_word`)."""
    return prepared.where(has_word(F.col("text"), F.col("cjk")))


def tokens(prepared: DataFrame) -> Column:
    """The token array of each prepared document (use inside a generator or
    a projection, not as a column to filter on)."""
    return word_tokens(F.col("text"), F.col("cjk"))


def joined_tokens(prepared: DataFrame) -> DataFrame:
    """``doc, text`` with the tokens joined by single blanks (documents with
    at least one token)."""
    return _with_words(prepared).select("doc", join_tokens(tokens(prepared)).alias("text"))


def token_stream(prepared: DataFrame) -> DataFrame:
    """``doc, pos, token`` — one row per token occurrence."""
    return prepared.select("doc", F.posexplode(tokens(prepared)).alias("pos", "token"))


def word_counts(prepared: DataFrame) -> DataFrame:
    """``word, n`` over all documents (partial + final hash aggregate)."""
    return (prepared.select(F.explode(tokens(prepared)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def top_words(counts: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most frequent words, ties by word (TakeOrderedAndProject)."""
    return counts.orderBy(F.col("n").desc(), F.col("word").asc()).limit(k)


def _counted(words: Column) -> Column:
    """``array<struct<word, n>>``: the empty word with 0, then the distinct elements of an array with their counts;
    NULL for an empty array."""
    mark = F.array(F.struct(F.lit("").alias("word"), F.lit(0).cast("bigint").alias("n")))

    def of_sorted(w: Column) -> Column:
        heads = F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: (i == 1) | (F.get(w, i - 1) != F.get(w, i - 2)))
        return F.transform(F.array(heads), lambda h: F.transform(h, lambda x, j: F.struct(
            F.get(w, x - 1).alias("word"), (F.coalesce(F.get(h, j + 1), F.size(w) + 1) - x).cast("bigint").alias("n"))))[0]

    # an array of one element binds the sorted words to a name, so they are computed once
    return F.transform(F.array(F.sort_array(words)), lambda w: F.when(F.size(w) > 0, F.concat(mark, of_sorted(w))))[0]


def term_rows(prepared: DataFrame, buckets: int | None = None) -> DataFrame:
    """``doc, word, n`` — a row for each distinct word of a document with its count, and one with the empty word and
    count 0 for each document that has a word.  With ``buckets`` the word is replaced by its hash bucket (md5, the same
    in any engine) and the empty word by -1; two words of a bucket are two rows."""
    rows = prepared.select("doc", F.explode(_counted(tokens(prepared))).alias("t"))
    # never NULL, so the joins below add no filter to one of their sides
    word, n = F.coalesce("t.word", F.lit("")), F.coalesce("t.n", F.lit(0))
    if buckets is not None:
        word = F.when(n == 0, F.lit(-1)).otherwise(F.coalesce(hash_bucket(word, buckets), F.lit(-1))).cast("bigint")
    return rows.select("doc", word.alias("word"), n.alias("n"))


def _moved(terms: DataFrame) -> DataFrame:
    """``doc, word, n, _salt``: the rows of :func:`term_rows`, dealt by word and salt."""
    salts = int(terms.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.coalesce(F.pmod(F.xxhash64("doc"), F.lit(salts)), F.lit(0)).cast("int")
    return terms.withColumn("_salt", salt).repartition(salts, "word", "_salt")


def _spread(terms: DataFrame) -> DataFrame:
    """``word, _salt, doc, tf`` of :func:`term_rows`, the marks with a ``tf`` of 0."""
    return _moved(terms).groupBy("word", "_salt", "doc").agg(F.sum("n").alias("tf"))


def term_counts(terms: DataFrame) -> DataFrame:
    """``word, _salt, doc, tf``, in the partitioning that :func:`tfidf` joins in."""
    return _spread(terms).where("tf > 0")


def _idf(df_col: Column, m: Column) -> Column:
    return F.log((m + F.lit(1.0)) / (df_col + F.lit(1.0)))


def document_count(prepared: DataFrame) -> Column:
    """Number of documents with at least one token, as a scalar sub-query."""
    has = has_word(F.col("text"), F.col("cjk"))
    return prepared.select(F.count_distinct(F.when(has, F.col("doc")))).scalar()


def inverse_document_frequency(terms: DataFrame, m: Column | None = None) -> DataFrame:
    """``word, df, idf`` with idf = ln((m + 1) / (df + 1)), the smoothed form
    also used by ``pyspark.ml.feature.IDF``; ``m`` is the number of documents
    with a word, counted from the marks of ``terms`` when not given.
    Distinct (word, document) pairs merge map-side, then per word."""
    pairs = terms.groupBy("word", "doc").agg(F.max("n").alias("n"))
    # the marks are left out by an aggregate, since a filter on the word would part the two readers of one exchange
    words = pairs.groupBy("word").agg(F.count("doc").alias("df"), F.max("n").alias("_most"))
    if m is None:
        m = words.select(F.coalesce(F.sum(F.when(F.col("_most") == 0, F.col("df"))), F.lit(0))).scalar()
    return words.where("_most > 0").select("word", "df", _idf(F.col("df"), m).alias("idf"))


def tfidf(terms: DataFrame, m: Column | None = None) -> DataFrame:
    """``doc, word, tf, tfidf`` of :func:`term_rows` — exact words, no hashing collisions.

    The counts, the lookup side and the document count read one exchange, which
    Spark reuses: all need the same columns, neither word nor salt is ever NULL,
    so no filter is inferred for one of them only, and the marks are told by
    their summed count."""
    counts = _spread(terms)
    if m is None:
        # of the marks alone: all rows of a document have one salt, so no (word, document) pairs are grouped for this
        m = _moved(terms).select(F.count_distinct(F.when(F.col("n") == 0, F.col("doc")))).scalar()
    # by way of tf, so that this side needs the columns of the exchange that the others need
    here = counts.groupBy("word", "_salt").agg(F.count(F.when(F.col("tf") >= 0, F.col("doc"))).alias("_n"))
    everywhere = Window.partitionBy("word")
    idf = here.select("word", "_salt", _idf(F.sum("_n").over(everywhere), m).alias("_idf"))
    return (counts.where("tf > 0").join(idf, ["word", "_salt"])
            .select("doc", "word", "tf", (F.col("tf") * F.col("_idf")).alias("tfidf")))


def doc_keyword(scores: DataFrame, digits: int = 6) -> DataFrame:
    """Best-scoring word per document, ties by word; the exact scores decide, the output is rounded.
    One shuffle by document, whose rows are at most its distinct words: the best score over them, and of the words
    that reach it (they alone are collected) the least."""
    best = scores.withColumn("_best", F.max("tfidf").over(Window.partitionBy("doc"))).where("tfidf = _best")
    return (best.groupBy("doc", "_best").agg(F.array_min(F.collect_set("word")).alias("word"))
            .select("doc", "word", F.round("_best", digits).alias("score")))
