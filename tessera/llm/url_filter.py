"""URL filter: a blocked Bloom filter of the listed canonical URLs passes
possible hits on to an exact hash join.

A listed entry is a host and a path prefix with a verdict.  It covers its host
and every subdomain of it, for paths that start with the prefix; the longest
listed entry wins.  Its canonical form is ``host + path``, so the entries that
could cover a URL are the URL's own host suffixes times its path prefixes, cut
only at the label counts and path lengths that the list uses.

Plan: distinct (host, path) pairs -> candidate keys -> join with the filter's
blocks on the block number -> bit test -> exact join on the key -> longest
entry per pair -> join back to the rows.  Equal URLs are judged once, so a URL
that fills a third of the table costs one row per task before the shuffle.

The filter is split into 256-bit blocks; a key sets one bit in each of the
block's eight words.  ``max_blocks`` bounds the broadcast (about 50 bytes a
block); a list too long for it raises the share of false positives only, and
the exact join removes those.

Edge cases: a NULL url or one without ``://`` has an empty host and path and
is allowed by default; NULL page ids and repeated rows are kept as they are;
an empty table gives an empty result; an empty list gives every row the
default; entries listed twice with different verdicts block.  Other columns of
the input are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans import write_through

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The two parts of a URL that entries speak of, never NULL."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    after = F.substr(rest, F.length(host) + 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(after, "^[^?#]*", 0)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """One bit for each 32-bit word of the key's block."""
    bits = F.xxhash64(key, F.lit("bits"))
    return [F.call_function("shiftleft", F.lit(1), F.shiftright(bits, 5 * i).bitwiseAND(F.lit(31)).cast("int"))
            for i in range(WORDS)]


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """``block, w0..w7``: the filter as a table, at most ``blocks`` rows."""
    marked = keys.select(_block(F.col("key"), blocks).alias("block"),
                         *[m.alias(f"m{i}") for i, m in enumerate(_masks(F.col("key")))])
    return marked.groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(WORDS)])


def _possible_hits(candidates: DataFrame, keys: DataFrame, blocks: int) -> DataFrame:
    probed = candidates.withColumn("block", _block(F.col("key"), blocks))
    found = probed.join(F.broadcast(bloom_blocks(keys, blocks)), "block")
    for i, mask in enumerate(_masks(F.col("key"))):
        found = found.where(F.col(f"w{i}").bitwiseAND(mask) == mask)
    return found.select("host", "path", "key")


def _candidate_keys(counts: list[int], lengths: list[int]) -> Column:
    """Host suffixes of the listed label counts times path prefixes of the listed lengths."""
    labels = F.split("host", r"\.", -1)
    numbers = F.filter(F.array(*[F.lit(c) for c in counts]), lambda c: c <= F.size(labels))
    sizes = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    suffixes = F.transform(numbers, lambda c: F.array_join(F.slice(labels, -c, c), "."))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(
        sizes, lambda n: F.concat(s, F.substr(F.col("path"), F.lit(1), n)))))


def judge_urls(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
               default: str = "allow", bits_per_key: int = 16, max_blocks: int = 1 << 16) -> DataFrame:
    """``id, host, path, rule, verdict`` for every row of ``pages``.

    ``listed`` holds ``host, path, verdict``.  ``rule`` is the longest entry
    that covers the URL (NULL if none does), ``verdict`` its verdict or
    ``default``.  The distinct label counts and path lengths of the list are
    the only thing collected; both are bounded by the longest entry.
    """
    entries = (listed.select(F.concat(F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit(""))).alias("key"),
                             F.size(F.split("host", r"\.", -1)).alias("labels"),
                             F.length(F.coalesce("path", F.lit(""))).alias("path_length"), "verdict")
               .where(F.col("key").isNotNull()))
    shape = entries.agg(F.collect_set("labels").alias("labels"), F.collect_set("path_length").alias("lengths"),
                        F.count(F.lit(1)).alias("n")).first()
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    if not shape.n:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    blocks = min(max_blocks, max(1, shape.n * bits_per_key // (32 * WORDS) + 1))
    candidates = (rows.select("host", "path").distinct()
                  .select("host", "path", F.explode(_candidate_keys(sorted(shape.labels), sorted(shape.lengths)))
                          .alias("key")))
    exact = entries.groupBy("key").agg(F.min(F.when(F.col("verdict") == "block", 0).otherwise(1)).alias("rank"),
                                       F.min("verdict").alias("other"))
    exact = exact.select("key", F.when(F.col("rank") == 0, "block").otherwise(F.col("other")).alias("verdict"))
    hits = _possible_hits(candidates, entries.select("key"), blocks).join(exact, "key")
    best = hits.groupBy("host", "path").agg(
        F.max_by(F.struct("key", "verdict"), F.struct(F.length("key"), F.col("key"))).alias("won"))
    # written: the join back then shuffles two plain tables, which AQE can split at a hot URL; never broadcast,
    # since it grows with the pages
    judged = write_through(best.select("host", "path", "won.key", "won.verdict"), "urls").hint("merge")
    return (rows.join(judged, ["host", "path"], "left")
            .select(id_col, "host", "path", F.col("key").alias("rule"),
                    F.coalesce("verdict", F.lit(default)).alias("verdict")))
