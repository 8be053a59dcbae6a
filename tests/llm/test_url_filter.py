"""The URL filter against a loop over all rules."""

from pyspark.sql import functions as F
from tessera.llm.queries import URL_RULES
from tessera.llm.url_filter import bloom_blocks, judge_urls

LISTED = "host string, path string, verdict string"


def brute(url, rules, default="allow"):
    text = url or ""
    rest = text[text.index("://") + 3:] if "://" in text else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else default


URLS = [None, "", "no scheme", "http://", "://x.com/", "https://WWW.Example.COM/en/a?b#c", "http://a.example.com/en/x",
        "http://example.com/en", "http://com/", "http://com", "http://x.com?y=/en/", "http://notexample.com/en/",
        "http://a.net/es/1", "http://net/fr/", "http://a.net/esx/", "http://b.org/x", "http://Ü.com/é/", "http://a..com//",
        "a://b://c.net/es/", "http://example.com:80/en/", "http://" + "a." * 3000 + "net/fr/x", "http://c.com/\nen/"]


def test_matches_every_rule(spark):
    rows = [(i, u, "x", "y") for i, u in enumerate(URLS)] + [(None, URLS[5], "x", "y"), (None, None, None, None)] + [
        (5, URLS[5], "x", "y")] * 3
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule string")
    for rules in (URL_RULES, URL_RULES + [("b.org", "/x/long/" * 50, "block"), ("org", "", "block"), ("com", "/", "block")], []):
        out = judge_urls(pages, spark.createDataFrame(rules, LISTED))
        known = {(h, p): v for h, p, v in rules if v == "allow"} | {(h, p): v for h, p, v in rules if v == "block"}
        merged = [(h, p, v) for (h, p), v in known.items()]
        want = sorted(((i, *brute(u, merged)) for i, u, _, _ in rows), key=repr)
        assert sorted((tuple(r) for r in out.collect()), key=repr) == want
        # one block for all keys: many false positives, the same result
        full = judge_urls(pages, spark.createDataFrame(rules, LISTED), max_blocks=1)
        assert sorted((tuple(r) for r in full.collect()), key=repr) == want


def test_filter_holds_every_key(spark):
    keys = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = bloom_blocks(keys, 300)
    assert blocks.count() <= 300
    word = lambda i: F.col(f"w{i}").cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))
    bits = blocks.select(sum(F.bit_count(word(i)) for i in range(8)).alias("n")).agg(F.avg("n")).first()[0]
    assert 80 < bits < 130


def test_empty_table(spark):
    none = spark.createDataFrame([], "page_id bigint, url string")
    assert judge_urls(none, spark.createDataFrame(URL_RULES, LISTED)).count() == 0
