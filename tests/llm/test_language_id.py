"""Rank-order profiles: a plain version of the distance, held-out accuracy, awkward rows."""

import zlib
from collections import Counter

from pyspark.sql import functions as F
from tessera.llm.language_id import BITS, ngrams, predict_languages

SIZE = 300


def plain_ngrams(text):
    words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
    s = f" {' '.join(words)} "
    out = Counter()
    for n in (1, 2, 3):
        for i in range(len(s) - n + 1):
            g = s[i:i + n]
            if g.strip() and " " not in g[1:-1]:
                out[g] += 1
    return out


def code(gram):
    v = 0
    for c in gram:
        v = (v << BITS) | ord(c)
    return v


def test_ngrams_are_those_of_a_plain_count():
    text = "The cat, é 日本 — sat! x1y"
    assert Counter(ngrams(text).tolist()) == Counter({code(g): n for g, n in plain_ngrams(text).items()})
    assert len(ngrams("12 34 ½ !")) == 0 and len(ngrams("")) == 0


def test_matches_plain_profiles(documents):
    rows = documents.select("doc_id", "text", "lang").collect()
    counts = {}
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 5 and r.lang and r.text:
            counts.setdefault(r.lang, Counter()).update(plain_ngrams(r.text))
    rank = lambda c: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], code(x[0])))[:SIZE]]
    profiles = {lang: {g: i for i, g in enumerate(rank(c))} for lang, c in sorted(counts.items())}
    out = {r.doc_id: r for r in predict_languages(documents, SIZE).collect()}
    assert len(out) == len(rows)
    for r in rows[:60]:
        own = rank(plain_ngrams(r.text))
        off = {lang: sum(abs(i - p[g]) if g in p else SIZE for i, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(off, key=lambda x: (off[x], x))
        assert (out[r.doc_id].lang_pred, round(out[r.doc_id].score, 9)) == (
            best, round(1 - off[best] / (SIZE * len(own)), 9))


def test_held_out_accuracy(documents):
    judged = predict_languages(documents).join(documents.select("doc_id", "lang"), "doc_id").where("held_out")
    n, right = judged.agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert n > 20 and right >= 0.95 * n


def test_awkward_rows(awkward, no_docs):
    out = predict_languages(awkward)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == awkward.count()
    und = {r.doc_id for r in out.where("lang_pred = 'und'").collect()}
    assert und == {0, 1, 2, 9, None}
    assert out.where("doc_id IS NULL AND NOT held_out").count() == 0
    assert out.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert predict_languages(no_docs).count() == 0
    unlabelled = predict_languages(awkward.withColumn("lang", F.lit(None).cast("string")))
    assert unlabelled.where("lang_pred != 'und' OR score != 0").count() == 0
