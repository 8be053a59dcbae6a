"""Lempel-Ziv fingerprints against a plain walk over the sorted documents."""

import hashlib

from tessera.llm import queries
from tessera.llm.lz_fingerprint import compare_with_edits, fingerprints, parse


def plain_phrases(text):
    known, phrase, out = set(), "", []
    for c in text:
        phrase += c
        if phrase not in known:
            known.add(phrase)
            out.append(phrase)
            phrase = ""
    return [*out, phrase] if phrase else out


def test_phrases():
    for text in ["", "a", "aaaaaaa", "abababababab", "the cat the cat é日本 the cat"]:
        ends = parse(text, [])
        assert [text[a:b] for a, b in zip([0, *ends], ends)] == plain_phrases(text)  # noqa: B905


def expected(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edit = text[:len(text) - half] + following[:half]
        out[doc] = (len(text), hashlib.sha256(edit.encode()).hexdigest(), edit, following)
    return out


def test_matches_plain_walk(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    want = expected(rows)
    out = {r.doc_id: r for r in compare_with_edits(documents, batch_chars=20_000).collect()}
    assert set(out) == set(want)
    texts = [(f"t{d}", t or "") for d, t in rows] + [(f"e{d}", w[2]) for d, w in want.items()]
    own = {r.doc_id: r.fingerprint for r in fingerprints(spark.createDataFrame(texts, "doc_id string, text string")).collect()}
    nxt = {d: t for d, t in rows}
    order = sorted(nxt, reverse=True)
    for i, d in enumerate(order):
        r = out[d]
        assert (r.n_chars, r.edited_sha256) == want[d][:2]
        assert r.fingerprint == own[f"t{d}"] and r.edited_fingerprint == own[f"e{d}"]
        follow = own[f"t{order[(i + 1) % len(order)]}"]
        alike = lambda a, b: sum(a[k:k + 2] == b[k:k + 2] for k in range(0, len(a), 2)) / (len(a) // 2)
        assert r.near_edited == alike(r.fingerprint, r.edited_fingerprint) and r.near_next == alike(r.fingerprint, follow)
    assert sum(r.near_edited > r.near_next for r in out.values()) > 0.9 * len(out)


def test_signature_estimates_phrase_overlap(documents, spark):
    a, b = [r.text for r in documents.where("n_chars > 3000").limit(2).collect()]
    mixed = a[:len(a) // 2] + b[:len(b) // 2]
    x, y = set(plain_phrases(a)), set(plain_phrases(mixed))
    df = spark.createDataFrame([(0, a), (1, mixed)], "doc_id int, text string")
    f, g = [bytes.fromhex(r.fingerprint) for r in fingerprints(df).orderBy("doc_id").collect()]
    assert abs(sum(i == j for i, j in zip(f, g, strict=True)) / len(f) - len(x & y) / len(x | y)) < 0.15


def test_awkward_rows(spark, awkward, no_docs):
    out = compare_with_edits(awkward)
    rows = out.collect()
    assert len(rows) == awkward.count()
    assert out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    same = [r.fingerprint for r in rows if r.doc_id in (5, 6)]
    assert len(same) == 3 and len(set(same)) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert {r.fingerprint for r in rows if not r.n_chars} == {"00" * 128}
    assert compare_with_edits(no_docs).count() == 0
    alone = compare_with_edits(awkward.where("doc_id = 5")).first()
    assert alone.near_next == 1.0 and alone.n_chars > 0


def plain_signature(text):
    """By whole numbers: the least product of each factor over the phrase hashes."""
    wide, base = (1 << 64) - 1, 0x9E3779B97F4A7C15

    def mixed(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & wide
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & wide
        return x ^ (x >> 31)

    hashes = [mixed((sum(mixed(ord(c) + 1) * pow(base, i, 1 << 64) for i, c in enumerate(p)) + len(p) * base) & wide) >> 32
              for p in set(plain_phrases(text))]
    factors = [mixed(k * base & wide) >> 32 | 1 for k in range(1, 129)]
    return bytes(mixed(min(h * f & 0xFFFFFFFF for h in hashes)) >> 56 for f in factors).hex() if hashes else "00" * 128


def test_query_against_plain_version(spark, documents, tmp_path):
    rows = [(r.doc_id, r.text[:2500 if r.doc_id % 3 else 300]) for r in documents.limit(14).collect()]
    rows += [(-1, None), (-2, ""), (-3, rows[0][1]), (-4, "é日本 😀 é日本 😀"), (1 << 60, "abab" * 700)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = expected(rows)
    text = dict(rows)
    out = queries.op9_lz_fingerprints(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in out) == sorted(text)
    alike = lambda a, b: sum(a[k:k + 2] == b[k:k + 2] for k in range(0, 256, 2)) / 128
    for r in out:
        n_chars, digest, edit, following = want[r.doc_id]
        own, changed = plain_signature(text[r.doc_id] or ""), plain_signature(edit)
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (n_chars, digest, own, changed)
        assert (r.near_edited, r.near_next) == (alike(own, changed), alike(own, plain_signature(following)))
