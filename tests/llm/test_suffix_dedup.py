"""Removal of repeated strings against a plain table of all strings."""

import hashlib
import random

import numpy as np
from tessera.llm import suffix_dedup as S

LAST = (1 << 63) - 1


def brute(rows, length=50):
    data = [((LAST if d is None else d), (t or "").encode()) for d, t in rows]
    least = {}
    for d, b in data:
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            least[s] = min(d, least.get(s, d))
    out = []
    for (doc, _), (d, b) in zip(rows, data, strict=True):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if least[b[i:i + length]] < d:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((doc, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    return out


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def rows_with_repeats():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choices("abcdéf", k=rnd.randint(1, 6)))
    passages = [" ".join(word() for _ in range(n)) for n in (8, 12, 30, 60)]
    rows = []
    for i in range(160):
        parts = [" ".join(word() for _ in range(rnd.randint(0, 25)))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            parts += [p[rnd.randint(0, 5):], " ".join(word() for _ in range(rnd.randint(0, 10)))]
        rows.append((i, " ".join(parts)))
    rows += [(160 + k, rows[k * 7][1]) for k in range(9)] + [(3, rows[50][1]), (None, rows[3][1]), (None, "ab" * 400)]
    return rows + [(300, "ab" * 300), (301, "a" * 200), (302, "a" * 49), (303, "a" * 50), (None, "ab" * 400)]


def test_matches_table_of_strings(spark, documents):
    rows = rows_with_repeats()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted((r[:5] for r in brute(rows)), key=repr)
    assert got(S.remove_repeats(df)) == want
    assert got(S.remove_repeats(df, hot_blocks=1, task_bytes=500, batch_chars=700)) == want
    assert sum(1 for r in want if r[2]) > 60
    real = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert got(S.remove_repeats(documents)) == sorted((r[:5] for r in brute(real)), key=repr)


def test_kept_text(spark):
    rows = rows_with_repeats()
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id bigint, text string, ord string, kept int")
    out = S.remove_repeats(df, keep=df.columns)
    assert out.select("kept_columns.*").columns == df.columns
    want = sorted(((d, b[5].decode("utf-8", "ignore")) for (d, _), b in zip(rows, brute(rows), strict=True)), key=repr)
    assert got(out.select("kept_columns.doc_id", "kept_columns.text")) == want


def test_awkward_rows(awkward, no_docs):
    assert got(S.remove_repeats(awkward)) == sorted(
        (r[:5] for r in brute([(r.doc_id, r.text) for r in awkward.collect()])), key=repr)
    assert S.remove_repeats(no_docs).count() == 0


def test_intervals_are_common_prefixes():
    rnd = random.Random(2)
    parts = ["".join(rnd.choices("ab", k=rnd.randint(12, 60))).encode() for _ in range(30)]
    owners = np.arange(30)[::-1].copy()
    least = {}
    for p, o in zip(parts, owners.tolist(), strict=True):
        for i in range(len(p) - 11):
            least[p[i:i + 12]] = min(o, least.get(p[i:i + 12], o))
    want = [least[p[i:i + 12]] for p in parts for i in range(len(p) - 11)]
    assert S.repeated_strings(parts, owners, 12).tolist() == want


def test_content_bytes_equal_to_no_separator():
    rnd = random.Random(4)
    for _ in range(5):
        shared = bytes(rnd.choice(b"ab\0") for _ in range(70))
        parts = [bytes(rnd.choices(b"abcd", k=rnd.randint(5, 30))) + shared + bytes(rnd.choices(b"abc\0", k=rnd.randint(5, 30)))
                 for _ in range(4)]
        owners = np.array([3, 1, 0, 2])
        least = {}
        for p, o in zip(parts, owners.tolist(), strict=True):
            for i in range(len(p) - 49):
                least[p[i:i + 50]] = min(o, least.get(p[i:i + 50], o))
        want = [least[p[i:i + 50]] for p in parts for i in range(len(p) - 49)]
        assert S.repeated_strings(parts, owners, 50).tolist() == want


def test_documents_with_nul_bytes(spark):
    rnd = random.Random(6)
    shared = "".join(rnd.choice("ab\0") for _ in range(90))
    rows = [(i, "".join(rnd.choices("cdef", k=20 + i)) + shared + "".join(rnd.choices("cd\0", k=30))) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = sorted((r[:5] for r in brute(rows)), key=repr)
    assert got(S.remove_repeats(df)) == want
    assert sum(1 for r in want if r[2] >= 90) == 11


def test_strings_longer_than_64_bytes():
    rnd = random.Random(8)
    passage = rnd.choices(b"ab", k=70)
    parts = []
    for _ in range(30):  # the same for 70 bytes, then one of two ends
        parts.append(bytes(rnd.choices(b"ab", k=rnd.randint(3, 9)) + passage + [rnd.choice(b"ab")] + passage[:rnd.randint(20, 60)]))
    owners = np.arange(30)[::-1].copy()
    for length in (65, 80):
        least = {}
        for p, o in zip(parts, owners.tolist(), strict=True):
            for i in range(len(p) - length + 1):
                least[p[i:i + length]] = min(o, least.get(p[i:i + length], o))
        want = [least[p[i:i + length]] for p in parts for i in range(len(p) - length + 1)]
        assert S.repeated_strings(parts, owners, length).tolist() == want


def test_intervals_against_plain_prefixes():
    rnd = random.Random(9)
    for length, symbols in ((1, 3), (2, 2), (5, 2), (8, 3), (9, 2), (17, 2), (50, 1), (50, 2)):
        for parts in (1, 2, 9, 40):
            base = bytes(rnd.randint(1, symbols) for _ in range(150))
            parts = list({base[i:i + length + rnd.randint(0, 80)] for i in (rnd.randint(0, 60) for _ in range(parts))})
            parts = [p for p in parts if len(p) >= length]
            owners = np.array([rnd.randint(0, 9) for _ in parts], np.int64)
            least = {}
            strings = [(p[i:i + length], int(o)) for p, o in zip(parts, owners, strict=True) for i in range(len(p) - length + 1)]
            for s, o in strings:
                least[s] = min(o, least.get(s, o))
            assert S.repeated_strings(parts, owners, length).tolist() == [least[s] for s, _ in strings]


def test_transform_is_in_the_order_of_suffixes():
    rnd = random.Random(3)
    for n in (1, 2, 7, 40, 500):
        text = np.array([rnd.randint(1, 2) for _ in range(n - 1)] + [0], np.uint8)
        order, before = S.transform(text)
        raw = text.tobytes()
        assert order.tolist() == sorted(range(n), key=lambda p: raw[p:])
        assert before.tolist() == [raw[p - 1] for p in order]


def test_texts_stay_where_they_are_scanned(spark, monkeypatch):
    passage = "é shared passage of more than fifty bytes, in two texts é"
    rows = [(0, "a " + passage + " b"), (1, "c " + passage + " é d"), (2, "a text of its own that loses nothing at all, long enough"),
            (3, "copied as a whole, and of more than fifty bytes in all"), (4, "copied as a whole, and of more than fifty bytes in all"),
            (5, "short"), (6, None), (None, "copied as a whole, and of more than fifty bytes in all")]
    written = []

    def noted(df, label="cut", write=S.write_through):
        written.append((label, dict(df.dtypes)))
        return write(df, label)

    monkeypatch.setattr(S, "write_through", noted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {(r.kept_columns.doc_id, r.kept_columns.text, r.n_removed) for r in S.remove_repeats(df, keep=df.columns).collect()}
    cut = f"c {passage} é d".replace(f" {passage} ", "")
    expected = {(d, t, 0) for d, t in rows} - {rows[1] + (0,), rows[4] + (0,), rows[7] + (0,)}
    assert out == expected | {(1, cut, len(f" {passage} ".encode())), (4, "", 54), (None, "", 54)}
    assert [types["cuts"] for _, types in written] == ["array<bigint>"]  # no text is written


def test_removed_runs_of_a_block_are_sent_once():
    rnd = random.Random(12)
    letters = lambda n: "".join(rnd.choices("abcdef", k=n))
    passage, other = letters(2 * S.STEP), letters(300)
    texts = [letters(80) + passage + letters(70), passage + letters(60) + other, other]
    frame = S.pd.DataFrame({"block": 0, "t1": [1, 2, 3], "t2": 0, "ord": [1, 2, 3], "last": [1, 2, 3], "text": texts})
    plan = S._Plan(50, 4, 256, 1_000_000, 1 << 18, False)
    shared = S.pd.concat([plan.shared_anchors(own) for _, own in S.pd.concat(plan.send_anchors(iter([frame]))).groupby("bucket")])
    sent = plan.send_segments(frame, shared)
    spans = sent[sent["bytes"].isna()]
    # one row for each run, not one for each segment in it (the ends, shared in part by a segment, are judged later)
    assert sorted(spans["source"].tolist()) == [1, 2]
    judged = S.pd.concat(plan.judge(iter([sent.sort_values("key")])))
    rows = plan.cut(frame, judged)
    want = brute([(1, texts[0]), (2, texts[1]), (3, texts[2])])
    assert [(r.first, r.n_removed, r.n_spans, r.kept_sha256) for r in rows.itertuples()] == [
        (d, gone, runs, digest) for d, _, gone, runs, digest, _ in want if gone]


def test_segments_hold_every_string_once():
    rnd = random.Random(13)
    texts = ["".join(rnd.choices("ab", k=n)) for n in (10, 49, 50, 51, S.STEP - 3, 120, 2 * S.STEP + 1)] + ["", "x" * 900]
    data, starts = S.text_bytes(texts)
    owner, at, count, anchor = S.segments(data, starts, 50)
    assert count.max() <= 64
    held = [(o, p) for o, a, n in zip(owner.tolist(), at.tolist(), count.tolist(), strict=True) for p in range(a, a + n)]
    assert held == [(i, starts[i] + p) for i, t in enumerate(texts) for p in range(len(t) - 49)]
    raw, by_string = data.tobytes(), {}
    for a, n, key in zip(at.tolist(), count.tolist(), anchor.tolist(), strict=True):
        for p in range(a, a + n):
            assert by_string.setdefault(raw[p:p + 50], key) == key
