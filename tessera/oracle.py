"""DuckDB SQL equivalents of the registered queries (views named after the
test tables).  Column names and rounding match :mod:`tessera.jobs`."""

from __future__ import annotations

from . import jobs as J

_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]{2,}')"
_DOCS = f"SELECT doc_id, {_TOKENS} AS toks FROM documents WHERE text IS NOT NULL AND length(trim(text)) > 0"
_YEAR = (f"o_orderdate >= TIMESTAMP '{J.YEAR}-01-01 00:00:00' "
         f"AND o_orderdate < TIMESTAMP '{J.YEAR + 1}-01-01 00:00:00'")
_BUYERS = f"SELECT o_custkey FROM orders WHERE o_orderstatus = '{J.BUYER_STATUS}' AND {_YEAR}"
_BUCKET = "((('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8))::BIGINT) % 10)"

_TC = f"""tok AS (SELECT doc_id, unnest(toks) AS word FROM ({_DOCS}) WHERE len(toks) > 0),
tc AS (SELECT doc_id, word, count(*) AS tf FROM tok GROUP BY doc_id, word),
m AS (SELECT count(DISTINCT doc_id) AS m FROM tc),
dfreq AS (SELECT word, count(*) AS df, ln((m.m + 1.0) / (count(*) + 1.0)) AS idf FROM tc, m GROUP BY word, m.m),
scores AS (SELECT tc.doc_id, tc.word, tc.tf, tc.tf * dfreq.idf AS tfidf FROM tc JOIN dfreq USING (word))"""

_FIRSTS = f"""ev AS (SELECT user_id, CAST(ts AS DATE) AS day, ts, event_id, event_type AS page
            FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL),
hit AS (SELECT user_id, day, ts AS hts, event_id AS hid FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, event_id) AS rn
          FROM ev WHERE page = '{J.TARGET_PAGE}') WHERE rn = 1),
bef AS (SELECT e.* FROM ev e JOIN hit h USING (user_id, day)
        WHERE e.ts < h.hts OR (e.ts = h.hts AND e.event_id < h.hid)),
firsts AS (SELECT user_id, day, page, ts, event_id FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, day, page ORDER BY ts, event_id) AS rn FROM bef)
        WHERE rn = 1)"""


def _itemsets(baskets_cte: str, min_support: float, max_size: int = 4) -> str:
    """Frequent itemsets of ``b(bk, item)`` (distinct rows) by self-joins, sizes 1..max_size.  Larger
    frequent sets, if the data held any, would show as missing rows here, not pass unseen."""
    levels = []
    for k in range(1, max_size + 1):
        aliases = [f"x{i}" for i in range(k)]
        frm = " JOIN ".join(
            f"b {a}" + ("" if i == 0 else f" ON {a}.bk = x0.bk AND {aliases[i - 1]}.item < {a}.item")
            for i, a in enumerate(aliases))
        items = " || ',' || ".join(f"{a}.item" for a in aliases)
        levels.append(f"SELECT {items} AS items, count(*) AS freq, {k} AS size FROM {frm} GROUP BY ALL")
    union = "\nUNION ALL ".join(levels)
    return f"""WITH {baskets_cte},
nb AS (SELECT count(DISTINCT bk) AS n FROM b),
lv AS ({union})
SELECT items, freq, CAST(size AS INTEGER) AS size FROM lv WHERE freq >= (SELECT ceil({min_support} * n) FROM nb)"""


def _users_sql() -> str:
    return f"""buyers AS (SELECT DISTINCT o_custkey FROM ({_BUYERS})),
users AS (SELECT c_custkey, c_name,
                 CASE WHEN b.o_custkey IS NOT NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
                 CASE WHEN {_BUCKET} < 8 THEN 'train' ELSE 'test' END AS split,
                 c_mktsegment AS v0, CAST(c_nationkey AS VARCHAR) AS v1
          FROM customer LEFT JOIN buyers b ON c_custkey = b.o_custkey),
pv AS (SELECT c_custkey, label, split, 0 AS pos, v0 AS value FROM users
       UNION ALL SELECT c_custkey, label, split, 1 AS pos, v1 AS value FROM users),
dict AS (SELECT pos, value, row_number() OVER (ORDER BY pos, value) - 1 AS ix
         FROM (SELECT DISTINCT pos, value FROM pv WHERE split = 'train')),
enc AS (SELECT u.c_custkey, u.label, u.split,
               coalesce(d0.ix, 0)::DOUBLE AS f0, coalesce(d1.ix, 0)::DOUBLE AS f1
        FROM users u LEFT JOIN dict d0 ON d0.pos = 0 AND d0.value IS NOT DISTINCT FROM u.v0
                     LEFT JOIN dict d1 ON d1.pos = 1 AND d1.value IS NOT DISTINCT FROM u.v1)"""


def _svm_sql() -> str:
    """Chained CTEs, one gradient step per iteration, with the same early stop."""
    parts = [_users_sql(),
             "tr AS (SELECT label, f0, f1, 2.0 * label - 1.0 AS s FROM enc WHERE split = 'train')",
             "w0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b, false AS conv)"]
    for i in range(1, J.SVM_ITERATIONS + 1):
        p = f"w{i - 1}"
        st = f"(1.0::DOUBLE / sqrt({i}::DOUBLE))"
        parts.append(f"""g{i} AS (SELECT count(*) AS n,
    sum(CASE WHEN 1.0 > tr.s * (tr.f0 * w.a + tr.f1 * w.b) THEN -tr.s * tr.f0 ELSE 0.0 END) AS ga,
    sum(CASE WHEN 1.0 > tr.s * (tr.f0 * w.a + tr.f1 * w.b) THEN -tr.s * tr.f1 ELSE 0.0 END) AS gb
  FROM tr, {p} w)""")
        parts.append(f"""u{i} AS (SELECT w.conv,
    w.a AS pa, w.b AS pb,
    CASE WHEN w.conv THEN w.a ELSE w.a * (1.0 - {st} * 0.01) + (-{st}) * (g.ga / g.n) END AS a,
    CASE WHEN w.conv THEN w.b ELSE w.b * (1.0 - {st} * 0.01) + (-{st}) * (g.gb / g.n) END AS b
  FROM {p} w, g{i} g)""")
        check = "false" if i == 1 else (
            "sqrt((a - pa) * (a - pa) + (b - pb) * (b - pb)) < 0.001 * greatest(sqrt(a * a + b * b), 1.0)")
        parts.append(f"w{i} AS (SELECT a, b, conv OR ({check}) AS conv FROM u{i})")
    parts.append(f"wf AS (SELECT a, b FROM w{J.SVM_ITERATIONS})")
    parts.append("scored AS (SELECT e.c_custkey, e.label, e.f0 * wf.a + e.f1 * wf.b AS score "
                 "FROM enc e, wf WHERE e.split = 'test')")
    return "WITH " + ",\n".join(parts)


def _wide_sql() -> str:
    """Slots of three features (the last wide), the entries of each row, ``enc`` with the joined slots."""
    positions = " UNION ALL ".join(
        f"SELECT c_custkey, label, split, {i} AS pos, {v} AS value FROM wusers" for i, v in enumerate(("v0", "v1", "v2")))
    return f"""wbuyers AS (SELECT DISTINCT o_custkey FROM ({_BUYERS})),
wusers AS MATERIALIZED (SELECT c_custkey, CASE WHEN b.o_custkey IS NOT NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS label,
                 CASE WHEN {_BUCKET} < 8 THEN 'train' ELSE 'test' END AS split, c_mktsegment AS v0,
                 CAST(c_nationkey AS VARCHAR) AS v1, CAST(CAST(floor(c_acctbal / {J.BALANCE_STEP}) AS BIGINT) AS VARCHAR) AS v2
          FROM customer LEFT JOIN wbuyers b ON c_custkey = b.o_custkey),
wpv AS MATERIALIZED ({positions}),
wdict AS MATERIALIZED (SELECT pos, value, row_number() OVER (ORDER BY pos, value) - 1 + pos AS slot
         FROM (SELECT DISTINCT pos, value FROM wpv WHERE split = 'train')),
wrest AS (SELECT p.pos, (SELECT count(*) FROM wdict d WHERE d.pos <= p.pos) + p.pos AS slot
          FROM (SELECT unnest([0, 1, 2]) AS pos) p),
ent AS MATERIALIZED (SELECT c_custkey, label, split, wpv.pos, coalesce(d.slot, r.slot)::BIGINT AS slot
        FROM wpv JOIN wrest r ON wpv.pos = r.pos LEFT JOIN wdict d ON d.pos = wpv.pos AND d.value IS NOT DISTINCT FROM wpv.value)"""


def _wide_svm_sql() -> str:
    """One table of weights for each iteration, joined to the entries by slot, with the same early stop."""
    parts = [_wide_sql(), "te AS MATERIALIZED (SELECT c_custkey, slot, 2.0 * label - 1.0 AS s FROM ent WHERE split = 'train')",
             "tn AS (SELECT count(DISTINCT c_custkey)::DOUBLE AS n FROM te)",
             "x0 AS MATERIALIZED (SELECT DISTINCT slot, 0.0::DOUBLE AS weight FROM te)",
             "stop0 AS (SELECT false AS conv)"]
    for i in range(1, J.SVM_ITERATIONS + 1):
        p, st = i - 1, f"(1.0::DOUBLE / sqrt({i}::DOUBLE))"
        parts.append(f"""mar{i} AS (SELECT c_custkey, sum(weight) AS m FROM te JOIN x{p} USING (slot) GROUP BY c_custkey)""")
        parts.append(f"""gr{i} AS (SELECT slot, sum(CASE WHEN 1.0 > s * m THEN -s ELSE 0.0 END) AS g
    FROM te JOIN mar{i} USING (c_custkey) GROUP BY slot)""")
        parts.append(f"""x{i} AS MATERIALIZED (SELECT slot, CASE WHEN conv THEN weight
        ELSE weight * (1.0 - {st} * 0.01) - {st} * g / n END AS weight FROM x{p} JOIN gr{i} USING (slot), tn, stop{p})""")
        check = "false" if i == 1 else (f"(SELECT sqrt(sum((a.weight - b.weight) ** 2)) < 0.001 * greatest(sqrt(sum(a.weight ** 2)), 1.0) "
                                        f"FROM x{i} a JOIN x{p} b USING (slot))")
        parts.append(f"stop{i} AS MATERIALIZED (SELECT conv OR {check} AS conv FROM stop{p})")
    parts.append(f"""wscored AS (SELECT c_custkey, label, sum(coalesce(weight, 0.0)) AS score
    FROM ent LEFT JOIN x{J.SVM_ITERATIONS} USING (slot) WHERE split = 'test' GROUP BY c_custkey, label)""")
    return "WITH " + ",\n".join(parts)


# The word of a hashed term is its bucket; the rest is the TF-IDF above.
_HASHED = _TC.replace(
    "unnest(toks) AS word FROM",
    "unnest(list_transform(toks, lambda w: ('0x' || substr(md5(w), 1, 8))::BIGINT % "
    f"{J.HASH_BUCKETS})) AS word FROM")

_JSON_STEPS = f"""js AS (
    SELECT event_id, 0 AS step, event_type AS page, '{J.JSON_SHOW}' AS type FROM events
    UNION ALL SELECT event_id, 1, 'p' || (event_id % 3), CASE WHEN event_id % 3 = 0 THEN 'click' ELSE '{J.JSON_SHOW}' END FROM events
    UNION ALL SELECT event_id, 2, CASE WHEN event_id % 2 = 0 THEN substr(event_type, 1, 4) ELSE event_type END, '{J.JSON_SHOW}' FROM events
    UNION ALL SELECT event_id, 3, CASE WHEN event_id % 4 = 0 THEN 'end' ELSE '{J.JSON_TARGET}' END, '{J.JSON_SHOW}' FROM events
    UNION ALL SELECT event_id, 4, 'after', '{J.JSON_SHOW}' FROM events),
sound AS (SELECT * FROM js WHERE event_id % 10 != 9)"""

SQL: dict[str, str] = {
    "range_filter": f"SELECT c_name FROM customer WHERE c_nationkey >= {J.TEEN_LOW} AND c_nationkey <= {J.TEEN_HIGH}",
    "format_row": f"""SELECT c_custkey,
        'Name: ' || coalesce(c_name, 'null') || ', Segment: ' || coalesce(c_mktsegment, 'null') AS line
        FROM customer WHERE c_nationkey >= {J.TEEN_LOW} AND c_nationkey <= {J.TEEN_HIGH}""",
    "delimited_parse": "SELECT c_name AS name, c_nationkey AS age FROM customer",
    "nested_field": "SELECT event_id, CAST(user_id AS VARCHAR) AS name, event_type AS city FROM events",
    "json_schema_infer": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "map_to_json": "SELECT event_id, json_object('message', event_type, 'user', CAST(user_id AS VARCHAR))::VARCHAR AS json FROM events",
    "json_required_fields": """SELECT c_custkey, c_name AS email, 'u/' || CAST(c_custkey AS VARCHAR) AS link,
        c_mktsegment AS gender, c_name AS name FROM customer
        WHERE c_acctbal > 0 AND c_name IS NOT NULL AND c_mktsegment IS NOT NULL""",
    "contains_filter": f"SELECT doc_id FROM documents WHERE contains(text, '{J.NEEDLE}')",
    "year_text_filter": f"SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE {_YEAR}",
    "word_count_top20": f"""SELECT word, count(*) AS n FROM (SELECT unnest(toks) AS word FROM ({_DOCS}))
        GROUP BY word ORDER BY n DESC, word LIMIT {J.TOP_K}""",
    "idf": f"WITH {_TC} SELECT word, df, round(idf, 6) AS idf FROM dfreq",
    "tfidf": f"WITH {_TC} SELECT doc_id, word, tf, round(tfidf, 6) AS tfidf FROM scores",
    "doc_keyword": f"""WITH {_TC},
        r AS (SELECT doc_id, word, round(tfidf, 6) AS score,
                     row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, word) AS rn FROM scores)
        SELECT doc_id, word, score FROM r WHERE rn = 1""",
    "text_tokens": f"""SELECT doc_id, CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS pos, unnest(toks) AS token
        FROM ({_DOCS}) WHERE len(toks) > 0""",
    "tokens_joined": f"SELECT doc_id, array_to_string(toks, ' ') AS text FROM ({_DOCS}) WHERE len(toks) > 0",
    # trailing white space first: empty words at the end are dropped
    "whitespace_tokens": r"""WITH t AS (
            SELECT doc_id, lower(text) AS t, regexp_replace(lower(text), '[ \t\n\x0B\f\r]+$', '') AS body
            FROM documents WHERE text IS NOT NULL),
        w AS (SELECT doc_id, CASE WHEN t = '' THEN [''] WHEN body = '' THEN []
                     ELSE regexp_split_to_array(body, '[ \t\n\x0B\f\r]') END AS w FROM t)
        SELECT doc_id, array_to_string(w, ' ') AS words, len(w)::INTEGER AS n_words FROM w""",
    "year_locate_filter": f"""SELECT o_orderkey, o_custkey, o_orderdate FROM orders
        WHERE strpos(CAST(o_orderdate AS VARCHAR), '{J.YEAR}') > 0""",
    "tfidf_hashed": f"WITH {_HASHED} SELECT doc_id, word AS bucket, tf, round(tfidf, 6) AS tfidf FROM scores",
    "trail_events": f"""WITH {_JSON_STEPS}
        SELECT event_id, CAST(step AS INTEGER) AS step, page, type,
               (SELECT ts IS NOT NULL FROM events e WHERE e.event_id = sound.event_id) AS timed FROM sound""",
    "path_to_target_json": f"""WITH {_JSON_STEPS},
        shown AS (SELECT event_id, page, min(step) AS step FROM sound
                  WHERE type = '{J.JSON_SHOW}' AND step < 3 AND event_id % 4 != 0 GROUP BY event_id, page),
        -- a later page is left out if it is part of the earlier ones joined with commas
        parts AS (SELECT s.event_id, s.page, s.step FROM shown s WHERE NOT EXISTS (
                  SELECT 1 FROM shown e WHERE e.event_id = s.event_id AND e.step < s.step AND contains(e.page, s.page)))
        SELECT event_id, 'exact' AS dedup, string_agg(page, ',' ORDER BY step) AS path FROM shown GROUP BY event_id
        UNION ALL
        SELECT event_id, 'substring' AS dedup, string_agg(page, ',' ORDER BY step) AS path FROM parts GROUP BY event_id""",
    "category_onehot": f"""WITH {_users_sql()}, widths AS (SELECT max(f0) + 1 AS w0 FROM enc)
        SELECT c_custkey, label, split, CAST(f0 AS INTEGER) || ',' || CAST(w0 + f1 AS INTEGER) AS slots FROM enc, widths""",
    "path_to_target": f"""WITH {_FIRSTS}
        SELECT user_id, day, string_agg(page, ',' ORDER BY ts, event_id) AS path, CAST(count(*) AS INTEGER) AS n_pages
        FROM firsts GROUP BY user_id, day""",
    "path_itemsets": _itemsets(f"{_FIRSTS},\nb AS (SELECT DISTINCT user_id || '/' || CAST(day AS VARCHAR) AS bk, page AS item FROM firsts)",
                               J.PATH_SUPPORT),
    "frequent_itemsets": _itemsets(
        """b AS (SELECT DISTINCT l_orderkey AS bk, p_brand AS item
                 FROM lineitem JOIN part ON l_partkey = p_partkey
                 WHERE p_brand IS NOT NULL AND l_orderkey IS NOT NULL)""", J.BRAND_SUPPORT),
    "distinct_keys": f"SELECT DISTINCT o_custkey FROM ({_BUYERS}) WHERE o_custkey IS NOT NULL",
    "membership_label": f"WITH {_users_sql()} SELECT c_custkey, label FROM users",
    "semi_members": f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN ({_BUYERS})",
    "anti_members": f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM ({_BUYERS}) WHERE o_custkey IS NOT NULL)",
    "union_labeled": f"WITH {_users_sql()} SELECT c_custkey, label FROM users",
    "train_test_split": f"WITH {_users_sql()} SELECT c_custkey, split FROM users",
    "position_values": f"WITH {_users_sql()} SELECT c_custkey, CAST(pos AS INTEGER) AS pos, value FROM pv",
    "category_index": f"WITH {_users_sql()} SELECT CAST(pos AS INTEGER) AS pos, value, CAST(ix AS BIGINT) AS ix FROM dict",
    "category_encode": f"WITH {_users_sql()} SELECT c_custkey, label, split, f0, f1 FROM enc",
    "composite_record": f"""WITH {_users_sql()}
        SELECT c_custkey, CAST(c_custkey AS VARCHAR) || ',' || v0 || '::' || v1 || ',' || CAST(label AS VARCHAR) AS record,
               CAST(c_custkey AS VARCHAR) AS key, v0 || '|' || v1 AS features, CAST(label AS VARCHAR) AS label
        FROM users""",
    "svm_weights": _svm_sql() + """
        SELECT CAST(0 AS INTEGER) AS j, round(a, 6) AS weight FROM wf
        UNION ALL SELECT CAST(1 AS INTEGER) AS j, round(b, 6) AS weight FROM wf""",
    "svm_scores": _svm_sql() + "\nSELECT c_custkey, label, round(score, 6) AS score FROM scored",
    "svm_error_rate": _svm_sql() + """
        SELECT count(*) AS n, round(avg(CASE WHEN (CASE WHEN score > 0 THEN 1.0 ELSE 0.0 END) <> label
                                        THEN 1.0 ELSE 0.0 END), 6) AS error_rate FROM scored""",
    "category_slots": f"""WITH {_wide_sql()}
        SELECT c_custkey, label, split, string_agg(CAST(slot AS VARCHAR), ',' ORDER BY pos) AS slots FROM ent
        GROUP BY c_custkey, label, split""",
    "svm_onehot_weights": _wide_svm_sql() + f"""
        SELECT slot::BIGINT AS slot, CAST(pos AS INTEGER) AS pos, value, round(weight, 6) AS weight
        FROM x{J.SVM_ITERATIONS} JOIN wdict USING (slot)""",
    "svm_onehot_scores": _wide_svm_sql() + "\nSELECT c_custkey, label, round(score, 6) AS score FROM wscored",
    "svm_onehot_error_rate": _wide_svm_sql() + """
        SELECT count(*) AS n, round(avg(CASE WHEN (CASE WHEN score > 0 THEN 1.0 ELSE 0.0 END) <> label
                                        THEN 1.0 ELSE 0.0 END), 6) AS error_rate FROM wscored""",
}
