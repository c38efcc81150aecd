"""SQL for the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"
_BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(pattern: str, lower: bool = True) -> str:
    text = "coalesce(text, '')"
    return f"regexp_extract_all({f"translate({text}, '{_UPPER}', '{_LOWER}')" if lower else text}, '{pattern}')"


_QUALITY = rf"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS t, {_words(_WORD, lower=False)} AS w,
            list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l
        FROM documents
    ),
    windows AS (
        SELECT doc_id, p, w[p:p + 2] AS g FROM d, unnest(range(1, greatest(len(w) - 1, 1))) AS u(p)
    ),
    repeated AS (SELECT doc_id, g FROM windows GROUP BY ALL HAVING count(*) > 1),
    covered AS (
        SELECT doc_id, count(DISTINCT p + k) AS n FROM windows JOIN repeated USING (doc_id, g), unnest([0, 1, 2]) AS u(k)
        GROUP BY doc_id
    ),
    counted AS (
        SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
            len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
            coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines,
            len(regexp_extract_all(t, '\p{{L}}')) AS letters, len(regexp_extract_all(t, '\p{{Lu}}')) AS upper_letters
        FROM d LEFT JOIN covered USING (doc_id)
    ),
    judged AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 4 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 10 * letters < 5 * word_chars OR 10 * upper_letters > 6 * letters) AS kept
    FROM judged
"""

_NEAR = f"""
    WITH RECURSIVE d AS (SELECT doc_id, {_words(_WORD)} AS w FROM documents),
    sets AS (
        SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN CASE WHEN len(w) = 1 THEN [w] ELSE [] END
            ELSE list_transform(range(1, len(w)), lambda p: w[p:p + 1]) END) AS s
        FROM d
    ),
    members AS (SELECT doc_id, unnest(s) AS g FROM sets),
    common AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM members a JOIN members b USING (g)
        WHERE a.doc_id <> b.doc_id GROUP BY ALL
    ),
    links AS (
        SELECT x, y FROM common JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y
        WHERE 100 * c >= 80 * (len(a.s) + len(b.s) - c)
    ),
    reach AS (
        SELECT doc_id, doc_id AS other FROM sets
        UNION
        SELECT r.doc_id, links.y FROM reach r JOIN links ON links.x = r.other
    )
    SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM sets JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""

_CONTAMINATION = f"""
    WITH d AS (SELECT doc_id, {_words(_BENCH_WORD)} AS w FROM documents),
    items AS (
        SELECT item_id, w, least(13, len(w)) AS k FROM (SELECT item_id, {_words(_BENCH_WORD)} AS w FROM benchmark)
        WHERE len(w) > 0
    ),
    strings AS (
        SELECT DISTINCT item_id, k, w[p:p + k - 1] AS g FROM items, unnest(range(1, len(w) - k + 2)) AS u(p)
    ),
    windows AS (
        SELECT doc_id, k, p, w[p:p + k - 1] AS g
        FROM d, (SELECT DISTINCT k FROM items) AS ks, unnest(range(1, greatest(len(w) - k + 2, 1))) AS u(p)
    ),
    found AS (SELECT doc_id, p, k, item_id FROM windows JOIN strings USING (k, g)),
    hit AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM found) GROUP BY 1),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY 1
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(names, '')) AS items_sha256, coalesce(n, 0) > 0 AND 20 * n >= len(w) AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_ARCHIVE = """
    WITH paged AS (
        SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
        FROM pages
    ),
    stored AS (
        SELECT payload_digest, max(page_id) AS first_id FROM paged WHERE payload_bytes >= 1000 GROUP BY 1
    )
    SELECT p.page_id, p.payload_bytes, p.payload_digest,
        CASE WHEN s.first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN s.first_id <> p.page_id THEN s.first_id END AS refers_to
    FROM paged p LEFT JOIN stored s USING (payload_digest)
"""

_RESAMPLING = f"""
    WITH crc AS (
        SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i:
            CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
    ),
    d AS (SELECT doc_id, {_words(_BENCH_WORD)} AS w FROM documents),
    b AS (SELECT {_words(_BENCH_WORD)} AS w FROM benchmark),
    vocabulary AS (SELECT DISTINCT unnest(w) AS word FROM (SELECT w FROM d UNION ALL SELECT w FROM b)),
    coded AS (
        SELECT word, xor(4294967295, list_reduce(
            list_prepend(4294967295, list_transform(range(1, strlen(word) + 1),
                lambda i: CAST('0x' || substr(hex(encode(word)), CAST(2 * i - 1 AS BIGINT), 2) AS BIGINT))),
            lambda c, x: xor(c >> 8, steps[CAST(xor(c, x) & 255 AS BIGINT) + 1]))) % 10000 AS bucket
        FROM vocabulary, crc
    ),
    words AS (SELECT doc_id, unnest(w) AS word FROM d),
    s AS (SELECT bucket, count(*) AS n FROM words JOIN coded USING (word) GROUP BY 1),
    t AS (SELECT bucket, count(*) AS n FROM (SELECT unnest(w) AS word FROM b) JOIN coded USING (word) GROUP BY 1),
    gain AS (
        SELECT u.bucket, CAST(floor(1000 * ln(
            CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * (coalesce((SELECT sum(n) FROM s), 0) + 10000)
            / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * (coalesce((SELECT sum(n) FROM t), 0) + 10000)))) AS BIGINT) AS g
        FROM range(10000) AS u(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
    ),
    weighed AS (
        SELECT doc_id, CAST(sum(g) AS BIGINT) AS weight FROM words JOIN coded USING (word) JOIN gain USING (bucket) GROUP BY 1
    ),
    noise AS (
        SELECT doc_id, CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM documents
    ),
    scored AS (
        SELECT doc_id, len(w) AS n_features, coalesce(weight, 0) AS weight,
            coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS score
        FROM d JOIN noise USING (doc_id) LEFT JOIN weighed USING (doc_id)
    ),
    places AS (
        SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
        FROM scored WHERE n_features >= 20
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
    FROM scored LEFT JOIN places USING (doc_id)
"""

_REPEATS = """
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n
        FROM documents
    ),
    windows AS (
        SELECT r, p, md5(substr(h, 2 * p + 1, 400)) AS w FROM d, unnest(range(0, greatest(n - 199, 0))) AS u(p)
    ),
    again AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
    starts AS (SELECT r, p FROM windows JOIN again USING (w)),
    marked AS (SELECT r, p, CASE WHEN lag(p) OVER (PARTITION BY r ORDER BY p) >= p - 200 THEN 0 ELSE 1 END AS opens FROM starts),
    numbered AS (SELECT r, p, sum(opens) OVER (PARTITION BY r ORDER BY p) AS run FROM marked),
    runs AS (SELECT r, run, min(p) AS first, max(p) + 200 AS last FROM numbered GROUP BY ALL),
    gaps AS (
        SELECT r, coalesce(lag(last) OVER (PARTITION BY r ORDER BY first), 0) AS first, first AS last FROM runs
        UNION ALL
        SELECT r, max(last), NULL FROM runs GROUP BY r
    ),
    kept AS (
        SELECT r, string_agg(substr(h, 2 * first + 1, 2 * (coalesce(last, n) - first)), '' ORDER BY first) AS k
        FROM gaps JOIN d USING (r) GROUP BY r
    ),
    removed AS (SELECT r, sum(last - first) AS n_removed, count(*) AS n_spans FROM runs GROUP BY r)
    SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
        sha256(unhex(coalesce(k, h))) AS kept_sha256
    FROM d LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)
"""

ORACLES: dict[str, str] = {
    "op1_quality_cascade": _QUALITY,
    "op3_hyperminhash": _NEAR,
    "op5_wu_manber": _CONTAMINATION,
    "op6_capture_index": _ARCHIVE,
    "op9_run_length_index": _REPEATS,
    "op11_importance_resampling": _RESAMPLING,
}
