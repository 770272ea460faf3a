"""DuckDB statements for the queries that SQL can express. They compare everything with everything and suit small tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), starts AS (
    SELECT item_id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS s FROM b WHERE len(w) > 0
), grams AS (
    SELECT DISTINCT item_id, list_aggregate(w[s + 1 : s + 10], 'string_agg', ' ') AS g, least(len(w), 10) AS n FROM starts
), places AS (
    SELECT r, w, unnest(range(len(w))) AS s FROM d
), sizes AS (
    SELECT DISTINCT n FROM grams
), slices AS (
    SELECT r, s, n, list_aggregate(w[s + 1 : s + n], 'string_agg', ' ') AS g FROM places JOIN sizes ON s + n <= len(w)
), hits AS (
    SELECT r, s, slices.n, item_id FROM slices JOIN grams ON slices.g = grams.g AND slices.n = grams.n
), hit_words AS (
    SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hits) GROUP BY r
), hit_items AS (
    SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit_words.n, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(hit_items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    hit_words.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

MIXING = r"""
WITH RECURSIVE rows_in AS (
    SELECT doc_id, source, coalesce('=' || source, '-') AS key,
        greatest(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 1) AS n_tokens,
        md5(concat_ws('|', coalesce('=' || CAST(doc_id AS VARCHAR), '-'), coalesce('=' || source, '-'), md5(coalesce(text, '')))) AS document
    FROM documents
), totals AS (
    SELECT key, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM rows_in GROUP BY key
), shares AS (
    SELECT key, tokens, tokens / CAST((SELECT sum(tokens) FROM totals) AS DOUBLE) AS p FROM totals
), bisect AS (
    SELECT 0 AS step, CAST(0 AS DOUBLE) AS low, CAST(1 AS DOUBLE) AS high
    UNION ALL
    SELECT step + 1,
        CASE WHEN within THEN low ELSE (low + high) / 2 END,
        CASE WHEN within THEN (low + high) / 2 ELSE high END
    FROM (
        SELECT step, low, high,
            (SELECT max(pow(p, (low + high) / 2) / p) / sum(pow(p, (low + high) / 2)) FROM shares) <= 1.25 AS within
        FROM bisect WHERE step < 32
    )
), exponent AS (
    SELECT CASE WHEN (SELECT max(1 / p) / count(*) FROM shares) <= 1.25 THEN 0 ELSE (SELECT high FROM bisect WHERE step = 32) END AS e
), quotas AS (
    SELECT key, tokens, CAST(floor(
        pow(p, e) / (SELECT sum(pow(p, e)) FROM shares, exponent) * (SELECT sum(tokens) FROM totals) + 0.5) AS BIGINT) AS quota
    FROM shares, exponent
), blocks AS (
    SELECT greatest(1, CAST(ceil(sum(quota) / 65536.0) AS BIGINT)) AS n FROM quotas
), passes AS (
    SELECT key, tokens, quota, unnest(range((quota + tokens - 1) // tokens)) AS epoch FROM quotas WHERE quota > 0
), taken AS (
    SELECT doc_id, source, key, n_tokens, tokens, quota, epoch,
        md5(concat_ws('|', '0', CAST(epoch AS VARCHAR), document)) AS ord
    FROM rows_in JOIN passes USING (key)
), placed AS (
    SELECT *, epoch * tokens + coalesce(sum(n_tokens) OVER (
        PARTITION BY key, epoch ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM taken
), blocked AS (
    SELECT *, CAST(start // ((quota + n - 1) // n) AS BIGINT) AS block FROM placed, blocks WHERE start < quota
)
SELECT block, row_number() OVER (PARTITION BY block ORDER BY substr(ord, 17, 16), ord) AS place,
    doc_id, source, CAST(epoch AS BIGINT) AS epoch, CAST(n_tokens AS BIGINT) AS n_tokens
FROM blocked
"""

JACCARD = rf"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
    SELECT r, w, unnest(range(greatest(len(w) - 4, 0) + 1)) AS s FROM d WHERE len(w) > 0
), grams AS (
    SELECT DISTINCT r, list_aggregate(w[s + 1 : s + 4], 'string_agg', ' ') AS g FROM places
), sizes AS (
    SELECT r, count(*) AS n FROM grams GROUP BY r
), shared_grams AS (
    SELECT x.r AS a, y.r AS b, count(*) AS n FROM grams x JOIN grams y ON x.g = y.g AND x.r < y.r GROUP BY x.r, y.r
), links AS (
    SELECT a, b FROM shared_grams o JOIN sizes p ON o.a = p.r JOIN sizes q ON o.b = q.r WHERE 100 * o.n >= 85 * (p.n + q.n - o.n)
), both_ways AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (
    SELECT DISTINCT a AS r, a AS other FROM both_ways
    UNION
    SELECT reached.r, both_ways.b FROM reached JOIN both_ways ON reached.other = both_ways.a
), smallest AS (
    SELECT reached.r, min(d.doc_id) AS c FROM reached JOIN d ON d.r = reached.other GROUP BY reached.r
)
SELECT d.doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles, coalesce(smallest.c, d.doc_id) AS component_id
FROM d LEFT JOIN sizes USING (r) LEFT JOIN smallest USING (r)
"""

QUALITY_RULES = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), lines AS (
    SELECT r, line, count(*) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line
), line_counts AS (
    SELECT r, sum(n) AS n_lines, sum(n - 1) AS n_dup_lines FROM lines GROUP BY r
), places AS (
    SELECT r, w, unnest(range(len(w) - 7)) AS s FROM d WHERE len(w) > 8
), windows AS (
    SELECT r, s, list_aggregate(w[s + 1 : s + 8], 'string_agg', ' ') AS g FROM places
), repeated AS (
    SELECT r, g FROM windows GROUP BY r, g HAVING count(*) > 1
), covered AS (
    SELECT r, count(DISTINCT p) AS n
    FROM (SELECT windows.r, unnest(range(s, s + 8)) AS p FROM windows JOIN repeated ON windows.r = repeated.r AND windows.g = repeated.g)
    GROUP BY r
), measures AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
    FROM d LEFT JOIN line_counts USING (r) LEFT JOIN covered USING (r)
), judged AS (
    SELECT *, CAST(
        CASE WHEN n_words < 20 THEN 1 ELSE 0 END
        | CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
        | CASE WHEN 10 * n_symbols > 2 * n_words THEN 4 ELSE 0 END
        | CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
        | CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
        | CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END AS BIGINT) AS failed_bits
    FROM measures
)
SELECT *, (failed_bits & 3) != 0 AS base_failed, failed_bits = 0 AS kept FROM judged
"""



def _vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Full scans in every round; one pair of subqueries per round."""
    steps = [
        """rows_in AS (
    SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""cut AS (
    SELECT r, p, CAST(x[p * (len(x) // {parts}) + 1 : (p + 1) * (len(x) // {parts})] AS DOUBLE[]) AS v
    FROM rows_in, range({parts}) AS t(p)
)""",
        f"""book0 AS (
    SELECT p, e, v FROM cut JOIN (
        SELECT r, row_number() OVER (ORDER BY vec_id, x) - 1 AS e FROM rows_in QUALIFY e < {entries}
    ) USING (r)
)""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""near{i} AS MATERIALIZED (
    SELECT r, p, min({{'d': CAST(list_inner_product(c.v, c.v) + list_inner_product(b.v, b.v) - 2 * list_inner_product(c.v, b.v) AS BIGINT), 'e': e}}) AS best
    FROM cut c JOIN book{i} b USING (p) GROUP BY r, p
)"""
        )
        if i < rounds:
            steps.append(
                f"""book{i + 1} AS MATERIALIZED (
    WITH means AS (
        SELECT p, e, list(floor(total / n) ORDER BY j) AS v FROM (
            SELECT p, best.e AS e, j, CAST(sum(v[j]) AS DOUBLE) AS total, count(*) AS n
            FROM near{i} JOIN cut USING (r, p), range(1, 4097) AS t(j) WHERE j <= len(v) GROUP BY p, best.e, j
        ) GROUP BY p, e
    )
    SELECT p, e, coalesce(means.v, book{i}.v) AS v FROM book{i} LEFT JOIN means USING (p, e)
)"""
            )
    return (
        "WITH "
        + ", ".join(steps)
        + f"""
, books AS (
    SELECT sha256(string_agg(text, ',' ORDER BY p, e)) AS codebooks_sha256
    FROM (SELECT p, e, array_to_string(list_transform(v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',') AS text FROM book{rounds})
), codes AS (
    SELECT r, string_agg(lower(lpad(hex(best.e), 2, '0')), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
    FROM near{rounds} GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM rows_in JOIN codes USING (r), books
"""
    )


VECTOR_CODES = _vector_codes()

ORACLES = {
    "op1_decontamination": DECONTAMINATION,
    "op2_mixing": MIXING,
    "op4_ngram_jaccard": JACCARD,
    "op6_quality_rules": QUALITY_RULES,
    "op13_vector_codes": VECTOR_CODES,
}
