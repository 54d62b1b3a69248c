"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from dwellmart.llm.queries import URL_RULES
from dwellmart.llm.url_filter import HOST_WORDS

_LISTED = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in URL_RULES.items())
_WORDS = ", ".join(f"'{word}'" for word in HOST_WORDS)
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_URL_FILTER = f"""
    WITH places AS (
        SELECT page_id, {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
        FROM pages),
    rules AS (
        SELECT rule, verdict, split_part(rule, '/', 1) AS rule_host,
               substr(rule, length(split_part(rule, '/', 1)) + 1) AS rule_path
        FROM (VALUES {_LISTED}) AS listed(rule, verdict)),
    fits AS (
        SELECT DISTINCT ON (host, path) host, path, rule, verdict
        FROM (SELECT DISTINCT host, path FROM places)
        JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        ORDER BY host, path, length(rule) DESC, length(rule_host) DESC)
    SELECT p.page_id, p.host, p.path, f.rule,
           coalesce(f.verdict, CASE WHEN list_has_any(regexp_extract_all(p.host, '[a-z0-9]+'), [{_WORDS}])
                                    THEN 'block' ELSE 'allow' END) AS verdict
    FROM places p LEFT JOIN fits f ON p.host = f.host AND p.path = f.path"""

_HARD_NEGATIVES = """
    WITH sound AS (
        SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
    scores AS (
        SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
               CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
        FROM sound a JOIN sound b ON a.vec_id <> b.vec_id
        WHERE a.vec_id % 50 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores
        WHERE label = anchor_label
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    windowed AS (
        SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS place
        FROM positives JOIN scores USING (anchor_id)
        WHERE label <> anchor_label AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
    SELECT anchor_id, positive_id, CAST(place AS INT) AS rank, negative_id, positive_score, negative_score
    FROM windowed WHERE place <= 3"""

_REPEATS = """
    WITH texts AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
    placed AS (
        SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place, words FROM texts),
    windows AS (
        SELECT doc_id, place, array_to_string(words[place : place + 19], ' ') AS phrase
        FROM placed WHERE place + 19 <= len(words)),
    again AS (
        SELECT doc_id, place, row_number() OVER (PARTITION BY phrase ORDER BY doc_id, place) > 1 AS earlier FROM windows),
    judged AS (
        SELECT doc_id, place, word, coalesce(bool_or(earlier) OVER (
            PARTITION BY doc_id ORDER BY place ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), FALSE) AS removed
        FROM placed LEFT JOIN again USING (doc_id, place)),
    kept AS (
        SELECT doc_id, count(*) FILTER (removed) AS n_removed,
               coalesce(string_agg(word, ' ' ORDER BY place) FILTER (NOT removed), '') AS text
        FROM judged GROUP BY doc_id)
    SELECT doc_id, len(words) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM texts LEFT JOIN kept USING (doc_id)"""

_NGRAM_JOIN = f"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS words
        FROM documents),
    starts AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS place FROM texts WHERE len(words) > 0),
    shingles AS (SELECT DISTINCT doc_id, array_to_string(words[place : place + 3], ' ') AS shingle FROM starts),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS one, b.doc_id AS two, count(*) AS n
        FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
        SELECT one, two FROM common c JOIN sizes a ON a.doc_id = one JOIN sizes b ON b.doc_id = two
        WHERE 100 * c.n >= 85 * (a.n + b.n - c.n)),
    reached AS (
        SELECT one AS doc_id, two AS other FROM links
        UNION SELECT r.doc_id, l.two FROM reached r JOIN links l ON r.other = l.one),
    least AS (SELECT doc_id, min(other) AS other FROM reached GROUP BY doc_id)
    SELECT t.doc_id, coalesce(s.n, 0) AS n_shingles, least(t.doc_id, coalesce(l.other, t.doc_id)) AS component_id
    FROM texts t LEFT JOIN sizes s ON t.doc_id = s.doc_id LEFT JOIN least l ON t.doc_id = l.doc_id"""

ORACLE_SQL: dict[str, str] = {"op1_ngram_join": _NGRAM_JOIN, "op9_repeats": _REPEATS, "op11_url_filter": _URL_FILTER, "op13_hard_negatives": _HARD_NEGATIVES}
