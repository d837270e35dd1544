"""Plain SQL for the operators whose whole result SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"[^\x20\x09-\x0D]+"

# Every pair of documents that share a run of words, and everything reachable over links.
_NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORDS}') AS words
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, shingle FROM (
        SELECT doc_id, unnest(CASE WHEN len(words) >= 5
            THEN [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)]
            WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w)),
n AS (SELECT w.doc_id, count(shingle) AS n FROM w LEFT JOIN s ON w.doc_id = s.doc_id GROUP BY w.doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle
    GROUP BY a.doc_id, b.doc_id),
pairs AS (
    SELECT a, b, x.n = common AND y.n = common AS same FROM shared JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
    WHERE 100 * common >= 75 * (x.n + y.n - common)),
reach AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a)
SELECT n.doc_id, n.n AS n_shingles, coalesce(component, n.doc_id) AS component_id,
       coalesce(component, n.doc_id) = n.doc_id AS kept, coalesce(class, n.doc_id) AS class_id
FROM n LEFT JOIN (SELECT a, min(b) AS component FROM reach GROUP BY a) r ON n.doc_id = r.a
LEFT JOIN (SELECT a, min(b) AS class FROM pairs WHERE same GROUP BY a) c ON n.doc_id = c.a"""

_REPEATED_PASSAGES = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS words FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS passage
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50)),
first AS (SELECT passage, min(doc_id) AS least FROM windows GROUP BY passage),
gone AS (
    SELECT DISTINCT doc_id, place FROM (
        SELECT doc_id, unnest(range(i, i + 50)) AS place FROM windows JOIN first USING (passage) WHERE least < doc_id)),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
    FROM each ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

_FILL_IN_MIDDLE = r"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens FROM documents),
d AS (
    SELECT *, len(tokens) AS n, [CAST('0x' || h[1 + 8 * k:8 + 8 * k] AS BIGINT) FOR k IN range(0, 4)] AS draws FROM t),
c AS (
    SELECT doc_id, text, tokens, n, least(draws[1] % (n + 1), draws[2] % (n + 1)) AS p, greatest(draws[1] % (n + 1), draws[2] % (n + 1)) AS m,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                  OR draws[3] % 100 >= 90 THEN 'plain' WHEN draws[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
x AS (
    SELECT *, array_to_string(tokens[1:p], '') AS prefix, array_to_string(tokens[p + 1:m], '') AS middle,
           array_to_string(tokens[m + 1:n], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM x"""

ORACLE = {
    "op1_minhash_near_dedup": _NEAR_DUPLICATES,
    "op10_substring_dedup": _REPEATED_PASSAGES,
    "op12_fill_in_middle": _FILL_IN_MIDDLE,
}
