"""SQL of the queries that SQL can express."""

from __future__ import annotations


def _field(value: str) -> str:
    return f"coalesce(strlen(cast({value} AS VARCHAR)) || ':' || cast({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


#: Bit by bit over the bytes of the decimal number; 3988292384 is the reversed polynomial of crc32.
_CRC = """xor(4294967295, list_reduce(
    list_transform(string_split(cast(doc_id AS VARCHAR), ''), lambda c: cast(ascii(c) AS BIGINT)),
    lambda crc, byte: list_reduce(range(8), lambda bits, k: CASE WHEN bits & 1 = 1 THEN xor(bits >> 1, 3988292384) ELSE bits >> 1 END, xor(crc, byte)),
    cast(4294967295 AS BIGINT)))"""

_NEXT = "list_transform(range(0, len(d), 2), lambda i: sha256(d[i + 1] || coalesce(d[i + 2], '')))"

MERKLE = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
        CASE WHEN {_CRC} % 7 = 0 AND n_chars IS NOT NULL THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS told,
    FROM documents
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, row_number() OVER () AS leaf_row FROM leaves
), lang_levels AS (
    SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS d FROM placed GROUP BY lang
    UNION ALL SELECT lang, level + 1, {_NEXT} FROM lang_levels WHERE len(d) > 1
), subroots AS (
    SELECT lang, level AS depth, d[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM lang_levels WHERE len(d) = 1
), top_levels AS (
    SELECT 0 AS level, list(subroot ORDER BY place) AS d FROM subroots
    UNION ALL SELECT level + 1, {_NEXT} FROM top_levels WHERE len(d) > 1
), steps AS (
    SELECT leaf_row, l.level AS step, (pos >> l.level) % 2 = 1 AS on_right, CASE WHEN (pos >> l.level) % 2 = 1 THEN l.d[pos >> l.level] ELSE coalesce(l.d[(pos >> l.level) + 2], '') END AS sibling
    FROM placed p JOIN lang_levels l ON p.lang IS NOT DISTINCT FROM l.lang WHERE len(l.d) > 1
    UNION ALL
    SELECT leaf_row, s.depth + t.level, (place >> t.level) % 2 = 1, CASE WHEN (place >> t.level) % 2 = 1 THEN t.d[place >> t.level] ELSE coalesce(t.d[(place >> t.level) + 2], '') END
    FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang CROSS JOIN top_levels t WHERE len(t.d) > 1
), paths AS (
    SELECT leaf_row, list({{'sibling': sibling, 'on_right': on_right}} ORDER BY step) AS path FROM steps GROUP BY leaf_row
), proofs AS (
    SELECT p.doc_id, p.leaf, s.subroot, (SELECT d[1] FROM top_levels WHERE len(d) = 1) AS root,
        sha256(coalesce(array_to_string(list_transform(path, lambda x: x.sibling), ''), '')) AS proof_sha256,
        coalesce(list_reduce(path, lambda node, x: {{'sibling': sha256(CASE WHEN x.on_right THEN x.sibling || node.sibling ELSE node.sibling || x.sibling END), 'on_right': false}}, {{'sibling': told, 'on_right': false}}).sibling, told) AS folded_root
    FROM placed p JOIN subroots s ON p.lang IS NOT DISTINCT FROM s.lang LEFT JOIN paths USING (leaf_row)
)
SELECT *, folded_root = root AS verified FROM proofs
"""

#: Of equal payloads of 1,000 bytes or more the one with the largest page_id is kept.
WARC = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload FROM pages
), measured AS (
    SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest,
        row_number() OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) AS copy,
        first_value(page_id) OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) AS original
    FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND copy > 1 THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND copy > 1 THEN original END AS refers_to
FROM measured
"""
