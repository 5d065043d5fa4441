"""The registered queries of the training-data operators in SQL, where SQL can express them."""

from __future__ import annotations

from tripmart.llm.licenses import LEAST, TEMPLATES

_TEMPLATES = ", ".join(f"('{name}', '{notice}')" for name, notice in TEMPLATES)

LOW = LEAST / (2 - LEAST)

_LICENSES = f"""
WITH template AS (
    SELECT license, list_filter(string_split(regexp_replace(lower(notice), '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '') AS w
    FROM (VALUES {_TEMPLATES}) AS t(license, notice)
), template_bigram AS (
    SELECT DISTINCT license, w[i] || ' ' || w[i + 1] AS bigram FROM template, unnest(range(1, len(w))) AS r(i)
), template_size AS (
    SELECT license, count(*) AS size FROM template_bigram GROUP BY license
), clean AS (
    SELECT doc_id, regexp_replace(lower(text), '[^a-z0-9\\n]+', ' ', 'g') AS clean FROM documents WHERE text IS NOT NULL
), unit AS (
    SELECT doc_id, unnest(list_distinct(list_concat(
        string_split(clean, chr(10)),
        list_transform(string_split_regex(clean, '\\n *\\n'), lambda p: replace(p, chr(10), ' ')),
        [replace(clean, chr(10), ' ')]))) AS unit
    FROM clean
    UNION ALL
    SELECT doc_id, unnest(list_transform(string_split_regex(lower(text), '[.!?;][\\t-\\r ]+'), lambda s: regexp_replace(s, '[^a-z0-9]+', ' ', 'g')))
    FROM documents WHERE text IS NOT NULL
), whole AS (
    SELECT doc_id, list_filter(string_split(replace(clean, chr(10), ' '), ' '), lambda w: w <> '') AS w FROM clean
), placed AS (
    SELECT doc_id, i AS place, w[i] || ' ' || w[i + 1] AS bigram FROM whole, unnest(range(1, len(w))) AS r(i)
), hit AS (
    SELECT doc_id, license, place, len(w) AS n_words, lead(place, (ceil(size * {LOW} - 1e-9) - 1)::BIGINT)
        OVER (PARTITION BY doc_id, license ORDER BY place) AS enough
    FROM placed JOIN template_bigram USING (bigram) JOIN template_size USING (license) JOIN template USING (license)
), inner_unit AS (
    SELECT doc_id, whole.w[greatest(1, least(place, len(whole.w) - n_words + 1)) :][: n_words] AS w
    FROM hit JOIN whole USING (doc_id) WHERE enough <= place + n_words - 2
), word AS (
    SELECT DISTINCT doc_id, list_filter(string_split(unit, ' '), lambda w: w <> '') AS w FROM unit
    UNION
    SELECT doc_id, w FROM inner_unit
), gram AS (
    SELECT doc_id, w AS unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
    FROM word WHERE len(w) > 1
), pair AS (
    SELECT doc_id, unit, license, size, len(g) AS n, unnest(g) AS bigram FROM gram, template_size
    WHERE len(g) BETWEEN size * {LEAST} / (2 - {LEAST}) AND size * (2 - {LEAST}) / {LEAST}
), dice AS (
    SELECT doc_id, license, unit, 2.0::DOUBLE * count(*) / (n + size) AS dice
    FROM pair JOIN template_bigram USING (license, bigram) GROUP BY doc_id, license, unit, n, size
)
SELECT doc_id, license, max(dice) AS dice, count(*) AS n_units FROM dice WHERE dice >= {LEAST} GROUP BY doc_id, license
"""

def _given(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


# The last bit of a CRC-32 before its final inversion: 1 where the checksum is even.
_CRC_BIT = """list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda x, i: xor(x >> 1, (x & 1) * 3988292384))) & 1"""

_MERKLE = f"""
WITH RECURSIVE given AS (
    SELECT doc_id, source, text, {" || ".join(map(_given, ("doc_id", "source", "lang", "n_chars")))} AS head FROM documents
), leaf AS (
    SELECT doc_id, source, sha256(head || {_given("text")}) AS leaf,
        CASE WHEN {_CRC_BIT} = 1 THEN sha256(head || {_given("replace(text, chr(10), '')")}) ELSE sha256(head || {_given("text")}) END AS changed
    FROM given
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM leaf
), tree AS (
    SELECT source, 0 AS level, place, leaf AS digest, n FROM placed
    UNION ALL
    SELECT source, level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 2) // 3
    FROM tree WHERE n > 1 GROUP BY source, level, place // 3
), subroot AS (
    SELECT source, digest, level, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1
), top AS (
    SELECT 0 AS level, place, digest, n FROM subroot
    UNION ALL
    SELECT level + 1, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 2) // 3
    FROM top WHERE n > 1 GROUP BY level, place // 3
), beside AS (
    SELECT a.source, a.level, a.place, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS l,
        coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS r
    FROM tree a JOIN tree b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.place // 3 = b.place // 3
    WHERE a.n > 1 GROUP BY a.source, a.level, a.place
), above AS (
    SELECT a.level, a.place, coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS l,
        coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS r
    FROM top a JOIN top b ON a.level = b.level AND a.place // 3 = b.place // 3 WHERE a.n > 1 GROUP BY a.level, a.place
), up AS (
    SELECT doc_id, leaf, source, 0 AS level, place, n, '' AS proof, changed AS folded FROM placed
    UNION ALL
    SELECT doc_id, leaf, u.source, u.level + 1, u.place // 3, (n + 2) // 3, proof || l || r, sha256(l || folded || r)
    FROM up u JOIN beside b ON u.source IS NOT DISTINCT FROM b.source AND u.level = b.level AND u.place = b.place WHERE n > 1
), on_top AS (
    SELECT doc_id, leaf, s.digest AS subroot, 0 AS level, s.place, s.n, proof, folded
    FROM up u JOIN subroot s ON u.source IS NOT DISTINCT FROM s.source WHERE u.n = 1
    UNION ALL
    SELECT doc_id, leaf, subroot, u.level + 1, u.place // 3, (n + 2) // 3, proof || l || r, sha256(l || folded || r)
    FROM on_top u JOIN above b ON u.level = b.level AND u.place = b.place WHERE n > 1
)
SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.digest AS verified
FROM on_top o, (SELECT digest FROM top WHERE n = 1) t WHERE o.n = 1
"""

ORACLE: dict[str, str] = {"op8_license_scan": _LICENSES, "op11_merkle_manifest": _MERKLE}
