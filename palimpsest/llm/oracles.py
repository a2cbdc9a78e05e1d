"""SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from .quality import MEASURES, RULES, mask

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quality() -> str:
    bits = " + ".join(f"CASE WHEN {condition} THEN {1 << bit} ELSE 0 END" for bit, _, condition in RULES)
    return rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 7), ' ') AS g FROM w, unnest(generate_series(1, len(w) - 7)) s(i)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
a AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k AS at FROM r, unnest(generate_series(0, 7)) s(k)) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
coalesce(a.n, 0) AS n_repeat_words FROM w LEFT JOIN a USING (doc_id)),
l AS (SELECT *, len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines FROM m),
f AS (SELECT *, CAST({bits} AS BIGINT) AS failed_bits FROM l)
SELECT doc_id, {", ".join(MEASURES[:5])}, failed_bits & {mask("base")} <> 0 AS base_failed, failed_bits & {mask("v2")} = 0 AS kept, failed_bits FROM f"""


_NEAR = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(list_slice(w, i, i + 4), ' ') END AS s
FROM w, unnest(generate_series(1, greatest(len(w) - 4, 1))) g(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
c AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT c.a, e.b FROM c JOIN e ON e.a = c.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.m AS component_id, m.m = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS m FROM c GROUP BY a) m USING (doc_id)"""

_REPEATS = rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 49), ' ') AS g FROM w, unnest(generate_series(1, len(w) - 49)) s(i)),
r AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS m FROM g) WHERE m < doc_id),
x AS (SELECT DISTINCT doc_id, i + k AS at FROM r, unnest(generate_series(0, 49)) s(k)),
k AS (SELECT w.doc_id, string_agg(w[i], ' ' ORDER BY i) AS kept FROM w, unnest(generate_series(1, len(w))) s(i) WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.doc_id = w.doc_id AND x.at = i) GROUP BY w.doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, (SELECT count(*) FROM x WHERE x.doc_id = w.doc_id) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)"""

_TOPK = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""

#: Base32 of SHA-1: 32 groups of five bits, from 40 hexadecimal digits.
_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
n AS (SELECT page_id, first, strlen(h) AS bytes, list_transform(string_split(sha1(h), ''), lambda c: strpos('0123456789abcdef', c) - 1) AS n FROM p),
g AS (SELECT page_id, first, bytes, list_transform(range(0, 32), lambda i: list_sum(list_transform(range(0, 5), lambda j: ((n[(5 * i + j) // 4 + 1] >> (3 - (5 * i + j) % 4)) & 1) << (4 - j)))) AS g FROM n)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, array_to_string(list_transform(g, lambda v: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v AS INTEGER) + 1, 1)), '') AS payload_digest,
CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM g"""

#: Pieces at the fixed signs, words of a piece, phrases of 1 to 4 words; arithmetic in 128 bits.
_PHRASES = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM t)),
g AS (SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g FROM w, unnest(generate_series(1, 4)) s(k), unnest(generate_series(1, len(w) - k + 1)) r(i)),
f AS (SELECT lang, k, g, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, g, a, string_split(g, ' ') AS w FROM f WHERE k > 1 AND a >= 30),
cuts AS (SELECT c.lang, c.g, c.a, j, x.a AS l, y.a AS r, CAST(CAST(2000000 AS HUGEINT) * c.a // (x.a + y.a) AS BIGINT) AS score
FROM c, unnest(generate_series(1, len(w) - 1)) s(j), f x, f y
WHERE x.lang = c.lang AND y.lang = c.lang AND x.g = array_to_string(list_slice(w, 1, j), ' ') AND y.g = array_to_string(list_slice(w, j + 1, len(w)), ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
longer AS (SELECT lang, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g, max(a) AS a FROM c, unnest(generate_series(2, len(w) - 1)) s(k), unnest(generate_series(1, len(w) - k + 1)) r(i) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN longer o USING (lang, g) WHERE o.a IS NULL OR CAST(100 AS HUGEINT) * o.a < CAST(80 AS HUGEINT) * b.a),
ranks AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g)) AS rank FROM kept)
SELECT lang, rank, g AS phrase, a, l, r, n, score FROM ranks JOIN n USING (lang) WHERE rank <= 2000"""

ORACLE_SQL = {"op13_phrase_collocations": _PHRASES, "op6_warc_salvage": _WARC, "op3_quality_rules": _quality(), "op7_hamming_near_dedup": _NEAR, "op8_suffix_tree_dedup": _REPEATS, "op10_threshold_topk": _TOPK}
