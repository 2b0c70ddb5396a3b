"""SQL twins of the queries that SQL can express on whole tables."""

from __future__ import annotations

from voxledger.llm.mixing import MIX_SQL
from voxledger.llm.secrets import SHAPES

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


# Every window of every item meets the word runs of the same length of every document.
CONTAMINATION_SQL = f"""
WITH it AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, {_words('text')} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, least(13, len(w)) AS k FROM it WHERE len(w) > 0))),
d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
runs AS (
  SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k)),
m AS (SELECT DISTINCT doc_id, i, k, item_id FROM runs JOIN win USING (k, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id
"""

# All pairs of vectors, then everything that can be reached from each.
EMBEDDING_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e,
         embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b
  ON a.ok AND b.ok AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT vec_id AS node, vec_id AS r FROM v
  UNION SELECT reach.node, links.w FROM reach JOIN links ON links.u = reach.r),
low AS (SELECT node, min(r) AS component_id FROM reach GROUP BY node),
n AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
SELECT v.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, low.component_id, v.vec_id = low.component_id AS kept
FROM v JOIN low ON low.node = v.vec_id LEFT JOIN n ON n.u = v.vec_id
"""

_DIGIT = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((g >> {shift}) & 31 AS INTEGER) + 1, 1)"

# Five hex digits of the SHA-1 are four digits in base 32.
ARCHIVE_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, b, sha1(b) AS hex, max(page_id) OVER (PARTITION BY sha256(b)) AS largest FROM p)
SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(list_transform(range(0, 8), lambda i: CAST('0x' || substr(hex, CAST(5 * i + 1 AS INTEGER), 5) AS BIGINT)),
         lambda g: {' || '.join(_DIGIT.format(shift=s) for s in (15, 10, 5, 0))}), '') AS payload_digest,
       CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to, true AS intact
FROM h
"""



def _either_case(pattern: str) -> str:
    """Letters outside of brackets in either case; no flag, as that would fold other letters too."""
    out, inside = "", False
    for c in pattern:
        inside = (inside or c == "[") and c != "]"
        out += f"[{c}{c.upper()}]" if c.isalpha() and not inside else c
    return out


_ASSIGN = (
    "(" + _either_case("password|passwd|secret|token|api_?key") + r""")[""" + '"' + r"""'']?[\x20]*[:=][\x20]*[""" + '"' + r"""'']?([A-Za-z0-9+/_.=-]+)"""
)
_KINDS = [
    ("assign", _ASSIGN, f"regexp_extract(v, '{_ASSIGN}', 2)", 8),
    ("access", "AKIA[A-Z0-9]+", "v", 16),
    ("hex", "[0-9a-f]+", "v", 32),
    *[(kind, pattern, "v", 1) for kind, pattern, _ in SHAPES],
]
_FOUND = " UNION ALL ".join(
    f"""SELECT doc_id, source, '{kind}' AS kind, {rank} AS rank, start, start + len(v) AS stop, {value} AS value FROM (
      SELECT doc_id, source, m[i] AS v, CAST(list_sum(list_transform(p[1 : i], lambda x: len(x)))
          + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: len(x))), 0) AS BIGINT) AS start
      FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
        SELECT doc_id, source, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS p FROM d)))
    WHERE len({value}) >= {least}"""
    for rank, (kind, pattern, value, least) in enumerate(_KINDS)
)

# Where a match begins: the lengths of what stands between matches and of the matches before it.
SECRET_SQL = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
found AS ({_FOUND}),
owners AS (
  SELECT value, count(DISTINCT source) + max(CAST(source IS NULL AS BIGINT)) AS n,
         count(DISTINCT doc_id) + max(CAST(doc_id IS NULL AS BIGINT)) AS n_docs
  FROM found GROUP BY value),
judged AS (SELECT f.*, rank < 3 AS base, o.n <= 2 AND o.n_docs <= 100 AS live FROM found f JOIN owners o USING (value)),
kept AS (
  SELECT j.* FROM judged j WHERE base OR live AND NOT EXISTS (
    SELECT 1 FROM judged b WHERE b.doc_id = j.doc_id AND b.base AND b.start <= j.start AND b.stop >= j.stop)),
g AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (live) AS n_live,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (base) AS base_spans,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM kept GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM d LEFT JOIN g ON g.doc_id = d.doc_id
"""

# Phrases of two and three words by their places in a piece; all of them are counted.
COLLOCATION_SQL = rf"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
f AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, CAST(count(*) AS HUGEINT) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) ks(k) WHERE len(w) >= k)
  GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cut AS (
  SELECT c.lang, c.k, c.phrase, c.a, c.w, x.f AS l, y.f AS r, (1000000 * c.a * c.a) // (x.f * y.f) AS score, j
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1 :], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_ AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE k = 3),
longest AS (SELECT lang, phrase, max(a) AS longer FROM inner_ GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN longest o ON o.lang = b.lang AND o.phrase = b.phrase
  WHERE o.longer IS NULL OR 100 * o.longer < 50 * b.a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN n ON n.lang = kept.lang
QUALIFY rank <= 2000
"""

ORACLES = {
    "op1_decontamination": CONTAMINATION_SQL,
    "op3_embedding_join": EMBEDDING_SQL,
    "op6_warc": ARCHIVE_SQL,
    "op8_secrets": SECRET_SQL,
    "op9_mixing": MIX_SQL,
    "op11_collocations": COLLOCATION_SQL,
}
