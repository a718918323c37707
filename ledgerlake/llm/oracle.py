"""SQL of the operators that SQL can express.

SimHash (XXH64), BPE, token files and the learned models have none; they are tested
against plain Python versions. Statements list what the Spark side never lists (pairs of
vectors, characters of a value), since they only run on small tables.
"""

from ledgerlake.llm import (
    decontaminate as deco, embedding_dedup, lexical_search, line_dedup, secret_scan as scan,
    source_audit as audit,
)

_NL = "chr(10)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _found(kind: int, pattern: str) -> str:
    pattern = _text(pattern)
    return f"""
  SELECT doc_id, source, {kind} AS kind, unnest(range(1, len(m) + 1)) AS place, unnest(m) AS value,
         unnest(g[:len(m)]) AS gap
  FROM (SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), {pattern}) AS m,
               string_split_regex(coalesce(text, ''), {pattern}) AS g FROM documents)"""


_SECRETS = f"""
WITH found AS ({" UNION ALL ".join(_found(kind, pattern) for kind, pattern in enumerate(
    (scan.ASSIGN, scan.ACCESS, scan.HEX, scan.BARE)))}),
placed AS (
  SELECT doc_id, source, kind, sum(length(gap) + length(value)) OVER (
           PARTITION BY doc_id, kind ORDER BY place) AS stop, length(value) AS size,
         if(kind = 0, regexp_extract(value, {_text(scan.ASSIGN)}, 2), value) AS secret
  FROM found),
candidates AS (
  SELECT doc_id, source, kind, stop - size AS start, stop, secret FROM placed
  WHERE CASE kind WHEN 0 THEN length(secret) >= {scan.ASSIGN_CHARS}
    WHEN 3 THEN regexp_matches(secret, '[a-z]') AND regexp_matches(secret, '[A-Z]')
      AND len(regexp_extract_all(secret, '[0-9]')) >= 3 ELSE true END),
owners AS (
  SELECT secret, count(DISTINCT coalesce(source, '')) AS n, count(DISTINCT doc_id) AS repositories
  FROM candidates GROUP BY secret),
judged AS (
  SELECT c.*, CASE WHEN n >= {scan.COPIED_OWNERS} OR repositories >= {scan.COPIED_REPOSITORIES} THEN 'copied'
      WHEN n = 1 AND length(secret) >= {scan.LIVE_CHARS}
        AND len(list_distinct(string_split(secret, ''))) >= {scan.LIVE_DISTINCT} THEN 'live'
      ELSE 'unclear' END AS verdict
  FROM candidates c JOIN owners USING (secret)),
spans AS (
  SELECT doc_id, kind, verdict, start,
         format('{{}}:{{}}:{{}}', {list(scan.KINDS)}[kind + 1], start, stop) AS span
  FROM judged j WHERE kind < 3 OR (verdict = 'live' AND NOT EXISTS (
    SELECT 1 FROM judged b WHERE b.doc_id = j.doc_id AND b.kind < 3
      AND b.start < j.stop AND j.start < b.stop)))
SELECT d.doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign,
       count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, kind) FILTER (WHERE kind < 3), ''))
         AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, kind), '') AS spans,
       count(*) FILTER (WHERE kind = 3) AS n_added,
       count(*) FILTER (WHERE verdict = 'live') AS n_owner_specific,
       count(*) FILTER (WHERE verdict = 'copied') AS n_copied
FROM documents d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id"""

_BLANKS = " || ".join(f"chr({ord(blank)})" for blank in line_dedup.BLANKS)
_LINES = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), {_NL}) AS lines FROM documents),
lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split),
keyed AS (
  SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {line_dedup.MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}),
judged AS (
  SELECT k.*, coalesce(keeper <> doc_id, false) AS gone FROM keyed k LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, {_NL} ORDER BY place) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM judged GROUP BY doc_id"""

_VECTORS = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, [x::double for x in embedding] AS v FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v)
        / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) >= {embedding_dedup.MIN_COSINE}),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
smallest AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, component_id,
       vec_id = component_id AS kept
FROM embeddings e JOIN smallest USING (vec_id)"""


def _tokens(table: str, name: str) -> str:
    return f"""
  SELECT {name}, [w for w in string_split_regex(
           regexp_replace(lower(coalesce(text, '')), '([{deco.UNSPACED}])', ' \\1 ', 'g'), '[^\\pL\\pN]+') if w <> ''] AS w
  FROM {table}"""


def _seeds(name: str, mask: tuple[int, ...]) -> str:
    picked = ", ".join(f"w[place + {offset}]" for offset in mask)
    return f"""
  SELECT {name}, place, {deco.MASKS.index(mask)} AS mask, [{picked}] AS seed
  FROM (SELECT *, unnest(range(1, len(w) - {mask[-1] - 1})) AS place FROM {name}_words)"""


_LEAKS = f"""
WITH doc_id_words AS ({_tokens("documents", "doc_id")}),
item_id_words AS (
  SELECT min(item_id) AS item_id, w FROM ({_tokens("benchmark", "item_id")})
  WHERE len(w) >= {deco.WINDOW} GROUP BY w),
hits AS (
  SELECT doc_id, item_id, d.place - i.place AS diagonal, i.place, mask
  FROM ({" UNION ALL ".join(_seeds("doc_id", mask) for mask in deco.MASKS)}) d
  JOIN ({" UNION ALL ".join(_seeds("item_id", mask) for mask in deco.MASKS)}) i USING (mask, seed)),
equal AS (
  SELECT doc_id, item_id, diagonal, [n for n in range(1, len(i.w) + 1)
           if n + diagonal >= 1 AND n + diagonal <= len(d.w) AND i.w[n] = d.w[n + diagonal]] AS places
  FROM (SELECT DISTINCT doc_id, item_id, diagonal FROM hits)
  JOIN doc_id_words d USING (doc_id) JOIN item_id_words i USING (item_id)),
windows AS (
  SELECT h.*, unnest(range(place - {deco.BEFORE}, place + 1)) AS first, places
  FROM hits h JOIN equal USING (doc_id, item_id, diagonal)),
verified AS (
  SELECT doc_id, item_id, diagonal, place, mask,
         max(len([n for n in places if n >= first AND n < first + {deco.WINDOW}])) AS n_equal
  FROM windows GROUP BY ALL HAVING n_equal >= {deco.MIN_EQUAL})
SELECT doc_id, item_id, count(*) AS n_hits, max(n_equal) AS n_equal,
       arg_min(diagonal, -n_equal * 100000000 + diagonal) AS doc_start
FROM verified GROUP BY doc_id, item_id
UNION ALL
SELECT doc_id, item_id, count(*), max(len(i.w)), min(place) - 1
FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS place FROM doc_id_words) d
JOIN (SELECT min(item_id) AS item_id, w FROM ({_tokens("benchmark", "item_id")})
      WHERE len(w) BETWEEN {deco.MIN_ITEM} AND {deco.WINDOW - 1} GROUP BY w) i
  ON d.w[place] = i.w[1] AND d.w[place:place + len(i.w) - 1] = i.w
GROUP BY doc_id, item_id"""

_SMALL = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _terms(pattern: str, rows: str) -> str:
    found = f"unnest(regexp_extract_all(translate(text, {_SMALL}), '{pattern}')) AS term"
    return f"SELECT * EXCLUDE (text), {found} FROM {rows}"


_SEARCH = f"""
WITH words AS ({_terms(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "(SELECT doc_id, text FROM documents)")}),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM ({_terms(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "(SELECT DISTINCT item_id, text FROM benchmark)")})
  GROUP BY ALL),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
counts AS (
  SELECT doc_id, term, count(*) AS tf FROM words SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM counts, whole GROUP BY term, n_docs),
scores AS (
  SELECT item_id, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (doc_id), whole
  GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= {lexical_search.TOP}"""

# Shares of every kept term in every group, also those it does not hold.
_AUDIT = f"""
WITH given AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS text FROM documents),
words AS ({_terms(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "given")}),
kept AS (
  SELECT lang, term, count(*) AS total FROM words
  GROUP BY ALL HAVING count(DISTINCT id) >= {audit.MIN_DOCS}),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
spots AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, total
  FROM (SELECT DISTINCT lang, source FROM given) JOIN kept USING (lang)
  LEFT JOIN counts USING (lang, source, term)),
shares AS (
  SELECT *, 1 + ({audit.SCALE} * (n + 1)::HUGEINT) // (sum(n) OVER g + count(*) OVER g) AS p,
         1 + ({audit.SCALE} * (total + 1)::HUGEINT) // (sum(total) OVER g + count(*) OVER g) AS q
  FROM spots WINDOW g AS (PARTITION BY lang, source)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM (SELECT DISTINCT lang, source FROM given) a JOIN (SELECT DISTINCT lang, source FROM given) b
    ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
FROM found QUALIFY part = 'pair' OR rank <= {audit.TOP_TERMS}"""

ORACLES: dict[str, str] = {
    "op1_secret_scan": _SECRETS,
    "op2_line_dedup": _LINES,
    "op3_embedding_near_dedup": _VECTORS,
    "op8_benchmark_decontamination": _LEAKS,
    "op11_ranked_lexical_search": _SEARCH,
    "op12_source_divergence_audit": _AUDIT,
}
