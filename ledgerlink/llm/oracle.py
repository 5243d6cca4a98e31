"""The same results in DuckDB SQL, for the operators that SQL can express."""

from __future__ import annotations

from ledgerlink.llm.queries import SHARDS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}')"


# Checksum of a text's UTF-8 bytes, half a byte at a time, the lower half first.
_CRC = """
nibbles AS (SELECT list_transform(range(0, 16), lambda i:
    list_reduce([i::BIGINT, 0, 0, 0, 0], lambda c, _:
      CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
digits AS (SELECT doc_id, text, string_split(hex(encode(coalesce(text, ''))), '') AS d
  FROM documents),
crc AS (SELECT doc_id, text, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(0, CASE WHEN coalesce(text, '') = ''
      THEN 0 ELSE len(d) END), lambda i:
      instr('0123456789ABCDEF', d[(i // 2) * 2 + 2 - i % 2])::BIGINT - 1)),
    lambda c, n: xor(c >> 4, t[(xor(c & 15, n) + 1)::INT]))) AS text_crc32
  FROM digits, nibbles)"""


def _unit(text: str) -> str:
    return f"(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE)"


_SHARDING = f"""
WITH {_CRC},
hashed AS (SELECT d.doc_id, d.source, (strlen(coalesce(d.text, '')) + 1)::BIGINT AS size,
    c.text_crc32, {_unit("'1:' || d.doc_id")} AS h
  FROM documents d JOIN crc c ON c.doc_id = d.doc_id AND c.text IS NOT DISTINCT FROM d.text),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id, size,
    text_crc32) - 1 AS r, count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total
  FROM hashed),
placed AS (SELECT *, row_number() OVER (ORDER BY
    (r + {_unit("'phase1:=' || source")}) / n, source, h, doc_id, size, text_crc32) - 1 AS p
  FROM ranked)
SELECT doc_id, source, size, text_crc32, 'rows' AS law,
  ((p * {SHARDS}) // total)::INT AS shard,
  (p - (((p * {SHARDS}) // total) * total + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot,
  NULL::INT AS grown_shard
FROM placed"""

# Tags that end a line, as HTML lays them out; a list of its own, apart from the operator's.
_BLOCK = "|".join([
    "html", "head", "body", "title", "main", "header", "footer", "nav", "section", "article",
    "aside", "address", "blockquote", "pre", "figcaption", "div", "p", "br", "hr", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt", "dd", "table", "tr", "th",
    "td",
])
_ENTITIES = (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("nbsp", " "), ("amp", "&"))


def _page_text() -> str:
    text = "translate(html, chr(10) || chr(13) || chr(9) || chr(12), '    ')"
    text = (f"regexp_replace({text}, '(?i)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>"
            f"|<!--.*?-->|<!doctype[^>]*>', '', 'g')")
    text = f"regexp_replace({text}, '(?i) *</?(?:{_BLOCK})\\b[^>]*>', chr(10), 'g')"
    text = f"regexp_replace({text}, '<[^>]*>', ' ', 'g')"
    for name, sign in _ENTITIES:
        text = f"replace({text}, '&{name};', '{sign}')"
    return f"regexp_replace({text}, '\\n[ \\n]*', chr(10), 'g')"


_LINE_DEDUP = f"""
WITH pages_text AS (SELECT page_id, nullif(lower(regexp_extract(url,
    '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '') AS host,
    {_page_text()} AS text FROM pages),
lines AS (SELECT DISTINCT host, text, trim(unnest(string_split(text, chr(10))), ' ') AS line
  FROM pages_text WHERE host IS NOT NULL),
content AS (SELECT * FROM lines WHERE line <> ''),
totals AS (SELECT host, count(DISTINCT text) AS total FROM content GROUP BY host),
often AS (SELECT host, list(line) AS frequent FROM (
    SELECT host, line, count(*) AS n FROM content GROUP BY host, line HAVING count(*) > 1) c
  JOIN totals USING (host) WHERE n > total * 0.05::DOUBLE GROUP BY host),
split AS (SELECT p.*, string_split(p.text, chr(10)) AS every,
    list_filter(string_split(p.text, chr(10)),
      lambda x: NOT coalesce(list_contains(o.frequent, trim(x, ' ')), FALSE)) AS rest
  FROM pages_text p LEFT JOIN often o ON o.host = p.host)
SELECT page_id, host, array_to_string(rest, chr(10)) AS text,
  coalesce(len(every), 0)::INT AS n_lines,
  coalesce(len(every) - len(rest), 0)::INT AS n_dropped,
  coalesce(len(every) > len(rest)
    AND len(list_filter(rest, lambda x: trim(x, ' ') <> '')) = 0, FALSE) AS emptied
FROM split"""

_REACH = """
reach AS (SELECT u AS a, u AS b FROM both_ways UNION
  SELECT r.a, l.v FROM reach r JOIN both_ways l ON l.u = r.b),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)"""

_NEAR_DEDUP = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_lowered("text")},
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words
    WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM shingles a
  JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM shared JOIN sizes p ON p.doc_id = u JOIN sizes q ON q.doc_id = v
  WHERE 100 * k >= 85 * (p.n + q.n - k)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
{_REACH}
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles,
  least(d.doc_id, coalesce(component_id, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON a = d.doc_id"""

_EMBEDDING_DEDUP = f"""
WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
usable AS (SELECT vec_id, x FROM vectors WHERE x IS NOT NULL AND len(x) > 0
  AND len(list_filter(x, lambda y: y IS NULL OR NOT isfinite(y))) = 0
  AND len(list_filter(x, lambda y: y <> 0)) > 0),
links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM usable a
  JOIN usable b ON a.vec_id < b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
degree AS (SELECT u, count(*) AS n FROM both_ways GROUP BY u),
{_REACH}
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links,
  least(e.vec_id, coalesce(component_id, e.vec_id)) AS component_id,
  e.vec_id <= coalesce(component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN degree ON u = e.vec_id LEFT JOIN least ON a = e.vec_id"""

_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

_DECONTAMINATION = f"""
WITH item AS (SELECT item_id, regexp_extract_all({_lowered("text")}, '{_WORD}') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS x FROM (
    SELECT item_id, w, least(10, len(w)) AS k,
      unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
words AS (SELECT doc_id, regexp_extract_all({_lowered("text")}, '{_WORD}') AS w
  FROM documents),
places AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS x FROM (
    SELECT doc_id, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS i
    FROM words, (SELECT DISTINCT k FROM windows))),
hits AS (SELECT doc_id, k, i, item_id FROM places JOIN windows USING (k, x)),
hit_words AS (SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, list(DISTINCT item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_hit,
  coalesce(len(ids), 0)::BIGINT AS n_items,
  sha256(coalesce(array_to_string(list_sort(ids), ','), '')) AS items_sha256,
  coalesce(n, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)"""

# A row inserted where that is cheaper, for each of the four states.
_RELAXED = """list_transform([1, 2, 3, 4], lambda s: list_sort([f[s], {
      'c': f[[3, 3, 4, 3][s]].c + 5, 'a': 'I' || f[[3, 3, 4, 3][s]].a,
      'r': chr(10) || CASE WHEN s = 3 THEN 'assistant:' ELSE 'user:' END
        || f[[3, 3, 4, 3][s]].r}])[1])"""

_CONVERSATION_REPAIR = f"""
WITH RECURSIVE nibbles AS (SELECT list_transform(range(0, 16), lambda i:
    list_reduce([i::BIGINT, 0, 0, 0, 0], lambda c, _:
      CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    string_split(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))),
      '') AS d FROM conversations),
hit AS (SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(0, len(d)), lambda i:
      instr('0123456789ABCDEF', d[(i // 2) * 2 + 2 - i % 2])::BIGINT - 1)),
    lambda c, n: xor(c >> 4, t[(xor(c & 15, n) + 1)::INT]))) % 20 AS hit FROM keyed, nibbles),
damaged AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN hit = 1 THEN '' WHEN hit = 2 THEN regexp_replace(text, '[.!?]', '', 'g')
      ELSE text END AS text, unnest(range(CASE WHEN hit = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE hit <> 0),
placed AS (SELECT *, coalesce(conv_id::VARCHAR, '') AS conv, role[1] AS initial,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
      substr(sha256(text), 1, 32), copy) AS place FROM damaged),
faults AS (SELECT *, CASE WHEN bare = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY place) > 1 THEN 'duplicate'
    WHEN bare[-1] NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lead(initial) OVER (PARTITION BY conv ORDER BY place) AS next_initial FROM placed),
counts AS (SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (next_initial IS NOT NULL
      AND initial || next_initial NOT IN ('su', 'ua', 'au')) AS illegal,
    count(*) AS n FROM faults GROUP BY conv),
-- Cheapest ways to the end from the states start, system, user and assistant.
walk AS (SELECT conv, n + 1 AS place, [
    {{'c': 0::BIGINT, 'a': '', 'r': ''}},
    {{'c': 10::BIGINT, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}},
    {{'c': 5::BIGINT, 'a': 'I', 'r': chr(10) || 'assistant:'}},
    {{'c': 0::BIGINT, 'a': '', 'r': ''}}] AS f FROM counts
  UNION ALL SELECT conv, place, {_RELAXED} FROM (SELECT conv, place, {_RELAXED} AS f FROM (
    SELECT w.conv, w.place - 1 AS place, list_transform([1, 2, 3, 4], lambda s: list_sort(
      list_filter([
        {{'c': w.f[s].c + 2, 'a': 'D' || w.f[s].a, 'r': w.f[s].r}},
        CASE WHEN x.fault IN ('blank', 'duplicate') THEN NULL ELSE {{
          'c': w.f[[3, 3, 4, 3][s]].c + 1 + CASE WHEN x.fault = 'truncated' THEN 5 ELSE 0 END,
          'a': 'R' || w.f[[3, 3, 4, 3][s]].a,
          'r': chr(10) || CASE WHEN s = 3 THEN 'assistant:' ELSE 'user:' END || x.text
            || w.f[[3, 3, 4, 3][s]].r}} END,
        CASE WHEN x.fault IN ('blank', 'duplicate') OR NOT coalesce(
            (x.initial = 's' AND s = 1) OR (x.initial = 'u' AND s <> 3)
            OR (x.initial = 'a' AND s = 3), FALSE) THEN NULL ELSE {{
          'c': w.f[CASE x.initial WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].c
            + CASE WHEN x.fault = 'truncated' THEN 5 ELSE 0 END,
          'a': 'K' || w.f[CASE x.initial WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].a,
          'r': chr(10) || x.role || ':' || x.text
            || w.f[CASE x.initial WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].r}} END],
        lambda o: o IS NOT NULL))[1]) AS f
    FROM walk w JOIN faults x ON x.conv = w.conv AND x.place = w.place - 1))),
best AS (SELECT conv, f[1] AS b FROM walk WHERE place = 1)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.c, 0)::BIGINT AS cost,
  coalesce(b.a, '') AS audit, sha256(coalesce(b.r[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counts c ON c.conv = coalesce(i.conv_id::VARCHAR, '')
LEFT JOIN best ON best.conv = c.conv"""

_COLLOCATIONS = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    {_lowered("text")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
runs AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p FROM (
    SELECT lang, w, k, unnest(range(1, greatest(len(w) - k + 2, 1))) AS i
    FROM words, (SELECT unnest([1, 2, 3, 4]) AS k))),
f AS (SELECT lang, k, p, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, k, p, a, unnest(range(1, k)) AS h, string_split(p, ' ') AS w
  FROM f WHERE k > 1),
scored AS (SELECT c.lang, c.p, c.a, min({{'score': ((2000000::HUGEINT * c.a) // (l.a + r.a))::BIGINT,
    'h': h, 'l': l.a, 'r': r.a}}) AS cut FROM cuts c
  JOIN f l ON l.lang = c.lang AND l.p = array_to_string(w[1:h], ' ')
  JOIN f r ON r.lang = c.lang AND r.p = array_to_string(w[h + 1:], ' ') GROUP BY ALL),
inner_runs AS (SELECT DISTINCT lang, a AS longer, array_to_string(w[i:i + z - 1], ' ') AS p FROM (
    SELECT lang, a, w, z, unnest(range(1, k - z + 2)) AS i FROM (
      SELECT lang, k, a, string_split(p, ' ') AS w, unnest(range(2, k)) AS z FROM f WHERE k > 2))),
hidden AS (SELECT DISTINCT s.lang, s.p FROM scored s JOIN inner_runs i USING (lang, p)
  WHERE 100::HUGEINT * i.longer >= 80::HUGEINT * s.a),
ranked AS (SELECT lang, p, a, cut, row_number() OVER (PARTITION BY lang
    ORDER BY cut.score DESC, a DESC, p) AS rank
  FROM scored ANTI JOIN hidden USING (lang, p))
SELECT lang, rank, p AS phrase, a, cut.l AS l, cut.r AS r, n, cut.score AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""

_SUBSTRING_DEDUP = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS x FROM (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 18, 1))) AS i FROM words)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i,
    row_number() OVER (PARTITION BY x ORDER BY doc_id, i) AS nth FROM windows) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS j FROM later),
single AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM words),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n
  FROM single ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)"""

SQL: dict[str, str] = {
    "op1_sharding": _SHARDING,
    "op2_line_dedup": _LINE_DEDUP,
    "op4_near_dedup": _NEAR_DEDUP,
    "op7_embedding_dedup": _EMBEDDING_DEDUP,
    "op10_decontamination": _DECONTAMINATION,
    "op11_conversation_repair": _CONVERSATION_REPAIR,
    "op12_phrases": _COLLOCATIONS,
    "op13_substring_dedup": _SUBSTRING_DEDUP,
}
