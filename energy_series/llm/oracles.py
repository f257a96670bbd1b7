"""DuckDB SQL of the queries of this folder that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _field(value: str) -> str:
    """Number of UTF-8 bytes, a colon and the value; a dash for a null."""
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


ORACLES: dict[str, str] = {
    "op4_line_dedup": r"""
WITH raw AS (
  SELECT row_number() OVER () AS r, doc_id, text, ('0x' || md5(text)[:15])::BIGINT AS k,
         list_filter(string_split(regexp_replace(text, '(\n|[.!?] )', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS recs
  FROM documents),
rec AS (
  SELECT r, k, generate_subscripts(recs, 1) AS i, unnest(recs) AS rec FROM raw),
tok AS (
  SELECT r, k, i, rec, string_split(rtrim(regexp_replace(rec, '[0-9]+', '0', 'g'), ' ' || chr(10)), ' ') AS t FROM rec),
leaf AS (
  SELECT r, k, i, rec, len(t) AS n, t[:12] AS lead FROM tok),
recurring AS (
  SELECT n, lead, min(k) AS kept FROM (SELECT DISTINCT r, k, n, lead FROM leaf WHERE n >= 5)
  GROUP BY n, lead HAVING min(k) < max(k) AND count(*) >= CASE WHEN n >= 8 THEN 2 ELSE 10 END),
marked AS (
  SELECT l.r, l.i, l.rec, c.n IS NOT NULL AND l.k <> c.kept AS gone
  FROM leaf l LEFT JOIN recurring c ON l.n = c.n AND l.lead = c.lead),
done AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         coalesce(string_agg(rec, '' ORDER BY i) FILTER (NOT gone), '') AS body
  FROM marked GROUP BY r)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped,
       length(coalesce(body, ''))::BIGINT AS n_chars, sha256(coalesce(body, '')) AS text_sha256
FROM raw LEFT JOIN done USING (r)
""",
    "op7_decontamination": rf"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
gram AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i:i + least(len(w), 10) - 1] AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item WHERE len(w) > 0)),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
win AS (
  SELECT r, n, i, w[i:i + n - 1] AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM gram) WHERE len(w) >= n)),
hit AS (SELECT r, item_id, i, win.n FROM win JOIN gram ON win.g = gram.g AND win.n = gram.n),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hit) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
""",
    "op11_source_divergence": rf"""
WITH doc AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
tok AS (SELECT r, lang, source, unnest(w) AS term FROM doc),
kept AS (SELECT lang, term, count(*) AS n FROM tok GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
size AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
cnt AS (SELECT lang, source, term, count(*) AS n FROM tok SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
grp AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM doc) g LEFT JOIN cnt c ON g.lang = c.lang AND g.source = c.source GROUP BY g.lang, g.source),
share AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * s.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 2)) // (s.total + 2 * s.v) AS q
  FROM grp g JOIN kept k ON g.lang = k.lang JOIN size s ON g.lang = s.lang
  LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
above AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM share WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
  FROM (SELECT * FROM pair UNION ALL SELECT * FROM above))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE
bits AS (
  SELECT i, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
lut AS (SELECT list(c ORDER BY i) AS l FROM bits WHERE k = 8),
doc AS (
  SELECT doc_id, coalesce('1' || lang, '0') AS g, {_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field('n_chars')} AS lead, text,
         list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                     lambda c, b: xor(l[xor(c & 255, b) + 1], c >> 8)) AS crc
  FROM documents, lut),
leaf AS (
  SELECT doc_id, g, sha256(lead || {_field('text')}) AS h,
         CASE WHEN xor(crc, 4294967295) % 3 = 0
              THEN sha256(lead || {_field(f"translate(text, '{_UPPER}', '{_LOWER}')")}) END AS claim
  FROM doc),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaf),
node AS (
  SELECT g, 0 AS lvl, pos AS i, h, n FROM placed
  UNION ALL
  SELECT g, any_value(lvl) + 1, i >> 3, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 7) >> 3 FROM node WHERE n > 1 GROUP BY g, i >> 3),
sub AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1),
top AS (
  SELECT 0 AS lvl, pos AS i, h, n FROM sub
  UNION ALL
  SELECT any_value(lvl) + 1, i >> 3, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 7) >> 3 FROM top WHERE n > 1 GROUP BY i >> 3),
around AS (
  SELECT g, lvl, i, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM (SELECT g, lvl, i, h FROM node WHERE n > 1 UNION ALL SELECT '', lvl, i, h FROM top WHERE n > 1)
  WINDOW w AS (PARTITION BY g, lvl, i >> 3 ORDER BY i)),
way AS (
  SELECT p.g, p.pos, a.lvl, a.l, a.r FROM placed p JOIN around a ON a.g = p.g AND a.i = p.pos >> (3 * a.lvl)
  UNION ALL
  SELECT p.g, p.pos, 100 + a.lvl, a.l, a.r FROM placed p JOIN sub s ON s.g = p.g JOIN around a ON a.g = '' AND a.i = s.pos >> (3 * a.lvl)),
step AS (SELECT *, row_number() OVER (PARTITION BY g, pos ORDER BY lvl) AS k FROM way),
proof AS (SELECT g, pos, string_agg(l || r, '' ORDER BY k) AS s FROM step GROUP BY g, pos),
fold AS (
  SELECT g, pos, 0::BIGINT AS k, coalesce(claim, h) AS h FROM placed
  UNION ALL
  SELECT f.g, f.pos, s.k, sha256(s.l || f.h || s.r) FROM fold f JOIN step s ON s.g = f.g AND s.pos = f.pos AND s.k = f.k + 1),
done AS (SELECT g, pos, arg_max(h, k) AS h FROM fold GROUP BY g, pos)
SELECT p.doc_id, p.h AS leaf, s.h AS subroot, t.h AS root, sha256(coalesce(w.s, '')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM placed p JOIN sub s ON s.g = p.g JOIN (SELECT h FROM top WHERE n = 1) t ON true
LEFT JOIN proof w ON w.g = p.g AND w.pos = p.pos JOIN done f ON f.g = p.g AND f.pos = p.pos
""",
}
