"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .mixing import CAP, SEED, random_offset

SPACES = r"[\x20\x09-\x0D]"

SQL = {}

SQL["op3_url_filter"] = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM parts
), rules(rhost, rpath, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
  SELECT u.page_id, u.host, u.path, rhost || rpath AS rule, verdict,
         row_number() OVER (PARTITION BY u.page_id, u.host, u.path
                            ORDER BY length(rhost || rpath) DESC NULLS LAST, length(rhost) DESC) AS place
  FROM urls u LEFT JOIN rules r
    ON (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""

SQL["op4_mix"] = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(source, '') AS s, source IS NULL AS nul,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), totals AS (
  SELECT s, nul, sum(size) AS source_size FROM sized GROUP BY ALL
), weighed AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY nul, s) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM totals
), filled AS (
  SELECT *, source_size * {CAP}.0::DOUBLE / w AS brim FROM weighed
), levels AS (
  SELECT a.s, a.nul, min((SELECT sum(source_size) FROM totals)::DOUBLE - coalesce(c.capped, 0) * {CAP}.0::DOUBLE) / min(c.wleft) AS level, min(a.brim) AS brim
  FROM filled a, LATERAL (SELECT sum(source_size) FILTER ((b.brim, b.nul, b.s) < (a.brim, a.nul, a.s)) AS capped,
                                 sum(w) FILTER ((b.brim, b.nul, b.s) >= (a.brim, a.nul, a.s)) AS wleft FROM filled b) c
  GROUP BY a.s, a.nul
), level AS (
  SELECT level FROM levels WHERE level <= brim ORDER BY brim, nul, s LIMIT 1
), targets AS (
  SELECT f.s, f.nul, f.source_size, least(f.source_size * {CAP}.0::DOUBLE, l.level * f.w) AS target FROM filled f, level l
), classed AS (
  SELECT *, length(bin(size)) * 8 + (size >> greatest(length(bin(size)) - 3, 0)) AS c,
         substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2) AS h FROM sized
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY s, nul ORDER BY c, h, size, doc_id) AS i FROM classed
), steps AS (
  SELECT p.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS e
  FROM placed p JOIN targets t USING (s, nul)
)
SELECT doc_id, source, size::BIGINT AS size, source_size::BIGINT AS source_size, target::DOUBLE AS target,
       (least(floor(i * e + {random_offset(SEED)!r}::DOUBLE) - floor((i - 1) * e + {random_offset(SEED)!r}::DOUBLE), ceil(e)) * size)::BIGINT AS taken
FROM steps
"""

SQL["op13_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), lists AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS p
  FROM lists, (VALUES (1), (2), (3)) s(k) WHERE len(w) >= k
), f AS (
  SELECT lang, k, p, count(*) AS a FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), halves AS (
  SELECT lang, k, p, a, unnest(range(1, k)) AS cut FROM f WHERE k > 1 AND a >= 10
), sides AS (
  SELECT *, p[1:cut] AS lp, p[cut + 1:] AS rp FROM halves
), cuts AS (
  SELECT c.lang, c.k, c.p, c.a, c.cut, x.a AS l, y.a AS r,
         ((1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a))::BIGINT AS score
  FROM sides c JOIN f x ON x.lang = c.lang AND x.p = c.lp JOIN f y ON y.lang = c.lang AND y.p = c.rp
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
), longer AS (
  SELECT lang, p[1:2] AS p, a FROM f WHERE k = 3 AND a >= 10
  UNION ALL SELECT lang, p[2:3], a FROM f WHERE k = 3 AND a >= 10
), inside AS (
  SELECT lang, p, max(a) AS most FROM longer GROUP BY ALL
), kept AS (
  SELECT s.lang, array_to_string(s.p, ' ') AS phrase, a, l, r, score FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.p = s.p
  WHERE s.k = 3 OR most IS NULL OR 100 * most < 50 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
