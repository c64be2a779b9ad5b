"""DuckDB statements that the training-data queries must equal."""

SQL: dict[str, str] = {}

_P5 = r"""
WITH f AS (
  SELECT 'bible_verses_enhanced.zolai_text' AS field_name, 'b' || id AS rid, zolai_text AS v, true AS is_text FROM bible_verses_enhanced
  UNION ALL SELECT 'wiki_content.content', 'w' || id, content, true FROM wiki_content
  UNION ALL SELECT 'zolai_vocabulary.frequency_corpus', 'v' || id, frequency_corpus::VARCHAR, false FROM zolai_vocabulary),
p AS (SELECT * FROM f WHERE v IS NOT NULL AND regexp_replace(v, '\s+', '', 'g') NOT IN ('', '-')),
n AS (SELECT field_name, count(*) AS field_rows FROM p GROUP BY 1),
t AS (SELECT field_name, rid, unnest(CASE WHEN is_text THEN regexp_extract_all(lower(v), '[\p{L}\p{M}\p{N}]+') ELSE [v] END) AS term FROM p),
c AS (SELECT field_name, term, count(*) AS occurrences, count(DISTINCT rid) AS n_rows FROM t GROUP BY 1, 2)
SELECT c.field_name, term, occurrences, n_rows,
       CASE WHEN n_rows <= 2 THEN 'rare' WHEN n_rows > 0.2 * field_rows THEN 'common' END AS mark
FROM c JOIN n USING (field_name)"""
SQL["p5_terms"] = _P5
SQL["p5_found"] = f"SELECT field_name, term, mark FROM ({_P5}) WHERE mark IS NOT NULL"

_P6 = r"""
WITH d AS (
  SELECT lower(trim(regexp_replace(zolai, '\s+', ' ', 'g'))) AS k, id, english, myanmar, pos, confidence, updated_at,
         coalesce(t.trust_rank, 2147483647) AS trust
  FROM dictionary_enhanced e LEFT JOIN source_trust t ON regexp_extract(e.source_file, '([^/]*)$', 1) = t.source_file
  WHERE zolai IS NOT NULL AND trim(zolai) NOT IN ('', '-')),
g AS (SELECT k, min(id) AS group_id, count(*) AS n_records FROM d GROUP BY k HAVING count(*) >= 2),
u AS (SELECT k, id, trust, confidence, updated_at, 'english' AS field_name, english AS v FROM d
      UNION ALL SELECT k, id, trust, confidence, updated_at, 'myanmar', myanmar FROM d
      UNION ALL SELECT k, id, trust, confidence, updated_at, 'pos', pos FROM d),
r AS (SELECT k, field_name, id, v, row_number() OVER (PARTITION BY k, field_name ORDER BY trust, confidence DESC NULLS LAST, updated_at DESC NULLS LAST, id) AS rn
      FROM u WHERE v IS NOT NULL AND trim(v) NOT IN ('', '-'))"""
SQL["p6_found"] = _P6 + "SELECT group_id, field_name, id AS record_id FROM r JOIN g USING (k) WHERE rn = 1"
SQL["p6_survivors"] = _P6 + """
SELECT group_id, g.k AS group_key, n_records,
       max(id) FILTER (field_name = 'english') AS english_id, max(v) FILTER (field_name = 'english') AS english,
       max(id) FILTER (field_name = 'myanmar') AS myanmar_id, max(v) FILTER (field_name = 'myanmar') AS myanmar,
       max(id) FILTER (field_name = 'pos') AS pos_id, max(v) FILTER (field_name = 'pos') AS pos
FROM g LEFT JOIN (SELECT * FROM r WHERE rn = 1) b ON b.k = g.k GROUP BY 1, 2, 3"""

# a layer is one more than the longest chain of records that dominate
SQL["p6_layers"] = r"""
WITH RECURSIVE d AS (
  SELECT lower(trim(regexp_replace(zolai, '\s+', ' ', 'g'))) AS k, id, coalesce(t.trust_rank, 2147483647) AS trust, coalesce(confidence, -1) AS conf, coalesce(updated_at, TIMESTAMP '1000-01-01') AS tm,
         (trim(coalesce(english, '')) NOT IN ('', '-'))::INT AS e, (trim(coalesce(myanmar, '')) NOT IN ('', '-'))::INT AS m, (trim(coalesce(pos, '')) NOT IN ('', '-'))::INT AS p
  FROM dictionary_enhanced x LEFT JOIN source_trust t ON regexp_extract(x.source_file, '([^/]*)$', 1) = t.source_file
  WHERE zolai IS NOT NULL AND trim(zolai) NOT IN ('', '-')),
g AS (SELECT k, min(id) AS group_id FROM d GROUP BY k HAVING count(*) >= 2),
c AS (SELECT * FROM d JOIN g USING (k) QUALIFY row_number() OVER (PARTITION BY k, e, m, p, trust ORDER BY conf DESC, tm DESC, id) = 1),
w AS (SELECT a.k, a.id AS a, b.id AS b FROM c a JOIN c b ON a.k = b.k AND a.id <> b.id AND a.e >= b.e AND a.m >= b.m AND a.p >= b.p AND a.trust <= b.trust AND (a.conf, a.tm, -a.id) >= (b.conf, b.tm, -b.id)),
l AS (SELECT id, 1 AS layer FROM c UNION SELECT w.b, layer + 1 FROM l JOIN w ON w.a = l.id)
SELECT group_id, c.id AS record_id, e + m + p AS n_fields, max(layer)::INT AS layer, (SELECT count(*) FROM w WHERE w.b = c.id)::INT AS n_above
FROM c JOIN l USING (id) GROUP BY 1, 2, 3, c.id"""

_P9 = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \t\r\n]+'), lambda t: t <> '') AS w FROM documents WHERE text IS NOT NULL),
g AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS s, w FROM d WHERE len(w) >= 50),
h AS (SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS x FROM g),
m AS (SELECT x FROM h GROUP BY x HAVING min(doc_id) < max(doc_id)),
p AS (SELECT doc_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 50 THEN 0 ELSE 1 END AS fresh FROM h SEMI JOIN m USING (x)),
r AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM p),
f AS (SELECT doc_id, min(s)::BIGINT AS first_token, (max(s) + 49)::BIGINT AS last_token FROM r GROUP BY doc_id, run)"""
SQL["p9_found"] = _P9 + "SELECT doc_id, first_token, last_token FROM f"
SQL["p9_share"] = _P9 + r""",
n AS (SELECT doc_id, len(list_filter(string_split_regex(coalesce(text, ''), '[ \t\r\n]+'), lambda t: t <> ''))::BIGINT AS n_tokens FROM documents),
k AS (SELECT doc_id, sum(last_token - first_token + 1)::BIGINT AS n_shared FROM f GROUP BY 1)
SELECT doc_id, n_tokens, coalesce(n_shared, 0) AS n_shared, CASE WHEN n_tokens > 0 THEN round(coalesce(n_shared, 0) / n_tokens, 6) END AS shared_share
FROM n LEFT JOIN k USING (doc_id)"""
SQL["p9_units"] = r"""
WITH t AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL),
u AS (SELECT doc_id, unnest(us) AS u, unnest(range(1, len(us) + 1)) AS i, kind, us FROM (
        SELECT doc_id, [text] AS us, 0 AS kind FROM t UNION ALL SELECT doc_id, string_split_regex(text, '\n[ \t\r]*\n'), 1 FROM t UNION ALL SELECT doc_id, string_split(text, chr(10)), 2 FROM t)),
w AS (SELECT doc_id, kind, i, list_filter(string_split_regex(u, '[ \t\r\n]+'), lambda t: t <> '') AS w FROM u),
p AS (SELECT doc_id, len(w) AS n, md5(array_to_string(w, ' ')) AS x, sum(len(w)) OVER (PARTITION BY doc_id, kind ORDER BY i) - len(w) AS a FROM w),
m AS (SELECT x FROM p WHERE n >= 50 GROUP BY x HAVING min(doc_id) < max(doc_id)),
s AS (SELECT DISTINCT doc_id, a, a + n - 1 AS b FROM p SEMI JOIN m USING (x) WHERE n >= 50),
f AS (SELECT *, CASE WHEN a - max(b) OVER (PARTITION BY doc_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= 1 THEN 0 ELSE 1 END AS fresh FROM s),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS run FROM f)
SELECT doc_id, (min(a) + 1)::BIGINT AS first_token, (max(b) + 1)::BIGINT AS last_token FROM r GROUP BY doc_id, run"""
SQL["p9_lines"] = r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
e AS (SELECT doc_id, i AS line_no, ls[i] AS x, CASE WHEN i = 1 THEN 0 ELSE list_sum(list_transform(ls[1:i - 1], lambda y: length(y) + 1)) END AS first_char
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM l)),
u AS (SELECT *, lower(trim(regexp_replace(x, '\s+', ' ', 'g'))) AS unit FROM e),
k AS (SELECT *, first_value(doc_id) OVER w AS kept_doc_id, first_value(line_no) OVER w AS kept_line_no
      FROM u WHERE length(unit) >= 40 WINDOW w AS (PARTITION BY unit ORDER BY doc_id, line_no))
SELECT doc_id, line_no::BIGINT AS line_no, first_char::BIGINT AS first_char, (first_char + length(x))::BIGINT AS last_char, kept_doc_id, kept_line_no::BIGINT AS kept_line_no
FROM k WHERE doc_id <> kept_doc_id OR line_no <> kept_line_no"""

SQL["p7_found"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, regexp_extract_all(lower(passage), '[\p{L}\p{M}\p{N}]+') AS w FROM eval_items WHERE passage IS NOT NULL),
n AS (SELECT *, least(12, len(w)) AS n FROM i WHERE len(w) > 0),
e AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS x FROM (SELECT item_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM n)),
k AS (SELECT DISTINCT n FROM n),
g AS (SELECT DISTINCT doc_id, n, array_to_string(w[s:s + n - 1], ' ') AS x
      FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, k WHERE len(w) >= n))
SELECT DISTINCT doc_id, item_id FROM g JOIN e USING (n, x)"""
_P3 = r"""
WITH RECURSIVE t AS (
  SELECT 'zolai_songs' AS table_name, id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}]+') AS w FROM zolai_songs
  UNION ALL SELECT 'articles', id, regexp_extract_all(lower(content), '[\p{L}\p{M}\p{N}]+') FROM articles),
s AS (SELECT DISTINCT table_name, id, array_to_string(w[i:i + 2], ' ') AS g
      FROM (SELECT table_name, id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= 10)),
n AS (SELECT table_name, id, count(*) AS n FROM s GROUP BY 1, 2),
o AS (SELECT a.table_name, a.id AS id_a, b.id AS id_b, count(*) AS c FROM s a JOIN s b ON a.table_name = b.table_name AND a.g = b.g AND a.id < b.id GROUP BY 1, 2, 3),
f AS (SELECT o.table_name, id_a, id_b FROM o JOIN n x ON x.table_name = o.table_name AND x.id = id_a JOIN n y ON y.table_name = o.table_name AND y.id = id_b
      WHERE c >= 0.5 * (x.n + y.n - c))"""
SQL["p3_found"] = _P3 + "SELECT * FROM f"
# classes are rows with one set of shingles; groups are what links connect
SQL["p3_groups"] = _P3 + r""",
k AS (SELECT table_name, id, min(id) OVER (PARTITION BY table_name, x) AS class_id FROM (SELECT table_name, id, md5(array_to_string(list_sort(array_agg(g)), '|')) AS x FROM s GROUP BY 1, 2)),
e AS (SELECT DISTINCT f.table_name, a.class_id AS a, b.class_id AS b FROM f JOIN k a ON a.table_name = f.table_name AND a.id = f.id_a JOIN k b ON b.table_name = f.table_name AND b.id = f.id_b WHERE a.class_id <> b.class_id),
u AS (SELECT * FROM e UNION SELECT table_name, b, a FROM e),
r AS (SELECT DISTINCT table_name, class_id AS a, class_id AS b FROM k UNION SELECT r.table_name, r.a, u.b FROM r JOIN u ON u.table_name = r.table_name AND u.a = r.b),
l AS (SELECT table_name, a, min(b) AS group_id FROM r GROUP BY 1, 2)
SELECT k.table_name, k.id, class_id, group_id, (SELECT count(*) FROM u WHERE u.table_name = k.table_name AND u.a = class_id) AS n_links
FROM k JOIN l ON l.table_name = k.table_name AND l.a = class_id"""
# the sources at their limit are those of least limit / target share, up to where the rest of the total fits the others
SQL["p8_budgets"] = r"""
WITH n AS (SELECT source, sum(strlen(text))::BIGINT AS tokens FROM documents WHERE strlen(text) > 0 GROUP BY 1),
m AS (SELECT source, max(target_share) AS g, max(max_repeats) AS r FROM mix_targets WHERE source IS NOT NULL GROUP BY 1),
j AS (SELECT source, g, tokens, (tokens * r)::DOUBLE AS cap, cap / g AS limit_at FROM m JOIN n USING (source) WHERE g > 0 AND r > 0),
c AS (SELECT *, (SELECT sum(tokens) FROM j) - coalesce(sum(cap) OVER (ORDER BY limit_at, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(g) OVER (ORDER BY limit_at, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS goals FROM j),
k AS (SELECT min(limit_at) AS first_free, arg_min(rest / goals, limit_at) AS level FROM c WHERE rest / goals <= limit_at * (1 + 1e-9))
SELECT source, coalesce(tokens, 0) AS tokens,
       CASE WHEN tokens IS NULL THEN 0 WHEN limit_at < coalesce(first_free, 'inf'::DOUBLE) THEN cap ELSE floor(least(level * g, cap) + 1e-6) END::BIGINT AS budget,
       CASE WHEN tokens IS NOT NULL THEN limit_at < coalesce(first_free, 'inf'::DOUBLE) END AS at_limit
FROM m LEFT JOIN (SELECT source, tokens, cap, limit_at FROM c) USING (source) CROSS JOIN k"""
