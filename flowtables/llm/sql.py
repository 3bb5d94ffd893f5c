"""SQL for queries that it can express, longer than a few lines."""

#: Leaves, trees, the tree of trees, siblings by level, then every leaf folded along its way.
MANIFEST = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, unnest([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text]) AS v, unnest([1, 2, 3, 4, 5]) AS pos,
    unnest([CAST(doc_id AS VARCHAR), source, lang, CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR), text]) AS w
  FROM documents),
leaves AS (
  SELECT doc_id, any_value(lang) AS lang,
    sha256(string_agg(CASE WHEN v IS NULL THEN '-' ELSE strlen(v) || ':' || v END, '' ORDER BY pos)) AS leaf,
    sha256(string_agg(CASE WHEN w IS NULL THEN '-' ELSE strlen(w) || ':' || w END, '' ORDER BY pos)) AS other,
    list_reduce(
      list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: [CAST(ascii(d) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS inverse
  FROM fields GROUP BY doc_id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
nodes AS (
  SELECT 0 AS level, lang, place, leaf AS digest, n FROM placed
  UNION ALL
  SELECT level + 1, lang, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY level, lang, place // 2),
subroots AS (SELECT lang, digest AS subroot FROM nodes WHERE n = 1),
trees AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER () AS n FROM subroots),
tops AS (
  SELECT 0 AS level, tree AS place, subroot AS digest, n FROM trees
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 1) // 2
  FROM tops WHERE n > 1 GROUP BY level, place // 2),
lower AS (
  SELECT p.doc_id, v.level, (p.place >> v.level) % 2 AS side, v.digest
  FROM placed AS p JOIN nodes AS v ON v.lang IS NOT DISTINCT FROM p.lang AND v.place = xor(p.place >> v.level, 1)),
upper AS (
  SELECT p.doc_id, 100 + v.level AS level, (t.tree >> v.level) % 2 AS side, v.digest
  FROM placed AS p JOIN trees AS t ON t.lang IS NOT DISTINCT FROM p.lang JOIN tops AS v ON v.place = xor(t.tree >> v.level, 1)),
proofs AS (
  SELECT doc_id, sha256(string_agg(digest, '' ORDER BY level)) AS proof_sha256 FROM (SELECT * FROM lower UNION ALL SELECT * FROM upper) GROUP BY doc_id),
steps AS (
  SELECT doc_id, level FROM placed AS p JOIN (SELECT DISTINCT lang, level FROM nodes WHERE n > 1) AS v ON v.lang IS NOT DISTINCT FROM p.lang
  UNION ALL SELECT doc_id, 100 + level FROM placed, (SELECT DISTINCT level FROM tops WHERE n > 1)),
way AS (
  SELECT doc_id, list({'side': side, 'digest': digest} ORDER BY level) AS way
  FROM steps LEFT JOIN (SELECT * FROM lower UNION ALL SELECT * FROM upper) USING (doc_id, level) GROUP BY doc_id),
folds AS (
  SELECT p.doc_id, 1 AS pos, CASE WHEN xor(p.inverse, 4294967295) % 7 = 0 THEN p.other ELSE p.leaf END AS digest, coalesce(w.way, []) AS way
  FROM placed AS p LEFT JOIN way AS w USING (doc_id)
  UNION ALL
  SELECT doc_id, pos + 1, sha256(CASE WHEN way[pos].side = 1 THEN way[pos].digest || digest WHEN way[pos].side = 0 THEN digest || way[pos].digest ELSE digest END), way
  FROM folds WHERE pos <= len(way)),
folded AS (SELECT doc_id, digest AS folded_root FROM folds WHERE pos = len(way) + 1)
SELECT p.doc_id, p.leaf, s.subroot, r.digest AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.folded_root, f.folded_root = r.digest AS verified
FROM placed AS p JOIN subroots AS s ON s.lang IS NOT DISTINCT FROM p.lang JOIN (SELECT digest FROM tops WHERE n = 1) AS r ON true
LEFT JOIN proofs AS q USING (doc_id) JOIN folded AS f USING (doc_id)
"""

#: Faults, then the least (cost, edits) by row and state, then the edits played over the rows.
REPAIR = r"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(
      list_concat([4294967295], flatten(list_transform(
        string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
        lambda d: [CAST(ascii(d) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) % 20 AS fate
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hashed WHERE fate <> 0),
placed AS (
  SELECT *, left(role, 1) AS initial,
    right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i
  FROM damaged),
faults AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM placed),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
roles(f, t, r) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (3, 2, 'u'), (2, 3, 'a')),
inserts(f, t, c, e) AS (
  VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 2, 2, 'I'), (1, 3, 4, 'II'), (2, 3, 2, 'I'), (3, 2, 2, 'I')),
edits(f, t, r, c, e) AS (
  SELECT s, s, NULL, 3, 'D' FROM (VALUES (0), (1), (2), (3)) AS states(s)
  UNION ALL SELECT f, t, r, 0, 'K' FROM roles
  UNION ALL SELECT f, t, NULL, 2, 'R' FROM roles WHERE r <> 's'),
ways AS (
  SELECT conv_id, 0 AS i, 0 AS state, '0000000000' AS best FROM counts
  UNION ALL
  SELECT w.conv_id, w.i + 1, e.t,
    min(printf('%010d', CAST(left(w.best, 10) AS INTEGER) + n.c + e.c + CASE WHEN e.e <> 'D' AND r.fault = 'truncated' THEN 1 ELSE 0 END) || substr(w.best, 11) || n.e || e.e)
  FROM ways AS w JOIN faults AS r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
    JOIN inserts AS n ON n.f = w.state JOIN edits AS e ON e.f = n.t
  WHERE e.e = 'D' OR (r.fault NOT IN ('blank', 'duplicate') AND (e.r IS NULL OR e.r = r.initial))
  GROUP BY w.conv_id, w.i, e.t),
solved AS (
  SELECT c.conv_id, min(printf('%010d', CAST(left(w.best, 10) AS INTEGER) + n.c) || substr(w.best, 11) || n.e) AS best
  FROM counts AS c JOIN ways AS w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n JOIN inserts AS n ON n.f = w.state AND n.t IN (0, 3)
  GROUP BY c.conv_id),
letters AS (
  SELECT conv_id, unnest(string_split(substr(best, 11), '')) AS e, unnest(range(1, length(best) - 9)) AS k FROM solved WHERE length(best) > 10),
steps AS (
  SELECT *, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS o FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)),
turns AS (
  SELECT s.conv_id, s.e, s.o, r.role, r.text, max(CASE WHEN s.o = 1 AND s.e = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS led
  FROM steps AS s LEFT JOIN faults AS r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i AND s.e <> 'I'
  WHERE s.e <> 'D'),
mended AS (
  SELECT conv_id, sha256(string_agg(
    CASE WHEN e = 'K' THEN role WHEN (o - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY o)) AS digest
  FROM turns GROUP BY conv_id)
SELECT v.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
  coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(CAST(left(s.best, 10) AS BIGINT), 0) AS cost,
  coalesce(substr(s.best, 11), '') AS audit, coalesce(m.digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS v
LEFT JOIN counts AS c ON c.conv_id IS NOT DISTINCT FROM v.conv_id
LEFT JOIN solved AS s ON s.conv_id IS NOT DISTINCT FROM v.conv_id
LEFT JOIN mended AS m ON m.conv_id IS NOT DISTINCT FROM v.conv_id
"""
