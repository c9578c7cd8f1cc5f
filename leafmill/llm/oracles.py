"""SQL for operators 2 and 9, written apart from them: plain joins over whole tables, for small scales only."""

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

JACCARD = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS sh FROM d, unnest(generate_series(1, greatest(len(w) - 4, least(len(w), 1)))) AS u(i)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.doc_id),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, count(*) OVER (PARTITION BY component_id) AS group_size FROM c LEFT JOIN n USING (doc_id)
"""

LINES = f"""
WITH l AS (SELECT doc_id, u.i, u.line, {_WORDS.format("u.line")} AS w0 FROM documents, LATERAL (SELECT unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i) u),
m AS (SELECT doc_id, i, list_transform(w0, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS w, len(w0) AS n FROM l WHERE len(w0) >= 8),
k AS (SELECT doc_id, i, unnest(CASE WHEN n >= 24 THEN [['whole', array_to_string(w[4:], ' ')], ['first', array_to_string(w[4:3 + (n - 3) // 2], ' ')], ['second', array_to_string(w[4 + (n - 3) // 2:], ' ')]]
             ELSE [['whole', array_to_string(w[4:], ' ')]] END) AS t, n, array_to_string(w[1:3], ' ') AS lead FROM m),
f AS (SELECT t, n, lead, count(DISTINCT doc_id) AS docs, min((doc_id, i)) AS first FROM k GROUP BY ALL HAVING count(DISTINCT doc_id) >= 3),
g AS (SELECT DISTINCT k.doc_id, k.i FROM k JOIN f USING (t, n, lead) WHERE (k.doc_id, k.i) <> f.first),
o AS (SELECT l.doc_id, count(*) AS n_lines, count(g.i) AS gone, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS kept FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY 1),
e AS (SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, gone > 0 AND len({_WORDS.format("kept")}) > 0 AS cut, gone, kept, coalesce(d.text, '') AS text FROM documents d LEFT JOIN o USING (doc_id))
SELECT doc_id, n_lines, CASE WHEN cut THEN gone ELSE 0 END AS n_dropped, sha256(CASE WHEN cut THEN kept ELSE text END) AS kept_sha256, strlen(CASE WHEN cut THEN kept ELSE text END) AS kept_bytes FROM e
"""
