"""DuckDB SQL for the queries that SQL can express, over whole tables."""

OP2_SQL = """WITH tab AS (SELECT list(list_reduce(range(8), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, CAST(n AS BIGINT)) ORDER BY n) AS tab FROM range(256) r(n)),
b AS (SELECT doc_id, text, coalesce(octet_length(encode(text)), 0) + 8 AS size, CASE WHEN text IS NOT NULL THEN xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT)), lambda a, v: xor(a >> 8, tab[(xor(a, v) & 255) + 1]), CAST(4294967295 AS BIGINT))) END AS text_crc32 FROM documents, tab),
p AS (SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS whole, row_number() OVER (ORDER BY doc_id) AS place FROM b),
s AS (SELECT *, CAST(least(23, floor((before + size / 2.0::DOUBLE) * 24 / whole)) AS INT) AS shard FROM p)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard, place - min(place) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INT) AS grown_shard FROM s"""

OP5_SQL = """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sqrt(list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])), lambda a, b: a + b)) AS score
 FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INT) AS rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

OP7_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS sh
 FROM w, LATERAL (SELECT unnest(range(1, greatest(2, len(ws) - 3))) AS i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * shared >= 75 * (nx.n + ny.n - shared)),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.y, r.seen FROM r JOIN l ON r.doc_id = l.x WHERE r.seen < l.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.least AS component_id FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(seen) AS least FROM r GROUP BY doc_id) r USING (doc_id)"""

OP8_SQL = r"""WITH d AS (SELECT doc_id, text, list_filter(string_split(regexp_replace(text, '\n', chr(10) || chr(1), 'g'), chr(1)), lambda x: x <> '') AS s FROM documents),
k AS (SELECT doc_id, list_transform(s, lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS keys FROM d),
u AS (SELECT doc_id, len(s) AS n, i, s[i] AS part, len(regexp_extract_all(s[i], '[^\x20\x09-\x0D]+')) AS w FROM d, LATERAL (SELECT unnest(range(1, len(s) + 1)) AS i)),
c AS (SELECT *, CAST(sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS upto FROM u),
r AS (SELECT a.doc_id, a.i, min(b.i) AS e FROM c a JOIN c b ON b.doc_id = a.doc_id AND b.i >= a.i AND b.upto - a.upto + a.w >= 8 GROUP BY 1, 2
 UNION SELECT b.doc_id, max(a.i), b.i FROM c b JOIN c a ON b.doc_id = a.doc_id AND b.i >= a.i AND b.upto - a.upto + a.w >= 8 GROUP BY b.doc_id, b.i),
a AS (SELECT doc_id, i, e, array_to_string(keys[i:e], chr(1)) AS run FROM r JOIN k USING (doc_id)),
later AS (SELECT doc_id, i, e FROM (SELECT *, min(doc_id) OVER (PARTITION BY run) AS first, row_number() OVER (PARTITION BY run, doc_id ORDER BY i) AS nth FROM a) WHERE doc_id > first OR nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, e + 1)) AS i FROM later),
j AS (SELECT u.doc_id, u.i, u.n, u.part, gone.i IS NOT NULL AS gone FROM u LEFT JOIN gone ON gone.doc_id = u.doc_id AND gone.i = u.i),
t AS (SELECT doc_id, coalesce(string_agg(part, '' ORDER BY i) FILTER (NOT gone), '') AS text, bool_or(gone AND i = n) AS cut, count(*) AS n, count(*) FILTER (gone) AS removed FROM j GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN t.cut THEN rtrim(t.text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) ELSE coalesce(t.text, d.text) END AS text, CAST(coalesce(t.n, 0) AS INT) AS lines, CAST(coalesce(t.removed, 0) AS INT) AS removed FROM d LEFT JOIN t USING (doc_id)"""

OP9_SQL = r"""WITH d AS (SELECT doc_id, text, list_filter(string_split(regexp_replace(text, '([.!?][ \t\r\x0B\f]|\n)', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS s FROM documents),
k AS (SELECT doc_id, list_transform(s, lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS keys FROM d),
u AS (SELECT doc_id, len(s) AS n, i, s[i] AS part, len(regexp_extract_all(s[i], '[^\x20\x09-\x0D]+')) AS w FROM d, LATERAL (SELECT unnest(range(1, len(s) + 1)) AS i)),
c AS (SELECT *, CAST(sum(w) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS upto FROM u),
r AS (SELECT a.doc_id, a.i, min(b.i) AS e FROM c a JOIN c b ON b.doc_id = a.doc_id AND b.i > a.i AND b.upto - a.upto + a.w >= 20 GROUP BY 1, 2),
a AS (SELECT doc_id, i, e, array_to_string(keys[i:e], chr(1)) AS run FROM r JOIN k USING (doc_id)),
later AS (SELECT doc_id, i, e FROM (SELECT *, min(doc_id) OVER (PARTITION BY run) AS first, row_number() OVER (PARTITION BY run, doc_id ORDER BY i) AS nth FROM a) WHERE doc_id > first OR nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, e + 1)) AS i FROM later),
j AS (SELECT u.doc_id, u.i, u.n, u.part, gone.i IS NOT NULL AS gone FROM u LEFT JOIN gone ON gone.doc_id = u.doc_id AND gone.i = u.i),
t AS (SELECT doc_id, coalesce(string_agg(part, '' ORDER BY i) FILTER (NOT gone), '') AS text, bool_or(gone AND i = n) AS cut, count(*) AS n, count(*) FILTER (gone) AS removed FROM j GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN t.cut THEN rtrim(t.text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) ELSE coalesce(t.text, d.text) END AS text, CAST(coalesce(t.n, 0) AS INT) AS sentences, CAST(coalesce(t.removed, 0) AS INT) AS removed FROM d LEFT JOIN t USING (doc_id)"""

OP11_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT *, CAST('0x' || x[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || x[9:16] AS BIGINT) % (n + 1) AS b, CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
f AS (SELECT *, CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form, least(a, b) AS low, greatest(a, b) AS high FROM h),
c AS (SELECT *, substring(text, 1, low) AS prefix, substring(text, low + 1, high - low) AS middle, substring(text, high + 1) AS suffix FROM f),
o AS (SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars, sha256(output) AS output_sha256,
 sha256(CASE WHEN form = 'plain' THEN output ELSE string_split(string_split(string_split(output, '<P>')[2], '<S>')[1], '<M>')[1] || string_split(output, '<M>')[2] || string_split(string_split(string_split(output, '<S>')[2], '<P>')[1], '<M>')[1] END) AS restored_sha256 FROM o"""

OP12_SQL = r"""WITH tab AS (SELECT list(list_reduce(range(8), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, CAST(n AS BIGINT)) ORDER BY n) AS tab FROM range(256) r(n)),
texts AS (SELECT row_number() OVER () AS id, doc_id, text, true AS own FROM documents UNION ALL SELECT -row_number() OVER (), NULL, text, false FROM benchmark),
w AS (SELECT id, own, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM texts WHERE text IS NOT NULL),
f AS (SELECT id, own, unnest(ws || list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS feature FROM w),
b AS (SELECT feature, xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(feature)), '..'), lambda x: CAST('0x' || x AS BIGINT)), lambda a, v: xor(a >> 8, tab[(xor(a, v) & 255) + 1]), CAST(4294967295 AS BIGINT))) % 10000 AS bucket FROM (SELECT DISTINCT feature FROM f), tab),
n AS (SELECT bucket, CAST(count(*) FILTER (own) AS DOUBLE) AS s, CAST(count(*) FILTER (NOT own) AS DOUBLE) AS t FROM f JOIN b USING (feature) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000)))) AS gain FROM n),
x AS (SELECT id, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM f JOIN b USING (feature) JOIN g USING (bucket) WHERE own GROUP BY id),
d AS (SELECT t.id, t.doc_id, coalesce(len(w.ws), 0) AS n_words, coalesce(x.n_features, 0) AS n_features, coalesce(x.weight, 0) AS weight, CAST('0x' || sha256('7:' || coalesce(CAST(t.doc_id AS VARCHAR), ''))[1:8] AS BIGINT) AS h
 FROM texts t LEFT JOIN w ON w.id = t.id LEFT JOIN x ON x.id = t.id WHERE t.own),
s AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM d),
r AS (SELECT id, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS whole FROM s WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r.rank <= whole * 25 // 100 THEN r.rank END AS rank FROM s LEFT JOIN r ON r.id = s.id"""

ORACLE = {"op2_sharding": OP2_SQL, "op5_neighbours": OP5_SQL, "op7_jaccard_join": OP7_SQL, "op8_line_dedup": OP8_SQL, "op9_span_dedup": OP9_SQL, "op11_fill_in_middle": OP11_SQL, "op12_target_resampling": OP12_SQL}
