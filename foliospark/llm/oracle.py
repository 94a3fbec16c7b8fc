"""SQL (DuckDB) for the queries that SQL can express over the whole tables."""

from __future__ import annotations

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lower(x: str) -> str:
    return f"translate({x}, '{_UP}', '{_LOW}')"


_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
_BY_LENGTH = sorted(_RULES, key=lambda r: -len(r[1] + r[2]))
_FITS = [(f"((host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}'))", h + p, v) for v, h, p in _BY_LENGTH]
_GLOBS = (r"^[^/]*casino[^/]*/", r"^[^/]*\.cheap-pills\.[^/]*/", r"^[^/]*free-bets[^/]*/", r"^[^/]*\.ads-track\.[^/]*/", r"^[^/]*\.adserver\.[^/]*/", r"/wp-login\.php")

OP1 = f"""WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM u), p AS (SELECT page_id, {_lower("raw")} AS host, substr(regexp_extract(rest, '^[^?#]*'), length(raw) + 1) AS path FROM h)
SELECT page_id, host, path, CASE {" ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in _FITS)} END AS rule,
CASE {" ".join(f"WHEN {c} THEN '{v}'" for c, _, v in _FITS)} {" ".join(f"WHEN regexp_matches('.' || host || path, '{g}') THEN 'block'" for g in _GLOBS)} ELSE 'allow' END AS verdict FROM p"""

_KEY_HOST = "regexp_replace(lower(regexp_extract(rest, '^([^/?#]*)', 1)), '^www\\.|:(?:80|443)$', '', 'g')"
_KEY_PATH = "regexp_replace(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '/+$', '')"
_KEY_QUERY = "regexp_replace(regexp_replace(regexp_extract(rest, '\\?(.*)$', 1), '(?:^|&)utm_[^&]*', '', 'g'), '^&', '')"
OP3 = f"""WITH b AS (SELECT page_id, url, '"' || md5(coalesce(html, '')) || '"' AS tag, ('0x' || substr(md5(coalesce(url, '')), 1, 7))::BIGINT AS v, 'day ' || (page_id % 365) AS day, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?([^#]*)', 1) AS rest FROM pages),
k AS (SELECT *, {_KEY_HOST} AS host, {_KEY_PATH} AS path, {_KEY_QUERY} AS query FROM b),
x AS (SELECT *, CASE WHEN host <> '' THEN host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS url_key FROM k),
f AS (SELECT page_id * 2 AS id, url_key, page_id AS ts, CASE WHEN v % 5 <> 0 THEN tag END AS etag, CASE WHEN v % 10 <> 0 THEN day END AS modified, CASE WHEN v % 2 = 0 THEN 'max-age=60' END AS cc, tag AS digest FROM x),
r AS (SELECT page_id * 2 + 1 AS id, url_key, page_id + 1 + v % 1000 AS ts, CASE WHEN v % 7 = 0 THEN '"stale"' ELSE 'W/' || tag END AS etag, day AS modified, CASE WHEN v % 3 = 0 THEN 'no-store' END AS cc, tag AS digest FROM x),
j AS (SELECT r.id, max({{'ts': f.ts, 'id': f.id}}).id AS fid FROM r LEFT JOIN f ON f.url_key = r.url_key AND f.ts < r.ts GROUP BY r.id),
o AS (SELECT r.*, j.fid, f.etag AS old_etag, f.modified AS old_modified, f.digest AS old_digest, f.cc AS old_cc,
 CASE WHEN fid IS NULL THEN 'orphan' WHEN r.etag IS NOT NULL AND f.etag IS NOT NULL THEN CASE WHEN regexp_replace(r.etag, '^W/', '') = f.etag THEN 'etag' ELSE 'mismatch' END
 WHEN r.modified IS NOT NULL AND f.modified IS NOT NULL THEN CASE WHEN r.modified = f.modified THEN 'modified' ELSE 'mismatch' END WHEN r.digest = f.digest THEN 'digest' ELSE 'mismatch' END AS outcome FROM r JOIN j USING (id) LEFT JOIN f ON f.id = j.fid)
SELECT id AS record_id, url_key, ts, fid AS response_id, outcome, CASE WHEN outcome IN ('etag', 'modified', 'digest') THEN old_digest END AS digest,
CASE WHEN outcome IN ('etag', 'modified', 'digest') THEN array_to_string(list_filter(['cache-control: ' || coalesce(cc, old_cc), 'content-type: text/html', 'date: now', 'etag: ' || etag, 'expires: later', 'last-modified: ' || modified, 'server: old'], lambda x: x IS NOT NULL), chr(10)) END AS headers FROM o"""

OP4 = """WITH RECURSIVE a AS (SELECT conv_id, turn, 'c' || conv_id || '-' || turn AS call_id, length(coalesce(text, '')) AS n FROM conversations WHERE role = 'assistant'),
c AS (SELECT *, lag(call_id) OVER (PARTITION BY conv_id ORDER BY turn) AS l1, lag(call_id, 3) OVER (PARTITION BY conv_id ORDER BY turn) AS l3 FROM a),
d AS (SELECT *, list_filter([CASE WHEN n % 5 <> 0 THEN l1 END, CASE WHEN n % 2 = 0 THEN l3 END, CASE WHEN n % 17 = 0 THEN call_id END, CASE WHEN n % 19 = 0 THEN 'x' || call_id END], lambda x: x IS NOT NULL) AS needs FROM c),
e AS (SELECT call_id, unnest(needs) AS need FROM d), k AS (SELECT e.* FROM e JOIN a ON a.call_id = e.need),
lost AS (SELECT call_id FROM k WHERE need = call_id UNION SELECT k.call_id FROM k JOIN lost ON k.need = lost.call_id),
path AS (SELECT call_id, 0 AS far FROM a UNION SELECT k.call_id, far + 1 FROM k JOIN path ON k.need = path.call_id WHERE k.call_id NOT IN (SELECT call_id FROM lost)),
lev AS (SELECT call_id, max(far) AS level FROM path WHERE call_id NOT IN (SELECT call_id FROM lost) GROUP BY call_id),
res AS (SELECT conv_id, turn, 'c' || conv_id || '-' || (turn - 1) AS call_id, text FROM conversations WHERE role <> 'assistant' AND turn > 0 UNION ALL SELECT conv_id, turn, 'c' || conv_id || '-' || (turn + 1), text FROM conversations WHERE role <> 'assistant' AND length(coalesce(text, '')) % 10 = 3),
r AS (SELECT * FROM res QUALIFY row_number() OVER (PARTITION BY call_id ORDER BY turn, text NULLS FIRST) = 1),
p AS (SELECT d.*, level, CASE WHEN len(needs) > 0 THEN '"after":["' || array_to_string(needs, '","') || '"],' ELSE '' END AS af, CASE WHEN n % 4 < 2 THEN '0.5' ELSE '100' END AS score,
 CASE WHEN n % 3 = 0 AND n % 11 = 0 THEN 'limit is not integer' WHEN n % 3 = 1 AND n % 13 = 0 THEN 'depth is unknown' WHEN n % 3 = 2 AND n % 7 = 0 THEN 'score is missing' END AS e1, CASE WHEN n % 19 = 0 THEN 'x' || call_id || ' is an unknown call' END AS e2 FROM d LEFT JOIN lev USING (call_id))
SELECT p.conv_id, p.call_id, p.turn, CASE n % 3 WHEN 0 THEN 'search' WHEN 1 THEN 'lookup' ELSE 'rate' END AS name, CASE WHEN r.turn IS NULL THEN 'no_result' WHEN r.turn > p.turn THEN 'linked' ELSE 'early_result' END AS status, r.turn AS result_turn, r.text AS content,
level::INT AS level, (row_number() OVER (PARTITION BY p.conv_id ORDER BY level NULLS LAST, p.turn, p.call_id))::INT AS position, e1 IS NULL AND e2 IS NULL AS valid, concat_ws('; ', e1, e2) AS errors,
CASE n % 3 WHEN 0 THEN '{' || af || '"limit":' || CASE WHEN n % 11 = 0 THEN '"ten"' ELSE '10' END || ',"query":"q' || n || '"}' WHEN 1 THEN '{' || af || CASE WHEN n % 13 = 0 THEN '"depth":2' ELSE '"fields":["b","a"]' END || ',"id":' || n || '}'
ELSE '{' || af || CASE WHEN n % 7 = 0 THEN '"final":true}' ELSE '"final":false,"score":' || score || '}' END END AS arguments
FROM p LEFT JOIN r ON r.call_id = p.call_id"""

_ALNUM = "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'"
OP5 = f"""WITH d AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_ALNUM}) AS w FROM documents), b AS (SELECT item_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_ALNUM}) AS w FROM benchmark WHERE item_id IS NOT NULL),
i AS (SELECT item_id, least(8, len(w)) AS l, unnest(list_transform(range(1, greatest(1, len(w) - 7) + 1), lambda k: array_to_string(w[k:k + least(8, len(w)) - 1], ' '))) AS win FROM b WHERE len(w) > 0),
n AS (SELECT DISTINCT l FROM i),
p AS (SELECT doc_id, l, unnest(list_transform(range(1, len(w) - l + 2), lambda k: {{'k0': k, 'win': array_to_string(w[k:k + l - 1], ' ')}})) AS x FROM d, n WHERE len(w) >= l),
m AS (SELECT p.doc_id, x.k0 AS k0, i.l, i.item_id FROM p JOIN i ON i.l = p.l AND i.win = p.x.win),
h AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k0, k0 + l)) AS pos FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""

OP7 = """WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT *, count(*) OVER (PARTITION BY norm) AS group_size, first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id FROM n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g"""

# DuckDB has no crc32: a table of the polynomial's remainders, then byte by byte.
_CRC = "list_transform(range(256), lambda i: list_reduce(range(8), lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i::BIGINT))"
OP8 = f"""WITH k AS (SELECT {_CRC} AS rest), d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), b AS (SELECT doc_id, md5(t) AS h, strlen(t) + 1 AS size, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes FROM d),
r AS (SELECT doc_id, h, size, xor(list_reduce(bytes, lambda c, x: xor(c // 256, rest[xor(c, x) % 256 + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS text_crc32 FROM b, k),
o AS (SELECT *, sum(size) OVER (ORDER BY h, doc_id) - size AS before, sum(size) OVER () AS total FROM r),
s AS (SELECT *, least(7, floor((before + size / 2.0) * 8 / total)) AS own, sum(size) OVER (PARTITION BY h) AS together, min(before) OVER (PARTITION BY h) AS since FROM o),
m AS (SELECT *, CASE WHEN together <= 0.01 * total / 8 THEN least(7, floor((since + together / 2.0) * 8 / total)) ELSE own END AS moved, min(own) OVER (PARTITION BY h) <> max(own) OVER (PARTITION BY h) AS across FROM s)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, (CASE WHEN across THEN moved ELSE own END)::INT AS shard, row_number() OVER (PARTITION BY CASE WHEN across THEN moved ELSE own END ORDER BY h, doc_id) - 1 AS slot,
NULL::INT AS grown_shard, NOT (across AND together > 0.01 * total / 8) AS whole FROM m"""

_SPACE = "'[^\\x20\\x09-\\x0D]+'"
OP9 = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_SPACE}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)), u AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, u.y FROM r JOIN u ON r.b = u.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) m ON m.a = d.doc_id"""

ORACLE = {"op1_url_filters": OP1, "op3_warc_revisits": OP3, "op4_chat_tool_calls": OP4, "op5_decontamination": OP5, "op7_exact_dedup": OP7, "op8_sharding": OP8, "op9_ngram_jaccard": OP9}
