"""DuckDB SQL for the corpus operators that SQL can express, written from their definitions."""
from __future__ import annotations

from .mixing import BLOCKS_PER_SHARD, N_SHARDS, SEED
from .sharding import SHARDS, SIZE
from .warc import TRACKING

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# One claim after the other: a bit string of the taken slots, and for each turn the first free slot in
# the preference order of the shard whose turn it is.
SHARDING = f"""
WITH RECURSIVE names AS (SELECT list_transform(range({len(SHARDS)}), lambda i: 'shard-' || lpad(i::VARCHAR, 2, '0')) AS l),
prefs AS (SELECT list_transform(l, lambda s: ('0x' || substr(md5('offset:' || s), 1, 15))::BIGINT % {SIZE}) AS off,
                 list_transform(l, lambda s: ('0x' || substr(md5('skip:' || s), 1, 15))::BIGINT % {SIZE - 1} + 1) AS skip FROM names),
claims AS (
  SELECT -1 AS turn, NULL::BIGINT AS slot, bitstring('0', {SIZE}) AS taken
  UNION ALL
  SELECT turn + 1, s, set_bit(taken, s::INTEGER, 1) FROM (
    SELECT turn, taken, (off[w] + skip[w] * list_filter(range({SIZE}), lambda j: get_bit(taken, ((off[w] + j * skip[w]) % {SIZE})::INTEGER) = 0)[1]) % {SIZE} AS s
    FROM (SELECT turn, taken, (turn + 1) % {len(SHARDS)} + 1 AS w FROM claims WHERE turn < {SIZE - 1}), prefs)
)
SELECT doc_id, k.slot AS slot, (turn % {len(SHARDS)})::INTEGER AS shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'text:' || md5(text), 'null')), 1, 15))::BIGINT % {SIZE} AS slot FROM documents) k
JOIN claims c ON c.slot = k.slot
"""

MIXING = f"""
WITH d AS (SELECT doc_id, text, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
             md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'text:' || md5(text), 'null')) AS o FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS s, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source),
w AS (SELECT *, ((rank - 1) % 3 + 1)::HUGEINT AS w, sum(s) OVER () AS total FROM s),
c AS (SELECT *, 3 * s * ((sum(w) OVER ()) - coalesce(sum(w) OVER b, 0)) <= w * (total - 3 * coalesce(sum(s) OVER b, 0)) AS capped
      FROM w WINDOW b AS (ORDER BY s::DOUBLE / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, s, rank, total, CASE WHEN capped THEN (3 * s)::DOUBLE
        ELSE (w * (total - coalesce(sum(3 * s) FILTER (capped) OVER (), 0)))::DOUBLE / (sum(w) FILTER (NOT capped) OVER ())::DOUBLE END AS target FROM c),
q AS (SELECT rank, target / (2 * k - 1) AS quotient, k FROM t, range(1, {N_SHARDS * BLOCKS_PER_SHARD + 1}) r(k) WHERE target > 0),
n AS (SELECT rank, count(*) AS quota FROM (SELECT rank FROM q ORDER BY quotient DESC, rank, k LIMIT {N_SHARDS * BLOCKS_PER_SHARD}) GROUP BY rank),
p AS (SELECT t.*, least(3 * s, coalesce(quota, 0) * total // {N_SHARDS * BLOCKS_PER_SHARD}) AS take FROM t LEFT JOIN n USING (rank)),
x AS (SELECT d.*, p.s, p.target, p.take, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, s::BIGINT AS source_size, target,
  CASE WHEN size = 0 THEN 0 ELSE (take // s) * size + greatest(least(first + size, take % s) - first, 0) END::BIGINT AS taken FROM x
"""

_WORDS = f"coalesce(regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"

# Words as rows of positions; a window is compared as its joined words (words hold no space).
DECONTAMINATION = f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
g AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, p, p + least(len(w), 10) - 1), ' ') AS win
      FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
l AS (SELECT DISTINCT n FROM g),
e AS (SELECT doc_id, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS win
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, l WHERE len(w) >= n)),
h AS (SELECT e.doc_id, e.p, e.n, g.item_id FROM e JOIN g ON e.win = g.win AND e.n = g.n),
c AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS at FROM h) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN k USING (doc_id)
"""

_TRACKED = ", ".join(f"'{t}'" for t in TRACKING)
REVISITS = f"""
WITH p AS (SELECT page_id, url, coalesce(length(html), 0) AS n_chars, md5(coalesce(html, '')) AS base,
             ('0x' || substr(md5(page_id::VARCHAR), 1, 8))::BIGINT AS h FROM pages),
v AS (SELECT *, unnest(range(0, h % 4 + 1)) AS visit FROM p),
k AS (SELECT *, page_id * 4 + visit AS record_id, ('0x' || substr(md5((page_id * 4 + visit)::VARCHAR), 1, 8))::BIGINT AS kind FROM v),
c AS (SELECT *, visit > 0 AND kind % 7 <> 0 AS again, CASE WHEN visit = 0 THEN '0' ELSE '1' END AS version,
        1700000000 + (page_id * 37 % 86400) * 30 + visit * 40000 AS t FROM k),
r AS (SELECT *, CASE WHEN h % 5 <> 0 THEN substr(md5(base || CASE WHEN again THEN CASE WHEN kind % 11 = 0 THEN 'stale' ELSE '0' END ELSE version END), 1, 12) END AS tag,
        CASE WHEN h % 3 <> 0 THEN 'm' || CASE WHEN again THEN '0' ELSE version END END AS modified,
        CASE WHEN contains(url, '://') THEN regexp_extract(url, '^.*?://([^#]*)', 1, 's') END AS rest FROM c),
u AS (SELECT *, regexp_replace(regexp_replace(translate(regexp_extract(rest, '^[^/?]*'), '{_UP}', '{_LOW}'), '^www[.]', ''), ':(80|443)$', '')
          || regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS site,
        list_sort(list_filter(string_split(regexp_extract(rest, '[?](.*)$', 1), '&'),
          lambda x: x <> '' AND split_part(x, '=', 1) NOT IN ({_TRACKED}))) AS params FROM r),
s AS (SELECT *, site || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS canonical FROM u),
f AS (SELECT *, last_value(CASE WHEN NOT again THEN {{'id': record_id, 'tag': tag, 'modified': modified, 'digest': base || '-' || version, 'n': n_chars}} END IGNORE NULLS)
        OVER (PARTITION BY canonical ORDER BY t, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS found FROM s),
o AS (SELECT *, CASE WHEN NOT again THEN 'full' WHEN found IS NULL OR canonical IS NULL THEN 'orphan'
        WHEN tag IS NOT NULL AND found.tag IS NOT NULL THEN CASE WHEN tag = found.tag THEN 'resolved' ELSE 'mismatch' END
        WHEN modified IS NOT NULL AND found.modified IS NOT NULL THEN CASE WHEN modified = found.modified THEN 'resolved' ELSE 'mismatch' END
        ELSE 'unvalidated' END AS outcome FROM f)
SELECT record_id, canonical, CASE WHEN again THEN 304 ELSE 200 END AS status,
  CASE WHEN outcome = 'full' THEN record_id WHEN outcome <> 'orphan' THEN found.id END AS refers_to, outcome,
  CASE outcome WHEN 'full' THEN base || '-' || version WHEN 'resolved' THEN found.digest END AS digest,
  CASE outcome WHEN 'full' THEN n_chars WHEN 'resolved' THEN found.n END::BIGINT AS n_chars,
  'content-length=' || CASE WHEN outcome = 'resolved' THEN found.n WHEN again THEN 0 ELSE n_chars END || ';date=t' || t || ';x-visit=' || visit AS headers
FROM o
"""

TOP_K = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * x.v[i]))::BIGINT AS score
      FROM e q JOIN e x ON q.vec_id <> x.vec_id AND q.vec_id % 50 = 0 AND len(q.v) = len(x.v))
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s) WHERE rank <= 5
"""

HARD_NEGATIVES = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, x.vec_id, x.label = a.label AS same,
        coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * x.v[i])), 0)::BIGINT AS score
      FROM e a JOIN e x ON a.vec_id % 100 = 0 AND a.vec_id <> x.vec_id AND len(a.v) = len(x.v)),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""

# crc32 from its definition: a table of 256 entries, then one step a byte.
SPELLING = f"""
WITH RECURSIVE t AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
r AS (SELECT doc_id, translate(run, '{_UP}', '{_LOW}') AS run, count(*) AS n
      FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL),
x AS (SELECT run, n, hex(encode(doc_id || ':' || run)) AS x FROM r),
b AS (SELECT run, n, list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT) AS b FROM x),
h AS (SELECT run, n, xor(list_reduce(b, lambda c, v: xor(t[(xor(c, v) & 255) + 1], c >> 8), 4294967295), 4294967295) AS h FROM b, t),
w AS (SELECT word, sum(n)::BIGINT AS n FROM (SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM h)
      WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
k AS (SELECT word, n, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
p AS (SELECT DISTINCT k.word AS a, u.word AS b FROM k JOIN w u ON u.word = k.l || k.r),
near AS (SELECT DISTINCT a.word, b.word AS near, b.n FROM k a JOIN k b ON a.l = b.l AND a.r = b.r AND a.word <> b.word
         UNION ALL SELECT a, b, w.n FROM p JOIN w ON w.word = b UNION ALL SELECT b, a, w.n FROM p JOIN w ON w.word = a),
best AS (SELECT word, near, n AS form_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, near) AS rank FROM near),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN near END AS form, CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
      FROM w LEFT JOIN best ON best.word = w.word AND rank = 1),
walk AS (SELECT word, word AS here, form AS next FROM f UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON f.word = walk.next)
SELECT f.word, form, here AS root, n, n_near, form_n FROM f JOIN walk ON walk.word = f.word AND walk.next IS NULL
"""

ORACLES = {"op6_warc_revisits": REVISITS, "op10_top_k": TOP_K, "op11_spelling_variants": SPELLING, "op13_hard_negatives": HARD_NEGATIVES, "op2_sharding": SHARDING, "op4_mixing": MIXING, "op5_decontamination": DECONTAMINATION}
