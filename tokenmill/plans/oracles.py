"""DuckDB oracles for the registered queries.

Written from the semantics, independently of the Spark plans: tokens are
handled one row per token, windows are cut by integer division of the
token position, specials by splitting on the literal text, etc.
"""
from __future__ import annotations

from ..functions.text import OTHER_WHITESPACE
from . import catalog as C

EOT = "<|endoftext|>"
MARK = "Ġ"
_OTHER_WS = ", ".join(f"chr({ord(c)})" for c in OTHER_WHITESPACE)

DOCS = f"""docs AS (
  SELECT CAST(doc_id % {C.N_SHARDS} AS INTEGER) AS shard_idx,
         CAST(doc_id // {C.N_SHARDS} AS BIGINT) AS row_idx, text
  FROM documents)"""

PREP = f"""prep AS (
  SELECT shard_idx, row_idx, replace(regexp_replace(text, '^ ', ''), ' ', '{MARK}') AS p FROM docs)"""

VOCAB = f"""base AS (
  SELECT CAST(i AS INTEGER) AS token, chr(CAST(i AS INTEGER)) AS text, 'base' AS kind FROM range(256) t(i)),
cand AS (
  SELECT DISTINCT ch AS text FROM (SELECT unnest(string_split(p, '')) AS ch FROM prep WHERE length(p) > 0)
  UNION SELECT '{MARK}' UNION SELECT '{EOT}'),
extra AS (
  SELECT CAST(255 + row_number() OVER (ORDER BY text) AS INTEGER) AS token, text,
         CASE WHEN text = '{EOT}' THEN 'special' ELSE 'char' END AS kind
  FROM cand WHERE text NOT IN (SELECT text FROM base)),
vocab AS (SELECT * FROM base UNION ALL SELECT * FROM extra)"""



def _pieces(docs: str = "docs") -> str:
    """Pieces by character classes: every character is a line break (n), space (s), other
    white space (o) or part of a word (w). A space whose next character, other white
    space aside, is of a word belongs to that word; any other is a piece."""
    return f"""pch AS (
  SELECT shard_idx, row_idx, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS i
  FROM {docs} WHERE text <> ''),
pcl AS (
  SELECT *, CASE WHEN ch IN (chr(10), chr(13)) THEN 'n' WHEN ch = ' ' THEN 's' WHEN ch IN ({_OTHER_WS}) THEN 'o' ELSE 'w' END AS c
  FROM pch),
pnb AS (
  SELECT *, lag(c) OVER w AS before, lag(i) OVER w AS before_i, lead(c) OVER w AS after
  FROM pcl WHERE c <> 'o' WINDOW w AS (PARTITION BY shard_idx, row_idx ORDER BY i)),
pst AS (
  SELECT *, c <> 'w' OR before IS DISTINCT FROM 'w' OR before_i <> i - 1 AS starts
  FROM pnb WHERE c <> 's' OR after IS DISTINCT FROM 'w'),
pno AS (
  SELECT *, sum(starts::INTEGER) OVER (PARTITION BY shard_idx, row_idx ORDER BY i) AS no FROM pst),
pone AS (
  SELECT shard_idx, row_idx, no, string_agg(CASE WHEN c = 's' THEN '{MARK}' WHEN c = 'w' AND starts AND before = 's' THEN '{MARK}' || ch
         ELSE ch END, '' ORDER BY i) AS piece FROM pno GROUP BY ALL),
pall AS (SELECT shard_idx, row_idx, list(piece ORDER BY no) AS pieces FROM pone GROUP BY ALL),
pc AS MATERIALIZED (
  SELECT d.shard_idx, d.row_idx, coalesce(p.pieces, []) AS pieces
  FROM {docs} d LEFT JOIN pall p ON p.shard_idx = d.shard_idx AND p.row_idx = d.row_idx)"""


PIECES = _pieces()

# Char-level encoding: every character of every piece is one token, then EOT.
def _shard_tokens(docs: str) -> str:
    return f"""{docs},
{PREP},
{VOCAB},
{PIECES},
pcs AS (
  SELECT shard_idx, row_idx, string_split(array_to_string(pieces, ''), '') AS cs FROM pc),
ptok AS (
  SELECT u.shard_idx, u.row_idx, list(v.token ORDER BY u.pos) AS toks
  FROM (SELECT shard_idx, row_idx, unnest(cs) AS ch, generate_subscripts(cs, 1) AS pos
        FROM pcs WHERE cs <> ['']) u
  JOIN vocab v ON v.text = u.ch GROUP BY u.shard_idx, u.row_idx),
st AS (
  SELECT d.shard_idx, d.row_idx,
         list_concat(coalesce(t.toks, []), [(SELECT token FROM vocab WHERE text = '{EOT}')]) AS toks
  FROM docs d LEFT JOIN ptok t ON t.shard_idx = d.shard_idx AND t.row_idx = d.row_idx
  WHERE d.text IS NOT NULL AND d.text <> ''),
tot AS (SELECT shard_idx, CAST(sum(len(toks)) AS BIGINT) AS t FROM st GROUP BY shard_idx),
offs AS (
  SELECT shard_idx, row_idx, CAST(len(toks) AS BIGINT) AS n_tokens,
         CAST(coalesce(sum(len(toks)) OVER (PARTITION BY shard_idx ORDER BY row_idx
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off
  FROM st)"""


SHARD_TOKENS = _shard_tokens(DOCS)

V, T, W = C.N_VAL, C.N_TEST, C.CONTEXT + 1

WINDOWS = f"""{SHARD_TOKENS},
tk AS (
  SELECT u.shard_idx, o.off + u.i - 1 AS p, u.token
  FROM (SELECT shard_idx, row_idx, unnest(toks) AS token, generate_subscripts(toks, 1) AS i FROM st) u
  JOIN offs o ON o.shard_idx = u.shard_idx AND o.row_idx = u.row_idx),
lab AS (
  SELECT shard_idx, token,
         CASE WHEN shard_idx = 0 AND p < {V} THEN 'val'
              WHEN shard_idx = 0 AND p < {V + T} THEN 'test' ELSE 'train' END AS split,
         CASE WHEN shard_idx = 0 AND p < {V} THEN p
              WHEN shard_idx = 0 AND p < {V + T} THEN p - {V}
              WHEN shard_idx = 0 THEN p - {V + T} ELSE p END AS rel
  FROM tk),
win AS (
  SELECT split, shard_idx, CAST(rel // {W} AS BIGINT) AS chunk_idx, list(token ORDER BY rel) AS w
  FROM lab GROUP BY split, shard_idx, rel // {W}),
windows AS (SELECT * FROM win WHERE len(w) = {W})"""


def _seg_parts() -> str:
    return f"""{DOCS},
inj AS (SELECT shard_idx, row_idx, '{EOT}' || replace(text, chr(10), '{EOT}') AS t FROM docs),
sp AS (SELECT shard_idx, row_idx, string_split(t, '{EOT}') AS parts FROM inj),
parts AS (
  SELECT shard_idx, row_idx, unnest(parts) AS part, generate_subscripts(parts, 1) AS i, len(parts) AS n
  FROM sp)"""


ORACLES: dict[str, str] = {
    "scan_docs": f"WITH {DOCS} SELECT shard_idx, row_idx, text FROM docs",
    "nonempty_docs": f"""WITH {DOCS}
SELECT shard_idx, row_idx, CAST(length(text) AS BIGINT) AS n_chars FROM docs
WHERE text IS NOT NULL AND text <> ''""",
    "preprocessed_chars": f"""WITH {DOCS}, {PREP}
SELECT shard_idx, row_idx, CAST(length(p) AS BIGINT) AS n_chars,
       array_to_string(string_split(p, ''), ' ') AS chars FROM prep""",
    "distinct_chars": f"""WITH {DOCS}, {PREP}
SELECT ch, COUNT(*) AS n_docs FROM (
  SELECT DISTINCT shard_idx, row_idx, ch FROM (
    SELECT shard_idx, row_idx, unnest(string_split(p, '')) AS ch FROM prep WHERE length(p) > 0))
GROUP BY ch""",
    "initial_vocab": f"WITH {DOCS}, {PREP}, {VOCAB} SELECT token, text, kind FROM vocab",
    "pieces": f"""WITH {DOCS}, {PIECES}
SELECT shard_idx, row_idx, CAST(len(pieces) AS BIGINT) AS n_pieces,
       array_to_string(pieces, ' ') AS pieces FROM pc""",
    "special_segments": f"""WITH {_seg_parts()},
segs AS (
  SELECT shard_idx, row_idx, i, 0 AS k, part AS seg_text, false AS special FROM parts WHERE part <> ''
  UNION ALL
  SELECT shard_idx, row_idx, i, 1 AS k, '{EOT}' AS seg_text, true AS special FROM parts WHERE i < n)
SELECT shard_idx, row_idx,
       CAST(row_number() OVER (PARTITION BY shard_idx, row_idx ORDER BY i, k) - 1 AS INTEGER) AS seg_idx,
       special, seg_text
FROM segs""",
    "special_segments_leading": f"""WITH {_seg_parts()},
lead AS (
  SELECT shard_idx, row_idx, min(i) FILTER (WHERE part <> '') AS f, max(n) AS n
  FROM parts GROUP BY shard_idx, row_idx),
segs AS (
  SELECT p.shard_idx, p.row_idx, p.i AS ord, true AS special, '{EOT}' AS seg_text
  FROM parts p JOIN lead l ON l.shard_idx = p.shard_idx AND l.row_idx = p.row_idx
  WHERE p.i < coalesce(l.f, l.n)
  UNION ALL
  SELECT p.shard_idx, p.row_idx, p.i, false, p.part
  FROM parts p JOIN lead l ON l.shard_idx = p.shard_idx AND l.row_idx = p.row_idx WHERE p.i = l.f
  UNION ALL
  SELECT p.shard_idx, p.row_idx, p.i, false, '{EOT}' || p.part
  FROM parts p JOIN lead l ON l.shard_idx = p.shard_idx AND l.row_idx = p.row_idx WHERE p.i > l.f)
SELECT shard_idx, row_idx,
       CAST(row_number() OVER (PARTITION BY shard_idx, row_idx ORDER BY ord) - 1 AS INTEGER) AS seg_idx,
       special, seg_text
FROM segs""",
    "char_tokens": f"""WITH {DOCS}, {PREP}, {VOCAB},
ct AS (
  SELECT u.shard_idx, u.row_idx, list(v.token ORDER BY u.pos) AS toks
  FROM (SELECT shard_idx, row_idx, unnest(string_split(p, '')) AS ch,
               generate_subscripts(string_split(p, ''), 1) AS pos FROM prep WHERE length(p) > 0) u
  JOIN vocab v ON v.text = u.ch GROUP BY u.shard_idx, u.row_idx)
SELECT d.shard_idx, d.row_idx, array_to_string(coalesce(ct.toks, []), ' ') AS tokens,
       CAST(len(coalesce(ct.toks, [])) AS BIGINT) AS n_tokens
FROM docs d LEFT JOIN ct ON ct.shard_idx = d.shard_idx AND ct.row_idx = d.row_idx""",
    "shard_tokens": f"""WITH {SHARD_TOKENS}
SELECT shard_idx, row_idx, CAST(len(toks) AS BIGINT) AS n_tokens, array_to_string(toks, ' ') AS tokens
FROM st""",
    "shard_stats": f"""WITH {SHARD_TOKENS},
nd AS (SELECT shard_idx, COUNT(*) AS n_docs FROM docs GROUP BY shard_idx)
SELECT nd.shard_idx, CAST(coalesce(tot.t, 0) AS BIGINT) AS n_tokens, nd.n_docs
FROM nd LEFT JOIN tot ON tot.shard_idx = nd.shard_idx""",
    "doc_offsets": f"""WITH {SHARD_TOKENS}
SELECT shard_idx, row_idx, n_tokens, off AS "offset" FROM offs""",
    "training_sample": None,  # filled below
    "training_sample_budget": None,
    "missing_shards": f"""SELECT CAST(i AS INTEGER) AS shard_idx, printf('shard_%05d.parquet', i) AS file_name
FROM range(50) t(i)
WHERE i NOT IN (SELECT DISTINCT doc_id % {C.N_SHARDS} FROM documents)""",
    "shard_budget": f"""WITH {SHARD_TOKENS},
cum AS (SELECT shard_idx, sum(t) OVER (ORDER BY shard_idx) AS c,
               row_number() OVER (ORDER BY shard_idx) AS k FROM tot)
SELECT CAST({int(20 * C.BUDGET_PARAMS)} AS BIGINT) AS budget_tokens,
       CAST(min(k) FILTER (WHERE c >= {int(20 * C.BUDGET_PARAMS)}) AS BIGINT) AS n_shards,
       CAST(max(c) AS BIGINT) AS total_tokens,
       CAST(ceil({20 * C.BUDGET_PARAMS} / 50000000.0) AS BIGINT) AS est_shards
FROM cum""",
    "split_sizes": f"""WITH {SHARD_TOKENS},
rng AS (
  SELECT 'val' AS split, shard_idx, least(t, {V}) AS n FROM tot WHERE shard_idx = 0
  UNION ALL SELECT 'test', shard_idx, least(greatest(t - {V}, 0), {T}) FROM tot WHERE shard_idx = 0
  UNION ALL SELECT 'train', shard_idx,
                   CASE WHEN shard_idx = 0 THEN t - least(t, {V + T}) ELSE t END FROM tot)
SELECT split, shard_idx, CAST(n AS BIGINT) AS n_tokens, CAST(n // {W} AS BIGINT) AS n_windows FROM rng""",
    "token_windows": f"""WITH {WINDOWS}
SELECT split, shard_idx, chunk_idx, array_to_string(w[1:{W - 1}], ' ') AS input_ids,
       array_to_string(w[2:{W}], ' ') AS target_ids
FROM windows""",
    "worker_stripes": f"""WITH {WINDOWS}
SELECT split, CAST(CASE WHEN split = 'train' THEN shard_idx % {C.N_WORKERS} ELSE 0 END AS INTEGER) AS worker,
       COUNT(*) AS n_windows
FROM windows GROUP BY ALL""",
}


def _sample_sql(fraction: float, max_chars: int) -> str:
    return f"""WITH {DOCS},
s0 AS (SELECT row_idx, text, row_number() OVER (ORDER BY row_idx) AS rn FROM docs WHERE shard_idx = 0),
ns AS (SELECT greatest(1, CAST(floor(COUNT(*) * CAST({fraction!r} AS DOUBLE)) AS BIGINT)) AS n FROM s0),
smp AS (SELECT row_idx, text FROM s0 WHERE rn <= (SELECT n FROM ns) AND text IS NOT NULL AND text <> ''),
bud AS (
  SELECT row_idx, text, coalesce(sum(length(text)) OVER (ORDER BY row_idx
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM smp)
SELECT row_idx, substring(text, 1, CAST({max_chars} - before AS BIGINT)) AS text,
       CAST(length(substring(text, 1, CAST({max_chars} - before AS BIGINT))) AS BIGINT) AS n_chars
FROM bud WHERE before < {max_chars}"""


ORACLES["training_sample"] = _sample_sql(*C.SAMPLE)
ORACLES["training_sample_budget"] = _sample_sql(*C.SAMPLE_TIGHT)

# --- pieces as a corpus of pair occurrences -------------------------------------
OCC = f"""{DOCS}, {PIECES},
occ AS (
  SELECT shard_idx, row_idx, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS piece_idx FROM pc),
pr AS (
  SELECT shard_idx, row_idx, piece_idx, i, substring(piece, i, 2) AS pair
  FROM (SELECT *, unnest(range(1, length(piece))) AS i FROM occ WHERE length(piece) >= 2)),
pcount AS (
  SELECT pair, COUNT(*) AS n, min({{'s': shard_idx, 'r': row_idx, 'p': piece_idx, 'i': i}}) AS first
  FROM pr GROUP BY pair)"""

ORACLES["pair_counts"] = f"WITH {OCC} SELECT pair, n FROM pcount"
ORACLES["top_pairs"] = f"""WITH {OCC}
SELECT pair, n FROM pcount ORDER BY n DESC, first LIMIT {C.N_TOP_PAIRS}"""

ORACLES["merge_pass"] = f"""WITH {OCC}, {PREP}, {VOCAB},
mtop AS (SELECT pair, row_number() OVER (ORDER BY n DESC, first) AS r
         FROM pcount ORDER BY n DESC, first LIMIT {C.N_PASS_MERGES}),
merges AS (
  SELECT a.token AS t1, b.token AS t2, CAST(999 + r AS INTEGER) AS new_token
  FROM mtop JOIN vocab a ON a.text = substring(pair, 1, 1) JOIN vocab b ON b.text = substring(pair, 2, 1)),
dp AS (SELECT DISTINCT piece FROM occ),
chars AS (SELECT piece, i, substring(piece, i, 1) AS ch
          FROM (SELECT piece, unnest(range(1, length(piece) + 1)) AS i FROM dp)),
toks AS (SELECT c.piece, c.i, v.token AS tok FROM chars c LEFT JOIN vocab v ON v.text = c.ch),
nx AS (SELECT piece, i, tok, lead(tok) OVER (PARTITION BY piece ORDER BY i) AS nxt FROM toks),
hit AS (SELECT nx.*, m.new_token, m.new_token IS NOT NULL AS h
        FROM nx LEFT JOIN merges m ON m.t1 = nx.tok AND m.t2 = nx.nxt),
isl AS (SELECT *, i - row_number() OVER (PARTITION BY piece, h ORDER BY i) AS grp FROM hit),
off AS (SELECT *, row_number() OVER (PARTITION BY piece, h, grp ORDER BY i) - 1 AS k FROM isl),
pk AS (SELECT *, h AND k % 2 = 0 AS pick FROM off),
cons AS (SELECT *, coalesce(lag(pick) OVER (PARTITION BY piece ORDER BY i), false) AS consumed FROM pk)
SELECT piece, array_to_string(list(CASE WHEN pick THEN new_token ELSE tok END ORDER BY i), ' ') AS codes
FROM cons WHERE NOT consumed GROUP BY piece"""

# The same pass with a document's characters as its sequence.
ORACLES["merge_pass_docs"] = (
    ORACLES["merge_pass"].replace("dp AS (SELECT DISTINCT piece FROM occ)", "dp AS (SELECT shard_idx || ':' || row_idx AS piece, text FROM docs)")
    .replace("SELECT piece, i, substring(piece, i, 1) AS ch", "SELECT piece, i, substring(text, i, 1) AS ch")
    .replace("SELECT piece, unnest(range(1, length(piece) + 1)) AS i FROM dp", "SELECT piece, text, unnest(range(1, length(text) + 1)) AS i FROM dp")
    .replace("SELECT piece, array_to_string", "SELECT CAST(split_part(piece, ':', 1) AS INTEGER) AS shard_idx, "
             "CAST(split_part(piece, ':', 2) AS BIGINT) AS row_idx, count(*) AS n_tokens, array_to_string"))

ORACLES["decode_docs"] = f"""WITH {DOCS}, {PIECES}
SELECT d.shard_idx, d.row_idx, replace(array_to_string(pc.pieces, ''), '{MARK}', ' ') || '{EOT}' AS text
FROM docs d JOIN pc ON pc.shard_idx = d.shard_idx AND pc.row_idx = d.row_idx
WHERE d.text IS NOT NULL AND d.text <> ''"""

# --- vector tables -----------------------------------------------------------------
EMB = """e AS (
  SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
         CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS d FROM embeddings)"""


def _rule(name: str, rows: int, cols: int, seed: float, scale: float, r: str = "r", c: str = "c") -> str:
    return f"""{name} AS (
  SELECT CAST(a.{r} AS INTEGER) AS {r}, CAST(b.{c} AS INTEGER) AS {c},
         {scale!r} * sin({seed!r} + 0.37 * a.{r} + 0.11 * b.{c}) AS w
  FROM range({rows}) a({r}), range({cols}) b({c}))"""


ORACLES["matmul_cells"] = """WITH
a AS (SELECT l_returnflag AS batch, l_linestatus AS i, l_linenumber AS k, sum(l_quantity) AS v
      FROM lineitem GROUP BY ALL),
b AS (SELECT l_returnflag AS batch, l_linenumber AS k, l_linestatus AS j, sum(l_discount) AS v
      FROM lineitem GROUP BY ALL)
SELECT a.batch, a.i, b.j, round(sum(a.v * b.v), 4) + 0.0 AS v
FROM a JOIN b ON a.batch = b.batch AND a.k = b.k GROUP BY ALL"""

# Vectors of the right size without gaps, and the others with the reason.
GAPPY = f"""g AS (
  SELECT vec_id, CASE vec_id % {C.GAPS} WHEN 1 THEN NULL WHEN 2 THEN embedding[1:{C.DIM - 1}]
    WHEN 3 THEN list_concat(embedding[1:5], [NULL::FLOAT], embedding[7:]) ELSE embedding END AS v FROM embeddings),
e AS (SELECT vec_id, CAST(unnest(v) AS DOUBLE) AS x, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS d
      FROM g WHERE len(v) = {C.DIM} AND len(list_filter(v, lambda x: x IS NULL)) = 0),
bad AS (SELECT vec_id, CASE WHEN v IS NULL THEN 'the vector is NULL' WHEN len(v) <> {C.DIM} THEN len(v) || ' entries instead of {C.DIM}'
          ELSE 'an entry is NULL' END AS reason
        FROM g WHERE v IS NULL OR len(v) <> {C.DIM} OR len(list_filter(v, lambda x: x IS NULL)) > 0)"""


def _rejects(idx: str) -> str:
    return f"UNION ALL SELECT vec_id, NULL::INTEGER AS {idx}, NULL::DOUBLE AS val, reason FROM bad"


ORACLES["vector_standardize"] = f"""WITH {GAPPY},
st AS (SELECT vec_id, avg(x) AS mu, var_pop(x) AS var FROM e GROUP BY vec_id)
SELECT e.vec_id, e.d, round((e.x - st.mu) / sqrt(st.var + 1e-5), 6) + 0.0 AS val, NULL AS reason
FROM e JOIN st ON st.vec_id = e.vec_id {_rejects('d')}"""

ORACLES["ffn_scores"] = f"""WITH {GAPPY},
{_rule('w1', C.DIM * 4, C.DIM, 0.5, 0.125, 'j', 'k')},
{_rule('b1', 1, C.DIM * 4, 1.5, 0.01, 'z', 'j')},
{_rule('w2', C.DIM, C.DIM * 4, 2.5, 0.0625, 'c', 'j')},
{_rule('b2', 1, C.DIM, 3.5, 0.01, 'z', 'c')},
h AS (
  SELECT e.vec_id, w1.j, sum(e.x * w1.w) + any_value(b1.w) AS y
  FROM e JOIN w1 ON w1.k = e.d JOIN b1 ON b1.j = w1.j GROUP BY e.vec_id, w1.j),
a AS (SELECT vec_id, j, 0.5 * y * (1 + tanh(sqrt(2 / pi()) * (y + 0.044715 * y * y * y))) AS y FROM h),
o AS (
  SELECT a.vec_id, w2.c, sum(a.y * w2.w) + any_value(b2.w) AS y
  FROM a JOIN w2 ON w2.j = a.j JOIN b2 ON b2.c = w2.c GROUP BY a.vec_id, w2.c)
SELECT vec_id, c AS d, round(y, 6) + 0.0 AS val, NULL AS reason FROM o {_rejects('d')}"""

ORACLES["project_vectors"] = f"""WITH {GAPPY},
{_rule('w', 16, C.DIM, 4.5, 0.125, 'j', 'k')},
{_rule('b', 1, 16, 5.5, 0.01, 'z', 'j')},
o AS (SELECT e.vec_id, w.j, sum(e.x * w.w) + any_value(b.w) AS y
      FROM e JOIN w ON w.k = e.d JOIN b ON b.j = w.j GROUP BY e.vec_id, w.j)
SELECT vec_id, j, round(y, 6) + 0.0 AS val, NULL AS reason FROM o {_rejects('j')}"""

ORACLES["embed_tokens"] = f"""WITH {WINDOWS},
{EMB},
ids AS (SELECT split, shard_idx, chunk_idx, unnest(w[1:{W - 1}]) AS token,
               generate_subscripts(w[1:{W - 1}], 1) - 1 AS pos FROM windows),
combo AS (
  SELECT t.vec_id AS token, p.vec_id AS pos, sum((t.x + p.x) * (t.x + p.x)) AS ss
  FROM e t JOIN e p ON p.d = t.d AND p.vec_id < {W - 1} AND t.vec_id % {C.UNKNOWN} <> 10
  GROUP BY t.vec_id, p.vec_id)
SELECT split, shard_idx, chunk_idx, round(sum(combo.ss), 4) + 0.0 AS sumsq, count(*) FILTER (combo.ss IS NULL) AS n_unknown
FROM ids LEFT JOIN combo ON combo.token = ids.token AND combo.pos = ids.pos
GROUP BY split, shard_idx, chunk_idx"""

_HD = C.DIM // C.HEADS
ORACLES["causal_pool"] = f"""WITH {EMB},
sc AS (
  SELECT q.label, q.vec_id AS qid, k.vec_id AS kid, q.d // {_HD} AS h, sum(q.x * k.x) / sqrt({_HD}) AS s
  FROM e q JOIN e k ON k.label = q.label AND k.vec_id <= q.vec_id AND k.d = q.d
  GROUP BY q.label, q.vec_id, k.vec_id, q.d // {_HD}),
ex AS (SELECT *, exp(s - max(s) OVER (PARTITION BY qid, h)) AS ev FROM sc),
wt AS (SELECT *, ev / sum(ev) OVER (PARTITION BY qid, h) AS a FROM ex),
o AS (SELECT wt.label, wt.qid, v.d, sum(wt.a * v.x) AS y
      FROM wt JOIN e v ON v.vec_id = wt.kid AND v.d // {_HD} = wt.h GROUP BY wt.label, wt.qid, v.d)
SELECT label, qid AS vec_id, d, round(y, 6) + 0.0 AS val FROM o"""

ORACLES["causal_pool_window"] = ORACLES["causal_pool"].replace("sc AS (", """rk AS (
  SELECT vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings),
sc AS (""", 1).replace("GROUP BY q.label, q.vec_id, k.vec_id", f"""JOIN rk a ON a.vec_id = q.vec_id JOIN rk b ON b.vec_id = k.vec_id
  WHERE b.r > a.r - {C.HISTORY} GROUP BY q.label, q.vec_id, k.vec_id""", 1)

ORACLES["group_softmax"] = f"""WITH
ev AS (SELECT event_id, CASE WHEN event_type <> '{C.UNKNOWN_USER}' THEN user_id END AS user_id, value FROM events),
m AS (SELECT event_id, user_id, exp(value - max(value) OVER (PARTITION BY user_id)) AS ev FROM ev)
SELECT event_id, user_id, round(ev / sum(ev) OVER (PARTITION BY user_id), 9) + 0.0 AS p FROM m"""


def _pass(inp: str, out: str, merges: str) -> str:
    """One greedy left-to-right pass of ``merges`` over ``inp(piece, i, tok)``."""
    return f"""{out}_h AS (
  SELECT x.*, m.new_token, m.new_token IS NOT NULL AS h,
         row_number() OVER (PARTITION BY x.piece ORDER BY x.i) AS rn
  FROM (SELECT piece, i, tok, lead(tok) OVER (PARTITION BY piece ORDER BY i) AS nxt FROM {inp}) x
  LEFT JOIN {merges} m ON m.t1 = x.tok AND m.t2 = x.nxt),
{out}_k AS (
  SELECT *, row_number() OVER (PARTITION BY piece, h, grp ORDER BY i) - 1 AS k
  FROM (SELECT *, rn - row_number() OVER (PARTITION BY piece, h ORDER BY i) AS grp FROM {out}_h)),
{out}_c AS (
  SELECT *, coalesce(lag(h AND k % 2 = 0) OVER (PARTITION BY piece ORDER BY i), false) AS consumed
  FROM {out}_k),
{out} AS (
  SELECT piece, i, CASE WHEN h AND k % 2 = 0 THEN new_token ELSE tok END AS tok
  FROM {out}_c WHERE NOT consumed)"""


ORACLES["encode_two_level"] = f"""WITH {OCC}, {PREP}, {VOCAB},
mtop AS (SELECT pair, row_number() OVER (ORDER BY n DESC, first) AS r
         FROM pcount ORDER BY n DESC, first LIMIT {C.N_PASS_MERGES}),
l1 AS (
  SELECT a.token AS t1, b.token AS t2, CAST(999 + r AS INTEGER) AS new_token, pair AS text
  FROM mtop JOIN vocab a ON a.text = substring(pair, 1, 1) JOIN vocab b ON b.text = substring(pair, 2, 1)),
pf AS (SELECT piece, COUNT(*) AS f FROM occ GROUP BY piece),
chars AS (SELECT piece, i, substring(piece, i, 1) AS ch
          FROM (SELECT piece, unnest(range(1, length(piece) + 1)) AS i FROM pf)),
c0 AS (SELECT c.piece, c.i, v.token AS tok FROM chars c LEFT JOIN vocab v ON v.text = c.ch),
{_pass('c0', 'q1', 'l1')},
adj AS (
  SELECT q.piece, q.tok AS t1, lead(q.tok) OVER (PARTITION BY q.piece ORDER BY q.i) AS t2 FROM q1 q),
l2c AS (
  SELECT adj.t1, adj.t2, sum(pf.f) AS n FROM adj JOIN pf ON pf.piece = adj.piece
  WHERE adj.t2 IS NOT NULL AND (adj.t1 >= 1000 OR adj.t2 >= 1000) GROUP BY adj.t1, adj.t2),
l2 AS (
  SELECT t1, t2, CAST(1999 + row_number() OVER (ORDER BY n DESC, t1, t2) AS INTEGER) AS new_token
  FROM l2c ORDER BY n DESC, t1, t2 LIMIT {C.N_LEVEL2_MERGES}),
allm AS (SELECT t1, t2, new_token FROM l1 UNION ALL SELECT t1, t2, new_token FROM l2),
txt AS (
  SELECT token, text FROM vocab
  UNION ALL SELECT new_token, text FROM l1
  UNION ALL SELECT l2.new_token, x1.text || x2.text FROM l2
    JOIN (SELECT token, text FROM vocab UNION ALL SELECT new_token, text FROM l1) x1 ON x1.token = l2.t1
    JOIN (SELECT token, text FROM vocab UNION ALL SELECT new_token, text FROM l1) x2 ON x2.token = l2.t2),
t2t AS (SELECT text, max(token) AS token FROM txt GROUP BY text),
whole AS (SELECT pf.piece, t2t.token FROM pf JOIN t2t ON t2t.text = pf.piece),
e0 AS (SELECT * FROM c0 WHERE piece NOT IN (SELECT piece FROM whole)),
{_pass('e0', 'e1', 'allm')},
{_pass('e1', 'e2', 'allm')},
{_pass('e2', 'e3', 'allm')}
SELECT piece, CAST(token AS VARCHAR) AS codes FROM whole
UNION ALL
SELECT piece, array_to_string(list(tok ORDER BY i), ' ') AS codes FROM e3 GROUP BY piece"""


# --- training, and encoding with what was trained -----------------------------------
# Unrolled: one CTE per merge. A merged token is a fresh character, so replace() is the
# greedy left-to-right replacement.

def _sym(k: int) -> str:
    return f"chr({0x40000 + k})"


def _symbols(n: int, vocab: str = "vocab") -> str:
    """``sy_n``: symbol, token, text and parts of the characters and merges, from the best pairs ``b_k``."""
    out = [f"""n0 AS (SELECT CAST(count(*) AS INTEGER) AS n FROM {vocab}),
sy_0 AS (SELECT text AS sym, token, text, NULL::INTEGER AS t1, NULL::INTEGER AS t2, NULL::INTEGER AS rank FROM {vocab} WHERE length(text) = 1)"""]
    out += [f"""sy_{k + 1} AS MATERIALIZED (SELECT * FROM sy_{k} UNION ALL
  SELECT {_sym(k)}, CAST(n + {k} AS INTEGER), x.text || y.text, x.token, y.token, {k}
  FROM b_{k}, n0, sy_{k} x, sy_{k} y WHERE x.sym = substring(pair, 1, 1) AND y.sym = substring(pair, 2, 1))""" for k in range(n)]
    return ",\n".join(out)


def _piece_training(n: int) -> str:
    out = ["""s_0 AS MATERIALIZED (
  SELECT piece, piece AS s, count(*) AS w, min({'s': shard_idx, 'r': row_idx, 'p': piece_idx}) AS first FROM occ GROUP BY piece)"""]
    for k in range(n):
        out.append(f"""b_{k} AS MATERIALIZED (
  SELECT pair FROM (SELECT substring(s, i, 2) AS pair, sum(w) AS n, min({{'f': first, 'i': i}}) AS f
                    FROM (SELECT s, w, first, unnest(range(1, length(s))) AS i FROM s_{k}) GROUP BY 1)
  ORDER BY n DESC, f LIMIT 1)""")
        out.append(f"s_{k + 1} AS MATERIALIZED (SELECT piece, replace(s, pair, {_sym(k)}) AS s, w, first FROM s_{k}, b_{k})")
    return ",\n".join(out)


def _sequence_training(n: int) -> str:
    out = [f"""s_0 AS MATERIALIZED (
  SELECT replace(CASE WHEN t[1] = ' ' THEN t[2:] ELSE t END, ' ', '{MARK}') AS s
  FROM (SELECT string_agg(text, chr(10) ORDER BY doc_id) AS t FROM documents WHERE text <> ''))"""]
    for k in range(n):
        out.append(f"""b_{k} AS MATERIALIZED (
  SELECT a || b AS pair FROM (
    SELECT unnest(l) AS a, unnest(l[2:]) AS b, generate_subscripts(l, 1) AS i FROM (SELECT string_split(s, '') AS l FROM s_{k}))
  WHERE b IS NOT NULL GROUP BY a, b ORDER BY count(*) DESC, min(i) LIMIT 1)""")
        out.append(f"s_{k + 1} AS MATERIALIZED (SELECT replace(s, pair, {_sym(k)}) AS s FROM s_{k}, b_{k})")
    return ",\n".join(out)


_N = C.N_MERGES
_MERGES = f"SELECT rank, t1, t2, token AS new_token, text FROM sy_{_N} WHERE rank IS NOT NULL"
_TRAINED = f"""{OCC}, {PREP}, {VOCAB},
{_piece_training(_N)},
{_symbols(_N)},
tv AS MATERIALIZED (
  SELECT token, text, kind FROM vocab UNION ALL SELECT token, text, 'merge' FROM sy_{_N} WHERE rank IS NOT NULL)"""

ORACLES["bpe_merges_piece"] = f"WITH {_TRAINED} {_MERGES}"
ORACLES["vocab_after_merges"] = f"WITH {_TRAINED} SELECT token, text, kind FROM tv"
ORACLES["bpe_merges"] = f"""WITH {DOCS}, {PREP}, {VOCAB},
{_sequence_training(_N)},
{_symbols(_N)}
{_MERGES}"""

# More passes than any piece of the corpus needs: a pass after the fixpoint changes nothing.
_PASSES = 8
_CODED = f"""{_TRAINED},
allm AS MATERIALIZED (SELECT t1, t2, token AS new_token FROM sy_{_N} WHERE rank IS NOT NULL),
t2t AS (SELECT text, max(token) AS token FROM tv GROUP BY text),
dp AS (SELECT DISTINCT piece FROM occ),
whole AS (SELECT dp.piece, t2t.token FROM dp JOIN t2t ON t2t.text = dp.piece),
e0 AS MATERIALIZED (
  SELECT c.piece, c.i, v.token AS tok
  FROM (SELECT piece, i, substring(piece, i, 1) AS ch FROM (SELECT piece, unnest(range(1, length(piece) + 1)) AS i FROM dp)) c
  LEFT JOIN t2t v ON v.text = c.ch WHERE c.piece NOT IN (SELECT piece FROM whole)),
{",".join(_pass(f"e{k}", f"e{k + 1}", "allm").replace(f"e{k + 1} AS (", f"e{k + 1} AS MATERIALIZED (") for k in range(_PASSES))},
coded AS MATERIALIZED (
  SELECT piece, [token] AS codes FROM whole UNION ALL SELECT piece, list(tok ORDER BY i) FROM e{_PASSES} GROUP BY piece)"""

ORACLES["piece_codes"] = f"WITH {_CODED} SELECT piece, array_to_string(codes, ' ') AS codes FROM coded"
ORACLES["encode_docs"] = f"""WITH {_CODED},
dt AS (SELECT o.shard_idx, o.row_idx, flatten(list(c.codes ORDER BY o.piece_idx)) AS toks
       FROM occ o JOIN coded c ON c.piece = o.piece GROUP BY ALL)
SELECT shard_idx, row_idx, CAST(len(toks) + 1 AS BIGINT) AS n_tokens,
       array_to_string(toks, ' ') || ' ' || (SELECT token FROM vocab WHERE text = '{EOT}') AS tokens FROM dt"""

ORACLES["vocab_collisions"] = f"""WITH {OCC}, {PREP}, {VOCAB},
g AS (SELECT substring(piece, i, 3) AS gram, count(*) AS n
      FROM (SELECT piece, unnest(range(1, length(piece) - 1)) AS i FROM occ WHERE length(piece) >= 3) GROUP BY 1),
r AS (SELECT gram, 10000 + 4 * (row_number() OVER (ORDER BY n DESC, gram) - 1) AS base FROM g ORDER BY n DESC, gram LIMIT {C.N_TRIGRAMS}),
every AS (SELECT text, token FROM vocab
  UNION ALL SELECT substring(gram, 1, 2), base FROM r UNION ALL SELECT substring(gram, 2, 2), base + 1 FROM r
  UNION ALL SELECT gram, base + 2 FROM r UNION ALL SELECT gram, base + 3 FROM r)
SELECT text, count(*) AS n_tokens, array_to_string(list(token ORDER BY token), ' ') AS tokens FROM every GROUP BY text HAVING count(*) > 1"""

# --- every vocabulary size, injected text --------------------------------------------
_WIDE_DOCS = DOCS.replace(" text\n", f" text || ' ' || chr(CAST({0x4E00} + doc_id % {C.WIDE_ALPHABET} AS INTEGER)) AS text\n")
ORACLES["encode_wide_alphabet"] = f"""WITH {_shard_tokens(_WIDE_DOCS)}
SELECT shard_idx, row_idx, CAST(len(toks) AS BIGINT) AS n_tokens, array_to_string(toks, ' ') AS tokens FROM st"""

ORACLES["decode_wide_vocab"] = f"""WITH {OCC},
top AS (SELECT piece FROM (SELECT piece, count(*) AS w FROM occ WHERE length(piece) > 1 GROUP BY piece) ORDER BY w DESC, piece LIMIT {C.WIDE_VOCAB}),
n AS (SELECT shard_idx, row_idx, sum(CASE WHEN top.piece IS NULL THEN length(occ.piece) ELSE 1 END) + 1 AS n_tokens
      FROM occ LEFT JOIN top ON top.piece = occ.piece GROUP BY ALL)
SELECT pc.shard_idx, pc.row_idx, replace(array_to_string(pc.pieces, ''), '{MARK}', ' ') || '{EOT}' AS text, CAST(n.n_tokens AS BIGINT) AS n_tokens
FROM pc JOIN n ON n.shard_idx = pc.shard_idx AND n.row_idx = pc.row_idx"""

ORACLES["oov_rejects"] = f"""WITH {DOCS}
SELECT shard_idx, row_idx, 'unknown character' AS reason FROM docs WHERE contains(text, 'worthless')"""


def _literal(text: str) -> str:
    return " || ".join(f"chr({ord(c)})" for c in text)


_mixed = "text"
for _a, _b in C.INJECTED:
    _mixed = f"replace({_mixed}, {_literal(_a)}, {_literal(_b)})"
ORACLES["pieces_injected"] = f"""WITH {DOCS},
mixed AS (SELECT shard_idx, row_idx, {_mixed} AS text FROM docs),
{_pieces("mixed")}
SELECT shard_idx, row_idx, CAST(len(pieces) AS BIGINT) AS n_pieces, array_to_string(pieces, '|') AS pieces FROM pc"""

# The longest special is marked first, so the others are only sought in what is left.
_marked = f"replace(replace(text, chr(10), '{EOT}'), ' the ', ' <|end ')"
for _k, _s in enumerate(sorted(C.MULTI_SPECIALS, key=len, reverse=True)):
    _marked = f"replace({_marked}, '{_s}', chr({0x50000 + _k}))"
_unmark = "".join(f" WHEN chr({0x50000 + k}) THEN '{t}'" for k, t in enumerate(sorted(C.MULTI_SPECIALS, key=len, reverse=True)))
ORACLES["special_segments_multi"] = f"""WITH {DOCS},
m AS (SELECT shard_idx, row_idx, string_split({_marked}, '') AS l FROM docs WHERE text <> ''),
c AS (SELECT shard_idx, row_idx, unnest(l) AS ch, generate_subscripts(l, 1) AS i FROM m),
f AS (SELECT *, ch >= chr({0x50000}) AND ch <= chr({0x50000 + 9}) AS special FROM c),
b AS (SELECT *, special OR coalesce(lag(special) OVER w, true) AS starts FROM f WINDOW w AS (PARTITION BY shard_idx, row_idx ORDER BY i)),
n AS (SELECT *, sum(starts::INTEGER) OVER (PARTITION BY shard_idx, row_idx ORDER BY i) - 1 AS no FROM b)
SELECT shard_idx, row_idx, CAST(no AS INTEGER) AS seg_idx, special,
       string_agg(CASE ch{_unmark} ELSE ch END, '' ORDER BY i) AS seg_text FROM n GROUP BY ALL"""

ORACLES["scan_shards"] = "SELECT NULL::INTEGER AS shard_idx, doc_id AS row_idx, text FROM documents"
ORACLES["pending_shards"] = f"""SELECT DISTINCT CAST(doc_id % {C.N_MANY_SHARDS} AS INTEGER) AS shard_idx FROM documents
WHERE doc_id % {C.N_MANY_SHARDS} NOT IN (SELECT item_id % {C.N_MANY_SHARDS} FROM benchmark)"""

_PASS_MERGES = f"""{OCC}, {PREP}, {VOCAB},
mtop AS (SELECT pair, row_number() OVER (ORDER BY n DESC, first) AS r FROM pcount ORDER BY n DESC, first LIMIT {C.N_PASS_MERGES}),
merges AS (
  SELECT a.token AS t1, b.token AS t2, CAST(999 + r AS INTEGER) AS new_token, pair AS text
  FROM mtop JOIN vocab a ON a.text = substring(pair, 1, 1) JOIN vocab b ON b.text = substring(pair, 2, 1)),
dp AS (SELECT DISTINCT piece FROM occ)"""
ORACLES["piece_lookup"] = f"""WITH {_PASS_MERGES},
t2t AS (SELECT text, max(token) AS token FROM (SELECT text, token FROM vocab UNION ALL SELECT text, new_token FROM merges) GROUP BY text)
SELECT dp.piece, t2t.token FROM dp LEFT JOIN t2t ON t2t.text = dp.piece"""
ORACLES["mergeable_pairs"] = f"""WITH {_PASS_MERGES}
SELECT x.piece, CAST(x.i - 1 AS INTEGER) AS pos, m.t1 AS tok, m.t2 AS nxt, m.new_token
FROM (SELECT piece, i, substring(piece, i, 2) AS pair FROM (SELECT piece, unnest(range(1, length(piece))) AS i FROM dp)) x
JOIN merges m ON m.text = x.pair"""

# The same tables by way of a published cache or dictionary.
ORACLES["cached_tokens"] = ORACLES["shard_tokens"]
ORACLES["split_windows"] = f"SELECT * FROM ({ORACLES['token_windows']}) WHERE split <> 'train'"
ORACLES["piece_dictionary"] = ORACLES["piece_codes"]

ORACLES["matmul_blocks"] = f"""WITH
a AS (SELECT l_returnflag AS batch, l_suppkey AS i, l_partkey % {C.MATRIX_INNER} AS k, sum(l_quantity) AS v FROM lineitem GROUP BY ALL),
b AS (SELECT l_returnflag AS batch, l_partkey % {C.MATRIX_INNER} AS k, l_linenumber AS j, sum(l_discount) AS v FROM lineitem GROUP BY ALL)
SELECT a.batch, a.i, b.j, round(sum(a.v * b.v), 4) + 0.0 AS v
FROM a JOIN b ON a.batch = b.batch AND a.k = b.k GROUP BY ALL"""

# Such specials cannot overlap; candidates are marked off, those that are no specials join their neighbours.
ORACLES["special_segments_many"] = f"""WITH {DOCS},
s AS (SELECT DISTINCT unnest(regexp_extract_all(text, '{C.MANY_SPECIALS}')) AS w FROM benchmark),
l AS (SELECT shard_idx, row_idx, string_split(regexp_replace(text, '({C.MANY_SPECIALS})', chr({0x50000}) || '\\1' || chr({0x50000}), 'g'), chr({0x50000})) AS l
      FROM docs WHERE text <> ''),
p AS (SELECT shard_idx, row_idx, unnest(l) AS part, generate_subscripts(l, 1) AS i FROM l),
f AS (SELECT p.*, p.i % 2 = 0 AND s.w IS NOT NULL AS special FROM p LEFT JOIN s ON s.w = p.part WHERE part <> ''),
b AS (SELECT *, special OR coalesce(lag(special) OVER w, true) AS starts FROM f WINDOW w AS (PARTITION BY shard_idx, row_idx ORDER BY i)),
n AS (SELECT *, sum(starts::INTEGER) OVER (PARTITION BY shard_idx, row_idx ORDER BY i) - 1 AS no FROM b)
SELECT shard_idx, row_idx, CAST(no AS INTEGER) AS seg_idx, special, string_agg(part, '' ORDER BY i) AS seg_text FROM n GROUP BY ALL"""

ORACLES["scan_shard_files"] = f"""SELECT CAST(doc_id % {C.N_SHARDS} AS INTEGER) AS shard_idx,
  row_number() OVER (PARTITION BY doc_id % {C.N_SHARDS} ORDER BY doc_id) - 1 AS row_idx, text FROM documents"""
ORACLES["stored_tokenizer"] = ORACLES["vocab_after_merges"]
