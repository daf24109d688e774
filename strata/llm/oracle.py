"""DuckDB SQL of the training-data queries that SQL can express exactly.

``op9`` tries all pairs that share a shingle; ``op6`` takes running sums over
whole sources; ``op11`` reads the digests off the turns themselves; ``op12``
hashes level by level over whole trees. The other queries hash, fit, tokenise, or retrieve by a method
that SQL can't state; their tests hold them against brute-force versions.
"""

from __future__ import annotations

from strata.llm.chat_format import END, LOSS_ROLE, PROBE_ID, PROBE_TEXT, START
from strata.llm.mixing import FILLS, MAX_EPOCHS, SCHEDULE_STARTS, WEIGHTS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACE = r"[\x20\x09-\x0D]+"

_NEAR = f"""WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_SPACE}'),
                             lambda w: w <> '') AS ws
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
           ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END) AS s
    FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM pairs JOIN sizes nx ON x = nx.doc_id JOIN sizes ny ON y = ny.doc_id
  WHERE 100 * shared >= 75 * (nx.n + ny.n - shared)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, e.y FROM reach r JOIN edges e ON r.other = e.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON d.doc_id = r.doc_id
LEFT JOIN sizes n ON d.doc_id = n.doc_id"""


def _fill(k: int) -> str:
    """One pass over the documents that fit into the room left; the last pass
    takes the longest alone."""
    before = " UNION ALL ".join(["SELECT NULL AS source, NULL AS key, 0 AS size", *[f"SELECT source, key, size FROM fill{i}" for i in range(k)]])
    order = "key" if k < FILLS else "size DESC, key DESC"
    kept = "run <= room" if k < FILLS else "spot = 1"
    return f"""picked{k} AS ({before}),
room{k} AS (
  SELECT r.source, r.room - coalesce((SELECT sum(p.size) FROM picked{k} p WHERE p.source IS NOT DISTINCT FROM r.source AND p.key IS NOT NULL), 0) AS room
  FROM room r),
fill{k} AS (
  SELECT source, key, size FROM (
    SELECT f.source, f.key, f.size, m.room,
           sum(f.size) OVER (PARTITION BY f.source ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS run,
           row_number() OVER (PARTITION BY f.source ORDER BY {order}) AS spot
    FROM free f JOIN room{k} m ON f.source IS NOT DISTINCT FROM m.source
    WHERE f.size <= m.room AND NOT EXISTS (
      SELECT 1 FROM picked{k} p WHERE p.source IS NOT DISTINCT FROM f.source AND p.key = f.key))
  WHERE {kept})"""


_MIX = f"""WITH docs AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, {MAX_EPOCHS} * source_size AS cap, sum(source_size) OVER () AS total,
         [{', '.join(map(str, WEIGHTS))}][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS INTEGER)] AS weight,
         [{', '.join(f'{x}::DOUBLE' for x in SCHEDULE_STARTS)}][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % {len(WEIGHTS)} + 1 AS INTEGER)] AS start
  FROM per_source),
shared AS (
  SELECT *, total - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left,
         row_number() OVER o AS spot
  FROM weighed WINDOW o AS (ORDER BY cap / weight, source ASC NULLS LAST)),
first_free AS (SELECT rest, weights_left FROM shared WHERE NOT (rest * weight >= cap * weights_left) ORDER BY spot LIMIT 1),
targets AS (
  SELECT s.source, s.source_size, s.start,
         CASE WHEN s.rest * s.weight >= s.cap * s.weights_left THEN CAST(s.cap AS DOUBLE)
              ELSE CAST(s.weight * (SELECT rest FROM first_free) AS DOUBLE) / CAST((SELECT weights_left FROM first_free) AS DOUBLE) END AS target
  FROM shared s),
stream AS (
  SELECT d.*, t.source_size, t.target, t.start,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS UNBOUNDED PRECEDING) AS ends,
         coalesce(lag(d.key) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id) = d.key, false) AS again
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
copied AS (
  SELECT *, CASE WHEN source_size = 0 THEN 1 ELSE {' + '.join(f'CASE WHEN {e} * source_size + ends <= target THEN 1 ELSE 0 END' for e in range(MAX_EPOCHS))} END AS copies,
         CASE WHEN start = 1 THEN share ELSE (sqrt(start * start + 2::DOUBLE * (2 - 2 * start) * share) - start) / (2 - 2 * start) END AS place
  FROM (SELECT *, coalesce((ends - size / 2::DOUBLE) / nullif(target, 0), 0) AS share FROM stream)),
room AS (SELECT source, min(target) - sum(copies * size) AS room FROM copied WHERE source_size > 0 GROUP BY source),
free AS (SELECT source, key, size FROM copied WHERE source_size > 0 AND copies < {MAX_EPOCHS} AND NOT again AND size > 0),
{', '.join(_fill(k) for k in range(FILLS + 1))},
fills AS ({' UNION ALL '.join(f'SELECT source, key FROM fill{k}' for k in range(FILLS + 1))})
SELECT c.doc_id, c.size, c.source_size, c.target,
       CAST((c.copies + CASE WHEN f.key IS NOT NULL AND NOT c.again THEN 1 ELSE 0 END) * c.size AS BIGINT) AS taken,
       round(CASE WHEN c.copies > 0 THEN c.place WHEN f.key IS NOT NULL AND NOT c.again THEN 1.0::DOUBLE END, 9) AS first_position
FROM copied c LEFT JOIN fills f ON c.key = f.key AND c.source IS NOT DISTINCT FROM f.source"""

_CHAT = rf"""WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES ({PROBE_ID}, 0, 'user', '{PROBE_TEXT}'), ({PROBE_ID}, 1, '{LOSS_ROLE}', '{PROBE_TEXT}')),
keyed AS (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone FROM said),
turns AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id, alone ORDER BY turn NULLS FIRST, role, text) AS before FROM keyed)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = '{LOSS_ROLE}' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = '{LOSS_ROLE}' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + {len(END)}
                + CASE WHEN before IS DISTINCT FROM role THEN {len(START) + 1} + length(replace(url_encode(role), '%20', '+')) ELSE 0 END) AS BIGINT) AS formatted_chars,
       count(*) FILTER (WHERE before IS DISTINCT FROM role) AS n_blocks
FROM turns GROUP BY conv_id, alone"""


def _hashed_part(value: str) -> str:
    return f"coalesce(CAST(octet_length(encode(CAST({value} AS VARCHAR))) AS VARCHAR) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_hashed_part(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


# CRC-32, bit by bit over the digits (and sign) of a number.
_CRC = """xor(4294967295, list_reduce(
  list_prepend(4294967295::UBIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS UBIGINT))),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda x, ignored: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)))"""

# Levels that the SQL reaches: 2^24 rows a language, 2^8 languages.
_ROW_LEVELS, _TREE_LEVELS = 24, 8


def _level(name: str, k: int) -> str:
    """Level k + 1 of all trees of ``name``; a tree with one node stays."""
    return f"""{name}{k + 1} AS (
  SELECT tree, pos // 2 AS pos, (min(n) + 1) // 2 AS n, CASE WHEN min(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY pos)) END AS h
  FROM {name}{k} GROUP BY tree, pos // 2)"""


def _folded(row: str, name: str, k: int) -> str:
    """Next step of the recomputed root and of the siblings' texts."""
    other = f"(SELECT s.h FROM {name}{k} s WHERE s.tree = f.tree AND s.pos = xor(f.pos, 1))"
    return f"""{row}{k + 1} AS (
  SELECT id, tree, pos // 2 AS pos, (n + 1) // 2 AS n, said || coalesce(CASE WHEN n > 1 THEN other END, '') AS said,
         CASE WHEN n = 1 THEN cur WHEN other IS NULL THEN sha256(cur) WHEN pos % 2 = 1 THEN sha256(other || cur) ELSE sha256(cur || other) END AS cur
  FROM (SELECT f.*, {other} AS other FROM {row}{k} f))"""


_MERKLE = f"""WITH hashed AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('1' || lang, '0') AS tree, {_leaf('n_chars')} AS leaf,
         CASE WHEN {_CRC} % 7 = 0 THEN {_leaf('(n_chars + 1)')} END AS tampered
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
lv0 AS (SELECT tree, pos, n, leaf AS h FROM placed),
{', '.join(_level('lv', k) for k in range(_ROW_LEVELS))},
tp0 AS (SELECT 0 AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, h, tree AS member FROM lv{_ROW_LEVELS}),
{', '.join(_level('tp', k) for k in range(_TREE_LEVELS))},
fd0 AS (SELECT id, tree, pos, n, '' AS said, coalesce(tampered, leaf) AS cur FROM placed),
{', '.join(_folded('fd', 'lv', k) for k in range(_ROW_LEVELS))},
ft0 AS (SELECT f.id, 0 AS tree, t.pos, t.n, f.said, f.cur FROM fd{_ROW_LEVELS} f JOIN tp0 t ON f.tree = t.member),
{', '.join(_folded('ft', 'tp', k) for k in range(_TREE_LEVELS))}
SELECT p.doc_id, p.leaf, t.h AS subroot, r.h AS root, sha256(f.said) AS proof_sha256, f.cur AS folded_root, f.cur = r.h AS verified
FROM placed p JOIN ft{_TREE_LEVELS} f ON p.id = f.id JOIN tp0 t ON p.tree = t.member CROSS JOIN tp{_TREE_LEVELS} r"""


ORACLE_SQL: dict[str, str] = {
    "op6_mixing": _MIX,
    "op9_near_dedup": _NEAR,
    "op11_chat_format": _CHAT,
    "op12_merkle_manifest": _MERKLE,
}
