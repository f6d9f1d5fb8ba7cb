"""DuckDB statements for the corpus queries that SQL can express, over the same tables."""

from __future__ import annotations

from schoolyard.llm.quality import BOILERPLATE, LineRules

RULES = LineRules()
WORDS = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w
  FROM documents
),
windows AS (
  SELECT r, p, list_slice(w, p, p + 4) AS gram
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 4)) AS p FROM d)
),
repeated AS (
  SELECT r, p FROM windows QUALIFY count(*) OVER (PARTITION BY r, gram) > 1
),
covered AS (
  SELECT r, count(DISTINCT p + k) AS n FROM repeated, (SELECT unnest(range(5)) AS k) GROUP BY r
),
lines AS (
  SELECT r, line, len(regexp_extract_all(line, '{WORDS}')) AS n
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
),
by_line AS (
  SELECT r,
    count(*) - count(DISTINCT line) AS dup,
    sum(CASE WHEN
      (n < {RULES.sentence_words}
        AND NOT regexp_matches(line, '[.!?…:;。！？]["''”’»)\]]*[\x20\x09-\x0D]*$'))
      OR len(regexp_extract_all(line, '[|>»·•]')) * 100 >= n * {RULES.separators_per_100_words}
      OR len(regexp_extract_all(line, '[#*$%&|<>]')) * 100 >= n * {RULES.symbols_per_100_words}
      OR len(regexp_extract_all(line, '!!')) * 100 >= n * {RULES.shouts_per_100_words}
      OR (n < {RULES.boilerplate_words} AND regexp_matches(line, '(?i){"|".join(BOILERPLATE)}'))
      THEN n ELSE 0 END) AS lost
  FROM lines WHERE n > 0 GROUP BY r
),
facts AS (
  SELECT doc_id, len(w) AS n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
    coalesce(dup, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    coalesce(lost, 0) AS lost_words
  FROM d LEFT JOIN covered USING (r) LEFT JOIN by_line USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND lost_words * 100 <= n_words * {RULES.lost_percent} AS kept,
  lost_words::BIGINT AS lost_words
FROM facts
"""

OP5 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  -- the template's 17 characters a turn, and one more for each backslash and control opening
  sum(17 + length(role) + length(text)
    + len(regexp_extract_all(role || ' ' || text, '\\|<\||</?s>|<</?SYS>|\[/?INST\]'))
    + len(regexp_extract_all(role, '\n')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP7 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e)
  WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 10
"""

# --- conversation repair ---------------------------------------------------------------------
# crc32 bit by bit; a state is what the repaired turns end with: 0 nothing, 1 system, 2 user,
# 3 assistant. Every step takes one row by every edit and up to two insertions behind it, and
# keeps the best of each state.
OP11 = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
),
marked AS (
  SELECT *, xor(list_reduce(
      [4294967295::BIGINT] || list_transform(string_split(k, ''), lambda c: ascii(c)::BIGINT),
      lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 20 AS kind
  FROM keyed
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS again
  FROM marked WHERE kind <> 0
),
placed AS (
  SELECT *, row_number() OVER w AS pos, left(role, 1) AS initial,
    left(lag(role) OVER w, 1) || left(role, 1) AS pair,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
faults AS (
  SELECT *, CASE WHEN ending = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
    WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed
),
facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
),
inserted(f, t, price, letters) AS (
  VALUES (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'),
         (2, 2, 0, ''), (2, 3, 3, 'I'), (3, 3, 0, ''), (3, 2, 3, 'I')
),
edited(f, t, price, letter, initial) AS (
  VALUES (0, 1, 0, 'K', 's'), (0, 2, 0, 'K', 'u'), (1, 2, 0, 'K', 'u'), (3, 2, 0, 'K', 'u'), (2, 3, 0, 'K', 'a'),
         (0, 2, 3, 'R', NULL), (1, 2, 3, 'R', NULL), (3, 2, 3, 'R', NULL), (2, 3, 3, 'R', NULL),
         (0, 0, 4, 'D', NULL), (1, 1, 4, 'D', NULL), (2, 2, 4, 'D', NULL), (3, 3, 4, 'D', NULL)
),
search AS (
  SELECT conv_id, 0::BIGINT AS pos, t AS state, price AS cost, letters AS audit
  FROM facts, inserted WHERE f = 0
  UNION ALL
  SELECT conv_id, pos, state, cost, audit FROM (
    SELECT s.conv_id, r.pos, i.t AS state, s.cost + e.price + i.price
        + CASE WHEN e.letter <> 'D' AND r.fault = 'truncated' THEN 3 ELSE 0 END AS cost,
      s.audit || e.letter || i.letters AS audit
    FROM search s
    JOIN faults r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.pos = s.pos + 1
    JOIN edited e ON e.f = s.state AND (e.initial IS NULL OR e.initial = r.initial)
      AND (e.letter = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
    JOIN inserted i ON i.f = e.t
  ) QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1
),
best AS (
  SELECT s.conv_id, s.cost, s.audit FROM search s
  JOIN facts f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.n = s.pos
  WHERE s.state IN (0, 3)
  QUALIFY row_number() OVER (PARTITION BY s.conv_id ORDER BY s.cost, s.audit) = 1
),
letters AS (
  SELECT conv_id, unnest(string_split(audit, '')) AS letter, unnest(range(len(audit))) AS nr
  FROM best WHERE audit <> ''
),
steps AS (
  SELECT *, CASE WHEN letter <> 'I' THEN
      count(*) FILTER (WHERE letter <> 'I') OVER (PARTITION BY conv_id ORDER BY nr) END AS pos,
    count(*) FILTER (WHERE letter <> 'D') OVER (PARTITION BY conv_id ORDER BY nr) AS place
  FROM letters
),
turns AS (
  SELECT t.conv_id, t.place, t.letter, r.role, CASE WHEN t.letter = 'I' THEN '' ELSE r.text END AS text,
    max(CASE WHEN t.letter = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY t.conv_id) AS shift
  FROM steps t LEFT JOIN faults r ON r.conv_id IS NOT DISTINCT FROM t.conv_id AND r.pos = t.pos
  WHERE t.letter <> 'D'
),
repaired AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - shift) % 2 = 1 THEN 'user'
      ELSE 'assistant' END || ':' || text, chr(10) ORDER BY place) AS whole
  FROM turns GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.cost, 0)::BIGINT AS cost,
  coalesce(b.audit, '') AS audit, sha256(coalesce(w.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired w ON w.conv_id IS NOT DISTINCT FROM c.conv_id
"""

# --- sets of word pairs ----------------------------------------------------------------------
# All links: of two linked sets, one of the rarest fifth (and one more) of either's shingles is shared.
OP12 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM d
),
spread AS (SELECT r, len(s) AS n, unnest(s) AS g FROM sets),
ranked AS (
  SELECT r, g, n, row_number() OVER (PARTITION BY r ORDER BY df, g) AS place
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS df FROM spread)
),
rare AS (SELECT r, g FROM ranked WHERE place <= n - ceil(n * 0.8) + 1),
links AS (
  SELECT a.r AS a, b.r AS b FROM (
    SELECT DISTINCT x.r AS x, y.r AS y FROM rare x JOIN rare y ON x.g = y.g AND x.r < y.r
  ) JOIN sets a ON a.r = x JOIN sets b ON b.r = y
  WHERE 100 * least(len(a.s), len(b.s)) >= 80 * greatest(len(a.s), len(b.s))
    AND 180 * len(list_intersect(a.s, b.s)) >= 80 * (len(a.s) + len(b.s))
),
reach AS (
  SELECT r AS a, r AS b FROM sets
  UNION
  SELECT reach.a, l.b FROM reach JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON l.a = reach.b
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(t.doc_id) AS component_id,
  coalesce(s.doc_id = min(t.doc_id), false) AS kept
FROM sets s JOIN reach ON reach.a = s.r JOIN sets t ON t.r = reach.b
GROUP BY s.r, s.doc_id, len(s.s)
"""


# --- centroid rounds -------------------------------------------------------------------------
def _op13(k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> str:
    """Every round written out: distances to all centroids, the nearest, the means."""
    steps = [f"""
WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
v AS MATERIALIZED (SELECT r, unnest(e) AS x, unnest(range({dims})) AS d FROM kept),
first AS (
  SELECT r, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS c FROM kept
  QUALIFY c < {k}
),
c0 AS MATERIALIZED (SELECT c, d, x FROM first JOIN v USING (r))"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, c, s FROM (
    SELECT v.r, t.c, sum((v.x - t.x) * (v.x - t.x))::BIGINT AS s FROM v JOIN c{i} t ON t.d = v.d GROUP BY v.r, t.c
  ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY s, c) = 1
)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (
  SELECT c, d, sum(x)::BIGINT AS s, count(*) AS n FROM a{i} JOIN v USING (r) GROUP BY c, d
),
c{i + 1} AS MATERIALIZED (
  SELECT t.c, t.d, CASE WHEN m.n IS NULL THEN t.x ELSE (m.s - ((m.s % m.n) + m.n) % m.n) // m.n END AS x
  FROM c{i} t LEFT JOIN m{i} m ON m.c = t.c AND m.d = t.d
)""")
    return ",".join(steps) + f"""
SELECT k.vec_id, a.c::INTEGER AS cluster, a.s AS distance,
  sum(a.s) OVER (PARTITION BY a.c)::BIGINT AS cluster_inertia, sum(a.s) OVER ()::BIGINT AS inertia,
  g.sha AS centroid_sha256
FROM a{rounds} a JOIN kept k USING (r)
JOIN (SELECT c, sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY d)) AS sha FROM c{rounds} GROUP BY c) g ON g.c = a.c
"""


ORACLES = {
    "op1_quality_rules": OP1,
    "op5_chat_format": OP5,
    "op7_topk_search": OP7,
    "op11_conversation_repair": OP11,
    "op12_minhash_near_dedup": OP12,
    "op13_centroid_clustering": _op13(),
}
