"""SQL counterparts of the queries that SQL can express."""

ORACLES = {}

ORACLES["op5_quality"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host,
    coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
windows AS (
  SELECT rid, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
repeats AS (SELECT rid, list(i) AS places FROM windows GROUP BY rid, a, b, c HAVING count(*) > 1),
covered AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (SELECT rid, unnest(places) AS i FROM repeats))
  GROUP BY rid),
lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
counts AS (
  SELECT doc_id, host, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines
  FROM w LEFT JOIN covered USING (rid) LEFT JOIN lines USING (rid)),
failed AS (
  SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repetitive,
    100 * n_symbols > 10 * word_chars AS symbols, 100 * n_dup_lines > 30 * n_lines AS dup_lines
  FROM counts),
rules AS (
  SELECT host, rule, count(*) AS docs, sum(CAST(bad AS BIGINT)) AS bad
  FROM (SELECT host, unnest(['short', 'repetitive', 'symbols', 'dup_lines']) AS rule,
          unnest([short, repetitive, symbols, dup_lines]) AS bad FROM failed)
  GROUP BY host, rule),
moments AS (
  SELECT rule, sum(docs) AS n, count(*) AS hosts, sum(bad) / sum(docs) AS mu,
    sum(bad * bad / docs) AS square, sum(docs * docs) AS docs_square
  FROM rules GROUP BY rule),
priors AS (
  SELECT rule, mu,
    (square - n * mu * mu - (hosts - 1) * mu * (1 - mu)) / nullif(n - docs_square / n, 0) AS variance
  FROM moments),
rates AS (
  SELECT host, CASE WHEN mu <= 0 OR mu >= 1 OR variance IS NULL OR variance <= 0 THEN mu
    ELSE (bad + greatest(mu * (1 - mu) / variance - 1, 0) * mu)
      / (docs + greatest(mu * (1 - mu) / variance - 1, 0)) END AS rate
  FROM rules JOIN priors USING (rule)),
verdicts AS (SELECT host, max(rate) >= 0.5 AS host_failed FROM rates GROUP BY host)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, short OR repetitive AS base_failed, host_failed,
  NOT (short OR repetitive OR host_failed) AS kept
FROM failed JOIN verdicts USING (host)
"""

ORACLES["op9_line_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, -9223372036854775808) AS doc,
    string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT rid, doc, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS line FROM d),
keyed AS (
  SELECT *, translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
firsts AS (SELECT key, min(doc) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT rid, pos, line, coalesce(doc > first, false) AS lost
  FROM keyed LEFT JOIN firsts USING (key)),
joined AS (
  SELECT rid, count(*) AS n_lines, sum(CAST(lost AS BIGINT)) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '') AS kept
  FROM marked GROUP BY rid)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped,
  sha256(kept) AS kept_sha256
FROM d JOIN joined USING (rid)
"""

ORACLES["op7_mixing"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
    CAST('0x' || substr(md5(concat_ws(':', 'mixing', 'block', CAST(doc_id AS VARCHAR))), 1, 15)
      AS BIGINT) AS block_hash,
    CAST('0x' || substr(md5(concat_ws(':', 'mixing', 'order', CAST(doc_id AS VARCHAR))), 1, 15)
      AS BIGINT) AS order_hash
  FROM documents),
sources AS (SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM d GROUP BY source),
logs AS (
  SELECT source, tokens, ln(tokens / max(tokens) OVER ()) AS x FROM sources WHERE tokens > 0),
measured AS (
  SELECT step, ln(sum(exp(step / 4096 * x)))
      - step / 4096 * sum(x * exp(step / 4096 * x)) / sum(exp(step / 4096 * x)) AS entropy,
    exp((1 - step / 4096) * -min(x)) AS repeats, count(*) AS n
  FROM logs, (SELECT unnest(range(4097)) AS step) GROUP BY step),
chosen AS (
  SELECT greatest(max(step) FILTER (WHERE entropy >= 0.95 * ln(n) - 1e-12),
    min(step) FILTER (WHERE repeats <= 3 + 1e-9)) / 4096 AS a FROM measured),
powers AS (SELECT source, tokens, exp(a * x) AS power FROM logs, chosen),
plan AS (
  SELECT s.source, s.tokens, round(coalesce(power / (SELECT sum(power) FROM powers), 0), 9) AS weight,
    greatest(coalesce(CAST(round(power * (SELECT max(tokens) FROM sources)) AS BIGINT), 0), s.tokens)
      AS budget,
    CAST(ceil(greatest(s.tokens, 1) / 4194304) AS BIGINT) AS n_blocks
  FROM sources s LEFT JOIN powers p ON s.source = p.source),
rows AS (
  SELECT d.*, weight, budget, block_hash % n_blocks AS block,
    CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS epochs,
    CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
  FROM d JOIN plan USING (source)),
blocks AS (
  SELECT source, block, sum(n_tokens) AS n, any_value(rest) AS rest,
    CAST('0x' || substr(md5(concat_ws(':', 'mixing', 'last', source, CAST(block AS VARCHAR))), 1, 15)
      AS BIGINT) AS place
  FROM rows GROUP BY source, block),
fitting AS (
  SELECT source, block, n,
    rest - (sum(n) OVER (PARTITION BY source ORDER BY place, block) - n) AS fits FROM blocks),
marked AS (
  SELECT r.*, sum(r.n_tokens) OVER (PARTITION BY r.source, r.block ORDER BY r.order_hash) AS running,
    f.n, f.fits
  FROM rows r JOIN fitting f ON r.source = f.source AND r.block = f.block)
SELECT doc_id, source, n_tokens, weight, budget, CAST(block AS INTEGER) AS block,
  CAST(epochs + CASE WHEN fits > 0 AND (n <= fits OR running <= fits) THEN 1 ELSE 0 END AS INTEGER)
    AS copies
FROM marked
"""

ORACLES["op8_near_dedup"] = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0),
shingles AS (SELECT DISTINCT rid, array_to_string(w[i:i + 4], ' ') AS shingle FROM places),
sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
shared AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.rid <> b.rid GROUP BY a.rid, b.rid),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON x = p.rid JOIN sizes q ON y = q.rid
  WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)),
reached AS (
  SELECT rid AS x, rid AS y FROM d UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
found AS (
  SELECT x, min(doc_id) AS component_id FROM reached JOIN d ON reached.y = d.rid GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
  doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN found ON d.rid = found.x LEFT JOIN sizes ON d.rid = sizes.rid
"""

ORACLES["op11_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
hashed AS (
  SELECT *, len(u) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS x,
    CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS y,
    CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS moved,
    CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS spm FROM d),
parts AS (
  SELECT *, array_to_string(u[1:least(x, y)], '') AS p,
    array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
    array_to_string(u[greatest(x, y) + 1:n], '') AS s,
    CASE WHEN n = 0 OR moved >= 50 OR contains(text, '<P>') OR contains(text, '<S>')
      OR contains(text, '<M>') THEN 'plain' WHEN spm < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM hashed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

_LEAK_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w"
)
ORACLES["op12_decontamination"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_LEAK_WORDS} FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_LEAK_WORDS} FROM benchmark),
item_places AS (
  SELECT item, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 8, 2))) AS i
  FROM b WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM item_places),
sizes AS (SELECT DISTINCT size FROM phrases),
places AS (
  SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size),
hits AS (
  SELECT rid, i, places.size, item FROM places JOIN phrases
  ON places.size = phrases.size AND array_to_string(w[i:i + places.size - 1], ' ') = phrase),
words AS (
  SELECT rid, count(DISTINCT place) AS n_hit
  FROM (SELECT rid, unnest(range(i, i + size)) AS place FROM hits) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rid) LEFT JOIN items USING (rid)
"""

ORACLES["op13_hard_negatives"] = """
WITH given AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL),
parts AS (
  SELECT rid, unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM given),
bad AS (SELECT DISTINCT rid FROM parts WHERE x IS NULL OR NOT isfinite(x)),
e AS (SELECT rid, vec_id, label FROM given WHERE rid NOT IN (SELECT rid FROM bad)),
scaled AS (SELECT rid, i, CAST(floor(256 * x) AS BIGINT) AS x FROM parts),
products AS (
  SELECT a.rid AS a, b.rid AS b, sum(a.x * b.x) AS score
  FROM scaled a JOIN scaled b ON a.i = b.i
  WHERE a.rid IN (SELECT rid FROM e WHERE vec_id % 100 = 0) GROUP BY a.rid, b.rid),
scored AS (
  SELECT a.rid AS a, a.vec_id AS anchor_id, b.rid AS b, b.vec_id, a.label = b.label AS same,
    CAST(coalesce(score, 0) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
  LEFT JOIN products p ON p.a = a.rid AND p.b = b.rid),
positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE same) WHERE place <= 5),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id,
    n.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.vec_id) AS place
  FROM positives p JOIN scored n ON n.a = p.a AND NOT n.same
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE place <= 10
"""
