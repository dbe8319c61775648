"""DuckDB SQL for those queries that SQL can say."""

from __future__ import annotations

from tidemark.llm.urls import MAX_STRENGTH, MIN_STRENGTH, SECOND_LEVEL, TOP_PRIOR

AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), e AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS body,
    regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g') AS name,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS no FROM rows
), l AS (
  SELECT *, sum(length(name) + length(body) + 24) OVER (PARTITION BY conv_id ORDER BY no) AS upto FROM e
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY no)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY no) FILTER (role = 'assistant'), '')) AS loss_sha256,
  max(upto)::BIGINT AS formatted_chars,
  (count(*) FILTER (role = 'assistant'))::BIGINT AS n_examples,
  coalesce(sum(upto - 11) FILTER (role = 'assistant'), 0)::BIGINT AS example_chars
FROM l GROUP BY conv_id
"""

MIXING = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), s AS (
  SELECT source, sum(size)::HUGEINT AS source_size FROM docs GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::HUGEINT AS weight,
    sum(source_size) OVER () * 150 AS total FROM s
), o AS (
  SELECT *, 2 * source_size AS cap, (2 * source_size)::DOUBLE / weight::DOUBLE AS level FROM w
), c AS (
  SELECT *, total - 100 * coalesce(sum(cap) OVER (ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num,
    100 * sum(weight) OVER (ORDER BY level, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS den FROM o
), line AS (
  SELECT level AS l, num AS n, den AS d FROM c WHERE num * weight < cap * den ORDER BY level, num, den LIMIT 1
), t AS (
  SELECT source, source_size, CASE WHEN level >= l THEN n * weight ELSE cap END AS share_num, CASE WHEN level >= l THEN d ELSE 1 END AS share_den
  FROM c LEFT JOIN line ON true
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN share_num // (share_den * source_size) ELSE 0 END AS whole FROM t
), f AS (
  SELECT doc_id, size, docs.source, source_size, share_num, share_den, whole,
    2 * coalesce(sum(size) OVER (PARTITION BY docs.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size AS middle
  FROM docs JOIN r ON docs.source IS NOT DISTINCT FROM r.source
), g AS (
  SELECT *, whole + CASE WHEN whole < 2 AND middle::HUGEINT * share_den <= 2 * (share_num - whole * share_den * source_size) THEN 1 ELSE 0 END AS epochs FROM f
)
SELECT doc_id, size, source, source_size::BIGINT AS source_size, share_num::DOUBLE / share_den::DOUBLE AS target, epochs::BIGINT AS epochs, (epochs * size)::BIGINT AS taken FROM g
"""

_SECOND = ", ".join(f"'{x}'" for x in SECOND_LEVEL)


def _strength(units: str, parent: str) -> str:
    return f"""SELECT *, CASE WHEN m < 2 OR within <= 0 THEN 10.0 WHEN between_ <= 0 THEN {MAX_STRENGTH} ELSE greatest({MIN_STRENGTH}, least({MAX_STRENGTH}, within / between_ - 1)) END AS strength FROM (
  SELECT *, (q - bad * p - (m - 1) * within) / nullif(n - nn / n, 0) AS between_ FROM (
  SELECT *, bad / n AS p, (bad / n) * (1 - bad / n) AS within FROM (
  SELECT {parent} AS name, count(*) AS m, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, sum(n::DOUBLE * n) AS nn, sum(bad::DOUBLE * bad / n) AS q FROM {units} GROUP BY 1)))"""


URLS = rf"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {AZ}) AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages
), k AS (
  SELECT doc_id, max(CASE WHEN quality = 0 THEN 1 WHEN quality IS NOT NULL THEN 0 END) AS bad FROM labels GROUP BY doc_id
), h0 AS (
  SELECT host, count(*) AS n, sum(bad)::BIGINT AS bad FROM p JOIN k ON page_id = doc_id WHERE bad IS NOT NULL AND host <> '' GROUP BY host
), h1 AS (
  SELECT *, string_split(host, '.') AS parts FROM (SELECT DISTINCT host FROM p WHERE host <> '') LEFT JOIN h0 USING (host)
), h2 AS (
  SELECT *, list_aggregate(parts[-2:], 'string_agg', '.') AS two, list_aggregate(parts[-3:], 'string_agg', '.') AS three FROM h1
), every AS (
  SELECT host AS name, n, bad, CASE WHEN two IN ({_SECOND}) THEN three ELSE two END AS domain, CASE WHEN two IN ({_SECOND}) THEN two ELSE parts[-1] END AS suffix FROM h2
), h AS (SELECT * FROM every WHERE n IS NOT NULL),
d AS (SELECT domain AS name, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix AS name, '' AS top, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
ks AS ({_strength('s', 'top')}), kd AS ({_strength('d', 'suffix')}), kh AS ({_strength('h', 'domain')}),
pt AS (SELECT (bad + {TOP_PRIOR}) / (n + 2 * {TOP_PRIOR}) AS post, strength FROM ks),
ps AS (SELECT s.name, (s.bad + pt.post * pt.strength) / (s.n + pt.strength) AS post, kd.strength FROM s CROSS JOIN pt JOIN kd ON s.name = kd.name),
pd AS (SELECT d.name, (d.bad + ps.post * ps.strength) / (d.n + ps.strength) AS post, kh.strength FROM d JOIN ps ON d.suffix = ps.name JOIN kh ON d.name = kh.name),
priors AS (
  SELECT e.name, coalesce(e.n, 0) AS n, coalesce(e.bad, 0) AS bad, coalesce(pd.post, ps.post, pt.post) AS post, coalesce(pd.strength, ps.strength, pt.strength) AS strength
  FROM every e LEFT JOIN pd ON e.domain = pd.name LEFT JOIN ps ON e.suffix = ps.name LEFT JOIN pt ON true
), ph AS (SELECT name, bad + post * strength AS a, n - bad + (1 - post) * strength AS b FROM priors),
blocked AS (SELECT name FROM ph WHERE a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5),
rules(action, rh, rp) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fit AS (
  SELECT page_id, url, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(action, length(rh || rp)) AS action
  FROM (SELECT DISTINCT p.page_id, p.host || p.path AS url, host, path FROM p) p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL
)
SELECT p.page_id, p.host, p.path, rule, coalesce(action, CASE WHEN blocked.name IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM p LEFT JOIN fit ON p.page_id = fit.page_id AND p.host || p.path = fit.url LEFT JOIN blocked ON p.host = blocked.name
"""

_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = rf"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, w[i : i + least(len(w), 10) - 1] AS g FROM b, range(1, greatest(len(w) - 9, 1) + 1) t(i) WHERE len(w) > 0
), d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT len(g) AS n FROM win),
grams AS (SELECT doc_id, i, n, w[i : i + n - 1] AS g FROM d, sizes, range(1, len(w) - n + 2) t(i) WHERE len(w) >= n),
hit AS (SELECT doc_id, i, grams.n, item_id FROM grams JOIN win ON grams.g = win.g),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM hit, range(i, i + n) t(j) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON d.doc_id = words.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""


IMPACT = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
total AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
tf AS (SELECT doc_id, len(w) AS n, t, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS t FROM d) GROUP BY doc_id, len(w), t),
df AS (SELECT t, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), total),
q AS (
  SELECT item_id, t, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), {AZ}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY item_id, t
), s AS (
  SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * tf.n * total.n) // total.l)))))::BIGINT AS score
  FROM q JOIN df USING (t) JOIN tf USING (t), total GROUP BY item_id, doc_id
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""

AUDIT = r"""
WITH l AS (SELECT doc_id AS id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), m AS (
  SELECT part, doc_id, CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask FROM d
), h AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM m LEFT JOIN l ON doc_id = id GROUP BY part, mask
), f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT [a.bit, b.bit, c.bit, e.bit, g.bit] AS bits, a.letter || b.letter || c.letter || e.letter || g.letter AS filter_order
  FROM f a, f b, f c, f e, f g WHERE (a.bit | b.bit | c.bit | e.bit | g.bit) = 31
), s AS (
  SELECT filter_order, i::INTEGER AS step, bits[i] AS bit, coalesce(list_sum(bits[1 : i - 1]), 0)::INTEGER AS earlier FROM o, range(1, 6) t(i)
), r AS (
  SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER ((mask & (bit | earlier)) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER ((mask & bit) > 0 AND (mask & earlier) = 0), 0)::BIGINT AS removed, coalesce(sum(n) FILTER ((mask & bit) > 0 AND (mask & earlier) > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER ((mask & bit) > 0 AND (mask & earlier) = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER ((mask & bit) > 0 AND (mask & earlier) = 0), 0)::BIGINT AS toxic_lost
  FROM h, s GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""

# Base32 digits are read five bits at a time from the bits of the digest.
WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (
  SELECT page_id, strlen(t)::BIGINT AS payload_bytes, min(page_id) OVER (PARTITION BY t) AS first,
    list_reduce(list_transform(string_split(sha1(t), ''), lambda c: ['0000', '0001', '0010', '0011', '0100', '0101', '0110', '0111', '1000', '1001', '1010', '1011', '1100', '1101', '1110', '1111'][strpos('0123456789abcdef', c)]), lambda x, y: x || y) AS bits FROM p
)
SELECT page_id, payload_bytes,
  list_reduce(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(16 * bits[5 * i + 1]::INTEGER + 8 * bits[5 * i + 2]::INTEGER + 4 * bits[5 * i + 3]::INTEGER + 2 * bits[5 * i + 4]::INTEGER + bits[5 * i + 5]::INTEGER + 1)::INTEGER]), lambda x, y: x || y) AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM d
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_chat": CHAT, "op3_mixing": MIXING, "op4_urls": URLS, "op5_decontaminate": DECONTAMINATE, "op11_impact": IMPACT, "op12_audit": AUDIT, "op13_warc": WARC}
