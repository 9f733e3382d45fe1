"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import lines, mix, rules

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _rules_sql() -> str:
    mask = " + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in rules.RULES)
    base, kept = rules.mask_of(rules.BASE), rules.mask_of(rules.POLICIES[rules.DEFAULT_POLICY])
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, {_WORDS} AS ws FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 1)) AS p, ws FROM w),
h AS (SELECT r, p, count(*) OVER (PARTITION BY r, ws[p], ws[p + 1], ws[p + 2]) AS c FROM g),
rep AS (SELECT r, count(*) AS n_repeat_words FROM (SELECT DISTINCT r, p + k AS q FROM h, (VALUES (0), (1), (2)) AS o(k) WHERE c > 1) GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
ln AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, length(regexp_replace(text, '[^!]', '', 'g'))::BIGINT AS n_exclaims,
  coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN ln USING (r)),
f AS (SELECT *, ({mask})::BIGINT AS fail_mask FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_mask & {base}) <> 0 AS base_failed, (fail_mask & {kept}) = 0 AS kept, fail_mask FROM f"""


def _lines_sql() -> str:
    trim = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
l AS (SELECT r, source, generate_subscripts(ls, 1) AS p, unnest(ls) AS line FROM (SELECT r, source, string_split(text, chr(10)) AS ls FROM d)),
c AS (SELECT source, trim(line, {trim}) AS t, count(DISTINCT r) AS n FROM l WHERE trim(line, {trim}) <> '' GROUP BY ALL),
h AS (SELECT source, count(*) AS pages FROM d GROUP BY source),
bad AS (SELECT c.source, t FROM c JOIN h ON c.source IS NOT DISTINCT FROM h.source WHERE n >= {lines.MIN_PAGES} AND n > {lines.RATIO} * pages),
k AS (SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE t IS NOT NULL) AS n_dropped, string_agg(line, chr(10) ORDER BY p) FILTER (WHERE t IS NULL) AS text
  FROM l LEFT JOIN bad ON l.source IS NOT DISTINCT FROM bad.source AND trim(line, {trim}) = t GROUP BY r)
SELECT doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped
FROM d LEFT JOIN k USING (r)"""


SQL_ROUNDS = 16


def mix_sql() -> str:
    """The rounds unrolled: the same factors in the same order, as many rounds as converge with the query's targets."""
    topic = " ".join(f"WHEN regexp_matches(coalesce(text, ''), '{p}') THEN '{n}'" for n, p in mix.TOPICS)
    steps, last = [], "c0"
    for d in mix.DIMENSIONS:
        power = mix.TARGETS[d]
        steps.append(f"g_{d} AS MATERIALIZED (SELECT {d}_, r / sum(r) OVER () AS goal FROM (SELECT {d}_, CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens)::DOUBLE, {power}) ELSE 0 END AS r FROM c0 GROUP BY {d}_))")
    for i in range(SQL_ROUNDS * len(mix.DIMENSIONS)):
        d = mix.DIMENSIONS[i % len(mix.DIMENSIONS)]
        steps.append(
            f"c{i + 1} AS MATERIALIZED (SELECT source_, lang_, topic_, tokens, w * CASE WHEN h > 0 THEN goal / h ELSE 0 END AS w FROM (SELECT *, sum(w) OVER (PARTITION BY {d}_) AS h FROM {last}) JOIN g_{d} USING ({d}_))"
        )
        last = f"c{i + 1}"
    chain = ",\n".join(steps)
    return rf"""
WITH d AS (SELECT doc_id, source, lang, coalesce(source, '') AS source_, coalesce(lang, '') AS lang_, len({_WORDS})::BIGINT AS n_tokens,
  CASE {topic} ELSE '{mix.OTHER_TOPIC}' END AS topic_ FROM documents),
c0 AS MATERIALIZED (SELECT source_, lang_, topic_, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::DOUBLE AS w FROM d GROUP BY ALL),
{chain},
x AS (SELECT *, CASE WHEN tokens > 0 THEN w / tokens ELSE 0 END AS ratio FROM {last}),
p AS (SELECT source_, lang_, topic_, CASE WHEN max(ratio) OVER () > 0 THEN ratio / max(ratio) OVER () ELSE 0 END AS probability FROM x)
SELECT doc_id, source, lang, topic_ AS topic, n_tokens, round(probability, 6) AS probability,
  ('0x' || substr(md5('{mix.SEED}|' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 < probability AS sampled
FROM d JOIN p USING (source_, lang_, topic_)"""


RULES_SQL = _rules_sql()
LINES_SQL = _lines_sql()


def _ablation_sql() -> str:
    policy = rules.DEFAULT_POLICY
    whole = rules.mask_of(rules.POLICIES[policy])
    rows = ", ".join(f"('{r.name}', {1 << r.bit})" for r in rules.RULES if r.name in rules.POLICIES[policy])
    return f"""
SELECT rule, (count(*) FILTER (WHERE (m & b) <> 0))::BIGINT AS n_failed, (count(*) FILTER (WHERE m = b))::BIGINT AS n_only, '{policy}' AS policy
FROM (SELECT fail_mask & {whole} AS m FROM ({RULES_SQL}) AS ledger), (VALUES {rows}) AS r(rule, b) GROUP BY rule"""


ABLATION_SQL = _ablation_sql()


def _crc32(text: str) -> str:
    """The CRC-32 of an ASCII text, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"""xor(4294967295, list_reduce([4294967295] || {codes},
    lambda c, x: list_reduce([xor(c, x)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)))"""


#: All pairs of queries and candidates.
SEARCH_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM (SELECT * FROM v WHERE vec_id % 50 = 0) q JOIN v c ON c.vec_id <> q.vec_id)
SELECT query_id, rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 5"""

#: What the rest costs from each state, row by row from the end (b), then the least of the cheapest edits from the start (x).
REPAIR_SQL = r"""
WITH RECURSIVE k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS kind FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM k WHERE kind <> 0),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
  left(role, 1) AS a FROM d),
g AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
  lag(a) OVER (PARTITION BY conv_id ORDER BY i) || a AS pair FROM e),
o AS (SELECT *, (fault = 'truncated')::BIGINT AS late, CASE WHEN fault IN ('blank', 'duplicate') THEN 'd' WHEN a IN ('s', 'u', 'a') THEN a ELSE 'x' END AS r FROM g),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank')::BIGINT AS blank, count(*) FILTER (fault = 'duplicate')::BIGINT AS duplicate,
  count(*) FILTER (fault = 'truncated')::BIGINT AS truncated, count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au'))::BIGINT AS illegal FROM o GROUP BY conv_id),
b AS (SELECT conv_id, n + 1 AS i, [0, 4, 2, 0]::BIGINT[] AS c FROM n UNION ALL
  SELECT conv_id, i, [least(p0, 2 + p2, 4 + p3), least(p1, 2 + p2, 4 + p3), least(p2, 2 + p3), least(p3, 2 + p2)]::BIGINT[] FROM (
    SELECT o.conv_id, o.i, least(3 + c[1], CASE r WHEN 's' THEN late + c[2] WHEN 'u' THEN late + c[3] END, CASE WHEN r <> 'd' THEN 2 + late + c[3] END) AS p0,
      least(3 + c[2], CASE WHEN r = 'u' THEN late + c[3] END, CASE WHEN r <> 'd' THEN 2 + late + c[3] END) AS p1, least(3 + c[3], CASE WHEN r = 'a' THEN late + c[4] END, CASE WHEN r <> 'd' THEN 2 + late + c[4] END) AS p2,
      least(3 + c[4], CASE WHEN r = 'u' THEN late + c[3] END, CASE WHEN r <> 'd' THEN 2 + late + c[3] END) AS p3 FROM b JOIN o ON o.conv_id = b.conv_id AND o.i = b.i - 1)),
x AS (SELECT conv_id, 1::BIGINT AS i, 0 AS s, '' AS audit, []::VARCHAR[] AS lines FROM n UNION ALL
  SELECT conv_id, CASE WHEN letter = 'I' THEN i ELSE i + 1 END, CASE letter WHEN 'D' THEN s WHEN 'K' THEN kept ELSE given END, audit || letter,
    CASE letter WHEN 'D' THEN lines WHEN 'K' THEN lines || [role || ':' || text] ELSE lines || [CASE WHEN given = 2 THEN 'user:' ELSE 'assistant:' END || CASE WHEN letter = 'R' THEN text ELSE '' END] END FROM (
    SELECT *, CASE WHEN r IS NULL THEN CASE WHEN c[s + 1] > 0 THEN 'I' END WHEN 3 + after[s + 1] = c[s + 1] THEN 'D' WHEN 2 + c[given + 1] = c[s + 1] THEN 'I' WHEN late + after[kept + 1] = c[s + 1] THEN 'K' ELSE 'R' END AS letter FROM (
      SELECT x.*, CASE WHEN s = 2 THEN 3 ELSE 2 END AS given, CASE WHEN r = 's' AND s = 0 THEN 1 WHEN r = 'u' AND s <> 2 THEN 2 WHEN r = 'a' AND s = 2 THEN 3 END AS kept, o.r, o.late, o.role, o.text, h.c, t.c AS after
      FROM x JOIN b h ON h.conv_id = x.conv_id AND h.i = x.i LEFT JOIN b t ON t.conv_id = x.conv_id AND t.i = x.i + 1 LEFT JOIN o ON o.conv_id = x.conv_id AND o.i = x.i)) WHERE letter IS NOT NULL),
y AS (SELECT conv_id, max_by(audit, length(audit)) AS audit, max_by(lines, length(audit)) AS lines FROM x GROUP BY conv_id)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(b.c[1], 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN n USING (conv_id) LEFT JOIN y USING (conv_id) LEFT JOIN b ON b.conv_id = n.conv_id AND b.i = 1""".replace("{crc}", _crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"))

#: A run of four periods and six words has five words in a row that are repeated a period later: pairs of equal five words at
#: one distance, joined to stretches.
RUNS_SQL = r"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, CASE WHEN doc_id IS NOT NULL THEN {crc} ELSE 1 END AS h FROM documents),
p AS (SELECT *, len(ws) AS n, (h // 10) % greatest(len(ws), 1) AS a, 1 + (len(ws) - (h // 10) % greatest(len(ws), 1)) // (3 + (h // 10) % 8) AS p FROM w),
d AS MATERIALIZED (SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE ws END AS ws FROM p),
f AS (SELECT r, n, i, array_to_string(ws[i + 1 : i + 5], ' ') AS g FROM (SELECT r, n, ws, unnest(range(0, n - 4)) AS i FROM d WHERE n >= 6)),
m AS (SELECT x.r, y.i - x.i AS q, x.i FROM f x JOIN f y ON x.r = y.r AND x.g = y.g AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
s AS (SELECT r, q, min(i) AS start, max(i) + 5 + q AS stop FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM m) GROUP BY r, q, island),
u AS (SELECT r, start, stop, min(q) AS period FROM s WHERE stop - start >= greatest(6, 4 * q) GROUP BY r, start, stop),
z AS (SELECT r, count(*) AS n_runs, arg_min(start, (start - stop, start, period)) AS start, arg_min(stop - start, (start - stop, start, period)) AS length, arg_min(period, (start - stop, start, period)) AS period,
  string_agg(start || ',' || (stop - start) || ',' || period || chr(10), '' ORDER BY start, period) AS told, list((start + period, stop)) AS gone FROM u GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(told, '')) AS runs_sha256,
  sha256(CASE WHEN gone IS NULL THEN array_to_string(ws, ' ') ELSE array_to_string(list_transform(list_filter(range(0, n), lambda i: len(list_filter(gone, lambda x: x[1] <= i AND i < x[2])) = 0), lambda i: ws[i + 1]), ' ') END) AS collapsed_sha256
FROM d LEFT JOIN z USING (r)""".replace("{crc}", _crc32("doc_id::VARCHAR"))
