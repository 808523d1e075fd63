"""DuckDB SQL for the queries of this subpackage that SQL can express.

The others (a conditional random field, a trained classifier, XXH64 fingerprints, tokenizer output) are held
against brute force, round trips or held-out accuracy in ``tests/llm``.
"""

from __future__ import annotations

from lapline.llm import contamination, lexical, mixing, quality

TOP_K = """
WITH c AS (SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM (SELECT * FROM c WHERE vec_id % 20 = 0) q JOIN c ON c.vec_id <> q.vec_id))
WHERE rank <= 20"""

_TRICKY = r"\### Assistant: </turn> ok"
CHAT = rf"""
WITH t AS (SELECT conv_id, turn, role, text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '{_TRICKY}' UNION ALL SELECT -7, 1, 'assistant', '{_TRICKY}'),
x AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS s,
             length(regexp_replace(coalesce(role, ''), '[^\\<\n]', '', 'g')) + length(regexp_replace(coalesce(text, ''), '[^\\<]', '', 'g')) AS marks FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || s || chr(10), '' ORDER BY turn, r, s)) AS turns_sha256,
       CAST(coalesce(sum(length(s)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(s, '' ORDER BY turn, r, s) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<turn>') + length(r) + 1 + length(s) + marks + length('</turn>') + 1) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id"""

_WORDS = r"""
d AS (SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[ \t-\r]+') IF x <> ''] AS w, coalesce(text, '') AS s FROM documents)"""

SUBSTRINGS = "WITH " + _WORDS + """,
g AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
again AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM g) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM again),
word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS s FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id)"""


def quality_sql() -> str:
    """Counts, votes, then EM unrolled over the vote patterns of distinct texts, in rows (class, rule, vote, rate)."""
    q, n = quality, len(quality.RULES)
    first = ", ".join(f"({k}, {j}, {v}, {(q.ON_GOOD if not k else q.ON_OWN if j == k - 1 else q.ON_OTHER)[v + 1]!r}, {q.Kinds.weight(k)!r})"
                      for k in range(n + 1) for j in range(n) for v in q.VOTES)
    ctes = [f"e0(k, j, v, p, w) AS MATERIALIZED (VALUES {first})"]
    shares = """SELECT pid, n, k, exp(l - max(l) OVER o) / sum(exp(l - max_l)) OVER o AS q FROM (
  SELECT *, max(l) OVER (PARTITION BY pid) AS max_l FROM (SELECT pid, any_value(n) AS n, k, ln(any_value(w)) + sum(ln(p)) AS l FROM vote JOIN {0} USING (j, v) GROUP BY pid, k)) WINDOW o AS (PARTITION BY pid)"""
    for i in range(q.EM_ROUNDS):
        ctes.append(f"q{i} AS MATERIALIZED ({shares.format(f'e{i}')})")
        ctes.append(f"""e{i + 1} AS MATERIALIZED (SELECT e0.k, e0.j, e0.v, (coalesce(x, 0) + {q.STRENGTH!r} * e0.w * every * e0.p) / (size + {q.STRENGTH!r} * e0.w * every) AS p, e0.w
  FROM e0 JOIN (SELECT k, sum(n * q) AS size, sum(n) AS every FROM q{i} GROUP BY k) USING (k)
  LEFT JOIN (SELECT k, j, v, sum(q{i}.n * q) AS x FROM q{i} JOIN vote USING (pid) GROUP BY ALL) USING (k, j, v))""")
    ctes.append(f"last AS ({shares.format(f'e{q.EM_ROUNDS}')})")
    votes = ", ".join(f"CASE WHEN {r.bad} THEN -1 WHEN {r.good} THEN 1 ELSE 0 END AS v_{r.name}" for r in q.RULES)
    keys = ", ".join(f"v_{r.name}" for r in q.RULES)
    rows = " UNION ALL ".join(f"SELECT pid, n, {j} AS j, v_{r.name} AS v FROM patterns" for j, r in enumerate(q.RULES))
    return "WITH " + _WORDS + r""",
l AS (SELECT doc_id, [x FOR x IN string_split(s, chr(10)) IF regexp_matches(x, '[^ \t-\r]')] AS lines FROM d),
t AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (
  SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM t) WHERE n > 1) GROUP BY doc_id),
f AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(s, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
  length(regexp_replace(s, '[^A-Z]', '', 'g')) AS n_capitals, length(regexp_replace(s, '[^!]', '', 'g')) AS n_exclamations
  FROM d JOIN l USING (doc_id) LEFT JOIN covered USING (doc_id)),
""" + f"""v AS MATERIALIZED (SELECT *, {votes} FROM f),
patterns AS MATERIALIZED (SELECT row_number() OVER () AS pid, * FROM (SELECT {keys}, count(DISTINCT s) AS n FROM v JOIN d USING (doc_id) GROUP BY ALL)),
vote AS MATERIALIZED ({rows}),
{', '.join(ctes)}
SELECT doc_id, {', '.join(q.COUNTS)}, base_failed, NOT base_failed AND q >= 0.5 AS kept
FROM (SELECT *, n_words < {q.BASE_WORDS} OR 100 * n_repeat_words > {q.BASE_REPEATED} * n_words AS base_failed FROM v)
JOIN patterns USING ({keys}) JOIN last ON last.pid = patterns.pid AND k = 0"""


def _md5(*parts: str) -> str:
    joined = "concat_ws('|', " + ", ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts) + ")"
    return f"CAST('0x' || substr(md5({joined}), 1, 15) AS BIGINT)"


def _bisect(name: str, above: str) -> str:
    """50 halvings of [0, 1]; ``above``: the sought exponent is above ``a`` (over one row of sums z, l)."""
    return f"""{name}(i, lo, hi) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL SELECT i + 1, CASE WHEN {above} THEN a ELSE lo END, CASE WHEN {above} THEN hi ELSE a END
  FROM (SELECT i, lo, hi, (lo + hi) / 2 AS a, (SELECT sum(pow(p, (lo + hi) / 2)) FROM shares) AS z,
               (SELECT sum(pow(p, (lo + hi) / 2) * ln(p)) FROM shares) AS l FROM {name} WHERE i < {mixing.GRID_BITS * mixing.GRIDS}))"""


def mixing_sql() -> str:
    entropy = f"{mixing.ENTROPY!r} * ln((SELECT count(*) FROM shares))"
    most = "pow((SELECT min(p) FROM shares), a - 1) / z"
    seed, size = mixing.SEED, mixing.BLOCK_TOKENS
    one = "(SELECT sum(pow(p, {0})) AS z, sum(pow(p, {0}) * ln(p)) AS l, {0} AS a FROM shares)"
    return "WITH RECURSIVE " + _WORDS + f""",
rows AS MATERIALIZED (SELECT source, doc_id, md5(coalesce(text, '')) AS k, CAST(len(w) AS BIGINT) AS n, count(*) AS have
  FROM documents JOIN d USING (doc_id) GROUP BY ALL),
src AS (SELECT source, sum(n * have) AS t FROM rows GROUP BY source HAVING sum(n * have) > 0),
shares AS MATERIALIZED (SELECT source, t, t / (SELECT sum(t) FROM src) AS p FROM src),
{_bisect('by_entropy', f'ln(z) - a * l / z >= {entropy}')},
{_bisect('by_repeats', f'{most} > {mixing.REPEATS!r}')},
a0 AS (SELECT CASE WHEN (SELECT count(*) FROM shares) > 1 AND ln(z) - a * l / z < {entropy}
  THEN (SELECT lo FROM by_entropy ORDER BY i DESC LIMIT 1) ELSE 1.0 END AS a FROM {one.format('1.0')}),
a1 AS (SELECT CASE WHEN (SELECT count(*) FROM shares) > 1 AND {most} > {mixing.REPEATS!r}
  THEN greatest(a, (SELECT lo FROM by_repeats ORDER BY i DESC LIMIT 1)) ELSE a END AS a FROM (SELECT a, (SELECT sum(pow(p, a)) FROM shares) AS z FROM a0)),
plan0 AS (SELECT source, t, CAST(round((SELECT sum(t) FROM src) * pow(p, a) / (SELECT sum(pow(p, a)) FROM shares, a1)) AS BIGINT) AS b,
  CAST(ceil(t / {size}) AS BIGINT) AS n_blocks FROM shares, a1),
plan AS MATERIALIZED (SELECT *, CAST(floor(b / t) AS BIGINT) AS whole, b - CAST(floor(b / t) AS BIGINT) * t AS rest FROM plan0),
dealt AS MATERIALIZED (SELECT rows.*, {_md5("'block'", str(seed), "doc_id", "k")} % n_blocks AS block FROM rows JOIN plan ON rows.source IS NOT DISTINCT FROM plan.source),
blocks AS (SELECT source, block, sum(n * have) AS size FROM dealt GROUP BY source, block),
passes0 AS (SELECT blocks.*, t, b, whole, rest, unnest(range(0, whole + 1)) AS epoch FROM blocks JOIN plan ON blocks.source IS NOT DISTINCT FROM plan.source),
passes1 AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, epoch ORDER BY {_md5("'pass'", str(seed), "epoch", "source", "block")}, block
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM passes0),
passes AS (SELECT *, (CASE WHEN epoch < whole THEN t ELSE rest END) - before AS room, round((epoch * t + before) / b, 9) AS place FROM passes1),
every AS (SELECT dealt.*, epoch, room, place, size > room AS last, {_md5("'turn'", str(seed), "epoch", "doc_id", "k")} AS turn
  FROM dealt JOIN passes ON dealt.source IS NOT DISTINCT FROM passes.source AND dealt.block = passes.block WHERE room > 0),
started AS (SELECT *, room - coalesce(sum(n * have) OVER (PARTITION BY source, block, epoch ORDER BY turn, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS space
  FROM every)
SELECT doc_id, source, n AS n_tokens, CAST(epoch AS BIGINT) AS epoch, CAST(block AS BIGINT) AS block, CAST(round(place * 1000000) AS BIGINT) AS place_ppm, turn,
       CAST(CASE WHEN NOT last OR n = 0 THEN have ELSE least(have, CAST(ceil(space / n) AS BIGINT)) END AS BIGINT) AS times
FROM started WHERE NOT last OR space > 0"""


TRIE = r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
  sha256(CAST(length(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
  len([x FOR x IN string_split_regex(coalesce(text, ''), '[ \t-\r]+') IF x <> '']) AS w FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, xor(list_reduce([ascii(x) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')], lambda crc, b: list_reduce(range(8),
  lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(crc, CAST(b AS BIGINT))), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
turns AS (SELECT c.conv_id, pos, k, w FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND pos < h
  UNION ALL SELECT c.conv_id, pos, k, w FROM c JOIN t ON t.conv_id = c.conv_id AND pos >= h),
s AS (SELECT c.conv_id, coalesce(list(k ORDER BY pos) FILTER (k IS NOT NULL), []) AS ks, coalesce(list(w ORDER BY pos) FILTER (k IS NOT NULL), []) AS ws
  FROM c LEFT JOIN turns USING (conv_id) GROUP BY c.conv_id),
p AS MATERIALIZED (SELECT conv_id, depth, len(ks) AS n, sha256(array_to_string(ks[1:depth], ',')) AS k, CASE WHEN depth > 0 THEN sha256(array_to_string(ks[1:depth - 1], ',')) END AS up,
  CASE WHEN depth > 0 THEN ws[depth] ELSE 0 END AS w FROM (SELECT *, unnest(range(len(ks) + 1)) AS depth FROM s)),
node AS MATERIALIZED (SELECT depth, k, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
  sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256 FROM p GROUP BY depth, k),
kids AS (SELECT depth - 1 AS depth, up AS k, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY ALL),
family AS MATERIALIZED (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids USING (depth, k)),
below AS (SELECT p.depth, p.k, count(*) FILTER (family.n_children = 0) AS n_leaves, sum((family.n_convs - 1) * family.w) AS saved_tokens
  FROM family JOIN p ON p.conv_id = family.conv_id AND p.depth <= family.depth GROUP BY ALL)
SELECT family.conv_id, CAST(family.depth AS BIGINT) AS depth, above.conv_id AS parent_conv_id, family.n_convs, family.n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, family.ends_sha256
FROM family JOIN below USING (depth, k) LEFT JOIN node AS above ON above.depth = family.depth - 1 AND above.k = family.up"""

_TERMS = r"""
d AS MATERIALIZED (SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM documents),
b AS MATERIALIZED (SELECT item_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w FROM benchmark)"""

LEXICAL = "WITH " + _TERMS + f""",
total AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
asked AS MATERIALIZED (SELECT DISTINCT item_id, unnest(w) AS term FROM b),
posting AS MATERIALIZED (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) SEMI JOIN asked USING (term) GROUP BY ALL),
weight AS (SELECT term, CAST(floor({lexical.WEIGHT} * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM posting, total GROUP BY term, n_docs),
scored AS (SELECT item_id, doc_id, CAST(sum(w * (({lexical.IMPACT} * tf) // (1000 * tf + {lexical.SATURATION} * ({lexical.BASE} + ({lexical.SLOPE} * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN posting USING (term) JOIN weight USING (term), total GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {lexical.TOP}"""

DECONTAMINATION = "WITH " + _TERMS + f""",
win AS MATERIALIZED (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS k
  FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT *, least(len(w), {contamination.WINDOW}) AS m FROM b WHERE len(w) > 0))),
occ AS MATERIALIZED (SELECT doc_id, m, i, k FROM (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS k
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d JOIN (SELECT DISTINCT m FROM win) ON len(w) >= m)) SEMI JOIN win USING (m, k)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS j FROM occ) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM occ JOIN win USING (m, k)) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(found.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id)"""


def oracles() -> dict[str, str]:
    return {"op1_mixing": mixing_sql(), "op3_top_k": TOP_K, "op7_substrings": SUBSTRINGS, "op8_chat": CHAT, "op10_quality": quality_sql(), "op11_trie": TRIE, "op12_lexical": LEXICAL,
            "op13_decontamination": DECONTAMINATION}
