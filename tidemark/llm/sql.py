"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm import quality_rules, secret_scan, shard


def shards(shards: int = 8, seed: int = 20240607) -> str:
    """CRC-32 byte by byte, row numbers, and the Feistel network with its cycle walk as a
    recursion over rounds; a row ends when its value after a full pass is below n."""
    keys = shard.round_keys(seed)
    m = ", ".join(str(k[0]) for k in keys)
    c = ", ".join(str(k[1]) for k in keys)
    p, rounds = shard.PRIME, shard.ROUNDS

    def mixed(x: str) -> str:
        t = f"(({x} * ms[i + 1] + cs[i + 1]) % {p})"
        return f"(({t} * {t} % {p}) >> 3)"

    return f"""
WITH RECURSIVE table256 AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(0, 8)),
                          lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS v
    FROM range(0, 256) r(b))),
base AS (
  SELECT row_number() OVER () AS u, doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT,
             list_transform(range(0, octet_length(encode(coalesce(text, '')))),
                            lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::BIGINT)),
           lambda x, y: xor(x // 256, t[(xor(x, y) % 256) + 1]))) AS crc
  FROM documents, table256),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, crc, size) - 1 AS rn, count(*) OVER () AS n FROM base),
dims AS (
  SELECT n, a, greatest(1, (n + a - 1) // a)::BIGINT AS b, [{m}]::BIGINT[] AS ms, [{c}]::BIGINT[] AS cs
  FROM (SELECT n, greatest(1, ceil(sqrt(n)))::BIGINT AS a FROM (SELECT count(*) AS n FROM documents))),
net AS (
  SELECT u, rn // b AS l, rn % b AS r, 0 AS i, n, a, b, ms, cs FROM numbered JOIN dims USING (n)
  UNION ALL
  SELECT u, CASE WHEN i = {rounds} THEN (l * b + r) // b WHEN i % 2 = 0 THEN (l + {mixed("r")}) % a ELSE l END,
         CASE WHEN i = {rounds} THEN (l * b + r) % b WHEN i % 2 = 1 THEN (r + {mixed("l")}) % b ELSE r END,
         CASE WHEN i = {rounds} THEN 0 ELSE i + 1 END, n, a, b, ms, cs
  FROM net WHERE NOT (i = {rounds} AND l * b + r < n)),
placed AS (SELECT u, l * b + r AS place FROM net WHERE i = {rounds} AND l * b + r < n)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'rows' AS law, (place % {shards})::INT AS shard,
       (place // {shards})::BIGINT AS slot, NULL::INT AS grown_shard
FROM numbered JOIN placed USING (u)
"""


WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def rule_votes() -> str:
    """Statistics per text, votes, and expectation-maximisation on the counted vote patterns with
    its rounds written one after the other."""
    votes = quality_rules.votes_sql()
    rules = quality_rules.RULES
    pattern = " || ".join(f"(CASE ({votes[r]}) WHEN 1 THEN '+' WHEN -1 THEN '-' ELSE '0' END)" for r in rules)
    start = ", ".join(f"({r}, '{v}', {quality_rules.START['g', v]}::DOUBLE, {quality_rules.START['b', v]}::DOUBLE)"
                      for r in range(len(rules)) for v in "+-0")
    share = quality_rules.PRIOR_SHARE

    def posterior(k: int) -> str:
        return f"""
post{k} AS MATERIALIZED (
  SELECT s, c, 1 / (1 + exp(least(700, ln(1 - any_value(prior)) + sum(ln(b)) - ln(any_value(prior)) - sum(ln(g))))) AS q
  FROM pat CROSS JOIN range({len(rules)}) AS x(i) JOIN par{k} ON r = i AND v = substr(s, i::INT + 1, 1) CROSS JOIN prior{k}
  GROUP BY s, c)"""

    rounds = ""
    for k in range(quality_rules.ROUNDS):
        rounds += f""",{posterior(k)},
tot{k} AS MATERIALIZED (SELECT sum(c * q) AS t, sum(c) AS n, {share} * sum(c) AS w FROM post{k}),
par{k + 1} AS MATERIALIZED (
  SELECT p.r, p.v, (coalesce(sum(c * q), 0) + any_value(w) * any_value(p.g)) / (any_value(t) + any_value(w)) AS g,
         (coalesce(sum(c * (1 - q)), 0) + any_value(w) * any_value(p.b)) / (any_value(n) - any_value(t) + any_value(w)) AS b
  FROM par0 p CROSS JOIN tot{k} LEFT JOIN post{k} ON substr(s, p.r + 1, 1) = p.v GROUP BY p.r, p.v),
prior{k + 1} AS MATERIALIZED (SELECT (t + 0.9 * w) / (n + w) AS prior FROM tot{k})"""
    last = quality_rules.ROUNDS
    return f"""
WITH words AS MATERIALIZED (
  SELECT row_number() OVER () AS u, doc_id, coalesce(text, '') AS t, {WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
  FROM documents),
win AS (SELECT u, i, w[i:i + 7] AS g FROM words, unnest(range(1, len(w) - 6)) AS r(i)),
again AS (SELECT u, i FROM win JOIN (SELECT u, g FROM win GROUP BY u, g HAVING count(*) > 1) USING (u, g)),
cover AS (SELECT u, sum(least(8, coalesce(nxt - i, 8))) AS n FROM (
            SELECT u, i, lead(i) OVER (PARTITION BY u ORDER BY i) AS nxt FROM again) GROUP BY u),
stat AS MATERIALIZED (
  SELECT u, doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper,
         length(t) - length(regexp_replace(t, '[!?]', '', 'g')) AS n_bangs
  FROM words LEFT JOIN cover USING (u)),
voted AS MATERIALIZED (SELECT *, {pattern} AS s FROM stat),
pat AS MATERIALIZED (SELECT s, count(*)::DOUBLE AS c FROM voted GROUP BY s),
par0 AS MATERIALIZED (SELECT * FROM (VALUES {start}) AS p(r, v, g, b)),
prior0 AS MATERIALIZED (SELECT 0.9::DOUBLE AS prior){rounds},{posterior(last)}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       (NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND q >= {quality_rules.MIN_POSTERIOR}) AS kept
FROM voted JOIN post{last} USING (s)
"""


def near_duplicates() -> str:
    """Shared shingles are counted per pair; links are closed by recursion."""
    return r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE w[i:i + 4] END AS g
  FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i) WHERE len(w) > 0),
size AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sh a JOIN sh b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN size USING (doc_id) JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
"""


def substring_dedup(length: int = 13) -> str:
    """The smallest document of every window, and the words that later documents' windows cover."""
    return f"""
WITH words AS MATERIALIZED (SELECT doc_id, {WORDS} AS w FROM documents),
win AS MATERIALIZED (SELECT doc_id, i, w[i:i + {length - 1}] AS g FROM words, unnest(range(1, len(w) - {length - 2})) AS r(i)),
first AS (SELECT g, min(doc_id) AS d FROM win GROUP BY g),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, p FROM win JOIN first USING (g), unnest(range(i, i + {length})) AS r(p) WHERE d < doc_id),
word AS (SELECT doc_id, p, w[p] AS x FROM words, unnest(range(1, len(w) + 1)) AS r(p)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""


def contamination(size: int = 13) -> str:
    """All windows of the items joined to all runs of words of the same length."""
    return _contamination(size).replace(NEAR_PARTS, "").replace(", coalesce(n_near, 0)::BIGINT AS n_near", "").replace(
        " LEFT JOIN close USING (doc_id)", "")


NEAR_PARTS = """,
pos AS MATERIALIZED (SELECT doc_id, p, w[p] AS t FROM doc, unnest(range(1, len(w) + 1)) AS r(p)),
freq AS MATERIALIZED (SELECT t, count(*) AS c FROM pos GROUP BY t),
part AS (SELECT g, n, o, g[o] AS t FROM (SELECT DISTINCT g, n FROM win), unnest(range(1, n + 1)) AS r(o)),
rare AS (SELECT g, list_sort(list_distinct(list(t))) AS ts FROM (
    SELECT g, n, t, row_number() OVER (PARTITION BY g ORDER BY c, t, o) AS k, count(*) OVER (PARTITION BY g) AS known
    FROM part JOIN freq USING (t)) WHERE k <= 3 AND known >= least(n, 3) GROUP BY g),
look AS MATERIALIZED (SELECT DISTINCT ts, unnest(ts) AS t, len(ts) AS need FROM rare),
post AS MATERIALIZED (SELECT doc_id, ts, need, p, t FROM pos JOIN look USING (t)),
near AS (SELECT DISTINCT doc_id, ts FROM (SELECT a.doc_id, a.ts, a.p, a.t FROM post a JOIN post b
    ON a.doc_id = b.doc_id AND a.ts = b.ts AND b.p >= a.p AND b.p < a.p + 30 GROUP BY a.doc_id, a.ts, a.p, a.t, a.need
    HAVING count(DISTINCT b.t) = a.need)),
close AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM near JOIN rare USING (ts) JOIN win USING (g) GROUP BY doc_id)"""


def proximity(size: int = 13) -> str:
    """The same with n_near: the rarest words of each window, and the documents that hold them within
    30 words."""
    return _contamination(size)


def _contamination(size: int) -> str:
    cut = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
           r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""
WITH doc AS MATERIALIZED (SELECT doc_id, {cut} AS w FROM documents),
item AS (SELECT item_id::VARCHAR AS item_id, {cut} AS w FROM benchmark),
win AS MATERIALIZED (SELECT DISTINCT item_id, w[i:i + {size - 1}] AS g, least(len(w), {size}) AS n
  FROM item, unnest(range(1, greatest(len(w) - {size - 1}, 1) + 1)) AS r(i) WHERE len(w) > 0),
run AS (SELECT doc_id, i, n, w[i:i + n - 1] AS g FROM doc, (SELECT DISTINCT n FROM win), unnest(range(1, len(w) - n + 2)) AS r(i)),
hit AS MATERIALIZED (SELECT doc_id, i, n, item_id FROM run JOIN win USING (g, n)),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS r(p) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id){NEAR_PARTS}
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(n_near, 0)::BIGINT AS n_near
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN close USING (doc_id)
"""


def secrets() -> str:
    """Matches and the text between them give places; owners and repositories per value; spans joined per text."""
    kinds = [("assign", secret_scan.ASSIGN, 2), ("access", secret_scan.ACCESS, 0), ("hex", secret_scan.HEX, 0),
             ("other", secret_scan.OTHER, 0)]
    parts = " UNION ALL ".join(f"""
  SELECT u, {k} AS k, regexp_extract_all(t, {_text(p)}, 0) AS m, regexp_extract_all(t, {_text(p)}, {g}) AS v,
         string_split_regex(t, {_text(p)}) AS gap FROM doc WHERE regexp_matches(t, {_text(p)})"""
                               for k, (_, p, g) in enumerate(kinds))
    n = [f"count(*) FILTER (WHERE k = {i})" for i in range(3)]
    return f"""
WITH doc AS MATERIALIZED (SELECT row_number() OVER () AS u, doc_id, coalesce(source, '') AS owner,
  coalesce(doc_id::VARCHAR, '') AS repo, coalesce(text, '') AS t FROM documents),
found AS ({parts}),
one AS (SELECT u, k, m[i] AS m, v[i] AS v,
          list_sum(list_transform(gap[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s
        FROM found, unnest(range(1, len(m) + 1)) AS r(i)),
cand AS MATERIALIZED (SELECT u, k, v, s, s + length(m) AS e FROM one JOIN doc USING (u)
  WHERE (k = 0 AND length(v) >= 6) OR k IN (1, 2) OR (k = 3 AND (NOT regexp_matches(v, {_text(secret_scan.MIXED_ONLY)})
        OR (regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[0-9]'))
        OR regexp_matches(v, {_text(secret_scan.VENDOR_INSIDE)})
        OR (regexp_matches(v, {_text(secret_scan.VENDOR_FIRST)}) AND (s = 0 OR NOT regexp_matches(substr(t, s::INT, 1), '[A-Za-z0-9]')))))),
own AS (SELECT v, count(DISTINCT owner) <= {secret_scan.MAX_OWNERS} AND count(DISTINCT repo) <= {secret_scan.MAX_REPOS} AS live
        FROM cand JOIN doc USING (u) GROUP BY v),
told AS (SELECT u, k, s, e, live,
           {_text(secret_scan.KINDS)}[k + 1] || ':' || s::BIGINT || ':' || e::BIGINT AS span
         FROM cand JOIN own USING (v) WHERE k < 3 OR live),
per AS (SELECT u, {n[0]} AS a, {n[1]} AS b, {n[2]} AS c, string_agg(span, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS base,
          string_agg(span, ',' ORDER BY s, k) AS spans, count(*) FILTER (WHERE live) AS n_live,
          count(*) FILTER (WHERE NOT live) AS n_copied FROM told GROUP BY u)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live,
       coalesce(n_copied, 0)::BIGINT AS n_copied
FROM doc LEFT JOIN per USING (u)
"""


def _text(x) -> str:
    if isinstance(x, list):
        return "[" + ", ".join(_text(y) for y in x) + "]"
    return "'" + x.replace("'", "''") + "'"
