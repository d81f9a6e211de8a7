"""DuckDB SQL for the divergence audit, the Merkle manifest and line removal."""

from __future__ import annotations

from tidemark.llm import divergence, line_dedup, manifest

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def divergences() -> str:
    """Counts of every group for every kept term, p and q as HUGEINT quotients, pairs by a join on the term."""
    scale, prior = divergence.SCALE, divergence.PRIOR
    return rf"""
WITH doc AS MATERIALIZED (SELECT row_number() OVER () AS u, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
tok AS MATERIALIZED (SELECT u, lang, source, t, count(*) AS n FROM (SELECT u, lang, source, unnest(w) AS t FROM doc) GROUP BY ALL),
kept AS MATERIALIZED (SELECT lang, t, sum(n) AS n FROM tok GROUP BY lang, t HAVING count(*) >= {divergence.MIN_DOCS}),
grp AS (SELECT DISTINCT lang, source FROM doc),
cnt AS MATERIALIZED (SELECT g.lang, g.source, k.t, k.n AS all_n, coalesce(c.n, 0) AS n FROM grp g JOIN kept k USING (lang)
  LEFT JOIN (SELECT lang, source, t, sum(n) AS n FROM tok GROUP BY ALL) c USING (lang, source, t)),
val AS MATERIALIZED (SELECT lang, source, t, n,
    1 + ({scale}::HUGEINT * (n + {prior})) // (sum(n) OVER g + {prior} * count(*) OVER g) AS p,
    1 + ({scale}::HUGEINT * (all_n + {prior})) // (sum(all_n) OVER g + {prior} * count(*) OVER g) AS q
  FROM cnt WINDOW g AS (PARTITION BY lang, source)),
gap AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM val a JOIN val b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gap ON gap.lang = a.lang AND gap.source = a.source AND gap.item = b.source),
term AS (SELECT lang, source, 'term' AS part, t AS item, p - q AS value FROM val WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)
QUALIFY part = 'pair' OR rank <= {divergence.TOP}
"""


def _tree(name: str, source: str, part: str, depth: int) -> str:
    """Nodes of `source` (part, i, h) level by level up to `depth`: {name}(part, l, i, h); a level is
    made only while the one below has several nodes."""
    out = f"{name}0 AS MATERIALIZED (SELECT {part} AS part, 0 AS l, i, h FROM {source})"
    for k in range(1, depth + 1):
        out += f""",
{name}{k} AS MATERIALIZED (SELECT part, {k} AS l, i // {manifest.FANOUT} AS i, sha256(string_agg(h, '' ORDER BY i)) AS h
  FROM {name}{k - 1} JOIN (SELECT part FROM {name}{k - 1} GROUP BY part HAVING count(*) > 1) USING (part) GROUP BY part, i // {manifest.FANOUT})"""
    return out + f",\n{name} AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM {name}{k}" for k in range(depth + 1)) + ")"


def merkle(depth: int = 8, upper: int = 3) -> str:
    """Trees of up to 8**depth leaves a language and 8**upper languages, with one step a level."""
    def field(c: str) -> str:
        return f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"

    fan = manifest.FANOUT

    def siblings(tree: str, alias: str) -> str:
        return f"""
{alias} AS MATERIALIZED (SELECT a.part, a.l, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i < a.i), '') AS before,
    coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (WHERE b.i > a.i), '') AS after
  FROM {tree} a JOIN {tree} t ON t.part = a.part AND t.l = a.l + 1 AND t.i = a.i // {fan}
  JOIN {tree} b ON b.part = a.part AND b.l = a.l AND b.i // {fan} = a.i // {fan} GROUP BY a.part, a.l, a.i)"""

    steps, last = "", "way0"
    for k in range(depth + upper):
        side, l, i = ("low", k, "i") if k < depth else ("high", k - depth, "g")
        part = "w.g" if k < depth else "0"
        at = f"w.{i} // {fan ** l}"
        node = "s.l IS NULL"
        steps += f""",
way{k + 1} AS (SELECT w.u, w.g, w.i, w.proof || coalesce(s.before || s.after, '') AS proof,
  CASE WHEN {node} THEN w.node ELSE sha256(s.before || w.node || s.after) END AS node
  FROM {last} w LEFT JOIN {side}_sib s ON s.part = {part} AND s.l = {l} AND s.i = {at})"""
        last = f"way{k + 1}"
    return f"""
WITH table256 AS (
  SELECT list(v ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(0, 8)),
                          lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS v
    FROM range(0, 256) r(b))),
raw AS MATERIALIZED (
  SELECT row_number() OVER () AS u, doc_id, lang, {leaf("text")} AS leaf, {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} AS other,
    CASE WHEN doc_id IS NULL THEN 1 ELSE xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT)),
      lambda x, y: xor(x // 256, t[(xor(x, y) % 256) + 1]))) END AS crc
  FROM documents, table256),
leaf AS MATERIALIZED (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM raw),
leaves AS (SELECT g, i, leaf AS h FROM leaf),
{_tree("low", "leaves", "g", depth)},
tops AS MATERIALIZED (SELECT part AS i, arg_max(h, l) AS h FROM low GROUP BY part),
{_tree("high", "tops", "0", upper)},
top AS (SELECT arg_max(h, l) AS root FROM high),
{siblings("low", "low_sib")},{siblings("high", "high_sib")},
way0 AS (SELECT u, g, i, '' AS proof, CASE WHEN crc % 3 = 0 THEN other ELSE leaf END AS node FROM leaf){steps}
SELECT doc_id, leaf, tops.h AS subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM leaf JOIN {last} w USING (u) JOIN tops ON tops.i = leaf.g CROSS JOIN top
"""


def line_dedup_sql() -> str:
    """First documents of all keys, and the lines that later documents lose."""
    return rf"""
WITH doc AS MATERIALIZED (SELECT row_number() OVER () AS u, doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
line AS MATERIALIZED (SELECT u, doc_id, p, x[p] AS s,
  translate(regexp_replace(x[p], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS k FROM doc, unnest(range(1, len(x) + 1)) AS r(p)),
first AS (SELECT k, min(doc_id) AS d FROM line WHERE length(k) >= {line_dedup.LEAST} GROUP BY k),
told AS (SELECT u, p, s, coalesce(doc_id > d, false) AS gone FROM line LEFT JOIN first USING (k)),
kept AS (SELECT u, count(*) FILTER (WHERE gone) AS n, string_agg(s, chr(10) ORDER BY p) FILTER (WHERE NOT gone) AS t FROM told GROUP BY u)
SELECT doc_id, len(x)::BIGINT AS n_lines, n::BIGINT AS n_dropped, sha256(coalesce(t, '')) AS kept_sha256 FROM doc JOIN kept USING (u)
"""
