"""DuckDB SQL for the contract queries that SQL can express."""

from __future__ import annotations

LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANK = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP5 = r"""
WITH dw AS (SELECT doc_id, xx AS k, regexp_extract_all({dtext}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM (SELECT doc_id, coalesce(text, '') AS text, hash(text) AS xx FROM {docs})),
bw AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
              regexp_extract_all({btext}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
       FROM (SELECT item_id, coalesce(text, '') AS text FROM benchmark)),
sized AS (SELECT item_id, w, least(len(w), 10) AS size FROM bw WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS win
          FROM (SELECT item_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS p FROM sized)),
sizes AS (SELECT DISTINCT size FROM sized),
docwin AS (SELECT doc_id, k, size, p, array_to_string(w[p:p + size - 1], ' ') AS win
           FROM (SELECT doc_id, k, w, size, unnest(generate_series(1, len(w) - size + 1)) AS p
                 FROM dw, sizes WHERE len(w) >= size)),
hits AS (SELECT DISTINCT doc_id, k, p, d.size AS size, g.item_id
         FROM docwin d JOIN grams g ON d.size = g.size AND d.win = g.win),
pos AS (SELECT doc_id, k, count(DISTINCT q) AS n_hit
        FROM (SELECT doc_id, k, unnest(generate_series(p, p + size - 1)) AS q FROM hits) GROUP BY doc_id, k),
items AS (SELECT doc_id, k, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, k, item_id FROM hits) GROUP BY doc_id, k)
SELECT dw.doc_id, CAST(len(dw.w) AS BIGINT) AS n_words, coalesce(pos.n_hit, 0) AS n_hit,
       coalesce(items.n_items, 0) AS n_items, sha256(coalesce(items.ids, '')) AS items_sha256,
       coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos ON dw.doc_id = pos.doc_id AND dw.k IS NOT DISTINCT FROM pos.k
LEFT JOIN items ON dw.doc_id = items.doc_id AND dw.k IS NOT DISTINCT FROM items.k
""".replace("{dtext}", LOWERED.format("text")).replace("{btext}", LOWERED.format("text"))

OP6 = r"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES
  ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
p AS (SELECT page_id, row_number() OVER () AS rn,
             {host} AS host,
             regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
m AS (SELECT p.rn, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
             max_by(r.verdict, length(rule_host || rule_path)) AS verdict
      FROM p JOIN rules r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
      GROUP BY p.rn)
SELECT page_id, host, path, m.rule AS rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.rn = m.rn
""".replace("{host}", LOWERED.format("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')"))

OP7 = r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, source, text, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {docs}),
win AS (SELECT rn, p, array_to_string(w[p:p + 2], ' ') AS g
        FROM (SELECT rn, w, unnest(generate_series(1, len(w) - 2)) AS p FROM d WHERE len(w) >= 3)),
rep AS (SELECT rn, count(DISTINCT q) AS n FROM (
          SELECT rn, unnest(generate_series(p, p + 2)) AS q
          FROM (SELECT rn, p, count(*) OVER (PARTITION BY rn, g) AS c FROM win) WHERE c > 1) GROUP BY rn),
ln AS (SELECT rn, doc_id, source, text, unnest(string_split(t, chr(10))) AS raw FROM d),
dup AS (SELECT rn, count(*) - count(DISTINCT raw) AS n FROM ln
        WHERE trim(raw, {blank}) <> '' GROUP BY rn),
nl AS (SELECT DISTINCT rn, doc_id, source, text, lower(trim(raw, {blank})) AS line FROM ln
       WHERE trim(raw, {blank}) <> ''),
freq AS (SELECT source, line, count(DISTINCT text) AS docs, arg_min(text, doc_id) AS first_text
         FROM nl GROUP BY source, line),
often AS (SELECT source, line, first_text FROM freq WHERE docs > 10),
gone AS (SELECT nl.rn, sum(length(nl.line)) AS removed FROM nl JOIN often o
         ON nl.source IS NOT DISTINCT FROM o.source AND nl.line = o.line AND nl.text <> o.first_text GROUP BY nl.rn),
tot AS (SELECT rn, sum(length(line)) AS total FROM nl GROUP BY rn),
m AS (SELECT d.rn, d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             coalesce(gone.removed, 0) AS removed, coalesce(tot.total, 0) AS total
      FROM d LEFT JOIN dup USING (rn) LEFT JOIN rep USING (rn) LEFT JOIN gone USING (rn) LEFT JOIN tot USING (rn))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * removed <= 30 * total AS kept
FROM m
""".replace("{blank}", BLANK)

OP10 = r"""
WITH ln AS (SELECT doc_id, rn, i, raw, {key} AS key FROM (
              SELECT doc_id, rn, unnest(lines) AS raw, unnest(generate_series(1, len(lines))) AS i
              FROM (SELECT doc_id, row_number() OVER () AS rn, string_split(coalesce(text, ''), chr(10)) AS lines
                    FROM {docs}))),
rep AS (SELECT key, max(doc_id) AS last_doc FROM ln WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT ln.*, rep.key IS NOT NULL AND ln.doc_id <> rep.last_doc AS gone FROM ln LEFT JOIN rep USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rn
""".replace("{key}", LOWERED.format(f"trim(raw, {BLANK})"))

def crc_tables() -> str:
    """CTEs ``crc0`` .. ``crc8`` and ``crc``, the list of the 256 byte values' remainders.

    3988292384 is the reflected polynomial of CRC-32 (fixed value).
    """
    out = ["crc0 AS (SELECT i, i AS c FROM (SELECT unnest(generate_series(0, 255)) AS i))"]
    for k in range(8):
        out.append(f"crc{k + 1} AS (SELECT i, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END AS c "
                   f"FROM crc{k})")
    return ",\n".join([*out, "crc AS (SELECT list(c ORDER BY i) AS t FROM crc8)"])


def tree_levels(name: str, levels: int) -> str:
    """CTEs ``{name}1`` .. from ``{name}0`` (tree, i, n, h): a tree's nodes level by level, and
    ``{name}_s0`` ..: the texts left and right of a node in its run. A lone node stays as it is."""
    out = []
    run = "OVER (PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN"
    for k in range(levels):
        out.append(f"{name}_s{k} AS (SELECT tree, i, n, coalesce(string_agg(h, '') {run} UNBOUNDED PRECEDING AND 1 "
                   f"PRECEDING), '') AS l, coalesce(string_agg(h, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') "
                   f"AS r FROM {name}{k})")
        out.append(f"{name}{k + 1} AS (SELECT tree, i // 8 AS i, (any_value(n) + 7) // 8 AS n, CASE WHEN any_value(n) = 1 "
                   f"THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {name}{k} "
                   f"GROUP BY tree, i // 8)")
    return ",\n".join(out)


def folds(name: str, source: str, at: str, levels: int, tree: str) -> str:
    """CTEs ``{name}_f1`` ..: rows of ``source`` with proof ``p`` and folded digest ``f`` a level on."""
    out = []
    for k in range(levels):
        before = source if k == 0 else f"{name}_f{k}"
        out.append(f"{name}_f{k + 1} AS (SELECT d.* EXCLUDE (p, f), d.p || s.l || s.r AS p, CASE WHEN s.n = 1 THEN d.f "
                   f"ELSE sha256(s.l || d.f || s.r) END AS f FROM {before} d JOIN {name}_s{k} s "
                   f"ON s.tree = d.{tree} AND s.i = d.{at} // {8 ** k})")
    return ",\n".join(out)


def spelt(field: str) -> str:
    text = f"CAST({field} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


# Levels enough for 8**7 documents of a language and 8**3 languages.
DOC_LEVELS, LANG_LEVELS = 7, 3
OP11 = f"""
WITH {crc_tables()},
leafs AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree,
                 sha256({" || ".join(map(spelt, ("doc_id", "source", "lang", "n_chars", "text")))}) AS leaf,
                 sha256({" || ".join(map(spelt, ("doc_id", "source", "lang", "n_chars", LOWERED.format("text"))))}) AS low,
                 xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                     lambda x: CAST(ascii(x) AS BIGINT))), lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1])), 4294967295) AS crc
          FROM documents, crc),
docs AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id, leaf) - 1 AS i,
                count(*) OVER (PARTITION BY tree) AS n FROM leafs),
node0 AS (SELECT tree, i, n, leaf AS h FROM docs),
{tree_levels("node", DOC_LEVELS)},
top0 AS (SELECT '^' AS tree, tree AS lang_tree, row_number() OVER (ORDER BY tree) - 1 AS i,
                count(*) OVER () AS n, h FROM node{DOC_LEVELS}),
{tree_levels("top", LANG_LEVELS)},
start AS (SELECT d.doc_id, d.tree, d.leaf, d.i, '^' AS top, u.i AS place, u.h AS subroot, g.h AS root, '' AS p,
                 CASE WHEN d.crc % 3 = 0 THEN d.low ELSE d.leaf END AS f
          FROM docs d JOIN top0 u ON u.lang_tree = d.tree CROSS JOIN top{LANG_LEVELS} g),
{folds("node", "start", "i", DOC_LEVELS, "tree")},
{folds("top", f"node_f{DOC_LEVELS}", "place", LANG_LEVELS, "top")}
SELECT doc_id, leaf, subroot, root, sha256(p) AS proof_sha256, f AS folded_root, f = root AS verified
FROM top_f{LANG_LEVELS}
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS rn, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({text}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
           FROM (SELECT lang, source, coalesce(text, '') AS text FROM documents)),
tok AS (SELECT rn, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM tok GROUP BY lang, term HAVING count(DISTINCT rn) >= 30),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT lang, source, term, count(*) AS c FROM tok JOIN kept USING (lang, term) GROUP BY lang, source, term),
every AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c
          FROM grp g JOIN kept k ON g.lang = k.lang
          LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
tot AS (SELECT lang, source, sum(c) AS n FROM every GROUP BY lang, source),
p AS (SELECT e.lang, e.source, e.term, e.c, CAST(1 + (1000000000 * CAST(e.c + 5 AS HUGEINT)) // (t.n + 5 * s.v) AS BIGINT) AS p
      FROM every e JOIN tot t ON e.lang = t.lang AND e.source = t.source JOIN size s ON s.lang = e.lang),
q AS (SELECT lang, term, CAST(1 + (1000000000 * CAST(c + 5 AS HUGEINT)) // (n + 5 * v) AS BIGINT) AS q
      FROM (SELECT lang, term, sum(c) AS c FROM cnt GROUP BY lang, term)
      JOIN (SELECT lang, sum(c) AS n FROM cnt GROUP BY lang) USING (lang) JOIN size USING (lang)),
dist AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(dist.value, 0) AS value
         FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN dist ON dist.lang = a.lang AND dist.source = a.source AND dist.item = b.source),
part AS (SELECT lang, source, 'pair' AS part, item, value FROM pair
         UNION ALL SELECT p.lang, p.source, 'term', p.term, p.p - q.q
         FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.c > 0 AND p.p > q.q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
           FROM part)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
""".replace("{text}", LOWERED.format("text"))

ORACLE: dict[str, str] = {
    "op5_decontaminate": OP5.replace("{docs}", "documents"),
    "op6_url_filters": OP6,
    "op7_quality_rules": OP7.replace("{docs}", "documents"),
    "op10_line_dedup": OP10.replace("{docs}", "documents"),
    "op11_merkle_manifest": OP11,
    "op12_source_divergence": OP12,
}
