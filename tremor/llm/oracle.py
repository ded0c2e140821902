"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH RECURSIVE parts AS (
  SELECT page_id, url, html,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages
), judged AS (
  SELECT page_id, url, html,
         coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1), '') AS path
  FROM parts
), rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), nodes AS (
  SELECT DISTINCT host, path, lower(split_part(url, '://', 1)) || '://' || host
         || regexp_extract(url, '^[^:]*://[^/?#]*([^#]*)', 1) AS node
  FROM judged WHERE contains(url, '://')
), links AS (
  SELECT DISTINCT lower(split_part(url, '://', 1)) || '://' || host
         || regexp_extract(url, '^[^:]*://[^/?#]*([^#]*)', 1) AS a,
         regexp_replace(regexp_extract(html,
           '(?i)<link rel="canonical" href="([a-z]+://[^"]*)"', 1), '#.*$', '') AS b
  FROM judged
  WHERE contains(url, '://') AND regexp_matches(html, '(?i)<link rel="canonical" href="[a-z]+://')
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(a, b) AS (
  SELECT a, b FROM both_ways UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a
), fit AS (
  SELECT host, path, arg_max({'rule': rhost || rpath, 'verdict': verdict},
                             length(rhost || rpath)) AS r
  FROM (SELECT DISTINCT host, path FROM nodes), rules
  WHERE (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY ALL
), alias AS (
  SELECT reach.a AS node, CASE WHEN bool_or(r.verdict = 'allow') THEN 'allow' ELSE 'block' END AS v
  FROM reach JOIN nodes ON nodes.node = reach.b JOIN fit USING (host, path) GROUP BY 1
)
SELECT page_id, host, path, r.rule AS rule, coalesce(r.verdict, v, 'allow') AS verdict,
       CASE WHEN r IS NOT NULL THEN 'rule' WHEN v IS NOT NULL THEN 'alias' ELSE 'default' END AS reason
FROM judged LEFT JOIN fit USING (host, path)
LEFT JOIN alias ON alias.node = lower(split_part(url, '://', 1)) || '://' || host
  || regexp_extract(url, '^[^:]*://[^/?#]*([^#]*)', 1)
"""

_WORDS = (r"list_filter(string_split_regex(translate(coalesce(text, ''), "
          r"'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')")

OP10 = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row, {_WORDS} AS w FROM documents),
items AS (SELECT DISTINCT item_id, {_WORDS} AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s : s + 12], ' ') AS win
  FROM items, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(s) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM wins),
runs AS (
  SELECT row, n, s, array_to_string(w[s : s + n - 1], ' ') AS win
  FROM docs, sizes, unnest(range(1, len(w) - n + 2)) AS t(s)
), hits AS (SELECT row, s, n, item_id FROM runs JOIN wins USING (n, win)),
per AS (
  SELECT row, count(DISTINCT place) AS n_hit
  FROM (SELECT DISTINCT row, s, n FROM hits), unnest(range(s, s + n)) AS t(place) GROUP BY row
), named AS (
  SELECT row, count(DISTINCT item_id) AS n_items,
         sha256(string_agg(DISTINCT item_id::varchar, ',' ORDER BY item_id::varchar)) AS sha
  FROM hits GROUP BY row
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(sha, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN per USING (row) LEFT JOIN named USING (row)
"""

OP8 = r"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::UBIGINT, 1, 1, 1, 1, 1, 1, 1, 1],
      lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS c
    FROM range(256) AS r(i))
), rows AS (
  SELECT doc_id, source, coalesce(strlen(text), 0) + 1 AS size,
         md5('17:' || coalesce(doc_id::varchar, '')) AS mix,
         CASE WHEN coalesce(text, '') = '' THEN 0 ELSE xor(4294967295::UBIGINT, list_reduce(
           list_concat([4294967295::UBIGINT], list_transform(
             range(strlen(text)), lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::UBIGINT)),
           lambda c, b: xor(c // 256, t[(xor(c % 256, b) + 1)::BIGINT]))) END AS crc
  FROM documents, crc_table
), ranked AS (
  SELECT *, (2 * (row_number() OVER (PARTITION BY source ORDER BY mix, doc_id, crc, size) - 1) + 1)
            / (2 * count(*) OVER (PARTITION BY source))::DOUBLE AS fraction
  FROM rows
), placed AS (
  SELECT *, row_number() OVER (ORDER BY fraction, source) - 1 AS pos, count(*) OVER () AS total
  FROM ranked
), cut AS (SELECT *, pos * 8 // total AS shard FROM placed)
SELECT doc_id, size, crc::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard,
       pos - (shard * total + 7) // 8 AS slot, NULL::INTEGER AS grown_shard, source
FROM cut
"""


_CRC_TABLE = """crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::UBIGINT, 1, 1, 1, 1, 1, 1, 1, 1],
      lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END) AS c
    FROM range(256) AS r(i))
)"""


def _crc32(text: str) -> str:
    """CRC-32 of a short, non-empty ASCII text, with ``crc_table`` in the FROM clause."""
    return (f"xor(4294967295::UBIGINT, list_reduce(list_concat([4294967295::UBIGINT], list_transform("
            f"string_split({text}, ''), lambda c: ascii(c)::UBIGINT)), "
            f"lambda c, b: xor(c // 256, t[(xor(c % 256, b) + 1)::BIGINT])))")


OP11 = f"""
WITH RECURSIVE {_CRC_TABLE}, keyed AS (
  SELECT *, {_crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 AS kind
  FROM conversations, crc_table
), damaged AS (
  SELECT coalesce(conv_id::varchar, ' ') AS conv, turn,
         CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '')
              ELSE coalesce(text, ' ') END AS text
  FROM keyed, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS u(k)
), placed AS (
  SELECT *, substr(role, 1, 1) AS init,
         row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
  FROM damaged
), faults AS (
  SELECT *, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last_char,
         row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again,
         lag(init) OVER (PARTITION BY conv ORDER BY i) AS before
  FROM placed
), rows AS (
  SELECT *, CASE WHEN last_char = '' THEN 'blank' WHEN again THEN 'duplicate'
                 WHEN last_char NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM faults
), sums AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || init NOT IN ('su', 'ua', 'au')) AS illegal,
         count(*) AS n
  FROM rows GROUP BY conv
), inserts(q, q2, c, s) AS (
  VALUES (0, 0, 0, ''), (0, 2, 2, 'I'), (0, 3, 4, 'II'), (1, 1, 0, ''), (1, 2, 2, 'I'), (1, 3, 4, 'II'),
         (2, 2, 0, ''), (2, 3, 2, 'I'), (3, 3, 0, ''), (3, 2, 2, 'I')
), edits(init, q, q2, c, s) AS (
  SELECT NULL::VARCHAR, q, q, 3, 'D' FROM range(4) AS r(q)
  UNION ALL SELECT NULL, q, CASE q WHEN 2 THEN 3 ELSE 2 END, 2, 'R' FROM range(4) AS r(q)
  UNION ALL VALUES ('s', 0, 1, 0, 'K'), ('u', 0, 2, 0, 'K'), ('u', 1, 2, 0, 'K'), ('u', 3, 2, 0, 'K'),
                   ('a', 2, 3, 0, 'K')
), best AS (
  SELECT conv, 0::BIGINT AS i, 0::BIGINT AS q, {{'c': 0::BIGINT, 's': ''}} AS b FROM sums
  UNION ALL
  SELECT best.conv, rows.i, e.q2::BIGINT,
         min({{'c': (b.c + x.c + e.c + CASE WHEN e.s <> 'D' AND fault = 'truncated' THEN 1 ELSE 0 END)::BIGINT,
               's': b.s || x.s || e.s}})
  FROM best JOIN rows ON rows.conv = best.conv AND rows.i = best.i + 1
  JOIN inserts x ON x.q = best.q
  JOIN edits e ON e.q = x.q2 AND (e.s = 'D' OR fault NOT IN ('blank', 'duplicate')
                                  AND (e.s = 'R' OR e.init = rows.init))
  GROUP BY best.conv, rows.i, e.q2
), solved AS (
  SELECT best.conv, min({{'c': b.c + x.c, 's': b.s || x.s}}) AS b
  FROM best JOIN sums ON sums.conv = best.conv AND best.i = sums.n
  JOIN inserts x ON x.q = best.q AND x.q2 IN (0, 3)
  GROUP BY best.conv
), steps AS (
  SELECT conv, p, b.s[p] AS e, length(replace(b.s[1 : p], 'I', '')) AS i
  FROM solved, unnest(range(1, length(b.s) + 1)) AS t(p)
), kept AS (
  SELECT steps.conv, p, e, role, CASE WHEN e = 'I' THEN '' ELSE text END AS text, init,
         row_number() OVER (PARTITION BY steps.conv ORDER BY p) AS j
  FROM steps LEFT JOIN rows ON rows.conv = steps.conv AND rows.i = steps.i WHERE e <> 'D'
), leads AS (
  SELECT *, first_value(CASE WHEN e = 'K' AND init = 's' THEN 1 ELSE 0 END)
              OVER (PARTITION BY conv ORDER BY j) AS lead
  FROM kept
), mended AS (
  SELECT conv, sha256(string_agg(
    CASE WHEN e = 'K' THEN role WHEN (j - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
    chr(10) ORDER BY j)) AS sha
  FROM leads GROUP BY conv
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(solved.b.c, 0) AS cost, coalesce(solved.b.s, '') AS audit,
       coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN sums ON sums.conv = coalesce(o.conv_id::varchar, ' ')
LEFT JOIN solved ON solved.conv = coalesce(o.conv_id::varchar, ' ')
LEFT JOIN mended ON mended.conv = coalesce(o.conv_id::varchar, ' ')
"""


def _coded(value: str) -> str:
    return f"coalesce(strlen({value})::varchar || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_coded(c) for c in (
        "doc_id::varchar", "source", "lang", f"({n_chars})::varchar", "text")) + ")"


_HALVED = ("list_transform(range(0, (len(h) + 1) // 2), "
           "lambda i: sha256(h[2 * i + 1] || coalesce(h[2 * i + 2], '')))")

OP12 = f"""
WITH RECURSIVE {_CRC_TABLE}, leaves AS (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
         CASE WHEN {_crc32("doc_id::varchar")} % 7 = 0 THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS start
  FROM documents, crc_table
), ranked AS (
  SELECT *, row_number() OVER () AS id,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r
  FROM leaves
), levels AS (
  SELECT lang, 0 AS lv, list(leaf ORDER BY r) AS h FROM ranked GROUP BY lang
  UNION ALL SELECT lang, lv + 1, {_HALVED} FROM levels WHERE len(h) > 1
), subroots AS (
  SELECT lang, h[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r
  FROM levels WHERE len(h) = 1
), tops AS (
  SELECT 0 AS lv, list(subroot ORDER BY r) AS h FROM subroots
  UNION ALL SELECT lv + 1, {_HALVED} FROM tops WHERE len(h) > 1
), paths AS (
  SELECT id, lv, h[xor(ranked.r >> lv, 1) + 1] AS sibling, (ranked.r >> lv) % 2 = 1 AS lft
  FROM ranked JOIN levels ON levels.lang IS NOT DISTINCT FROM ranked.lang AND len(h) > 1
  UNION ALL
  SELECT id, 1000 + lv, h[xor(subroots.r >> lv, 1) + 1], (subroots.r >> lv) % 2 = 1
  FROM ranked JOIN subroots ON subroots.lang IS NOT DISTINCT FROM ranked.lang JOIN tops ON len(h) > 1
), folded AS (
  SELECT id, sha256(coalesce(string_agg(sibling, '' ORDER BY lv), '')) AS proof,
         list({{'h': sibling, 'lft': lft}} ORDER BY lv) AS path
  FROM paths GROUP BY id
), result AS (
  SELECT doc_id, leaf, subroot, (SELECT h[1] FROM tops WHERE len(h) = 1) AS root,
         coalesce(proof, sha256('')) AS proof_sha256,
         list_reduce(list_concat([{{'h': start, 'lft': false}}], coalesce(path, [])), lambda a, p:
           {{'h': sha256(CASE WHEN p.h IS NULL THEN a.h WHEN p.lft THEN p.h || a.h ELSE a.h || p.h END),
             'lft': false}}).h AS folded_root
  FROM ranked JOIN subroots ON subroots.lang IS NOT DISTINCT FROM ranked.lang LEFT JOIN folded USING (id)
)
SELECT *, folded_root = root AS verified FROM result
"""

ORACLE_SQL = {"op1_url_filter": OP1, "op8_sharding": OP8, "op10_decontamination": OP10,
              "op11_conversations": OP11, "op12_manifest": OP12}
