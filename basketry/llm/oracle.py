"""DuckDB SQL of the text queries that SQL can express, written apart from the operators."""

from __future__ import annotations

SQL: dict[str, str] = {}

#: Words are maximal runs without the six ASCII white-space characters.
_SPACES = r"[\x20\x09-\x0D]+"

SQL["op6_quality_rules"] = rf"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         [x FOR x IN regexp_split_to_array(coalesce(text, ''), '{_SPACES}') IF x <> ''] AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS k FROM twice) GROUP BY doc_id
), m AS (
  SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words,
         coalesce(list_sum([length(x) FOR x IN w]), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep ON d.doc_id = rep.doc_id
), v AS (
  SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
         (1000 * n_symbols) // greatest(n_words, 1) AS symbols,
         (1000 * n_dup_lines) // greatest(n_lines, 1) AS dup_lines,
         (100 * word_chars) // greatest(n_words, 1) AS long_words
  FROM m
), u AS (
  SELECT lang, source, unnest(['symbols', 'dup_lines', 'long_words']) AS measure,
         unnest([symbols, dup_lines, long_words]) AS x
  FROM v WHERE NOT base_failed
), b AS (
  SELECT lang, source, measure,
         (x // (1 << greatest(length(bin(x)) - 6, 0))::BIGINT) * (1 << greatest(length(bin(x)) - 6, 0))::BIGINT AS bucket, count(*) AS n
  FROM u GROUP BY ALL
), s AS (
  SELECT 0 AS level, lang, source, measure, bucket, sum(n) AS n FROM b GROUP BY lang, source, measure, bucket
  UNION ALL SELECT 1, lang, NULL, measure, bucket, sum(n) FROM b GROUP BY lang, measure, bucket
  UNION ALL SELECT 2, NULL, NULL, measure, bucket, sum(n) FROM b GROUP BY measure, bucket
), r AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bucket) AS seen,
         sum(n) OVER (PARTITION BY level, lang, source, measure) AS total
  FROM s
), q AS (
  SELECT level, lang, source, measure, max(total) AS total,
         min(bucket) FILTER (WHERE seen * 100 >= total * 25) AS low,
         min(bucket) FILTER (WHERE seen * 100 >= total * 75) AS high
  FROM r GROUP BY level, lang, source, measure
), f AS (
  SELECT g.lang, g.source, g.measure,
         CASE WHEN g.total >= 50 THEN g.high + 3 * (g.high - g.low)
              WHEN l.total >= 50 THEN l.high + 3 * (l.high - l.low)
              ELSE e.high + 3 * (e.high - e.low) END AS fence
  FROM q g
  JOIN q l ON l.level = 1 AND l.lang IS NOT DISTINCT FROM g.lang AND l.measure = g.measure
  JOIN q e ON e.level = 2 AND e.measure = g.measure
  WHERE g.level = 0
), w AS (
  -- A bound takes in the whole bucket that its fence lies in.
  SELECT lang, source, measure, (fence // width + 1) * width - 1 AS fence
  FROM (SELECT *, (1 << greatest(length(bin(fence::BIGINT)) - 6, 0))::BIGINT AS width FROM f)
), bound AS (
  SELECT lang, source,
         max(greatest(fence, 250)) FILTER (WHERE measure = 'symbols') AS b_symbols,
         max(greatest(fence, 350)) FILTER (WHERE measure = 'dup_lines') AS b_lines,
         max(greatest(fence, 1800)) FILTER (WHERE measure = 'long_words') AS b_long
  FROM w GROUP BY lang, source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND symbols <= b_symbols AND dup_lines <= b_lines AND long_words <= b_long, false) AS kept
FROM v LEFT JOIN bound ON v.lang IS NOT DISTINCT FROM bound.lang AND v.source IS NOT DISTINCT FROM bound.source
"""

SQL["op8_chat_formatting"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), f AS (
  SELECT *, (contains(text, '<|im_start|>') OR contains(text, '<|im_end|>') OR contains(role, '<|im_start|>')
             OR contains(role, '<|im_end|>') OR contains(role, chr(10)) OR suffix(role, ' %')) AS marked
  FROM c
), w AS (
  SELECT *, CASE WHEN marked
    THEN length(role) + 2 * (length(role) - length(replace(replace(replace(role, '%', ''), '<', ''), chr(10), ''))) + 2
         + length(text) + 2 * (length(text) - length(replace(replace(text, '%', ''), '<', '')))
    ELSE length(role) + length(text) END + 24 AS chars
  FROM f
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars, true AS round_trip
FROM w GROUP BY conv_id
"""

SQL["op5_benchmark_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), it AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM it WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, dw.n, i, item_id FROM dw JOIN iw ON dw.g = iw.g AND dw.n = iw.n
), covered AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered ON d.doc_id = covered.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""

#: Levels of a tree are steps of a recursion; a proof is folded along its list of siblings.
SQL["op11_merkle_manifest"] = r"""
WITH RECURSIVE fields AS (
  -- Unsigned crc32 of the decimal doc_id, bit by bit: each byte is followed by seven steps without input.
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
           lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))), 4294967295::BIGINT) AS crc
  FROM documents
), hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(claimed) || ':' || claimed, '-')) AS other
  FROM (SELECT *, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS claimed,
               coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
        FROM fields)
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY source) AS n
  FROM hashed
), nodes(level, source, p, n, h) AS (
  SELECT 0, source, p, n, leaf FROM leaves
  UNION ALL
  SELECT level + 1, source, p // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY p))
  FROM nodes WHERE n > 1 GROUP BY level, source, p // 3, n
), subroots AS (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS p, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops(level, p, n, h) AS (
  SELECT 0, p, n, h FROM subroots
  UNION ALL
  SELECT level + 1, p // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY p)) FROM tops WHERE n > 1 GROUP BY level, p // 3, n
), runs AS (
  SELECT level, source, p // 3 AS run, list(h ORDER BY p) AS hs FROM nodes WHERE n > 1 GROUP BY ALL
), top_runs AS (
  SELECT level, p // 3 AS run, list(h ORDER BY p) AS hs FROM tops WHERE n > 1 GROUP BY ALL
), steps AS (
  SELECT l.source, l.p, r.level, r.hs, (l.p // power(3, r.level)::BIGINT) % 3 AS place
  FROM leaves l JOIN runs r ON r.source IS NOT DISTINCT FROM l.source AND r.run = l.p // power(3, r.level + 1)::BIGINT
  UNION ALL
  SELECT l.source, l.p, 1000 + r.level, r.hs, (s.p // power(3, r.level)::BIGINT) % 3 AS place
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
  JOIN top_runs r ON r.run = s.p // power(3, r.level + 1)::BIGINT
), paths AS (
  SELECT source, p, list({'l': array_to_string(hs[1:place], ''), 'r': array_to_string(hs[place + 2:], '')} ORDER BY level) AS path
  FROM steps GROUP BY source, p
), folded AS (
  SELECT l.doc_id, l.source, l.leaf, s.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root,
         sha256(array_to_string(list_transform(coalesce(path, []), lambda x: x.l || x.r), '')) AS proof_sha256,
         list_reduce(list_prepend({'l': l.other, 'r': ''}, coalesce(path, [])), lambda a, x: {'l': sha256(x.l || a.l || x.r), 'r': ''}).l AS folded_root
  FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
  LEFT JOIN paths ON paths.source IS NOT DISTINCT FROM l.source AND paths.p = l.p
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified, source FROM folded
"""

#: A recursion over rows with one column for each place in ``(s?(ua)+)?`` instead of stacks.
SQL["op13_conversation_repair"] = r"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(conv_id::VARCHAR, ' ') AS key, coalesce(role, ' ') AS role0, coalesce(text, ' ') AS text0,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
), kinds AS (
  -- Unsigned crc32, bit by bit: each byte is followed by seven steps without input.
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(name, ''),
           lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
           lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))), 4294967295::BIGINT) % 20 AS kind
  FROM given
), damaged AS (
  SELECT key, turn, role0, text0, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy,
         CASE WHEN kind = 4 THEN 'user' ELSE role0 END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text0, '[.!?]', '', 'g') ELSE text0 END AS text
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role0, md5(text0), copy) AS i, left(role, 1) AS who
  FROM damaged
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated'
                 ELSE '' END AS fault,
         lag(who) OVER (PARTITION BY key ORDER BY i) || who AS pair
  FROM placed
), counts AS (
  SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY key
), best AS (
  -- Cheapest (cost, audit) after i rows at each place of (s?(ua)+)?: nothing yet (z), after s (h), after the first u
  -- (f), after an a (t), after a later u (l). Inserts before the next row are taken first (the o columns).
  SELECT key, 0::BIGINT AS i, n, {'c': 0::BIGINT, 'a': ''} AS z, {'c': 1000000000::BIGINT, 'a': ''} AS h, {'c': 1000000000::BIGINT, 'a': ''} AS f,
         {'c': 1000000000::BIGINT, 'a': ''} AS t, {'c': 1000000000::BIGINT, 'a': ''} AS l
  FROM counts
  UNION ALL
  SELECT key, i, n,
         {'c': oz.c + 3, 'a': oz.a || 'D'},
         list_min([{'c': oh.c + 3, 'a': oh.a || 'D'}, {'c': oz.c + CASE WHEN stays AND who = 's' THEN x ELSE 1000000000 END, 'a': oz.a || 'K'}]),
         list_min([{'c': og.c + 3, 'a': og.a || 'D'}, {'c': oz.c + cu, 'a': oz.a || eu}, {'c': oh.c + cu, 'a': oh.a || eu}]),
         list_min([{'c': ot.c + 3, 'a': ot.a || 'D'}, {'c': og.c + ca, 'a': og.a || ea}, {'c': ol.c + ca, 'a': ol.a || ea}]),
         list_min([{'c': ol.c + 3, 'a': ol.a || 'D'}, {'c': ot.c + cu, 'a': ot.a || eu}])
  FROM (
    SELECT *, list_min([l, {'c': ot.c + 2, 'a': ot.a || 'I'}]) AS ol
    FROM (
      SELECT *, list_min([t, {'c': og.c + 2, 'a': og.a || 'I'}, {'c': l.c + 2, 'a': l.a || 'I'}]) AS ot
      FROM (
        SELECT b.key, r.i, b.n, b.z AS oz, b.h AS oh, b.t, b.l, r.who, r.fault NOT IN ('blank', 'duplicate') AS stays,
               (r.fault = 'truncated')::INT AS x,
               CASE WHEN r.fault IN ('blank', 'duplicate') THEN 1000000000 ELSE (r.fault = 'truncated')::INT + CASE WHEN r.who = 'u' THEN 0 ELSE 2 END END AS cu,
               CASE WHEN r.fault IN ('blank', 'duplicate') THEN 1000000000 ELSE (r.fault = 'truncated')::INT + CASE WHEN r.who = 'a' THEN 0 ELSE 2 END END AS ca,
               CASE WHEN r.who = 'u' THEN 'K' ELSE 'R' END AS eu, CASE WHEN r.who = 'a' THEN 'K' ELSE 'R' END AS ea,
               list_min([b.f, {'c': b.z.c + 2, 'a': b.z.a || 'I'}, {'c': b.h.c + 2, 'a': b.h.a || 'I'}]) AS og
        FROM best b JOIN judged r ON r.key = b.key AND r.i = b.i + 1
      )
    )
  )
), ended AS (
  SELECT key, list_min([z, t, {'c': l.c + 2, 'a': l.a || 'I'}, {'c': f.c + 2, 'a': f.a || 'I'}, {'c': h.c + 4, 'a': h.a || 'II'}]) AS won
  FROM best WHERE i = n
), letters AS (
  SELECT key, k, won.a[k] AS e, count(*) FILTER (won.a[k] <> 'I') OVER (PARTITION BY key ORDER BY k) AS i
  FROM (SELECT key, won, unnest(range(1, len(won.a) + 1)) AS k FROM ended)
), turns AS (
  SELECT l.key, l.e, j.role, j.who, j.text, row_number() OVER (PARTITION BY l.key ORDER BY l.k) AS o
  FROM letters l LEFT JOIN judged j ON j.key = l.key AND j.i = l.i AND l.e <> 'I' WHERE l.e <> 'D'
), named AS (
  SELECT key, o, CASE WHEN e = 'K' THEN role WHEN (o - headed) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END AS line
  FROM (SELECT *, max(CASE WHEN o = 1 AND e = 'K' AND who = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY key) AS headed FROM turns)
), repaired AS (
  SELECT key, string_agg(line, chr(10) ORDER BY o) AS whole FROM named GROUP BY key
)
SELECT g.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(won.c, 0) AS cost, coalesce(won.a, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, key FROM given) g LEFT JOIN counts USING (key) LEFT JOIN ended USING (key) LEFT JOIN repaired USING (key)
"""
