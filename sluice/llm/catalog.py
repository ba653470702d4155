"""The queries of this package and their SQL, where SQL can express them."""

from __future__ import annotations

from . import divergence, html_blocks, line_dedup, mixing, nn_descent, packing, prefix_trie, quality, sharding, simhash, substring, token_count, url_filter

#: A rule fits its host and subdomains if the path starts with the rule's; the longest wins.
_OP4_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), cut AS (
  SELECT page_id, regexp_extract(rest, '^[^?#]*') AS rest FROM parts
), split AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         CASE WHEN strpos(rest, '/') > 0 THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path
  FROM cut
), ruled AS (
  SELECT *, '.' || host || path AS canon,
    CASE WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
         WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
         WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
         WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
         WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM split
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
       WHEN rule IS NOT NULL THEN 'allow'
       WHEN canon LIKE '%/wp-login%' AND strpos(substr(canon, strpos(canon, '/wp-login') + 9), '/') = 0 THEN 'block'
       WHEN canon LIKE '%/cart/%' OR canon LIKE '%.doubleclick.net/%' OR canon LIKE '%/%.zip' THEN 'block'
       ELSE 'allow' END AS verdict
FROM ruled
"""

#: Raking as a recursion with window sums, until a round finds every marginal within 0.5 %.
_OP1_SQL = r"""
WITH RECURSIVE marked AS (
  SELECT doc_id, coalesce(source, '\N') AS source, coalesce(lang, '\N') AS lang,
    't' || ((instr('0123456789abcdef', substr(md5(lower(regexp_extract(coalesce(text, ''), '[^\x20\x09-\x0D]+'))), 1, 1)) - 1) % 8) AS topic,
    greatest(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')), 1)::BIGINT AS tokens
  FROM documents
), cells AS (
  SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM marked GROUP BY ALL
), values_ AS (
  SELECT 's' AS m, source AS v, sum(tokens) AS n FROM cells GROUP BY ALL
  UNION ALL SELECT 'l', lang, sum(tokens) FROM cells GROUP BY ALL
  UNION ALL SELECT 't', topic, sum(tokens) FROM cells GROUP BY ALL
), named AS (
  SELECT *, CASE WHEN m = 's' AND v = 'src0' THEN 0.1::DOUBLE WHEN m = 'l' AND v = 'en' THEN 0.4::DOUBLE WHEN m = 'l' AND v IN ('de', 'fr', 'es') THEN 0.2::DOUBLE WHEN m = 't' AND v = 't0' THEN 0.15::DOUBLE END AS s
  FROM values_
), sums AS (
  SELECT *, coalesce(sum(s) OVER w, 0) AS given, coalesce(sum(n) FILTER (WHERE s IS NULL) OVER w, 0) AS other, sum(n) OVER w AS whole
  FROM named WINDOW w AS (PARTITION BY m)
), shares AS (
  SELECT m, v, n, whole, CASE WHEN other = 0 THEN s / given WHEN given < 1 - 1e-12 THEN coalesce(s, (1 - given) * n / other)
    ELSE coalesce(s / given * (1 - other / whole), n / whole) END AS share FROM sums
), scale AS (SELECT least(0.5, 0.8 * min(n / whole / share)) AS x, max(whole) AS whole FROM shares
), raked AS (
  SELECT 0 AS k, c.*, x AS q, s.share * x * whole_ AS ts, l.share * x * whole_ AS tl, t.share * x * whole_ AS tt, 1.0::DOUBLE AS off
  FROM cells c JOIN shares s ON s.m = 's' AND s.v = source JOIN shares l ON l.m = 'l' AND l.v = lang JOIN shares t ON t.m = 't' AND t.v = topic, (SELECT x, whole AS whole_ FROM scale)
  UNION ALL
  SELECT k + 1, source, lang, topic, tokens, q2 * tt / g3, ts, tl, tt, max(greatest(o1, o2, abs(g3 / tt - 1))) OVER () FROM (
    SELECT *, sum(tokens * least(1, q2)) OVER (PARTITION BY topic) AS g3 FROM (
      SELECT *, q1 * tl / g2 AS q2, abs(g2 / tl - 1) AS o2 FROM (
        SELECT *, sum(tokens * least(1, q1)) OVER (PARTITION BY lang) AS g2 FROM (
          SELECT *, q * ts / g1 AS q1, abs(g1 / ts - 1) AS o1 FROM (
            SELECT *, sum(tokens * least(1, q)) OVER (PARTITION BY source) AS g1 FROM raked WHERE k < 60 AND off > 5e-3)))))
), odds AS (
  SELECT source, lang, topic, least(1.0, q) AS p FROM raked WHERE k = (SELECT max(k) FROM raked)
)
SELECT doc_id, source, lang, topic, tokens, round(p, 6) AS probability,
  (('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0) < p AS sampled
FROM marked JOIN odds USING (source, lang, topic)
"""

#: Every pair, and reachability: for small tables only, as the driver's oracle run is.
_OP9_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT a AS vec_id, b AS other FROM links
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1),
least AS (SELECT vec_id, min(other) AS m FROM reach GROUP BY 1)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id))::BIGINT AS component_id, vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN degree USING (vec_id) LEFT JOIN least USING (vec_id)
"""

#: Every window as a string.
_OP10_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS k FROM w, unnest(range(1, len(words) - 11)) t(i)),
firsts AS (SELECT k, min(doc_id) AS d FROM win GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN firsts USING (k) WHERE d < doc_id),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY 1)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)
"""


#: Every prefix of every conversation, and every node beside all its ancestors; crc32 bit by bit.
_OP11_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, md5(length(r) || ':' || r || x) AS id, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL)
), whole AS (
  SELECT conv_id, list({'id': id, 'w': w} ORDER BY turn NULLS FIRST, id) AS t,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda s, c:
      list_reduce(list_prepend(xor(s, c), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 4 AS h
  FROM turns GROUP BY 1
), rebuilt AS (
  SELECT a.conv_id, list_concat(coalesce(b.t[1:a.h], []), a.t[a.h + 1:]) AS t FROM whole a LEFT JOIN whole b ON b.conv_id = a.conv_id - a.conv_id % 20
), prefixes AS (
  SELECT conv_id, len(t) AS n, d, array_to_string(list_transform(t[1:d], lambda x: x.id), ',') AS k, array_to_string(list_transform(t[1:d - 1], lambda x: x.id), ',') AS up,
    coalesce(t[d].w, 0) AS w, list_transform(range(0, d + 1), lambda e: array_to_string(list_transform(t[1:e], lambda x: x.id), ',')) AS line
  FROM rebuilt, unnest(range(0, len(t) + 1)) r(d)
), nodes AS (
  SELECT k, d, min(up) AS up, min(line) AS line, min(conv_id) AS conv_id, count(*) AS n_convs, min(w) AS w, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '') AS ends
  FROM prefixes GROUP BY k, d
), fans AS (SELECT up, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), sums AS (
  SELECT a AS k, sum((n_convs - 1) * w) AS saved, count(*) FILTER (f.n IS NULL) AS leaves
  FROM (SELECT k, n_convs, w, unnest(line) AS a FROM nodes) e LEFT JOIN fans f ON f.up = e.k GROUP BY 1
)
SELECT x.conv_id, x.d AS depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(f.n, 0)::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(x.ends) AS ends_sha256
FROM nodes x JOIN sums s ON s.k = x.k LEFT JOIN fans f ON f.up = x.k LEFT JOIN nodes p ON x.d > 0 AND p.k = x.up
"""

#: All in whole numbers, over every term of every group.
_OP13_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), each AS (SELECT row, lang, source, unnest(words) AS term FROM docs
), kept AS (SELECT lang, term, count(*) AS total FROM each GROUP BY 1, 2 HAVING count(DISTINCT row) >= 30
), counts AS (SELECT lang, source, term, count(*) AS n FROM each JOIN kept USING (lang, term) GROUP BY 1, 2, 3
), groups_ AS (
  SELECT lang, source, coalesce((SELECT sum(n) FROM counts c WHERE c.lang = g.lang AND c.source = g.source), 0)::HUGEINT AS size, (SELECT count(*) FROM kept k WHERE k.lang = g.lang)::HUGEINT AS v
  FROM (SELECT DISTINCT lang, source FROM docs) g
), p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, (1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (size + 5 * v))::BIGINT AS p
  FROM groups_ JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
), q AS (
  SELECT lang, term, (1 + (1000000000::HUGEINT * (total + 5)) // ((sum(total) OVER (PARTITION BY lang))::HUGEINT + 5 * count(*) OVER (PARTITION BY lang)))::BIGINT AS q FROM kept
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM groups_ a JOIN groups_ b ON a.lang = b.lang AND a.source <> b.source
), found AS (
  SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank FROM found) WHERE part = 'pair' OR rank <= 50
"""


def queries() -> dict:
    return {
        "op1_source_mixing": mixing.op1_source_mixing,
        "op2_line_dedup": line_dedup.op2_line_dedup,
        "op3_sharding": sharding.op3_sharding,
        "op4_url_filters": url_filter.op4_url_filters,
        "op5_token_counts": token_count.op5_token_counts,
        "op6_packing": packing.op6_packing,
        "op7_quality": quality.op7_quality,
        "op8_simhash": simhash.op8_simhash,
        "op9_embedding_dedup": nn_descent.op9_embedding_dedup,
        "op10_substring_dedup": substring.op10_substring_dedup,
        "op11_prefix_trie": prefix_trie.op11_prefix_trie,
        "op12_html_text": html_blocks.op12_html_text,
        "op13_source_divergence": divergence.op13_source_divergence,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_source_mixing": _OP1_SQL, "op4_url_filters": _OP4_SQL, "op9_embedding_dedup": _OP9_SQL, "op10_substring_dedup": _OP10_SQL, "op11_prefix_trie": _OP11_SQL, "op13_source_divergence": _OP13_SQL}
