"""SQL for the registered queries that SQL can express."""

from lineside.llm import secret_scan

NEAR_DUPLICATES = """
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), own AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
  FROM cut
), class AS (
  SELECT min(doc_id) AS rep, list_sort(s) AS s, len(s) AS n FROM own WHERE len(s) > 0 GROUP BY list_sort(s), len(s)
), one AS (
  SELECT rep, n, unnest(s) AS g FROM class
), link AS (
  SELECT x.rep AS u, y.rep AS v FROM one x JOIN one y ON x.g = y.g AND x.rep < y.rep
    AND least(x.n, y.n) * 100 >= greatest(x.n, y.n) * 80
  GROUP BY x.rep, y.rep, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), edge AS (SELECT u, v FROM link UNION SELECT v, u FROM link
), reach(node, root) AS (
  SELECT rep, rep FROM class UNION SELECT edge.v, reach.root FROM reach JOIN edge ON edge.u = reach.node
), label AS (SELECT node, min(root) AS root FROM reach GROUP BY node
), placed AS (SELECT class.s, label.root FROM class JOIN label ON label.node = class.rep)
SELECT own.doc_id, CAST(len(own.s) AS BIGINT) AS n_shingles, coalesce(placed.root, own.doc_id) AS component_id,
  own.doc_id = coalesce(placed.root, own.doc_id) AS kept
FROM own LEFT JOIN placed ON list_sort(own.s) = placed.s
"""

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _secret_matches() -> str:
    """Matches of each kind with their places: what lies between them tells where they begin."""
    checks = {
        "assign": f"length(v) >= {secret_scan.LEAST_ASSIGNED}", "access": f"length(m) >= {secret_scan.LEAST_ACCESS}",
        "blob": "regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')"}
    out = []
    for order, kind in enumerate(secret_scan.KINDS):
        pattern = secret_scan.PATTERNS[kind].replace("'", "''")
        group = secret_scan.VALUE.get(kind, 0)
        out.append(f"""
  SELECT r, {order} AS k, a, a + length(m) AS b, v FROM (
    SELECT r, m[i] AS m, v[i] AS v,
      coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
        + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS a
    FROM (
      SELECT r, m, v, g, unnest(range(1, len(m) + 1)) AS i FROM (
        SELECT r, regexp_extract_all(text, '{pattern}') AS m, regexp_extract_all(text, '{pattern}', {group}) AS v,
          regexp_split_to_array(text, '{pattern}') AS g
        FROM doc WHERE regexp_matches(text, '{pattern}'))))
  WHERE {checks.get(kind, 'true')}""")
    return " UNION ALL ".join(out)


SECRETS = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), hit AS ({_secret_matches()}
), candidate AS (
  SELECT * FROM hit WHERE k < 3
  UNION ALL SELECT h.* FROM hit h WHERE h.k = 3 AND NOT EXISTS (
    SELECT 1 FROM hit o WHERE o.r = h.r AND o.k < 3 AND o.a < h.b AND h.a < o.b)
), candidate_4 AS (
  SELECT * FROM candidate
  UNION ALL SELECT h.* FROM hit h WHERE h.k = 4 AND NOT EXISTS (
    SELECT 1 FROM candidate o WHERE o.r = h.r AND o.a < h.b AND h.a < o.b)
), span AS (
  SELECT * FROM candidate_4
  UNION ALL SELECT h.* FROM hit h WHERE h.k = 5 AND NOT EXISTS (
    SELECT 1 FROM candidate_4 o WHERE o.r = h.r AND o.a < h.b AND h.a < o.b)
), held AS (
  SELECT v, count(DISTINCT coalesce(source, chr(0))) AS owners FROM span JOIN doc USING (r) GROUP BY v
), judged AS (
  SELECT r, k, a, b, CASE WHEN owners >= {secret_scan.COPIED_OWNERS} THEN 'copied'
    WHEN owners = 1 AND length(v) >= {secret_scan.LEAST} AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
      AND len(list_distinct(string_split(v, ''))) >= {secret_scan.DIFFERENT}
      AND NOT regexp_matches(lower(v), '{'|'.join(secret_scan.MADE_UP)}') THEN 'live' ELSE 'unclear' END AS verdict
  FROM span JOIN held USING (v)
), kept AS (
  SELECT r, k, a, b, verdict, (['{"', '".join(secret_scan.KINDS)}'])[k + 1] || ':' || a || ':' || b AS s
  FROM judged WHERE k < 3 OR verdict = 'live'
), told AS (
  SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    string_agg(s, ',' ORDER BY a, k) FILTER (k < 3) AS base, string_agg(s, ',' ORDER BY a, k) AS spans,
    count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'copied') AS n_copied,
    string_agg(s, ',' ORDER BY a, k) FILTER (verdict = 'live') AS live
  FROM kept GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
  coalesce(n_copied, 0) AS n_copied, coalesce(live, '') AS live
FROM doc LEFT JOIN told USING (r)
"""

SPELLING = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), run AS (
  SELECT doc_id, w, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({_FOLD.format("text")}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS w FROM documents)
  WHERE length(w) >= 5 GROUP BY doc_id, w
), byte AS (
  SELECT doc_id, w, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w)) AS x FROM run
), summed AS (
  SELECT doc_id, w, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(0, length(x), 2), lambda i: CAST('0x' || x[i + 1:i + 2] AS BIGINT))),
    lambda c, b: xor(t[xor(c, b) % 256 + 1], c >> 8))) AS h
  FROM byte, crc
), bent AS (
  SELECT CASE WHEN h % 97 = 0 THEN w[1:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, n FROM summed
), word AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM bent WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM word)
), pair AS (
  SELECT x.word AS u, y.word AS v, y.n AS m FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT cut.word, word.word, word.n FROM cut JOIN word ON cut.rest = word.word
  UNION SELECT word.word, cut.word, cut.n FROM cut JOIN word ON cut.rest = word.word
), best AS (
  SELECT u, count(*) AS n_near, max(m) AS m FROM pair GROUP BY u
), chosen AS (
  SELECT best.u, n_near, best.m, min(v) AS v FROM best JOIN pair ON pair.u = best.u AND pair.m = best.m
  GROUP BY best.u, n_near, best.m
), formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN v END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n
  FROM word LEFT JOIN chosen ON word.word = chosen.u
), walk(word, place, form) AS (
  SELECT word, word, form FROM formed
  UNION ALL SELECT walk.word, formed.word, formed.form FROM walk JOIN formed ON walk.form = formed.word
)
SELECT formed.word, formed.form, walk.place AS root, n, n_near, form_n
FROM formed JOIN walk ON walk.word = formed.word AND walk.form IS NULL
"""

_TERMS = f"regexp_extract_all({_FOLD.format('coalesce(text, chr(32))')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
SEARCH = f"""
WITH doc AS (SELECT doc_id, unnest(t) AS term, len(t) AS n FROM (SELECT doc_id, {_TERMS} AS t FROM documents) WHERE len(t) > 0),
size AS (SELECT count(DISTINCT doc_id) AS docs, count(*) AS terms FROM doc),
posting AS (SELECT doc_id, term, any_value(n) AS n, count(*) AS tf FROM doc GROUP BY doc_id, term),
known AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM posting, size GROUP BY term, docs
), asked AS (
  SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY item_id, term
), score AS (
  SELECT item_id, doc_id, CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN known USING (term) JOIN posting USING (term), size GROUP BY item_id, doc_id
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0)
WHERE rank <= 10
"""
