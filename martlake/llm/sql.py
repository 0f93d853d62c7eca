"""DuckDB SQL with the results of the queries that SQL can express."""

from __future__ import annotations

from martlake.llm import mixing, near_dedup, substring_dedup, url_rules, warc

WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"

MIXING = f"""
WITH sizes AS (
  SELECT doc_id, source, len({WORDS.format('text')})::BIGINT AS size FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sizes GROUP BY source),
weighed AS (SELECT *, (place % 3 + 1)::DOUBLE AS w, 3.0::DOUBLE * source_size AS cap FROM per),
filled AS (
  SELECT *, ((SELECT sum(source_size) FROM per)::DOUBLE - coalesce(sum(cap) OVER (
      ORDER BY cap / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(w) OVER (ORDER BY cap / w, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lvl FROM weighed),
chosen AS (SELECT lvl FROM filled WHERE lvl * w <= cap ORDER BY cap / w, place LIMIT 1),
targets AS (
  SELECT place, source, source_size,
         coalesce(least(cap, (SELECT lvl FROM chosen) * w), cap)::DOUBLE AS target FROM filled),
conf AS (SELECT greatest(1, ceil(sum(size) / {mixing.SLOTS}.0))::BIGINT AS b, sum(size)::BIGINT AS total FROM sizes),
sized AS (
  SELECT t.*, b, least(b, greatest(1, floor(target / {mixing.LEAST_SLOTS})))::BIGINT AS own FROM targets t, conf),
wide AS (SELECT *, CASE WHEN own = b THEN target ELSE target * (b::DOUBLE / own) END AS width FROM sized),
long AS (
  SELECT max(b) AS b, CASE WHEN bool_or(own < b) THEN ceil(sum(width))::BIGINT ELSE (SELECT total FROM conf) END AS n FROM wide),
ends AS (
  SELECT place, CASE WHEN place = max(place) OVER () THEN 1::BIGINT << {mixing.POINT_BITS} ELSE
    floor(sum(width) OVER (ORDER BY place) / sum(width) OVER () * (1::BIGINT << {mixing.POINT_BITS})) END AS hi
  FROM wide WHERE target > 0),
spans AS (SELECT place, coalesce(lag(hi) OVER (ORDER BY place), 0) AS lo, hi FROM ends),
slots AS (
  SELECT k AS slot, (k::HUGEINT * {mixing.GOLDEN}) % (1::BIGINT << {mixing.POINT_BITS}) AS point
  FROM (SELECT unnest(range(0, (SELECT ceil(n / b::DOUBLE)::BIGINT FROM long))) AS k)),
ranked AS (
  SELECT s.place, row_number() OVER (PARTITION BY s.place ORDER BY slot) - 1 AS r
  FROM slots JOIN spans s ON point >= s.lo AND point < s.hi),
draws AS (
  SELECT place, r % n AS block, count(*) AS times FROM ranked
  JOIN (SELECT place, ceil(source_size / own::DOUBLE)::BIGINT AS n FROM wide) USING (place)
  WHERE r // n < 3 GROUP BY ALL),
laid AS (
  SELECT z.doc_id, t.place, z.size, coalesce(sum(z.size) OVER (PARTITION BY t.place ORDER BY md5('7:' || z.doc_id),
      z.doc_id, z.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sizes z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source WHERE z.size > 0),
parts AS (
  SELECT doc_id, place, size, start, unnest(range(start // own, (start + size - 1) // own + 1)) AS block, own AS b
  FROM laid JOIN wide USING (place)),
words AS (
  SELECT doc_id, sum((least(start + size, (block + 1) * b) - greatest(start, block * b)) * times) AS taken
  FROM parts JOIN draws USING (place, block) GROUP BY doc_id)
SELECT z.doc_id, z.size, t.source_size, t.target, coalesce(w.taken, 0)::BIGINT AS taken
FROM sizes z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source LEFT JOIN words w USING (doc_id)
"""

REPEATS = f"""
WITH w AS (SELECT doc_id, {WORDS.format('text')} AS words FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + {substring_dedup.WINDOW} - 1], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - {substring_dedup.WINDOW} + 2)) AS i FROM w)),
again AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {substring_dedup.WINDOW})) AS i FROM windows SEMI JOIN again USING (s)),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(lost.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)
"""

REVISITS = f"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS hex, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
d AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i: substr('{warc.BASE32}',
    ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '') AS digest,
    min(page_id) OVER (PARTITION BY hex) AS original FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN original IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN original IS DISTINCT FROM page_id THEN original END AS refers_to
FROM d
"""

NEAR = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + {near_dedup.SHINGLE} - 1], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - {near_dedup.SHINGLE} + 2,
        least(len(words), 1) + 1))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM shingles x JOIN shingles y
  ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
  WHERE 100 * common >= {near_dedup.PERCENT} * (na.n + nb.n - common)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, m) AS component_id,
       doc_id = least(doc_id, m) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN low ON low.a = doc_id
"""

_RULES = ", ".join(f"('{a}', '{h}', '{p}')" for a, h, p in url_rules.RULES)
_CANON = """concat(regexp_replace({h}, '^www\\.', ''), regexp_replace({p}, '(/index\\.html?|/+)$', ''),
  coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(
    regexp_extract({u}, '(?s)^[^?#]*\\?([^#]*)', 1), '&'),
    lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^(utm_[a-z]+|ref|fbclid|gclid|sessionid)='))), '&'), ''), ''))"""
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _canonical(url: str) -> str:
    rest = f"regexp_extract({url}, '(?s)^.*?://(.*)$', 1)"
    host = _LOWER.format(f"regexp_extract({rest}, '(?s)^([^/?#]*)', 1)")
    path = f"regexp_extract({rest}, '(?s)^[^/?#]*([^?#]*)', 1)"
    return f"CASE WHEN {host} <> '' THEN {_CANON.format(h=host, p=path, u=rest)} END"


def _first(html: str, patterns) -> str:
    """Target of the first tag that fits, or empty."""
    tag, href = (p.replace("'", "''") for p in patterns)
    return f"regexp_extract(regexp_extract({html}, '{tag}'), '{href}', 1)"


def _parts(url: str) -> str:
    """What relative targets need of the address that they are relative to."""
    rest = f"regexp_extract(coalesce({url}, ''), '(?s)^.*?://(.*)$', 1)"
    return rf"""nullif(regexp_extract({url}, '(?is)^([a-z][a-z0-9+.-]*)://', 1), '') AS scheme,
      regexp_extract({rest}, '(?s)^([^/?#]*)', 1) AS authority, regexp_extract({rest}, '(?s)^[^/?#]*([^?#]*)', 1) AS here,
      regexp_extract({rest}, '(?s)^[^?#]*(\?[^#]*)', 1) AS query"""


def _without_dots(path: str) -> str:
    return f"""(array_to_string(list_reduce(list_transform(string_split({path}, '/'), lambda x: [x]), lambda a, x:
      CASE WHEN x[1] = '.' THEN a WHEN x[1] = '..' THEN a[:greatest(len(a) - 1, 1)] ELSE a || x END), '/')
      || CASE WHEN string_split({path}, '/')[-1] IN ('.', '..') THEN '/' ELSE '' END)"""


def _resolved(t: str) -> str:
    """Target ``t`` against the columns of :func:`_parts`."""
    path, tail = f"regexp_extract({t}, '(?s)^([^?#]*)', 1)", f"regexp_extract({t}, '(?s)^[^?#]*(.*)$', 1)"
    site = "(scheme || '://' || authority)"
    folder = "CASE WHEN here = '' THEN '/' ELSE regexp_extract(here, '(?s)^(.*/)', 1) END"
    return f"""CASE WHEN regexp_matches({t}, '(?i)^[a-z][a-z0-9+.-]*://') THEN {t}
      WHEN regexp_matches({t}, '(?i)^[a-z][a-z0-9+.-]*:') THEN NULL
      WHEN starts_with({t}, '//') THEN scheme || ':' || {t}
      WHEN starts_with({t}, '#') THEN {site} || here || query || {t}
      WHEN starts_with({t}, '?') THEN {site} || here || {t}
      WHEN starts_with({t}, '/') THEN {site} || {_without_dots(path)} || {tail}
      ELSE {site} || {_without_dots(f"({folder} || {path})")} || {tail} END"""


URLS = f"""
WITH RECURSIVE rules(action, rule_host, rule_path) AS (VALUES {_RULES}),
cut AS (SELECT page_id, html, url, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) AS rest FROM pages),
own AS (
  SELECT page_id, {_LOWER.format("regexp_extract(rest, '(?s)^([^/?#]*)', 1)")} AS host,
         regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path, {_canonical("coalesce(url, '')")} AS address
  FROM cut),
found AS (
  SELECT url, nullif({_first("html", url_rules.BASE)}, '') AS base, {_first("html", url_rules.CANONICAL)} AS link FROM pages
  UNION ALL
  SELECT url, nullif({_first("html", url_rules.BASE)}, ''), {_first("html", url_rules.REFRESH)} FROM pages),
based AS (
  SELECT url, link, coalesce({_resolved("base")}, url) AS base
  FROM (SELECT url, link, base, {_parts("url")} FROM found WHERE link <> '')),
linked AS (SELECT url, {_resolved("link")} AS target FROM (SELECT url, link, {_parts("base")} FROM based)),
edges AS (
  SELECT DISTINCT {_canonical("coalesce(url, '')")} AS a, {_canonical("target")} AS b,
         {_LOWER.format("regexp_extract(regexp_extract(target, '(?s)^.*?://(.*)$', 1), '(?s)^([^/?#]*)', 1)")} AS host,
         regexp_extract(regexp_extract(target, '(?s)^.*?://(.*)$', 1), '(?s)^[^/?#]*([^?#]*)', 1) AS path
  FROM linked WHERE target IS NOT NULL),
whole AS (SELECT * FROM edges WHERE a IS NOT NULL AND b IS NOT NULL),
both_ways AS (SELECT a, b FROM whole WHERE a <> b UNION SELECT b, a FROM whole WHERE a <> b),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
every AS (
  SELECT page_id, host, path, address, true AS is_page FROM own
  UNION ALL SELECT DISTINCT NULL, host, path, b, false FROM whole),
fits AS (
  SELECT host, path, arg_max(action, length(rule_host || rule_path)) AS action,
         arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule
  FROM (SELECT DISTINCT host, path FROM every) JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY host, path),
ruled AS (
  SELECT page_id, e.host, e.path, rule, action, is_page, coalesce(least(m, address), address) AS component
  FROM every e LEFT JOIN fits ON e.host = fits.host AND e.path = fits.path LEFT JOIN low ON low.a = address),
spread AS (SELECT component, bool_or(action = 'allow') AS some_allow FROM ruled
           WHERE component IS NOT NULL AND action IS NOT NULL GROUP BY component)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN some_allow THEN 'allow' WHEN NOT some_allow THEN 'block' END,
       'allow') AS verdict, component
FROM ruled LEFT JOIN spread USING (component) WHERE is_page
"""


LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERMS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TERMS.format("coalesce(text, '')")} AS ts FROM documents),
docs AS (SELECT r, doc_id, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY ALL),
items AS (SELECT row_number() OVER () AS i, item_id, {TERMS.format('text')} AS ts FROM (
  SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
asked AS (SELECT i, term, count(*)::BIGINT AS q FROM (SELECT i, unnest(ts) AS term FROM items) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term), total),
scored AS (
  SELECT i, r, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN docs USING (r), total GROUP BY ALL),
ranked AS (
  SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS place
  FROM scored JOIN docs USING (r) WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked JOIN items USING (i) WHERE place <= 10
"""

PHRASES = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER.format("coalesce(text, '')")},
         '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
grams AS (SELECT lang, w, i, unnest(range(1, least(5, len(w) - i + 1) + 1)) AS k FROM starts),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM grams GROUP BY ALL
      HAVING k = 1 OR count(*) >= 100),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cands AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE k >= 2),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(ws[1:cut], ' ') AS head, array_to_string(ws[cut + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cands)),
scored AS (
  SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, n,
         ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = head JOIN f y ON y.lang = c.lang AND y.phrase = rest
  JOIN n ON n.lang = c.lang),
least_cut AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
held AS (
  SELECT lang, array_to_string(ws[i:i + size - 1], ' ') AS phrase, max(a) AS a
  FROM (SELECT lang, ws, a, size, unnest(range(1, k - size + 2)) AS i
        FROM (SELECT *, unnest(range(2, k)) AS size FROM cands)) GROUP BY ALL),
kept AS (
  SELECT s.* FROM least_cut s LEFT JOIN held h ON h.lang = s.lang AND h.phrase = s.phrase
  WHERE h.a IS NULL OR 100 * h.a < 100 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

SQL = {"op1_mixing": MIXING, "op5_substring_dedup": REPEATS, "op6_warc_revisits": REVISITS, "op7_near_dedup": NEAR,
       "op8_url_equivalence": URLS, "op12_lexical_search": LEXICAL, "op13_phrases": PHRASES}
