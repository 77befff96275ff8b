"""SQL for the queries that SQL can express, written for DuckDB.

Said from the definitions, not from the operators' steps: near duplicates are
counted over all shared shingles, neighbours over all pairs.
"""

from __future__ import annotations

S = r"[ \t\n\x{0b}\f\r]"

OP4 = rf"""
WITH lines AS (
  SELECT doc_id, unnest(range(len(l)))::INT AS pos, unnest(l) AS raw, text
  FROM (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents)),
toks AS (
  SELECT doc_id, pos, list_transform(list_filter(regexp_split_to_array(raw, '{S}+'), lambda t: t <> ''),
    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS t FROM lines),
leafed AS (SELECT doc_id, pos, t, len(t) AS n, len(t) || ' ' || array_to_string(t[1:3], ' ') AS leaf FROM toks WHERE len(t) >= 3),
tok AS (SELECT DISTINCT doc_id, leaf, t, n, unnest(range(len(t)))::INT AS i, unnest(t) AS w FROM leafed),
seen AS (SELECT leaf, i, w, count(DISTINCT doc_id) AS seen FROM tok WHERE w <> '<*>' GROUP BY leaf, i, w),
counted AS (
  SELECT k.leaf, k.t, k.n, list({{'i': k.i, 'w': k.w, 'seen': s.seen}} ORDER BY k.i) AS places, list(s.seen ORDER BY s.seen DESC) AS counts
  FROM (SELECT DISTINCT leaf, t, n, i, w FROM tok) k JOIN seen s USING (leaf, i, w) GROUP BY k.leaf, k.t, k.n),
kinds AS (
  SELECT leaf, t, 5 AS need, 0 AS strict, places, counts[(n * 80 + 99) // 100] AS least FROM counted
  UNION ALL SELECT leaf, t, 2, 1, places, counts[(n * 95 + 99) // 100] FROM counted WHERE n >= 50),
shaped AS (
  SELECT leaf, t, need, strict, list_transform(list_filter(places, lambda p: p.seen >= least), lambda p: {{'i': p.i, 'w': p.w}}) AS shape FROM kinds WHERE least IS NOT NULL),
class AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS c FROM documents),
members AS (SELECT o.doc_id, CASE WHEN s.strict = 0 THEN o.doc_id ELSE c.c END AS who, o.pos, o.leaf, s.need, s.strict, s.shape FROM leafed o JOIN shaped s ON s.leaf = o.leaf AND s.t = o.t JOIN class c USING (doc_id)),
held AS (SELECT leaf, strict, shape, min(who) AS f FROM members GROUP BY leaf, strict, shape, need HAVING count(DISTINCT who) >= need),
owners AS (SELECT t, min(c) AS own FROM leafed JOIN class USING (doc_id) GROUP BY t),
drawn AS (SELECT m.doc_id, m.pos, m.leaf, arg_min(m.who <> h.f, h.strict) AS goes, min(h.strict) AS strict, arg_min(h.f, h.strict) AS f FROM members m JOIN held h ON h.leaf = m.leaf AND h.strict = m.strict AND h.shape = m.shape GROUP BY m.doc_id, m.pos, m.leaf),
totals AS (SELECT doc_id, sum(len(t)) AS total FROM toks GROUP BY doc_id),
shared AS (SELECT d.doc_id, d.f, sum(greatest(len(t) - 4 - CASE WHEN own = d.f THEN 0 ELSE (len(t) * 5 + 99) // 100 * 5 END, 0)) AS n FROM drawn d JOIN leafed USING (doc_id, pos) JOIN owners USING (t) WHERE goes AND strict = 1 GROUP BY d.doc_id, d.f),
copies AS (SELECT s.doc_id, f FROM shared s JOIN totals a USING (doc_id) JOIN totals b ON b.doc_id = f WHERE n * 100 >= (a.total + b.total - 8 - n) * 80),
gone AS (SELECT doc_id, pos FROM drawn d WHERE goes AND (strict = 0 OR NOT EXISTS (SELECT 1 FROM copies c WHERE c.doc_id = d.doc_id AND c.f = d.f)))
SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_dropped,
  md5(coalesce(string_agg(l.raw, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL), '')) AS text_md5
FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id
"""

OP7 = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding) AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM p
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""

OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x{0b}\f\r]+'), lambda t: t <> '') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT x.d, e.b FROM reach x JOIN "both" e ON e.a = x.r)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, r.c AS component_id, w.doc_id = r.c AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT d, min(r) AS c FROM reach GROUP BY d) r ON r.d = w.doc_id
""".replace("both AS MATERIALIZED", '"both" AS MATERIALIZED')

_LEVEL = """t{d} AS (SELECT gram, a, b, gram[1:{d}] AS ctx FROM {source}),
s{d} AS (SELECT ctx, sum(a) AS na, sum(b) AS nb, count(*) FILTER (a > 0) AS ta, count(*) FILTER (b > 0) AS tb FROM t{d} GROUP BY ctx),
p{d} AS (SELECT t.gram, coalesce((t.a + s.ta * {qa}) / nullif(s.na + s.ta, 0), {qa}) AS pa, coalesce((t.b + s.tb * {qb}) / nullif(s.nb + s.tb, 0), {qb}) AS pb
  FROM t{d} t JOIN s{d} s ON s.ctx = t.ctx{join})"""


def _levels() -> str:
    parts = []
    for d in range(4):
        source = "(SELECT gram, sum(a) AS a, sum(b) AS b FROM (SELECT gram[" + str(4 - d) + ":] AS gram, a, b FROM g3) GROUP BY gram)"
        lower = f" JOIN p{d - 1} q ON q.gram = t.gram[2:]" if d else ""
        qa, qb = ("q.pa", "q.pb") if d else ("0.025::DOUBLE", "0.025::DOUBLE")
        parts.append(_LEVEL.format(d=d, source=source, qa=qa, qb=qb, join=lower))
    return ",\n".join(parts)


OP9 = rf"""
WITH u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages),
h AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule FROM h),
j AS (SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS ruled,
  regexp_replace(translate(CASE WHEN contains(url, '://') THEN rest ELSE coalesce(url, '') END, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[^a-z0/._?=&%#:-]', '~', 'g') AS sym FROM r),
e AS (SELECT page_id, host, path, rule, ruled, sym, unnest(list_transform(range(1, length(sym) + 2), lambda i: ('^^^' || sym || '$')[i:i + 3])) AS gram FROM j),
g3 AS (SELECT gram, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b FROM e GROUP BY gram),
{_levels()},
k AS (SELECT sym, avg(ln(pa) - ln(pb)) AS ratio FROM e JOIN p3 USING (gram) GROUP BY sym),
sc AS (SELECT j.page_id, j.host, j.path, j.rule, j.ruled, k.ratio FROM j JOIN k USING (sym)),
bins AS (SELECT floor(greatest(-20.0, least(20.0, ratio)) * 1000)::BIGINT AS bin, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b FROM sc WHERE ruled IS NOT NULL GROUP BY 1),
cum AS (SELECT greatest(lag(bin, 1, -20001) OVER (ORDER BY bin) + 1, least(bin, 0)) AS edge, sum(a) OVER (ORDER BY bin DESC) / sum(a) OVER () - sum(b) OVER (ORDER BY bin DESC) / sum(b) OVER () AS gain FROM bins),
cut AS (SELECT coalesce((SELECT edge FROM cum WHERE gain IS NOT NULL ORDER BY gain DESC, abs(edge), edge LIMIT 1) / 1000.0, 0.0) AS cut)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN ratio >= (SELECT cut FROM cut) THEN 'allow' ELSE 'block' END) AS verdict, round(ratio, 6) AS ratio FROM sc
"""



_ONCE = "(SELECT * REPLACE (coalesce(w * s_{dim} / nullif(sum(w) OVER (PARTITION BY {dim}), 0), 0) AS w) FROM {of})"
_ROUND = _ONCE.format(dim="topic", of=_ONCE.format(dim="lang", of=_ONCE.format(dim="source", of="r WHERE k < 100")))
_TARGETS = ", ".join(f"m_{d} AS (SELECT {d}, p / sum(p) OVER () AS share FROM (SELECT {d}, pow(sum(mass), 0.7) AS p FROM cells GROUP BY {d}))" for d in ("source", "lang", "topic"))

#: A hundred rounds of raking; the scale by the sorted cells: those of smallest
#: mass to weight are full, and the first share of the rest that fills none is it.
OP10 = f"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
  CASE WHEN contains(text, 'icense') OR contains(text, 'icence') OR contains(text, 'll rights reserved') THEN 'legal'
       WHEN regexp_matches(text, '[A-Za-z0-9]@[A-Za-z0-9]') THEN 'contact' WHEN contains(text, ' | ') THEN 'table'
       WHEN length(text) < 1000 THEN 'short' ELSE 'prose' END AS topic,
  len(list_filter(regexp_split_to_array(coalesce(text, ''), '{S}+'), lambda t: t <> '')) AS tokens FROM documents),
cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS mass FROM docs GROUP BY ALL HAVING sum(tokens) > 0),
{_TARGETS},
r AS (SELECT 0 AS k, c.*, mass::DOUBLE AS w, s1.share AS s_source, s2.share AS s_lang, s3.share AS s_topic FROM cells c JOIN m_source s1 USING (source) JOIN m_lang s2 USING (lang) JOIN m_topic s3 USING (topic)
  UNION ALL SELECT * REPLACE (k + 1 AS k) FROM {_ROUND}),
raked AS (SELECT * FROM r WHERE k = 100),
sorted AS (SELECT mass / w AS ratio, coalesce(sum(mass) OVER before, 0) AS full_mass, sum(w) OVER rest AS open_weight FROM raked WHERE w > 0
  WINDOW before AS (ORDER BY mass / w, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), rest AS (ORDER BY mass / w, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
scale AS (SELECT coalesce(arg_min(x, ratio) FILTER (x <= ratio), max(ratio)) AS scale FROM (SELECT ratio, ((SELECT 0.5 * sum(mass) FROM cells) - full_mass) / open_weight AS x FROM sorted)),
done AS (SELECT source, lang, topic, least(1.0, w / mass * (SELECT scale FROM scale)) AS p FROM raked),
out AS (SELECT d.*, CASE WHEN tokens > 0 THEN coalesce(p, 0) ELSE 0 END AS p FROM docs d LEFT JOIN done USING (source, lang, topic))
SELECT doc_id, source, lang, topic, tokens, round(p, 6) AS probability, ('0x' || md5('mix:' || doc_id)[1:8])::BIGINT / 4294967296.0 < p AS kept FROM out
"""

OP12 = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.e, r.e)::BIGINT AS score FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""

OP13 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
f AS (SELECT page_id, octet_length(body) AS n, sha256(body) AS digest, min(page_id) OVER (PARTITION BY body) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to, NULL::VARCHAR AS problem FROM f
"""

ORACLES: dict[str, str] = {"op10_mixing": OP10, "op12_hard_negatives": OP12, "op13_warc": OP13, "op4_line_dedup": OP4, "op7_vptree": OP7, "op8_neardup": OP8, "op9_urls": OP9}
