"""DuckDB SQL with the results of the registered queries."""

SQL: dict[str, str] = {}
SQL["op2_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM benchmark),
bi AS (SELECT item_id, w, least(10, len(w)) m, unnest(range(1, len(w) - least(10, len(w)) + 2)) i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') k FROM bi),
ms AS (SELECT DISTINCT m FROM bw),
di AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) i FROM d, ms WHERE len(w) >= m),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') k FROM di),
hit AS (SELECT doc_id, m, i, item_id FROM dw JOIN bw USING (m, k)),
pos AS (SELECT DISTINCT doc_id, unnest(range(i, i + m)) p FROM (SELECT DISTINCT doc_id, m, i FROM hit)),
n AS (SELECT doc_id, count(*) n FROM pos GROUP BY 1),
it AS (SELECT doc_id, count(*) n, string_agg(item_id, ',' ORDER BY item_id) s FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) n_words, CAST(coalesce(n.n, 0) AS BIGINT) n_hit, CAST(coalesce(it.n, 0) AS BIGINT) n_items,
sha256(coalesce(it.s, '')) items_sha256, coalesce(n.n, 0) > 0 contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""

_PLACES = """CASE WHEN regexp_matches(t, {p}) THEN list_transform(range(1, len(regexp_extract_all(t, {p})) + 1), lambda i: {{'s': CAST(list_sum(list_transform(string_split_regex(t, {p})[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(regexp_extract_all(t, {p})[1:i - 1], lambda x: length(x))), 0) AS BIGINT), 'n': CAST(length(regexp_extract_all(t, {p})[i]) AS BIGINT), 'v': CAST(length(regexp_extract_all(t, {p}, {g})[i]) AS BIGINT)}}) ELSE [] END"""


def _secrets() -> str:
    from . import secret_scan as s

    places = lambda p, g=0: _PLACES.format(p="'" + p.replace("'", "''") + "'", g=g)
    one = lambda src, rank, where="true": f"list_transform(list_filter({src}, lambda x: {where}), lambda x: {{'s': x.s, 'r': {rank}, 'e': x.s + x.n}})"
    text = lambda src: f"array_to_string(list_transform({src}, lambda x: ['assign','access','hex','id','weak','endpoint'][x.r + 1] || ':' || x.s || ':' || x.e), ',')"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') t FROM documents),
m AS (SELECT doc_id, {places(s.ASSIGN, 2)} a, {places(s.ACCESS)} k, {places(s.HEX)} h, {places(s.IDENT, 2)} i, {places(s.ENDPOINT)} u FROM t),
b AS (SELECT doc_id, list_sort(list_concat(list_concat({one('a', 0, 'x.v >= 6')}, {one('k', 1)}), {one('h', 2, 'x.n >= 24')})) base,
 list_concat(list_concat(list_concat({one('i', 3)}, {one('a', 4, 'x.v < 6')}), {one('h', 4, 'x.n < 24')}), {one('u', 5)}) weak FROM m),
c AS (SELECT doc_id, base, list_filter(weak, lambda w: len(list_filter(base, lambda b: b.s < w.e AND w.s < b.e)) = 0) weak FROM b),
l AS (SELECT doc_id, base, list_filter(weak, lambda w: len(list_filter(list_concat(base, weak), lambda p: p.s < w.e + 200 AND w.s < p.e + 200 AND (w.r IN (0, 2, 4)) <> (p.r IN (0, 2, 4)))) > 0) weak FROM c)
SELECT doc_id, CAST(len(list_filter(base, lambda x: x.r = 0)) AS BIGINT) n_assign, CAST(len(list_filter(base, lambda x: x.r = 1)) AS BIGINT) n_access, CAST(len(list_filter(base, lambda x: x.r = 2)) AS BIGINT) n_hex,
 sha256({text('base')}) base_sha256, {text('list_sort(list_concat(base, weak))')} spans FROM l
"""


SQL["op10_secret_scan"] = _secrets()


def _mixing(rounds: int = 24, keep: float = 0.5) -> str:
    from .mixing import DATA, TARGETS

    margins = ("source", "lang", "topic")
    base = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') source, coalesce(lang, '') lang, coalesce(text, '') t, len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\r\\n]+')) n FROM documents),
m AS (SELECT doc_id, source, lang, n, CASE WHEN n = 0 THEN 'empty' WHEN len(regexp_extract_all(t, '{DATA}')) * 33 >= length(t) THEN 'data' WHEN n < 100 THEN 'short' WHEN n > 600 THEN 'long' ELSE 'prose' END topic FROM d),
c AS (SELECT source, lang, topic, CAST(sum(n) AS DOUBLE) tokens FROM m GROUP BY ALL HAVING sum(n) > 0)"""  # noqa: S608
    for m in margins:
        base += f",\nt_{m} AS (SELECT {m}, pow(sum(tokens), {TARGETS[m]}) / sum(pow(sum(tokens), {TARGETS[m]})) OVER () t FROM c GROUP BY {m})"
    base += ",\nw0 AS (SELECT c.*, tokens w, a.t t_source, b.t t_lang, e.t t_topic FROM c JOIN t_source a USING (source) JOIN t_lang b USING (lang) JOIN t_topic e USING (topic))"
    k = 0
    for _ in range(rounds):
        for m in margins:
            base += f",\nw{k + 1} AS MATERIALIZED (SELECT * REPLACE (w * t_{m} / sum(w) OVER (PARTITION BY {m}) AS w) FROM w{k})"
            k += 1
    return base + f""",
p AS MATERIALIZED (SELECT source, lang, topic, tokens, w / sum(w) OVER () w FROM w{k}),
o AS (SELECT *, sum(tokens) OVER z - tokens full_, sum(w) OVER z - w gone, {keep} * sum(tokens) OVER () budget FROM p WINDOW z AS (ORDER BY tokens / w, source, lang, topic ROWS UNBOUNDED PRECEDING)),
l AS (SELECT arg_min(level, full_) level FROM (SELECT (budget - full_) / (1 - gone) level, full_, tokens / w r FROM o) WHERE level <= r),
q AS (SELECT source, lang, topic, least(1.0, level * w / tokens) p FROM p, l)
SELECT doc_id, source, lang, topic, CAST(n AS BIGINT) n_tokens, round(coalesce(p, 0), 6) probability, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12) AS BIGINT) / pow(2, 48) < coalesce(round(p, 9), 0) kept
FROM m LEFT JOIN q USING (source, lang, topic)
"""


SQL["op6_mixing"] = _mixing()
SQL["op8_chat_format"] = """
WITH t AS (SELECT conv_id, turn, regexp_replace(replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '|>', '| >'), '[\\x00-\\x1F\\x7F]', ' ', 'g') role, replace(coalesce(text, ''), '<|', '< |') text FROM conversations),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) n FROM t),
s AS (SELECT DISTINCT conv_id, role perspective FROM t WHERE role <> 'system'),
g AS (SELECT n.conv_id, perspective, n, role = perspective own,
 CASE WHEN role = 'system' THEN '<|system|>' || chr(10) WHEN role = perspective THEN '<|assistant|>' || chr(10) ELSE '<|user name=' || role || '|>' || chr(10) END head, text || '<|end|>' body
 FROM n JOIN s ON n.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (SELECT *, CAST(sum(length(head) + length(body) + 1) OVER (PARTITION BY conv_id, perspective ORDER BY n) AS BIGINT) e FROM g)
SELECT conv_id, perspective, n, head || body || chr(10) AS text, e - 1 - length(body) - length(head) AS start, CASE WHEN own THEN (e - 1 - length(body)) || ':' || (e - 1) ELSE '' END mask, CAST(CASE WHEN own THEN length(body) ELSE 0 END AS BIGINT) n_masked
FROM o
"""

SQL["op5_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id a, b.vec_id b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
r AS (SELECT vec_id AS id, vec_id AS root FROM v UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(root) root FROM r GROUP BY 1), n AS (SELECT a, count(*) n FROM l GROUP BY 1)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) n_links, root component_id, vec_id = root kept FROM v JOIN c ON c.id = vec_id LEFT JOIN n ON n.a = vec_id
"""
SQL["op3_ngram_join"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) i FROM d WHERE len(w) > 0),
s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 4], ' ')) k FROM i),
z AS (SELECT doc_id, count(*) n FROM s GROUP BY 1),
p AS (SELECT x.doc_id a, y.doc_id b, count(*) n FROM s x JOIN s y ON x.k = y.k AND x.doc_id < y.doc_id GROUP BY ALL),
h AS (SELECT a, b FROM p JOIN z za ON za.doc_id = a JOIN z zb ON zb.doc_id = b WHERE 9 * p.n >= 4 * (za.n + zb.n)),
l AS MATERIALIZED (SELECT a, b FROM h UNION ALL SELECT b, a FROM h),
r AS (SELECT doc_id AS id, doc_id AS root FROM d UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id),
c AS (SELECT id, min(root) root FROM r GROUP BY 1), n AS (SELECT a, count(*) n FROM l GROUP BY 1)
SELECT doc_id, root class_id, CAST(coalesce(n, 0) AS BIGINT) n_links, doc_id = root kept FROM d JOIN c ON c.id = doc_id LEFT JOIN n ON n.a = doc_id
"""
SQL["op7_suffix_dedup"] = """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) h FROM documents),
i AS (SELECT doc_id, h, unnest(range(0, CAST(length(h) / 2 AS BIGINT) - 49)) p FROM d WHERE length(h) >= 100),
w AS (SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 100)) k FROM i),
m AS (SELECT k, min(doc_id) first FROM w GROUP BY k HAVING min(doc_id) < max(doc_id)),
c AS (SELECT doc_id, p FROM w JOIN m USING (k) WHERE first < doc_id),
g AS (SELECT doc_id, p, sum(CASE WHEN p - q <= 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) r FROM (SELECT doc_id, p, coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -100) q FROM c)),
s AS (SELECT doc_id, min(p) a, max(p) + 50 b FROM g GROUP BY doc_id, r),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) f FROM s),
t AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) n, count(*) c, max(b) e, list((f, a) ORDER BY a) x FROM k GROUP BY doc_id)
SELECT doc_id, CAST(length(h) / 2 AS BIGINT) n_bytes, coalesce(n, 0) n_removed, coalesce(c, 0) n_spans,
 sha256(unhex(CASE WHEN n IS NULL THEN h ELSE array_to_string(list_transform(x, lambda y: substr(h, 2 * y[1] + 1, 2 * (y[2] - y[1]))), '') || substr(h, 2 * e + 1) END)) kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""
