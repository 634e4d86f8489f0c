"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import quality as Q

_WORD = r"[^\x20\x09-\x0D]+"

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS n, sha1(html) AS digest FROM p),
m AS (SELECT digest, max(page_id) AS last FROM d WHERE n >= 1000 GROUP BY digest)
SELECT d.page_id, d.n AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN d.page_id IS DISTINCT FROM coalesce(m.last, d.page_id) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN d.page_id IS DISTINCT FROM coalesce(m.last, d.page_id) THEN m.last END AS refers_to
FROM d LEFT JOIN m USING (digest)
"""

MIXING = rf"""
WITH s AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
           CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS h
    FROM documents),
per AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
    FROM s GROUP BY source),
r AS (
    SELECT *, source_size * 3 AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total,
           CAST(coalesce(sum(source_size * 3) OVER (ORDER BY source_size * 3 / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS capped,
           CAST(sum(w) OVER (ORDER BY source_size * 3 / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS open_w
    FROM per),
lv AS (
    SELECT (total - capped) / open_w AS level FROM r WHERE (total - capped) / open_w * w <= cap
    ORDER BY cap / w, source NULLS LAST LIMIT 1),
t AS (
    SELECT source, source_size, least(CAST(cap AS DOUBLE), level * w) AS target FROM r, lv),
b AS (
    SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
u AS (
    SELECT source, h, upto - size AS before, upto FROM (
        SELECT source, h, CAST(sum(size) AS BIGINT) AS size,
               CAST(sum(sum(size)) OVER (PARTITION BY source ORDER BY h) AS BIGINT) AS upto
        FROM s GROUP BY source, h)),
e AS (
    SELECT b.source, min(u.h) AS h FROM u JOIN b ON u.source IS NOT DISTINCT FROM b.source
    WHERE u.upto >= b.target - b.passes * b.source_size GROUP BY b.source),
cut AS (
    SELECT b.source, b.source_size, b.target, b.passes,
           e.h + CASE WHEN u.upto - (b.target - b.passes * b.source_size) < (b.target - b.passes * b.source_size) - u.before THEN 1 ELSE 0 END AS threshold
    FROM b LEFT JOIN e ON b.source IS NOT DISTINCT FROM e.source
    LEFT JOIN u ON u.source IS NOT DISTINCT FROM e.source AND u.h = e.h)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, cut.source_size, cut.target,
       CAST(s.size * (cut.passes + CASE WHEN s.h < cut.threshold THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM s JOIN cut ON s.source IS NOT DISTINCT FROM cut.source
"""

_CLASSES = [("lower", "[a-z]"), ("other", r"[^\x00-\x7F]"), ("upper", "[A-Z]"), ("digit", "[0-9]"), ("symbol", r"[#*$%&|<>]")]


def quality() -> str:
    counted = ", ".join(f"len(regexp_extract_all(text, '{p}')) AS c_{n}" for n, p in _CLASSES)
    marks = " - ".join(["chars - c_space", *(f"c_{n}" for n, _ in _CLASSES)])
    classes = "[" + ", ".join(f"c_{n}" for n in Q.NAMES) + "]"
    total = "[" + ", ".join(f"sum(c_{n})" for n in Q.NAMES) + "]"
    js = ("sqrt(greatest(list_sum(list_transform(list_zip({p}, {q}), lambda x: "
          "CASE WHEN x[1] > 0 THEN x[1] * log2(x[1] / ((x[1] + x[2]) / 2)) ELSE 0.0 END + "
          "CASE WHEN x[2] > 0 THEN x[2] * log2(x[2] / ((x[1] + x[2]) / 2)) ELSE 0.0 END)) / 2, 0.0))")
    share = "list_transform({c}, lambda x: x / {n})"
    return rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
base AS (
    SELECT r, doc_id, lang, text, len(ws) AS n, length(text) AS chars,
           CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars, {counted},
           len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')))
           - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')))) AS n_dup_lines
    FROM d),
classed AS (SELECT *, {marks} AS c_mark FROM (SELECT *, chars - word_chars AS c_space FROM base)),
win AS (
    SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) >= 3)),
rep AS (SELECT r, unnest([i, i + 1, i + 2]) AS i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS k FROM win) WHERE k >= 2),
nrep AS (SELECT r, count(DISTINCT i) AS n_repeat FROM rep GROUP BY r),
tok AS (SELECT r, lang, unnest(ws) AS w FROM d),
freq AS (SELECT lang, w, count(*) AS k, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, w) AS place FROM tok WHERE lang IS NOT NULL GROUP BY lang, w),
common AS (SELECT lang, w FROM freq WHERE place <= {Q.COMMON}),
lens AS (SELECT lang, sum(n) AS n, sum(chars) AS chars, {total} AS cs FROM classed WHERE lang IS NOT NULL GROUP BY lang HAVING sum(n) > 0),
wref AS (
    SELECT c.lang, list(c.w ORDER BY c.w) AS ws, list(f.k / l.n ORDER BY c.w) AS q
    FROM common c JOIN freq f ON f.lang = c.lang AND f.w = c.w JOIN lens l ON l.lang = c.lang GROUP BY c.lang),
ref AS (SELECT l.lang, {share.format(c="l.cs", n="l.chars")} AS cq, w.ws, list_append(w.q, 1.0 - list_sum(w.q)) AS wq FROM lens l JOIN wref w ON w.lang = l.lang),
hits AS (SELECT t.r, c.lang, c.w, count(*) AS k FROM tok t JOIN common c ON t.w = c.w GROUP BY t.r, c.lang, c.w),
grid AS (
    SELECT x.r, c.lang, list(coalesce(h.k, 0) ORDER BY c.w) AS k FROM classed x CROSS JOIN common c
    LEFT JOIN hits h ON h.r = x.r AND h.lang = c.lang AND h.w = c.w WHERE x.n >= {Q.MIN_WORDS} GROUP BY x.r, c.lang),
wjs AS (
    SELECT g.r, min({js.format(p=share.format(c="list_append(g.k, x.n - list_sum(g.k))", n="x.n"), q="f.wq")}) AS js
    FROM grid g JOIN classed x ON x.r = g.r JOIN ref f ON f.lang = g.lang GROUP BY g.r),
cjs AS (
    SELECT x.r, min({js.format(p=share.format(c=classes, n="x.chars"), q="f.cq")}) AS js
    FROM classed x CROSS JOIN ref f WHERE x.chars >= {Q.MIN_CHARS} GROUP BY x.r),
judged AS (
    SELECT x.doc_id, x.n, x.word_chars, x.c_symbol, x.n_dup_lines, coalesce(p.n_repeat, 0) AS n_repeat,
           x.n < {Q.LEAST_WORDS} OR 100 * coalesce(p.n_repeat, 0) > {Q.MOST_REPEATED_PERCENT} * x.n AS base_failed,
           coalesce(c.js, 0) > {Q.MAX_CHAR_JS} OR coalesce(w.js, 0) > {Q.MAX_WORD_JS} AS diverges
    FROM classed x LEFT JOIN nrep p USING (r) LEFT JOIN cjs c USING (r) LEFT JOIN wjs w USING (r))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, word_chars, CAST(c_symbol AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND NOT diverges AS kept
FROM judged
"""


def manifest(levels: int = 7, above: int = 5, fan_out: int = 16) -> str:
    """The tree unrolled to ``levels`` over documents and ``above`` over sources; a level more changes nothing."""
    framed = lambda e: f"coalesce(strlen(CAST({e} AS VARCHAR)) || ':' || CAST({e} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(framed(e) for e in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    # crc32 over the digits of the id: -1 asks for one shift
    crc = ("xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))), "
           "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) END), 4294967295)")
    side = lambda frame: f"coalesce(string_agg(h, '') OVER (PARTITION BY g, pos // {fan_out} ORDER BY pos ROWS BETWEEN {frame}), '')"

    def tree(name: str, n: int) -> str:
        out = []
        for i in range(n):
            out.append(f"{name}{i + 1} AS (SELECT g, pos // {fan_out} AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h, "
                       f"(any_value(n) + {fan_out - 1}) // {fan_out} AS n FROM {name}{i} GROUP BY g, pos // {fan_out})")
            out.append(f"{name}_side{i} AS (SELECT g, pos, CASE WHEN n > 1 THEN [{side('UNBOUNDED PRECEDING AND 1 PRECEDING')}, {side('1 FOLLOWING AND UNBOUNDED FOLLOWING')}] END AS s FROM {name}{i})")
        return ",\n".join(out)

    joins = " ".join(f"JOIN a_side{i} a{i} ON a{i}.g = l.g AND a{i}.pos = l.pos // {fan_out ** i}" for i in range(levels))
    joins += " JOIN b0 ON b0.name = l.g JOIN " + " JOIN ".join(f"b_side{i} bs{i} ON bs{i}.pos = b0.pos // {fan_out ** i}" for i in range(above))
    path = "list_filter([" + ", ".join([f"a{i}.s" for i in range(levels)] + [f"bs{i}.s" for i in range(above)]) + "], lambda x: x IS NOT NULL)"
    return rf"""
WITH d AS (
    SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE '.' || source END AS g, {leaf('text')} AS leaf,
           CASE WHEN {crc} % 5 = 0 THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
    FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
a0 AS (SELECT g, pos, leaf AS h, n FROM l),
{tree('a', levels)},
b0 AS (SELECT 1 AS g, g AS name, row_number() OVER (ORDER BY g) - 1 AS pos, h, count(*) OVER () AS n FROM a{levels}),
{tree('b', above)},
p AS (SELECT l.doc_id, l.leaf, l.changed, b0.h AS subroot, {path} AS path FROM l {joins}),
f AS (
    SELECT doc_id, leaf, subroot, b{above}.h AS root, sha256(array_to_string(list_transform(path, lambda x: x[1] || x[2]), '')) AS proof_sha256,
           list_reduce(list_prepend([coalesce(changed, leaf), ''], path), lambda x, y: [sha256(y[1] || x[1] || y[2]), ''])[1] AS folded_root
    FROM p, b{above})
SELECT *, folded_root = root AS verified FROM f
"""


COLLOCATIONS = r"""
WITH p AS (
    SELECT lang, row_number() OVER () AS piece, regexp_extract_all(x, '[^\x20\x09]+') AS ws FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS x
        FROM documents)),
t AS (SELECT lang, piece, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM p),
g AS (SELECT lang, w AS w1, lead(w, 1) OVER s AS w2, lead(w, 2) OVER s AS w3 FROM t WINDOW s AS (PARTITION BY piece ORDER BY i)),
f1 AS (SELECT lang, w1, count(*) AS c FROM g GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS c FROM g WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS c FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
cuts AS (
    SELECT f2.lang, f2.w1, f2.w2, NULL AS w3, f2.c AS a, 1 AS k, x.c AS l, y.c AS r FROM f2
    JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
    UNION ALL
    SELECT f3.lang, f3.w1, f3.w2, f3.w3, f3.c, 1, x.c, y.c FROM f3
    JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
    UNION ALL
    SELECT f3.lang, f3.w1, f3.w2, f3.w3, f3.c, 2, x.c, y.c FROM f3
    JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2 JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3),
s AS (SELECT *, CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
least AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, w1, w2, w3 ORDER BY score, k) = 1),
inner_of AS (
    SELECT lang, w1, w2, max(c) AS c FROM (SELECT lang, w1, w2, c FROM f3 UNION ALL SELECT lang, w2, w3, c FROM f3) GROUP BY ALL),
kept AS (
    SELECT least.* FROM least LEFT JOIN inner_of i ON i.lang = least.lang AND i.w1 = least.w1 AND i.w2 = least.w2 AND least.w3 IS NULL
    WHERE i.c IS NULL OR 100 * i.c < 50 * least.a),
n AS (SELECT lang, count(*) AS n FROM g GROUP BY lang),
ranked AS (
    SELECT lang, concat_ws(' ', w1, w2, w3) AS phrase, a, l, r, score,
           row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, concat_ws(' ', w1, w2, w3)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
    SELECT row_number() OVER () AS r, vec_id, label, CASE WHEN len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
           AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN CAST(embedding AS DOUBLE[]) END AS e FROM embeddings),
pair AS (
    SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT r, r AS at FROM v UNION SELECT reach.r, pair.b FROM reach JOIN pair ON reach.at = pair.a),
low AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.at GROUP BY reach.r),
deg AS (SELECT a AS r, count(*) AS n FROM pair GROUP BY a)
SELECT v.vec_id, coalesce(deg.n, 0) AS n_links, low.component_id, v.vec_id IS NOT DISTINCT FROM low.component_id AS kept
FROM v JOIN low USING (r) LEFT JOIN deg USING (r)
"""


ORACLE: dict[str, str] = {
    "op3_warc_salvage": WARC,
    "op4_quality_divergence": quality(),
    "op10_mixing": MIXING,
    "op11_collocations": COLLOCATIONS,
    "op12_embedding_dedup": EMBEDDINGS,
    "op13_merkle_manifest": manifest(),
}
