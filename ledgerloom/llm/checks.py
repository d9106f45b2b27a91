"""SQL for the queries that SQL can express, each worked out from its contract."""

from __future__ import annotations

from ledgerloom.llm import quality_rules, url_cascade

SUFFIX_LEVELS = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
    SELECT doc_id, i, substring(h, 2 * i + 1, 200) AS w
    FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 99, 0))) AS i FROM texts)),
again AS (
    SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, i) > 1),
parted AS (
    SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh
    FROM again),
numbered AS (SELECT *, SUM(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM parted),
spans AS (
    SELECT doc_id, span, MIN(i) AS a, MAX(i) + 100 AS b FROM numbered GROUP BY doc_id, span),
gaps AS (
    SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
    UNION ALL
    SELECT doc_id, coalesce(MAX(s.b), 0), any_value(length(h) // 2)
    FROM texts LEFT JOIN spans s USING (doc_id) GROUP BY doc_id),
kept AS (
    SELECT doc_id, string_agg(substring(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h
    FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT t.doc_id, length(t.h) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       coalesce(s, 0) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM texts t JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, SUM(b - a) AS n, COUNT(*) AS s FROM spans GROUP BY doc_id) x USING (doc_id)
"""


def _url_cascade() -> str:
    def fits(domain: str) -> str:
        return f"(host = '{domain}' OR ends_with(host, '.{domain}'))"

    rules = sorted(url_cascade.RULES, key=lambda r: -len(r[1] + r[2]))
    cases = [(f"{fits(d)} AND starts_with(path, '{p}')", d + p, v) for v, d, p in rules]
    rule = " ".join(f"WHEN {test} THEN '{name}'" for test, name, _ in cases)
    verdict = " ".join(f"WHEN {test} THEN '{v}'" for test, _, v in cases)
    listed = " OR ".join(fits(d) for d in url_cascade.BLOCKED)
    return f"""
WITH rests AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substring(url, position('://' IN url) + 3)
           ELSE '' END AS rest
    FROM pages),
parts AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), '{url_cascade.UPPER}', '{url_cascade.LOWER}') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rests),
told AS (SELECT *, coalesce({listed}, FALSE) AS listed FROM parts)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict} WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM told
"""


PROJECTION_FOREST = """
WITH RECURSIVE able AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL)) = 0
      AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM able a JOIN able b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings
JOIN (SELECT a AS vec_id, MIN(b) AS component_id FROM reach GROUP BY a) c USING (vec_id)
LEFT JOIN (SELECT a AS vec_id, COUNT(*) AS n FROM links GROUP BY a) x USING (vec_id)
"""


def _quality_rules() -> str:
    names = ("symbols", "capitals", "dup_lines", "repeats")
    shares = (
        "n_symbols / nullif(word_chars, 0)",
        "n_capitals / nullif(word_chars, 0)",
        "n_dup_lines / nullif(n_lines, 0)",
        "n_repeat_words / nullif(n_words, 0)",
    )
    grid, p = quality_rules.GRID, quality_rules.RISK / len(names)
    cells = ", ".join(
        f"CAST(floor(coalesce({share}, 0) * {grid}) AS INTEGER) AS {name}" for name, share in zip(names, shares)
    )
    unpivot = " UNION ALL ".join(f"SELECT stratum, '{n}' AS ratio, {n} AS cell FROM good" for n in names)
    broken = ", ".join(f"CASE WHEN {n} > c_{n} THEN '{n}' END" for n in names)
    cuts = ", ".join(f"MAX(cut) FILTER (ratio = '{n}') AS c_{n}" for n in names)
    blank = r"[\x20\x09-\x0D]"
    return rf"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t FROM documents),
lists AS (
    SELECT *, list_filter(string_split_regex(t, '{blank}+'), lambda x: x <> '') AS w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{blank}', '', 'g') <> '') AS l
    FROM texts),
windows AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM lists)),
covered AS (
    SELECT doc_id, COUNT(DISTINCT i + o) AS n
    FROM (SELECT doc_id, i FROM windows QUALIFY COUNT(*) OVER (PARTITION BY doc_id, g) > 1) x, range(0, 3) r(o)
    GROUP BY doc_id),
counted AS (
    SELECT doc_id, stratum, len(w) AS n_words, length(regexp_replace(t, '{blank}', '', 'g')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals,
           len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
    FROM lists LEFT JOIN covered USING (doc_id)),
measured AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {cells} FROM counted),
good AS (
    SELECT * FROM measured SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1) x USING (doc_id)
    WHERE NOT base_failed),
cells AS ({unpivot}),
tested AS (
    SELECT stratum, ratio, c, COUNT(*) AS n, COUNT(*) FILTER (cell > c) AS k
    FROM cells, range(0, {grid}) r(c) GROUP BY stratum, ratio, c),
proven AS (
    SELECT *, CASE WHEN k > n * {p} THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
               exp(lgamma(n + 1) - (CASE WHEN i > 0 THEN lgamma(i + 1) ELSE 0 END) - lgamma(n - i + 1)
                   + i * ln({p}) + (n - i) * ln(1 - {p})))) END AS tail,
           {quality_rules.LEVEL} / ({len(names)} * (SELECT COUNT(DISTINCT stratum) FROM good)) AS bound
    FROM tested),
chosen AS (
    SELECT stratum, ratio, coalesce(MAX(c) FILTER (tail > bound), -1) + 1 AS cut
    FROM proven GROUP BY stratum, ratio HAVING cut < {grid}),
limits AS (SELECT stratum, {cuts} FROM chosen GROUP BY stratum),
told AS (SELECT *, concat_ws(',', {broken}) AS broken FROM measured LEFT JOIN limits USING (stratum))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND broken = '' AS kept, broken
FROM told
"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    code = f"hex(encode({text}))"
    pairs = f"list_transform(range(0, length({code}) // 2), lambda i: ('0x' || substring({code}, 2 * i + 1, 2))::BIGINT)"
    bits = "list_reduce(range(0, 8), lambda a, i: xor(a >> 1, 3988292384 * (a & 1)), xor(c, b))"
    return f"xor(list_reduce({pairs}, lambda c, b: {bits}, 4294967295), 4294967295)"


LETTER_TREES = f"""
WITH RECURSIVE runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{url_cascade.UPPER}', '{url_cascade.LOWER}'),
                                             '[A-Za-z\u00C0-\u00FF]+')) AS run
    FROM documents),
counted AS (
    SELECT run, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h, k
    FROM (SELECT doc_id, run, COUNT(*) AS k FROM runs WHERE length(run) >= 6 GROUP BY ALL)),
results AS (
    SELECT CASE WHEN h % 199 <> 0 THEN run
           ELSE substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) END AS word, k
    FROM counted),
words AS (
    SELECT word, CAST(SUM(k) AS BIGINT) AS n FROM results
    WHERE length(word) >= 6 GROUP BY word HAVING SUM(k) >= 5),
less AS (
    SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
    SELECT a.word, b.word AS other, b.n FROM less a JOIN less b
        ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
    UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word),
best AS (
    SELECT word, COUNT(*) AS n_near, MAX(n) AS most, MIN(other) FILTER (top) AS other
    FROM (SELECT *, n = MAX(n) OVER (PARTITION BY word) AS top FROM near) GROUP BY word),
told AS (
    SELECT word, w.n, coalesce(n_near, 0) AS n_near,
           CASE WHEN most >= 5 * w.n THEN other END AS form, CASE WHEN most >= 5 * w.n THEN most END AS form_n
    FROM words w LEFT JOIN best USING (word)),
chains AS (
    SELECT word, word AS here, 0 AS steps FROM told
    UNION ALL SELECT c.word, t.form, steps + 1 FROM chains c JOIN told t ON t.word = c.here WHERE t.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n
FROM told JOIN (SELECT word, arg_max(here, steps) AS root FROM chains GROUP BY word) USING (word)
"""


TRUNCATION_PEELING = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (
    SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST,
                         sha256(length(role) || ':' || role || text)) AS path,
           {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h
    FROM turns GROUP BY conv_id),
rebuilt AS (
    SELECT o.conv_id, list_concat(coalesce(b.path[1:o.h], []), o.path[o.h + 1:]) AS path
    FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100),
prefixes AS (
    SELECT conv_id, path[1:d] AS path, d, len(path) = d AS ends
    FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)),
nodes AS (
    SELECT path, d, MIN(conv_id) AS conv_id, COUNT(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY path, d),
children AS (
    SELECT path[1:d - 1] AS path, d - 1 AS d, COUNT(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
measured AS (
    SELECT nodes.*, coalesce(n, 0) AS n_children,
           CASE WHEN d > 0 THEN (n_convs - 1) * length(path[d].text) ELSE 0 END AS saved
    FROM nodes LEFT JOIN children USING (path, d)),
under AS (
    SELECT path[1:k] AS path, k AS d, SUM(CAST(n_children = 0 AS BIGINT)) AS n_leaves, SUM(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM measured) GROUP BY ALL)
SELECT m.conv_id, m.d AS depth, p.conv_id AS parent_conv_id, m.n_convs, m.n_children,
       CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, m.ends_sha256
FROM measured m JOIN under u USING (path, d) LEFT JOIN nodes p ON p.d = m.d - 1 AND p.path = m.path[1:m.d - 1]
"""


SQL = {
    "op1_suffix_levels": SUFFIX_LEVELS,
    "op2_url_cascade": _url_cascade(),
    "op5_projection_forest": PROJECTION_FOREST,
    "op8_quality_rules": _quality_rules(),
    "op11_letter_trees": LETTER_TREES,
    "op13_truncation_peeling": TRUNCATION_PEELING,
}
