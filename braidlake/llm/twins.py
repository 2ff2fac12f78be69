"""SQL twins, for DuckDB, of the queries that SQL can express."""

WORDS = "list_filter(string_split_regex(coalesce({text}, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')"
LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Links are all pairs of equal lines or of lines with enough common shingles; components by reach.
LINES = r"""
WITH RECURSIVE lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS no
    FROM documents
), compared AS (
    SELECT *, dense_rank() OVER (ORDER BY line) AS node FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), classes AS (
    SELECT node, any_value(line) AS line, min((doc_id, no)) AS first FROM compared GROUP BY node
), shingles AS (
    SELECT DISTINCT node, hash(substr(line, i, 8)) AS s
    FROM (SELECT node, line, unnest(range(1, greatest(1, length(line) - 7) + 1)) AS i FROM classes)
), sizes AS (
    SELECT node, count(*) AS n FROM shingles GROUP BY node
), links AS (
    SELECT p.a, p.b
    FROM (SELECT x.node AS a, y.node AS b, count(*) AS c
          FROM shingles x JOIN shingles y ON x.s = y.s AND x.node <> y.node GROUP BY ALL) p
    JOIN sizes m ON m.node = p.a JOIN sizes n ON n.node = p.b
    WHERE c / (m.n + n.n - c) >= 0.8
), reach(node, other) AS (
    SELECT a, b FROM links UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.other
), roots AS (
    SELECT node, least(node, coalesce(min(other), node)) AS root
    FROM classes LEFT JOIN reach USING (node) GROUP BY node
), stays AS (
    SELECT root, min(first) AS first FROM roots JOIN classes USING (node) GROUP BY root
), marked AS (
    SELECT l.doc_id, l.no, l.line, s.first IS NOT NULL AND (l.doc_id, l.no) <> s.first AS gone
    FROM lines l LEFT JOIN compared c ON c.doc_id = l.doc_id AND c.no = l.no
    LEFT JOIN roots r ON r.node = c.node LEFT JOIN stays s ON s.root = r.root
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       md5(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS text_md5
FROM marked GROUP BY doc_id
"""

NEAR = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, {WORDS.format(text=LOWER)} AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
    SELECT p.a, p.b
    FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
          FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL) p
    JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b
    WHERE 100 * c >= 80 * (m.n + n.n - c)
), reach(doc_id, other) AS (
    SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), roots AS (
    SELECT d.doc_id, least(d.doc_id, coalesce(min(other), d.doc_id)) AS component_id
    FROM documents d LEFT JOIN reach USING (doc_id) GROUP BY d.doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM roots LEFT JOIN sizes USING (doc_id)
"""

REPEATS = f"""
WITH words AS (
    SELECT doc_id, {WORDS.format(text="text")} AS w FROM documents
), windows AS (
    SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50)
), least AS (
    SELECT s, min(doc_id) AS first FROM windows GROUP BY s
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS at
    FROM windows JOIN least USING (s) WHERE first < doc_id
), each AS (
    SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS at FROM words
), kept AS (
    SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.at) FILTER (c.at IS NULL) AS text, count(c.at) AS n
    FROM each e LEFT JOIN covered c ON c.doc_id = e.doc_id AND c.at = e.at GROUP BY e.doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM words d LEFT JOIN kept k USING (doc_id)
"""

URLS = r"""
WITH parts AS (
    SELECT page_id, url, lower(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's')) AS host,
           regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path,
           regexp_extract(coalesce(url, ''), '^.*?://[^?#]*\?([^#]*)', 1, 's') AS args
    FROM pages
), named AS (
    SELECT *, CASE WHEN host = '' THEN NULL ELSE
        regexp_replace(regexp_replace(host, ':(?:80|443)?$', ''), '^www\.', '')
        || regexp_replace(regexp_replace(path, '/index\.html?$', '/'), '/+$', '')
        || CASE WHEN bare = '' THEN '' ELSE '?' || bare END END AS canonical
    FROM (SELECT *, regexp_replace(regexp_replace(args, '(?:^|&)(?:utm_[a-z]+|ref|gclid|fbclid)=[^&]*', '', 'g'), '^&', '') AS bare
          FROM parts)
), listed AS (
    SELECT DISTINCT canonical FROM named WHERE substr(md5(url), 1, 1) < '8'
), rules(rule, verdict, rule_host, rule_path) AS (
    VALUES ('org/', 'allow', 'org', '/'), ('example.org/es/', 'block', 'example.org', '/es/'),
           ('example.org/en/1', 'block', 'example.org', '/en/1'), ('com/fr/', 'allow', 'com', '/fr/'),
           ('com/de/', 'block', 'com', '/de/')
), fitting AS (
    SELECT n.page_id, n.host, n.path, n.canonical IN (SELECT canonical FROM listed WHERE canonical IS NOT NULL) AS listed,
           r.rule, r.verdict,
           row_number() OVER (PARTITION BY n.page_id ORDER BY length(r.rule) DESC NULLS LAST, r.rule) AS k
    FROM named n LEFT JOIN rules r
      ON (n.host = r.rule_host OR ends_with(n.host, '.' || r.rule_host)) AND starts_with(n.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(listed, false) AS listed
FROM fitting WHERE k = 1
"""

MIX = """
WITH totals AS (
    SELECT source, CAST(sum(length(text)) AS DOUBLE) AS total FROM documents GROUP BY source
), whole AS (
    SELECT sum(total) AS whole, sum(pow(total, 0.5)) AS weights FROM totals
), means AS (
    SELECT source, CASE WHEN total > 0 THEN pow(total, 0.5) / weights * whole / total ELSE 0 END AS rate
    FROM totals CROSS JOIN whole
), pieces AS (
    SELECT source, CAST(greatest(ceil(rate / 16), 1) AS INT) AS n, rate / greatest(ceil(rate / 16), 1) AS mean FROM means
), below AS (
    SELECT source, k, sum(CASE WHEN mean > 0 THEN exp(k * ln(mean) - mean - lgamma(k + 1)) ELSE CAST(k = 0 AS INT) END)
               OVER (PARTITION BY source ORDER BY k) AS c
    FROM pieces, range(100) AS t(k)
), draws AS (
    SELECT d.doc_id, d.source, d.text, i,
           (CAST('0x' || substr(md5(concat_ws(':', coalesce(CAST(d.doc_id AS VARCHAR), ''), '17', 'n', CAST(i AS VARCHAR))), 1, 13)
                 AS BIGINT) + 0.5) / pow(2, 52) AS u
    FROM documents d JOIN (SELECT source, unnest(range(1, n + 1)) AS i FROM pieces) p ON p.source IS NOT DISTINCT FROM d.source
), counts AS (
    SELECT doc_id, w.source, text, i, count(b.k) AS n
    FROM draws w LEFT JOIN below b ON b.source IS NOT DISTINCT FROM w.source AND b.c < w.u GROUP BY ALL
), copies AS (
    SELECT doc_id, source, text, sum(n) AS n_copies FROM counts GROUP BY ALL
)
SELECT doc_id, source, copy, CAST(n_copies AS BIGINT) AS n_copies,
       md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(copy AS VARCHAR), '17:order')) AS shuffle_key,
       md5(text) AS text_md5
FROM (SELECT *, unnest(range(1, CAST(n_copies AS BIGINT) + 1)) AS copy FROM copies)
"""

# Every query against every row.
NEAREST = """
WITH points AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), ranked AS (
    SELECT q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.v, p.v) AS BIGINT) AS score,
           row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, p.v) DESC, p.vec_id) AS rank
    FROM points q JOIN points p ON p.vec_id <> q.vec_id
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# Dense: every group with every kept term of its language.
DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source
    FROM documents
), words AS (
    SELECT doc, lang, source, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
), kept AS (
    SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 10
), vocabulary AS (
    SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), sources AS (
    SELECT DISTINCT lang, source FROM docs
), counts AS (
    SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (
    SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL
), shares AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
           CAST(1 + 1000000000 * (coalesce(c.n, 0)::HUGEINT + 2) // (coalesce(t.total, 0) + 2 * v.v) AS BIGINT) AS p,
           CAST(1 + 1000000000 * (k.n::HUGEINT + 2) // (v.total + 2 * v.v) AS BIGINT) AS q
    FROM sources s JOIN kept k ON k.lang = s.lang JOIN vocabulary v ON v.lang = s.lang
    LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
    LEFT JOIN totals t ON t.lang = s.lang AND t.source = s.source
), sums AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL
), parts AS (
    SELECT s.lang, s.source, 'pair' AS part, o.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
    FROM sources s JOIN sources o ON o.lang = s.lang AND o.source <> s.source
    LEFT JOIN sums v ON v.lang = s.lang AND v.source = s.source AND v.item = o.source
    UNION ALL
    SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
WHERE part = 'pair' OR rank <= 10
"""


def licenses_sql(notices: dict[str, str]) -> str:
    """Every template against every window of every text."""
    rows = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in sorted(notices.items()))
    tokens = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda t: t <> '')"
    pairs = "CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END"
    return f"""
WITH known AS (
    SELECT license, len(w) AS n, list_distinct({pairs}) AS shingles
    FROM (SELECT license, {tokens} AS w FROM (VALUES {rows}) AS v(license, text))
), texts AS (
    SELECT doc_id, {pairs} AS p FROM (SELECT doc_id, {tokens} AS w FROM documents) WHERE len(w) > 0
), likely AS (
    SELECT * FROM texts CROSS JOIN known WHERE len(list_intersect(shingles, p)) / len(shingles) >= 0.92
), places AS (
    SELECT *, unnest(list_distinct(list_append(range(1, greatest(1, len(p) - 6) + 1, 4), greatest(1, len(p) - 6)))) AS spot
    FROM likely
), judged AS (
    SELECT doc_id, license,
           len(list_intersect(shingles, list_slice(p, greatest(1, spot - n), greatest(1, spot - n) + 7 + 2 * n))) / len(shingles) AS part
    FROM places
)
SELECT doc_id, license, max(part) AS containment FROM judged WHERE part >= 0.92 GROUP BY ALL
"""
