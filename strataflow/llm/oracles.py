"""DuckDB SQL for the results of operators whose main path is in Python."""

from __future__ import annotations

SUFFIX_DEDUP = r"""
WITH bytes AS (
    SELECT doc_id, encode(coalesce(text, '')) AS data, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), windows AS (
    SELECT doc_id, place, md5(data[place:place + 399]) AS content
    FROM (SELECT doc_id, data, unnest(range(1, n - 398)) AS place FROM bytes WHERE n >= 400)
), repeated AS (
    SELECT doc_id, place FROM windows QUALIFY count(*) OVER (PARTITION BY content) > 1
), runs AS (
    SELECT doc_id, min(place) AS first, max(place) + 399 AS last FROM (
        SELECT doc_id, place, sum(fresh) OVER (PARTITION BY doc_id ORDER BY place) AS run FROM (
            SELECT doc_id, place, CASE WHEN place - lag(place, 1, -1000) OVER (PARTITION BY doc_id ORDER BY place) > 400 THEN 1 ELSE 0 END AS fresh
            FROM repeated)) GROUP BY doc_id, run
), gaps AS (
    SELECT doc_id, coalesce(lag(last) OVER w, 0) + 1 AS first, runs.first - 1 AS last FROM runs WINDOW w AS (PARTITION BY doc_id ORDER BY first)
    UNION ALL SELECT doc_id, max(last) + 1, max(n) FROM runs JOIN bytes USING (doc_id) GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(hex(data[first:last]), '' ORDER BY first) AS text FROM gaps JOIN bytes USING (doc_id) WHERE first <= last GROUP BY doc_id
), counted AS (
    SELECT doc_id, sum(last - first + 1) AS gone, count(*) AS spans FROM runs GROUP BY doc_id
)
SELECT b.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
       CASE WHEN spans IS NULL THEN sha256(data) ELSE sha256(unhex(coalesce(kept.text, ''))) END AS kept_sha256
FROM bytes b LEFT JOIN counted USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE split AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(words, place, place + 4), ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS place FROM split WHERE len(words) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
), components AS (
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, place, md5(array_to_string(list_slice(words, place, place + 34), ' ')) AS content
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS place FROM split)
), repeated AS (
    SELECT doc_id, place FROM (SELECT doc_id, place, count(*) OVER (PARTITION BY content) AS copies FROM windows) WHERE copies > 1
), covered AS (
    SELECT DISTINCT doc_id, place + step AS place FROM repeated, range(0, 35) AS r(step)
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
    FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM split) ANTI JOIN covered USING (doc_id, place)
    GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SOURCE_DIVERGENCE = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS place, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), occurring AS (
    SELECT DISTINCT lang, source FROM docs
), found AS (
    SELECT place, lang, source, unnest(terms) AS term FROM docs
), kept AS (
    SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM found GROUP BY lang, term HAVING count(DISTINCT place) >= 10
), langs AS (
    SELECT lang, sum(n) AS n, count(*) AS v FROM kept GROUP BY lang
), counted AS (
    SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (
    SELECT o.lang, o.source, coalesce(sum(n), 0) AS n FROM occurring o LEFT JOIN counted USING (lang, source) GROUP BY ALL
), shares AS (
    SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (t.n + 2 * l.v) AS HUGEINT) AS p,
           CAST(1 + (1000000000 * (k.n + 2)) // (l.n + 2 * l.v) AS HUGEINT) AS q
    FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counted c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM occurring a JOIN occurring b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR rank <= 10
"""

RANKED_SEARCH = rf"""
WITH docs AS (
    SELECT doc_id, row_number() OVER () AS place,
           regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), lengths AS (
    SELECT doc_id, place, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0
), whole AS (
    SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(n) AS BIGINT) AS total FROM lengths
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), held AS (
    SELECT place, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT place, unnest(terms) AS term FROM docs)
    SEMI JOIN asked USING (term) GROUP BY ALL
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(whole.n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, whole GROUP BY term
), scored AS (
    SELECT item_id, place, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * l.n * whole.n) // whole.total)))) AS BIGINT) AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN lengths l USING (place), whole GROUP BY item_id, place
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scored JOIN lengths USING (place) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
