"""Training-data queries once more as SQL, where SQL can express them."""

from __future__ import annotations

from .hosts import BOUND, LIMIT, LOWER, STRONGEST, TWO_LABEL_SUFFIXES, UPPER, WEAKEST
from .minhash import PERCENT

_SUFFIXES = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)


def _strength(groups: str, mean: str) -> str:
    return f"""
        SELECT CASE WHEN r > 0 THEN least(greatest(1 / r - 1, {WEAKEST}::DOUBLE), {STRONGEST}::DOUBLE)
                    ELSE {STRONGEST}::DOUBLE END AS k
        FROM (SELECT CASE WHEN sum(n * (n - 1) * {mean} * (1 - {mean})) > 0
                          THEN sum(pow(bad - n * {mean}, 2) - n * {mean} * (1 - {mean}))
                               / sum(n * (n - 1) * {mean} * (1 - {mean})) ELSE 0 END AS r
              FROM {groups})"""


_HOSTS = f"""
    WITH parts AS (
        SELECT page_id,
               coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
               coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages),
    named AS (
        SELECT *, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS two,
               array_to_string(list_slice(string_split(host, '.'), -3, -1), '.') AS three,
               string_split(host, '.')[-1] AS one
        FROM parts),
    seen AS (
        SELECT page_id, host, path, CASE WHEN two IN ({_SUFFIXES}) THEN three ELSE two END AS "domain",
               CASE WHEN two IN ({_SUFFIXES}) THEN two ELSE one END AS suffix
        FROM named),
    labelled AS (
        SELECT s.*, CASE WHEN coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 THEN 1 ELSE 0 END AS bad
        FROM seen s JOIN labels l ON s.page_id = l.doc_id WHERE host <> ''),
    h0 AS (SELECT host, "domain", suffix, count(*) AS n, sum(bad) AS bad FROM labelled GROUP BY ALL),
    d0 AS (SELECT "domain", suffix, sum(n) AS n, sum(bad) AS bad FROM h0 GROUP BY ALL),
    s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d0 GROUP BY ALL),
    world AS (SELECT (coalesce(sum(bad), 0) + 1)::DOUBLE / (coalesce(sum(n), 0) + 2) AS m0,
                     (coalesce(sum(n), 0) + 2)::DOUBLE AS mass0 FROM s0),
    s1 AS (SELECT s0.*, m0 FROM s0, world),
    ks AS ({_strength("s1", "m0")}),
    s2 AS (SELECT s1.*, (bad + m0 * k) / (n + k) AS m1, n + k AS mass1 FROM s1, ks),
    d1 AS (SELECT d0.*, m1 FROM d0 JOIN s2 USING (suffix)),
    kd AS ({_strength("d1", "m1")}),
    d2 AS (SELECT d1.*, (bad + m1 * k) / (n + k) AS m2, n + k AS mass2 FROM d1, kd),
    h1 AS (SELECT h0.*, m2 FROM h0 JOIN d2 ON h0."domain" = d2."domain" AND h0.suffix = d2.suffix),
    kh AS ({_strength("h1", "m2")}),
    h2 AS (SELECT h1.*, (bad + m2 * k) / (n + k) AS m3, n + k AS mass3 FROM h1, kh),
    judged AS (
        SELECT s.page_id, s.host, s.path, coalesce(m3, m2, m1, m0) AS m,
               CASE WHEN m3 IS NOT NULL THEN mass3 WHEN m2 IS NOT NULL THEN mass2
                    WHEN m1 IS NOT NULL THEN mass1 ELSE mass0 END AS mass
        FROM seen s LEFT JOIN (SELECT host, m3, mass3 FROM h2) h ON s.host = h.host
        LEFT JOIN (SELECT "domain", m2, mass2 FROM d2) d ON s."domain" = d."domain"
        LEFT JOIN (SELECT suffix, m1, mass1 FROM s2) x ON s.suffix = x.suffix, world),
    ruled AS (
        SELECT *, CASE
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
            WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
            WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
            WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS "rule"
        FROM judged)
    SELECT page_id, host, path, "rule",
           CASE WHEN "rule" IN ('net/', 'example.com/de/') THEN 'block' WHEN "rule" IS NOT NULL THEN 'allow'
                WHEN host <> '' AND m - {BOUND} * sqrt(m * (1 - m) / (mass + 1)) > {LIMIT} THEN 'block'
                ELSE 'allow' END AS verdict
    FROM ruled"""

_NEAR_COPIES = f"""
    WITH RECURSIVE split AS (
        SELECT doc_id, list_filter(regexp_split_to_array(
                   translate(coalesce("text", ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
        FROM documents),
    runs AS (
        SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: list_slice(ws, i, i + 4))
                            WHEN len(ws) > 0 THEN [ws] ELSE [] END AS runs
        FROM split),
    shingles AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(runs) AS shingle FROM runs),
    sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS MATERIALIZED (
        SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
        WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
    reached AS (
        SELECT doc_id AS a, doc_id AS b FROM documents
        UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
    groups AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM documents d JOIN groups g ON d.doc_id = g.doc_id LEFT JOIN sizes s ON d.doc_id = s.doc_id"""

_NEGATIVES = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        list_inner_product(a.v, b.v)::BIGINT AS score
    FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
    s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""

_REPEATS = """
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), placed AS (
    SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS pos FROM texts WHERE len(words) >= 20
), windows AS (
    SELECT doc_id, pos, array_to_string(words[pos:pos + 19], ' ') AS seq FROM placed
), later AS (
    SELECT doc_id, pos FROM windows
    QUALIFY row_number() OVER (PARTITION BY seq ORDER BY doc_id, pos) > 1
), gone AS (
    SELECT doc_id, list(DISTINCT place) AS places
    FROM (SELECT doc_id, unnest(range(pos, pos + 20)) AS place FROM later) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
    sha256(array_to_string(
        CASE WHEN places IS NULL THEN words
        ELSE list_transform(list_filter(list_zip(words, range(1, len(words) + 1)), lambda x: NOT list_contains(places, x[2])), lambda x: x[1]) END, ' '
    )) AS kept_sha256
FROM texts LEFT JOIN gone USING (doc_id)
"""

_PHRASES = """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]'
    )) AS piece
    FROM documents
), numbered AS (
    SELECT lang, row_number() OVER () AS piece_id, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), places AS (
    SELECT lang, piece_id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM numbered
), runs AS (
    SELECT lang, word AS a, lead(word, 1) OVER here AS b, lead(word, 2) OVER here AS c, lead(word, 3) OVER here AS d
    FROM places WINDOW here AS (PARTITION BY piece_id ORDER BY pos)
), counted AS MATERIALIZED (
    SELECT lang, [a] AS p, count(*)::BIGINT AS f FROM runs GROUP BY ALL
    UNION ALL SELECT lang, [a, b], count(*)::BIGINT FROM runs WHERE b IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, [a, b, c], count(*)::BIGINT FROM runs WHERE c IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, [a, b, c, d], count(*)::BIGINT FROM runs WHERE d IS NOT NULL GROUP BY ALL
), totals AS (
    SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE len(p) = 1 GROUP BY lang
), candidates AS MATERIALIZED (
    SELECT * FROM counted WHERE f >= 30 AND len(p) >= 2
), parts AS MATERIALIZED (
    SELECT lang, p, f AS a, k, p[:k] AS first_part, p[k + 1:] AS rest
    FROM candidates, (VALUES (1), (2), (3)) ks(k) WHERE k < len(p)
), cuts AS (
    SELECT c.lang, c.p, c.a, k, l.f AS l, r.f AS r,
        (2000000::HUGEINT * c.a // (l.f::HUGEINT + r.f))::BIGINT AS score
    FROM parts c
    JOIN counted l ON l.lang = c.lang AND l.p = c.first_part
    JOIN counted r ON r.lang = c.lang AND r.p = c.rest
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inside AS (
    SELECT lang, p[i:i + size - 1] AS p, max(f) AS most
    FROM candidates, (VALUES (1), (2), (3)) starts(i), (VALUES (2), (3)) sizes(size)
    WHERE size < len(p) AND i + size - 1 <= len(p) GROUP BY ALL
), kept AS (
    SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score
    FROM scored LEFT JOIN inside USING (lang, p)
    WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang)
QUALIFY rank <= 2000
"""

ORACLES = {"op1_hyperminhash": _NEAR_COPIES, "op2_host_reputation": _HOSTS,
    "op11_hard_negatives": _NEGATIVES,
    "op12_repeated_passages": _REPEATS,
    "op13_phrases": _PHRASES,
}
