"""DuckDB SQL for the corpus operators that SQL can express."""

SPACES = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORDS = f"""CASE WHEN trim(coalesce(text, ''), {SPACES}) = '' THEN []
  ELSE string_split_regex(trim(coalesce(text, ''), {SPACES}), '[ \\t-\\r]+') END"""

QUALITY_RULES = f"""
WITH RECURSIVE base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS x FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM base)
), twice AS (
  SELECT r, unnest(range(i, i + 8)) AS pos FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1
), repeats AS (SELECT r, count(DISTINCT pos) AS n FROM twice GROUP BY r),
lines AS (
  SELECT r, i, l, {WORDS.replace('text', 'l')} AS lw
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM base)
), full_lines AS (
  SELECT *, row_number() OVER (PARTITION BY r, l ORDER BY i) AS nth FROM lines WHERE len(lw) > 0
), judged AS (
  SELECT r, i, l, lw, nth,
    len(list_filter(['all rights reserved', 'copyright (c)', 'privacy policy', 'terms of use', 'terms of service', 'cookie policy',
      'cookie settings', 'accept cookies', 'accept all cookies', 'sign up for', 'subscribe to our', 'click here to', 'enable javascript',
      'powered by', 'skip to content', 'skip to main content', 'share on', 'share this on'], lambda x: contains(lower(l), x))) > 0
    OR (len(lw) < 4 AND NOT regexp_matches(l, '[.!?:;…。]["'')\\]]?[ \\t-\\r]*$'))
    OR 100 * len(regexp_extract_all(l, '\\||»|›|→|::')) > 25 * len(lw)
    OR 100 * len(regexp_extract_all(l, '[!?][!?]')) > 30 * len(lw)
    OR 100 * len(regexp_extract_all(l, '[#*$%&|<>]')) > 10 * length(array_to_string(lw, '')) AS fails
  FROM full_lines
), by_text AS (
  SELECT r, count(*) FILTER (nth > 1) AS dups,
    coalesce(sum(len(lw)) FILTER (nth = 1 AND NOT fails), 0) AS clean_words
  FROM judged GROUP BY r
), figures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dups, 0)::BIGINT AS n_dup_lines,
    coalesce(repeats.n, 0)::BIGINT AS n_repeat_words, coalesce(clean_words, 0)::BIGINT AS clean_words
  FROM base LEFT JOIN repeats USING (r) LEFT JOIN by_text USING (r)
), failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM figures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * clean_words >= 60 * n_words AS kept, clean_words
FROM failed
"""

SOURCE_MIXING = f"""
WITH docs AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size, md5('0:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents
), sources AS (SELECT source, sum(size)::HUGEINT AS s FROM docs GROUP BY source),
weighed AS (SELECT source, s, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::HUGEINT AS w FROM sources),
ordered AS (
  SELECT source, s, w, (SELECT sum(s) FROM weighed) - 3 * coalesce(sum(s) OVER before, 0) AS free,
    sum(w) OVER (ORDER BY s::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS others,
    row_number() OVER (ORDER BY s::DOUBLE / w, source NULLS LAST) AS nth
  FROM weighed
  WINDOW before AS (ORDER BY s::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), stop AS (SELECT min(nth) AS nth FROM ordered WHERE NOT 3 * s * others < w * free),
rest AS (SELECT free, others FROM ordered JOIN stop USING (nth)),
shares AS (
  SELECT source, s, CASE WHEN ordered.nth < stop.nth THEN (3 * s)::DOUBLE
    ELSE (w * (SELECT free FROM rest))::DOUBLE / (SELECT others FROM rest)::DOUBLE END AS target
  FROM ordered, stop
), plans AS (
  SELECT *, CASE WHEN s > 0 THEN floor(target / s::DOUBLE)::BIGINT ELSE 0 END AS times FROM shares
), placed AS (
  SELECT doc_id, size, s, target, times, target - times * s AS rest,
    sum(size) OVER (PARTITION BY docs.source ORDER BY key) AS reach, sum(size) OVER (PARTITION BY docs.source, key) AS held
  FROM docs JOIN plans ON docs.source IS NOT DISTINCT FROM plans.source
)
SELECT doc_id, size, s::BIGINT AS source_size, target,
  (size * (times + CASE WHEN rest > 0 AND 2 * reach - held <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""

JACCARD_JOIN = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), split AS (SELECT doc_id, {WORDS} AS w FROM docs),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM split WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * shared >= 75 * (a.n + b.n - shared)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON reach.other = links.x
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
"""

CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS tab
)"""


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, with a row of ``crc_table`` at hand."""
    raw = f"hex(encode({text}))"
    octets = f"list_transform(range(length({raw}) // 2), lambda i: ('0x' || substr({raw}, 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"


PERIODIC_RUNS = f"""
WITH {CRC_TABLE}, split AS (
  SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w, {crc32("coalesce(doc_id::VARCHAR, '')")} AS h, tab FROM documents, crc_table
), planned AS (
  SELECT r, doc_id, w, len(w) AS n, doc_id IS NOT NULL AND h % 10 = 0 AND len(w) > 0 AS planted, (h // 10) % greatest(len(w), 1) AS a, h // 10 AS g FROM split
), docs AS (
  SELECT r, doc_id, n, CASE WHEN planted THEN w[1:a] || list_transform(range(n - a), lambda i: w[a + i % (1 + (n - a) // (3 + g % 8)) + 1]) ELSE w END AS w
  FROM planned
), places AS (SELECT r, unnest(w) AS word, unnest(range(n)) AS i FROM docs),
grams AS (
  SELECT r, i, list(word) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS gram FROM places
), keyed AS (SELECT r, i, hash(gram) AS k, gram FROM grams WHERE len(gram) = 6),
-- a run of 12 words or more has equal six-word windows one period apart, all along
same AS (SELECT x.r, x.i, y.i - x.i AS q FROM keyed x JOIN keyed y ON x.r = y.r AND x.k = y.k AND x.i < y.i AND x.gram = y.gram),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM same),
stretches AS (SELECT r, q, min(i) AS start, max(i) - min(i) + 6 + q AS length FROM islands GROUP BY r, q, island),
runs AS (SELECT r, start, length, min(q) AS period FROM stretches WHERE length >= greatest(12, 2 * q) GROUP BY r, start, length),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(concat_ws(',', start, length, period) || chr(10), '' ORDER BY start, period) AS lines,
    arg_max({{'s': start, 'n': length, 'p': period}}, (length, -start, -period)) AS best
  FROM runs GROUP BY r
), dropped AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM places ANTI JOIN dropped USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.n::BIGINT AS length, best.p::BIGINT AS period,
  floor(1000 * best.n / best.p)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""

IMPORTANCE_RESAMPLING = f"""
WITH {CRC_TABLE}, texts AS (
  SELECT row_number() OVER () AS r, doc_id, text, true AS own FROM documents UNION ALL SELECT NULL, NULL, text, false FROM benchmark
), found AS (
  SELECT r, doc_id, own, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
), words AS (SELECT r, own, unnest(w) AS word FROM found),
buckets AS (SELECT word, {crc32('word')} % 10000 AS b FROM (SELECT DISTINCT word FROM words), crc_table),
hashed AS (SELECT r, own, b FROM words JOIN buckets USING (word)),
counts AS (
  SELECT k AS b, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM range(10000) x(k) LEFT JOIN hashed ON b = k GROUP BY k
), gains AS (
  SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM counts
), summed AS (SELECT r, sum(gain)::BIGINT AS weight FROM hashed JOIN gains USING (b) WHERE own GROUP BY r),
scored AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, len(w) >= 20 AS ready,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM found LEFT JOIN summed USING (r) WHERE own
), ranked AS (SELECT *, row_number() OVER (ORDER BY ready DESC, score DESC, doc_id NULLS LAST, weight, n_features) AS nth FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN nth <= floor(10 * (SELECT count(*) FROM scored WHERE ready) / 100) THEN nth END AS rank FROM ranked
"""
