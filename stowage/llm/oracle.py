"""The queries of this package that SQL can express, for another engine over the same tables."""

ORACLE = {
    "op3_line_dedup": """
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
three AS (
  SELECT doc_id, pos, line AS a, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c FROM lines
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
later AS (
  SELECT doc_id, pos FROM three WHERE c IS NOT NULL AND trim(a) || trim(b) || trim(c) <> ''
  QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) > 1),
covered AS (SELECT DISTINCT doc_id, pos + k AS pos FROM later, (VALUES (0), (1), (2)) s(k)),
cut AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
         CAST(count(*) FILTER (WHERE gone) AS INTEGER) AS lines_removed
  FROM (SELECT l.*, c.pos IS NOT NULL AS gone FROM lines l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.pos = c.pos)
  GROUP BY doc_id)
SELECT d.doc_id, c.text, coalesce(c.lines_removed, 0) AS lines_removed FROM documents d LEFT JOIN cut c USING (doc_id)
""",
    "op4_warc": """
WITH own AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
digests AS (SELECT page_id, body, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS holder FROM own)
SELECT page_id, octet_length(encode(body)) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
         (CAST('0x' || substr(hex, 1 + 5 * (k // 4), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31 AS INTEGER), 1)
         FOR k IN range(32)], '')
         AS payload_digest,
       CASE WHEN page_id = holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> holder THEN holder END AS refers_to
FROM digests
""",
    "op11_exact_dedup": """
WITH own AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM own WINDOW w AS (PARTITION BY text_sha256)
""",
    "op12_phrases": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS own FROM pieces),
totals AS (SELECT lang, CAST(sum(len(own)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(own[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, own, k, unnest(range(1, len(own) - k + 2)) AS i FROM words, range(1, 6) s(k) WHERE len(own) >= k)),
counted AS (SELECT lang, phrase, any_value(k) AS k, count(*) AS f FROM grams GROUP BY lang, phrase HAVING count(*) >= 100),
found AS (SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS own FROM counted WHERE k > 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(own[i:i + j - 1], ' ') AS phrase
    FROM (SELECT lang, a, own, j, unnest(range(1, k - j + 2)) AS i FROM found, range(2, 5) t(j) WHERE j < k)) GROUP BY lang, phrase),
outer_most AS (SELECT o.* FROM found o LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
cuts AS (
  SELECT lang, phrase, a, c, array_to_string(own[1:c], ' ') AS head, array_to_string(own[c + 1:k], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS c FROM outer_most)),
scored AS (
  SELECT x.lang, x.phrase, a, c, l.f AS l, r.f AS r, n, CAST((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts x JOIN counted l ON l.lang = x.lang AND l.phrase = head JOIN counted r ON r.lang = x.lang AND r.phrase = tail
  JOIN totals t ON t.lang = x.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1)
SELECT lang, row_number() OVER w AS rank, phrase, a, l, r, n, score FROM lowest
WINDOW w AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER w <= 2000
""",
    "op13_ranked_search": r"""
WITH own AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
sized AS (SELECT doc_id, terms, len(terms) AS n FROM own WHERE len(terms) > 0),
held AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS tokens FROM sized),
tfs AS (SELECT doc_id, any_value(n) AS n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(terms) AS term FROM sized) GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, held GROUP BY term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // tokens)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tfs USING (term), held GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER w <= 10
""",
}
