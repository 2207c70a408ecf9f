"""SQL for the operators' queries that SQL can express, over the same tables."""

from __future__ import annotations

# Only A to Z change case.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP4 = """
WITH payload AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
digest AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM payload),
record AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN nullif(min(page_id) OVER (PARTITION BY payload_digest), page_id) END AS refers_to
  FROM digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM record"""

OP6 = f"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')][:len(words)]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) END AS shingles
  FROM listed),
held AS (SELECT doc_id, unnest(shingles) AS shingle FROM shingled),
pair AS (
  SELECT a.doc_id AS one, b.doc_id AS two, count(*) AS shared
  FROM held a JOIN held b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
  SELECT one, two FROM pair JOIN shingled a ON a.doc_id = one JOIN shingled b ON b.doc_id = two
  WHERE 100 * shared >= 75 * (len(a.shingles) + len(b.shingles) - shared)),
step AS (SELECT one, two FROM link UNION ALL SELECT two, one FROM link),
reach AS (
  SELECT doc_id, doc_id AS other FROM shingled
  UNION SELECT reach.doc_id, step.two FROM reach JOIN step ON step.one = reach.other)
SELECT doc_id, CAST(len(any_value(shingles)) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM shingled JOIN reach USING (doc_id) GROUP BY doc_id"""

OP11 = f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
spoken AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM piece),
gram AS (
  SELECT lang, m, unnest(list_transform(range(1, len(words) - m + 2), lambda i: array_to_string(words[i:i + m - 1], ' '))) AS phrase
  FROM spoken, (VALUES (1), (2), (3)) AS lengths(m) WHERE len(words) >= m),
counted AS (SELECT lang, m, phrase, count(*) AS f FROM gram GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE m = 1 GROUP BY lang),
candidate AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS words FROM counted WHERE m > 1 AND f >= 10),
cut AS (
  SELECT lang, phrase, a, k, array_to_string(words[1:k], ' ') AS head, array_to_string(words[k + 1:], ' ') AS tail
  FROM candidate, (VALUES (1), (2)) AS cuts(k) WHERE k < m),
scored AS (
  SELECT cut.lang, cut.phrase, a, k, h.f AS l, t.f AS r,
    CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score
  FROM cut JOIN counted h ON h.lang = cut.lang AND h.phrase = head JOIN counted t ON t.lang = cut.lang AND t.phrase = tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
holder AS (
  SELECT lang, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase, a AS longer
  FROM candidate WHERE m = 3),
kept AS (
  SELECT * FROM best WHERE NOT EXISTS (
    SELECT 1 FROM holder WHERE holder.lang = best.lang AND holder.phrase = best.phrase AND 100 * longer >= 50 * a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""

LLM_ORACLES = {"op4_warc_chunks": OP4, "op6_signature_trees": OP6, "op11_fm_phrases": OP11}
