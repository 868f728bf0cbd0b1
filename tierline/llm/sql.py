"""The same results in SQL, where SQL can express them."""

EXACT = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept,
       sha256(content) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY content)
"""

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1 AS BIGINT) AS rank
  FROM sized GROUP BY source
),
limits AS (
  SELECT *, CAST([3, 1, 2][rank % 3 + 1] AS DOUBLE) AS weight,
         CAST([1.5, 0.5, 1.0][rank % 3 + 1] AS DOUBLE) AS early,
         CAST([0.5, 1.5, 1.0][rank % 3 + 1] AS DOUBLE) AS late,
         source_size * CAST(2 AS DOUBLE) AS most
  FROM ranked
),
levels AS (
  SELECT *, most / weight AS fills,
         (CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE)
          - coalesce(sum(most) OVER (ORDER BY most / weight, rank
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, rank
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS candidate
  FROM limits
),
targets AS (
  SELECT *, coalesce(least(most, weight * max(CASE WHEN candidate <= fills THEN candidate END) OVER ()),
                     most) AS target
  FROM levels
),
starts AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.early, t.late,
         CAST(floor(t.target) AS BIGINT) AS demand,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY t.rank ORDER BY s.place, s.doc_id, s.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
shares AS (
  SELECT *, CAST(start AS DOUBLE) / target * (early + late) / 2 AS share FROM starts
)
SELECT doc_id, size, source_size, target,
       CAST(demand // greatest(source_size, 1) * size
         + greatest(0, least(size, demand - demand // greatest(source_size, 1) * source_size - start))
         AS BIGINT) AS taken,
       CASE WHEN size > 0 AND start < demand
            THEN 2 * share / (early + sqrt(greatest(0.0, early * early + 2 * (late - early) * share)))
       END AS position
FROM shares
"""

WARC = r"""
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100
                 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
  FROM sized
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM firsts
"""

SEARCH = r"""
WITH words AS (
  SELECT doc_id, row AS doc, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT doc_id, text, row_number() OVER () AS row FROM documents)
),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
lengths AS (SELECT doc, count(*) AS n FROM words GROUP BY doc),
sizes AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
counts AS (SELECT doc_id, doc, term, count(*) AS tf FROM words GROUP BY doc_id, doc, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * max(docs) + 2 AS DOUBLE)
                                    / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counts, sizes GROUP BY term
),
scored AS (
  SELECT a.item_id, c.doc_id, c.doc,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM counts c JOIN asked a USING (term) JOIN weights USING (term) JOIN lengths USING (doc), sizes
  GROUP BY a.item_id, c.doc_id, c.doc
),
ranked AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (
           PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

PHRASES = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^.,;:!?\x0A-\x0D]+')) AS piece
    FROM documents
  )
),
places AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
  FROM pieces, (VALUES (1), (2), (3), (4)) lengths(k)
  WHERE len(w) >= k
),
counts AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM places GROUP BY lang, k, phrase
),
sizes AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND a >= 30
),
cuts AS (
  SELECT lang, k, phrase, a, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:k], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates)
),
scored AS (
  SELECT c.lang, c.phrase, c.a, h.a AS l, t.a AS r, j,
         CAST(c.a AS HUGEINT) * 2000000 // (CAST(h.a AS HUGEINT) + t.a) AS score
  FROM cuts c
  JOIN counts h ON h.lang = c.lang AND h.phrase = c.head
  JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail
),
weakest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
),
inside AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - size + 2)) AS i
        FROM (SELECT *, unnest(range(2, k)) AS size FROM candidates WHERE k > 2))
  GROUP BY ALL
),
ranked AS (
  SELECT lang, phrase, w.a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, w.a DESC, phrase COLLATE "binary") AS rank
  FROM weakest w LEFT JOIN inside USING (lang, phrase)
  WHERE longer IS NULL OR CAST(longer AS HUGEINT) * 100 < CAST(w.a AS HUGEINT) * 80
)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang)
WHERE rank <= 2000
"""

STATEMENTS: dict[str, str] = {
    "op7_mix": MIX,
    "op9_exact_dedup": EXACT,
    "op10_warc": WARC,
    "op11_reversed_search": SEARCH,
    "op13_son_phrases": PHRASES,
}
