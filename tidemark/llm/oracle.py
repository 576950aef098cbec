"""The same questions in DuckDB SQL, where SQL can ask them."""

from __future__ import annotations

OP4_CHAT_FORMAT = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), escaped AS (
    SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text,
        '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[NEXT]', '[\NEXT]'), '[ROLE]', '[\ROLE]'),
        '[/ROLE]', '[\/ROLE]'), '<<SYS>>', '<\<SYS>>'), '<</SYS>>', '<\</SYS>>'),
        '[INST]', '[\INST]'), '[/INST]', '[\/INST]') AS safe,
        lag(role) OVER turns AS before
    FROM rows WINDOW turns AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), lengths AS (
    SELECT *, length(safe) + CASE
        WHEN before = role THEN length('[NEXT]')
        WHEN role = 'user' THEN length('<s></s>[INST][/INST]')
        WHEN role = 'system' THEN length('<s></s><<SYS>><</SYS>>')
        WHEN role = 'assistant' THEN length('<s></s>')
        ELSE length('<s></s>[ROLE][/ROLE]' || role) END AS chars
    FROM escaped
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM lengths GROUP BY conv_id
"""

OP2_LINE_DEDUP = r"""
WITH split AS (
    SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents
), lines AS (
    SELECT doc_id, unnest(range(1, len(parts) + 1)) AS line, parts FROM split
), sets AS (
    SELECT doc_id, line, parts[line] AS line_text, list_sort(list_distinct(regexp_extract_all(
        translate(parts[line], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'))) AS w
    FROM lines
), numbered AS (
    SELECT *, row_number() OVER (ORDER BY doc_id, line) AS place FROM sets
), classes AS (
    SELECT w, min(place) AS first, len(w) AS n FROM numbered WHERE len(w) > 0 GROUP BY w
), words AS (
    SELECT first, n, unnest(w) AS word FROM classes
), counted AS (
    SELECT *, count(*) OVER (PARTITION BY word) AS met FROM words
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY first ORDER BY met, word) AS rank FROM counted
), prefixes AS (
    SELECT first, n, word FROM ranked WHERE rank <= n - (75 * n + 99) // 100 + 1
), candidates AS (
    SELECT DISTINCT a.first AS earlier, b.first AS later FROM prefixes a JOIN prefixes b
        ON a.word = b.word AND a.first < b.first AND 100 * a.n >= 75 * b.n AND 100 * b.n >= 75 * a.n
), matched AS (
    SELECT DISTINCT later FROM candidates c JOIN classes a ON a.first = c.earlier JOIN classes b ON b.first = c.later
    WHERE 100 * len(list_intersect(a.w, b.w)) >= 75 * (a.n + b.n - len(list_intersect(a.w, b.w)))
), decided AS (
    SELECT x.*, c.first IS NOT NULL AND (x.place > c.first OR m.later IS NOT NULL) AS goes
    FROM numbered x LEFT JOIN classes c USING (w) LEFT JOIN matched m ON m.later = c.first
), kept AS (
    SELECT doc_id, string_agg(line_text, chr(10) ORDER BY line) FILTER (NOT goes) AS text, count(*) AS n_lines, count_if(goes) AS n_removed
    FROM decided GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN k.n_removed > 0 THEN coalesce(k.text, '') ELSE d.text END AS text,
       CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE k.n_lines END::INTEGER AS n_lines,
       coalesce(k.n_removed, 0)::INTEGER AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

OP5_NGRAM_JACCARD_JOIN = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), places AS (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle FROM places
), sizes AS (
    SELECT doc_id, count(*)::BIGINT AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), reached AS (
    SELECT doc_id AS node, doc_id AS from_id FROM documents
    UNION SELECT l.b, r.from_id FROM reached r JOIN links l ON l.a = r.node
)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.from_id) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reached r ON r.node = d.doc_id GROUP BY d.doc_id
"""

# Base32 of a SHA-1: five hexadecimal digits are four letters.
OP7_WARC = """
WITH hashed AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS digest
    FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM hashed
), numbered AS (
    SELECT *, [('0x' || substr(digest, 5 * j + 1, 5))::INTEGER FOR j IN range(0, 8)] AS parts FROM firsts
)
SELECT page_id, payload_bytes,
       array_to_string([array_to_string(
           [substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> shift) % 32 + 1, 1) FOR shift IN [15, 10, 5, 0]], '')
           FOR v IN parts], '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM numbered
"""

OP9_EXACT_DEDUP = r"""
WITH hashed AS (
    SELECT doc_id, length(coalesce(text, '')) AS n_code_points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), ranked AS (
    SELECT *, row_number() OVER best AS place, first_value(doc_id) OVER best AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM hashed
    WINDOW best AS (PARTITION BY text_sha256 ORDER BY n_code_points DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""

OP11_COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang
), places AS (
    SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM split, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size
), counted AS (
    SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*)::HUGEINT AS f
    FROM places GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE size >= 2
), cuts AS (
    SELECT lang, phrase, size, a, w, unnest(range(1, size)) AS k FROM candidates
), scored AS (
    SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
    FROM cuts c
    JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
    JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:c.size], ' ')
), weakest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), starts AS (
    SELECT lang, a, size, w, part, unnest(range(1, size - part + 2)) AS i
    FROM candidates, (SELECT unnest([2, 3]) AS part) WHERE size > part
), inside AS (
    SELECT lang, array_to_string(w[i:i + part - 1], ' ') AS phrase, max(a) AS longer FROM starts GROUP BY ALL
), kept AS (
    SELECT w.* FROM weakest w LEFT JOIN inside i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * w.a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

OP13_LEXICAL_SEARCH = r"""
WITH words AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents
), counted AS (
    SELECT doc_id, term, count(*)::BIGINT AS tf FROM words GROUP BY ALL
), lengths AS (
    SELECT doc_id, sum(tf)::BIGINT AS n FROM counted GROUP BY doc_id
), totals AS (
    SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM lengths
), norms AS (
    SELECT doc_id, 75 + (25::HUGEINT * n * docs) // terms AS m FROM lengths, totals
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counted, totals GROUP BY term, docs
), asked AS (
    SELECT item_id, term, count(*)::BIGINT AS query_tf
    FROM (SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), scores AS (
    SELECT item_id, doc_id, sum(query_tf * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN counted USING (term) JOIN norms USING (doc_id) GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

SQL: dict[str, str] = {
    "op2_line_dedup": OP2_LINE_DEDUP,
    "op4_chat_format": OP4_CHAT_FORMAT,
    "op5_ngram_jaccard_join": OP5_NGRAM_JACCARD_JOIN,
    "op7_warc": OP7_WARC,
    "op9_exact_dedup": OP9_EXACT_DEDUP,
    "op11_collocations": OP11_COLLOCATIONS,
    "op13_lexical_search": OP13_LEXICAL_SEARCH,
}
