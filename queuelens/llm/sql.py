"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op1_quotes": r"""
        WITH RECURSIVE m AS (
            SELECT row_number() OVER () AS rid, conv_id, turn, role,
                regexp_split_to_array(coalesce(text, ''), '\r?\n') AS lines
            FROM conversations),
        cut AS (
            SELECT rid, conv_id, turn, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM m),
        l AS (
            SELECT rid, conv_id, turn, i,
                length(regexp_replace(regexp_extract(line, '^((?:[ \t]*>)+)', 1), '[^>]', '', 'g')) AS level,
                regexp_replace(line, '^((?:[ \t]*>)+)[ \t]?', '') AS body
            FROM cut),
        n AS (
            SELECT *, level = 0 AND coalesce(lead(level) OVER w, 0) > 0 AND regexp_matches(
                body, '(^|[^\p{L}])(wrote|schrieb|écrit|escribió)\s*:\s*$') AS intro
            FROM l WINDOW w AS (PARTITION BY rid ORDER BY i)),
        own AS (
            SELECT rid, regexp_replace(string_agg(body, chr(10) ORDER BY i), '^\s+|\s+$', '', 'g') AS text
            FROM n WHERE level = 0 AND NOT intro GROUP BY rid),
        t AS (
            SELECT rid, conv_id, turn, i, level, CASE WHEN intro THEN '' ELSE trim(regexp_replace(
                lower(body), '[^\p{L}\p{N}]+', ' ', 'g')) END AS text
            FROM n),
        s AS (
            SELECT *, text <> '' AND (lag(text) OVER w IS NULL OR lag(text) OVER w = ''
                OR lag(level) OVER w <> level) AS begins
            FROM t WINDOW w AS (PARTITION BY rid ORDER BY i)),
        g AS (
            SELECT *, sum(begins::int) OVER (PARTITION BY rid ORDER BY i) AS run FROM s),
        p AS (
            SELECT conv_id, turn, level, text FROM g WHERE text <> ''
            UNION
            SELECT conv_id, turn, level, string_agg(text, ' ' ORDER BY i) FROM g WHERE text <> ''
            GROUP BY rid, conv_id, turn, level, run HAVING count(*) > 1),
        q AS (SELECT * FROM p WHERE level > 0 AND turn IS NOT NULL),
        linked AS (
            SELECT q.conv_id, q.turn, q.level, q.text, max(w.turn) AS source
            FROM q LEFT JOIN p AS w ON w.level = 0 AND w.conv_id IS NOT DISTINCT FROM q.conv_id
                AND w.text = q.text AND w.turn < q.turn
            GROUP BY ALL),
        votes AS (
            SELECT conv_id, turn, level, source, sum(length(text)) AS chars
            FROM linked WHERE source IS NOT NULL GROUP BY ALL),
        parents AS (
            SELECT conv_id, turn, source AS parent FROM votes
            QUALIFY row_number() OVER (PARTITION BY conv_id, turn
                ORDER BY level, chars DESC, source DESC) = 1),
        up AS (
            SELECT conv_id, turn, parent AS root, 1 AS depth FROM parents
            UNION ALL
            SELECT u.conv_id, u.turn, p.parent, u.depth + 1 FROM up u
            JOIN parents p ON p.conv_id IS NOT DISTINCT FROM u.conv_id AND p.turn = u.root),
        roots AS (
            SELECT conv_id, turn, arg_max(root, depth) AS root, max(depth) AS depth FROM up GROUP BY ALL),
        counts AS (
            SELECT conv_id, turn, count(*) AS quoted, count(source) AS found FROM linked GROUP BY ALL),
        j AS (
            SELECT m.conv_id, m.turn, m.role, coalesce(own.text, '') AS text,
                coalesce(c.quoted, 0) AS n_quoted, coalesce(c.found, 0) AS n_linked,
                p.parent AS parent_turn, coalesce(r.root, m.turn) AS root_turn,
                coalesce(r.depth, 0)::BIGINT AS depth
            FROM m LEFT JOIN own USING (rid)
            LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM m.conv_id AND c.turn = m.turn
            LEFT JOIN parents p ON p.conv_id IS NOT DISTINCT FROM m.conv_id AND p.turn = m.turn
            LEFT JOIN roots r ON r.conv_id IS NOT DISTINCT FROM m.conv_id AND r.turn = m.turn)
        SELECT *, row_number() OVER (PARTITION BY conv_id
            ORDER BY (root_turn IS NULL)::int, root_turn, depth, turn,
                sha256(coalesce(role, '') || chr(10) || text)) AS place
        FROM j""",
    "op9_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n
            FROM pages),
        r AS (
            SELECT page_id, html, n,
                CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS largest
            FROM p)
        SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
            CASE WHEN page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN page_id <> largest THEN largest END AS refers_to
        FROM r""",
    "op12_search": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        i AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        c AS (SELECT count(*) FILTER (len(terms) > 0) AS docs, sum(len(terms))::BIGINT AS words FROM d),
        t AS (
            SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM d)
            WHERE term IN (SELECT term FROM i) GROUP BY rid, term),
        w AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
            FROM t, c GROUP BY term, docs),
        s AS (
            SELECT item_id, rid, doc_id, sum(w * ((1000000000 * tf)
                // (1000 * tf + 20 * (50 + (50 * len(terms) * docs) // words))))::BIGINT AS score
            FROM i JOIN w USING (term) JOIN t USING (term) JOIN d USING (rid), c
            GROUP BY item_id, rid, doc_id),
        r AS (
            SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, rid)
                AS rank, doc_id, score
            FROM s WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50""",
    "op13_exact": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_chars,
                sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))
                    AS text_sha256
            FROM documents),
        g AS (
            SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id
            FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_chars DESC, doc_id NULLS LAST))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g""",
}
