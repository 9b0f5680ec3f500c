"""SQL for the registered queries that SQL can express."""

from __future__ import annotations

from sediment.llm.line_quality import BOILERPLATE

WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SYMBOLS = "'#*$%&|<>'"


def _bare(text: str) -> str:
    return f"length(translate({text}, {WHITE}, ''))"


def _count(text: str, characters: str) -> str:
    return f"(length({text}) - length(translate({text}, {characters}, '')))"


_LINE_WORDS = "len(string_split(trim(line, ' '), ' '))"
_BOILERPLATE = "|".join(BOILERPLATE)


def _centroid_rounds(rounds: int) -> str:
    """Assignment to the nearest centroid, then exact floors of the means, so many times; then assignment."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS (
            SELECT row_id, vec_id, v, c, distance FROM (
                SELECT row_id, vec_id, v, c, distance, row_number() OVER (PARTITION BY row_id ORDER BY distance, c) AS n
                FROM (
                    SELECT row_id, vec_id, kept.v, c{i}.c, list_sum(list_transform(list_zip(kept.v, c{i}.v),
                        lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
                    FROM kept, c{i}))
            WHERE n = 1)""")
        if i < rounds:
            steps.append(f"""
        m{i} AS (
            SELECT c, list(m ORDER BY d) AS v FROM (
                SELECT c, d, ((s - ((s % n) + n) % n) // n)::BIGINT AS m FROM (
                    SELECT c, d, sum(x)::BIGINT AS s, count(*) AS n FROM (
                        SELECT c, unnest(v) AS x, unnest(range(1, 65)) AS d FROM a{i})
                    GROUP BY c, d))
            GROUP BY c),
        c{i + 1} AS (SELECT c{i}.c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))""")
    return ",".join(steps)


ORACLE = {
    "op2_exact_dedup": """
        WITH rows AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
            FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
            count(*) OVER (PARTITION BY norm) AS group_size,
            doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
        FROM rows""",
    "op3_substring_dedup": """
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        windows AS (
            SELECT doc_id, i, row_number() OVER (PARTITION BY part ORDER BY doc_id, i) AS n
            FROM (
                SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS part
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d))),
        removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM windows WHERE n > 1),
        gone AS (SELECT doc_id, list(p) AS ps FROM removed GROUP BY doc_id),
        placed AS (
            SELECT doc_id, w, ps, list_zip(w, range(1, len(w) + 1)) AS z FROM d LEFT JOIN gone USING (doc_id))
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
            sha256(CASE WHEN ps IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
                list_transform(list_filter(z, lambda x: NOT list_contains(ps, x[2])), lambda x: x[1]), ' ') END) AS kept_sha256
        FROM placed""",
    "op7_line_quality": f"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
            FROM documents),
        windows AS (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, part) AS n
            FROM (
                SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS part
                FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d))),
        repeated AS (
            SELECT doc_id, count(DISTINCT p) AS n
            FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM windows WHERE n > 1) GROUP BY doc_id),
        lines AS (
            SELECT doc_id, line, {_bare("line")} AS bare
            FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
        judged AS (
            SELECT doc_id, line, bare, bare > 0 AND (
                {_count("line", SYMBOLS)} * 100 > bare * 10
                OR {_count("line", "'!?'")} > {_LINE_WORDS} * 0.5
                OR {_count("line", "'|'")} >= 2
                OR ({_LINE_WORDS} <= 12 AND regexp_matches(lower(line), '{_BOILERPLATE}'))) AS fails
            FROM lines),
        by_doc AS (
            SELECT doc_id, count(*) FILTER (WHERE bare > 0) - count(DISTINCT line) FILTER (WHERE bare > 0) AS n_dup_lines,
                count(*) FILTER (WHERE fails) AS n_failed_lines,
                coalesce(sum(bare) FILTER (WHERE fails), 0)::BIGINT AS lost_chars
            FROM judged GROUP BY doc_id),
        counted AS (
            SELECT d.doc_id, len(w)::BIGINT AS n_words, {_bare("t")}::BIGINT AS word_chars,
                {_count("t", SYMBOLS)}::BIGINT AS n_symbols, n_dup_lines,
                coalesce(repeated.n, 0) AS n_repeat_words, n_failed_lines, lost_chars
            FROM d JOIN by_doc USING (doc_id) LEFT JOIN repeated USING (doc_id))
        SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
            NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * lost_chars <= 50 * word_chars AS kept
        FROM counted""",
    "op13_centroid_clusters": f"""
        WITH kept AS (
            SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        c0 AS (
            SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
            FROM (SELECT v, coalesce(sha256('1:' || vec_id), 'null') AS h FROM kept ORDER BY h, v LIMIT 16)),{_centroid_rounds(3)}
        SELECT vec_id, c::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
            (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c3.v, ',')) AS centroid_sha256
        FROM a3 JOIN c3 USING (c)""",
    "op11_prefix_trie": """
        WITH crc_table AS (
            SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
        turns AS (
            SELECT conv_id, sha256(length(role) || ':' || role || text) AS step, length(text) AS chars,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS p
            FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
            WHERE conv_id IS NOT NULL),
        convs AS (
            SELECT conv_id, list(step ORDER BY p) AS steps, list(chars ORDER BY p) AS chars FROM turns GROUP BY conv_id),
        lengths AS (
            SELECT conv_id, xor(list_reduce(list_prepend(4294967295, list_transform(
                string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
            FROM convs, crc_table),
        paths AS (
            SELECT c.conv_id, coalesce(list_slice(o.steps, 1, h), []) || list_slice(c.steps, h + 1, len(c.steps)) AS steps,
                coalesce(list_slice(o.chars, 1, h), []) || list_slice(c.chars, h + 1, len(c.chars)) AS chars
            FROM convs c JOIN lengths USING (conv_id) LEFT JOIN convs o ON o.conv_id = c.conv_id - c.conv_id % 100),
        prefixes AS (
            SELECT conv_id, d, array_to_string(list_slice(steps, 1, d), '') AS key,
                array_to_string(list_slice(steps, 1, d - 1), '') AS up, len(steps) = d AS ends,
                CASE WHEN d = 0 THEN 0 ELSE chars[d] END AS chars
            FROM (SELECT *, unnest(range(0, len(steps) + 1)) AS d FROM paths)),
        nodes AS (
            SELECT key, d, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n, min(chars) AS chars,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
            FROM prefixes GROUP BY key, d),
        children AS (SELECT up AS key, d - 1 AS d, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY ALL),
        counted AS (SELECT nodes.*, coalesce(kids, 0) AS kids FROM nodes LEFT JOIN children USING (key, d)),
        below AS (
            SELECT u.key, u.d, count(*) FILTER (WHERE v.kids = 0) AS n_leaves, sum((v.n - 1) * v.chars)::BIGINT AS saved
            FROM counted u JOIN counted v ON starts_with(v.key, u.key) GROUP BY u.key, u.d)
        SELECT c.conv_id, c.d::BIGINT AS depth, parent.conv_id AS parent_conv_id, c.n AS n_convs, c.kids AS n_children,
            n_leaves, saved AS saved_tokens, c.ends_sha256
        FROM counted c JOIN below USING (key, d) LEFT JOIN counted parent ON c.d > 0 AND parent.key = c.up AND parent.d = c.d - 1""",
}
