"""DuckDB statements for the registered queries that SQL can express."""

from __future__ import annotations

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"



def _shingles(table: str, key: str) -> str:
    """``key, shingle``: the distinct runs of five words of every text, or its only run."""
    return f"""
        SELECT {key}, unnest(list_distinct(list_transform(
                   range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1),
                   lambda i: array_to_string(ws[i:i + 4], ' ')))) AS shingle
        FROM (SELECT {key}, list_filter(string_split_regex(translate(coalesce(text, ''), {_UPPER}),
                                                           '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
              FROM {table})
    """


ORACLE_SQL: dict[str, str] = {
    "op2_chat_format": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), escaped AS (
            SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') AS safe_text,
                   replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'),
                           ':', '\:') AS safe_role
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
                   AS loss_sha256,
               sum(length(safe_role) + length(safe_text)
                   + length('### ') + length(': ') + length('</turn>' || chr(10)))::BIGINT AS formatted_chars
        FROM escaped GROUP BY conv_id
    """,
    "op3_decontamination": f"""
        WITH held AS ({_shingles("documents", "doc_id")}),
        wanted AS ({_shingles("benchmark", "item_id")}),
        sets AS (SELECT item_id, count(*) AS n, list_sort(list(shingle)) AS all_of_it FROM wanted GROUP BY item_id),
        items AS (SELECT min(item_id) AS item_id, n FROM sets GROUP BY all_of_it, n)
        SELECT h.doc_id, i.item_id, i.n AS n_item_shingles, count(*) AS n_shared
        FROM held h JOIN wanted w USING (shingle) JOIN items i ON i.item_id = w.item_id
        GROUP BY h.doc_id, i.item_id, i.n HAVING 100 * count(*) >= 80 * i.n
    """,
    "op6_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
        ), keyed AS (
            SELECT doc_id, pos, line, translate(trim(line, {_BLANKS}), {_UPPER}) AS key FROM lines
        ), common AS (
            SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        ), marked AS (
            SELECT k.doc_id, k.pos, k.line, c.key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c USING (key)
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op9_jaccard_join": f"""
        WITH RECURSIVE held AS ({_shingles("documents", "doc_id")}),
        sizes AS (SELECT doc_id, count(*) AS n FROM held GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
            FROM held a JOIN held b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
        ),
        links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * n_both >= 80 * (x.n + y.n - n_both)
        ),
        reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b)
        SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles,
               least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
        FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id
    """,
    "op11_hard_negatives": """
        WITH good AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, a.label AS anchor_label, c.vec_id, c.label,
                   list_inner_product(a.v, c.v)::BIGINT AS score
            FROM good a, good c WHERE a.vec_id % 100 = 0
        ), positives AS (
            SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score
            FROM scored WHERE label = anchor_label AND vec_id <> anchor_id
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id,
               row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
               s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
        WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
        QUALIFY rank <= 10
    """,
    "op13_fingerprints": f"""
        WITH texts AS (
            SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM documents
        ), pairs AS (
            SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first(text) OVER (ORDER BY doc_id)) AS next FROM texts
        ), edits AS (
            SELECT *, left(text, n_chars - n_chars // 2) || left(next, n_chars // 2) AS edited FROM pairs
        ), each AS (
            SELECT doc_id, 'own' AS what, text AS t FROM edits UNION ALL SELECT doc_id, 'next', next FROM edits
            UNION ALL SELECT doc_id, 'edited', edited FROM edits
        ), word_lists AS (
            SELECT doc_id, what, list_filter(string_split_regex(translate(t, {_UPPER}), '[\\x20\\x09-\\x0D]+'),
                                             lambda w: w <> '') AS ws FROM each
        ), digests AS (
            SELECT doc_id, what, list_transform(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1),
                                                lambda i: md5(array_to_string(ws[i:i + 4], ' '))[1:16]) AS ds
            FROM word_lists
        ), sketches AS (
            SELECT doc_id, what, CASE WHEN len(list_filter(ds, lambda d: d < '4')) > 0
                THEN list_sort(list_distinct(list_filter(ds, lambda d: d < '4'))) ELSE list_sort(ds)[1:1] END AS ds
            FROM digests
        ), sides AS (
            SELECT o.doc_id, o.ds AS o, e.ds AS e, n.ds AS n
            FROM (FROM sketches WHERE what = 'own') o JOIN (FROM sketches WHERE what = 'edited') e USING (doc_id)
            JOIN (FROM sketches WHERE what = 'next') n USING (doc_id)
        )
        SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, array_to_string(o, '') AS fingerprint,
               array_to_string(e, '') AS edited_fingerprint,
               CASE WHEN least(len(o), len(e)) = 0 THEN (len(o) = len(e))::INT::DOUBLE
                    ELSE len(list_intersect(o, e)) / least(len(o), len(e)) END AS near_edited,
               CASE WHEN least(len(o), len(n)) = 0 THEN (len(o) = len(n))::INT::DOUBLE
                    ELSE len(list_intersect(o, n)) / least(len(o), len(n)) END AS near_next
        FROM edits JOIN sides USING (doc_id)
    """,
}
