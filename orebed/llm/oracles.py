"""SQL counterparts of the training-data queries, where SQL can express the result."""

from __future__ import annotations

#: The 256 steps of the CRC-32 of bytes, from its reversed polynomial.
_CRC_TABLE = """
    crc_steps AS (
        SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step
    )
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes; `step` of crc_steps must be in reach."""
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: ('0x' || hex(encode({text}))[2 * i + 1:2 * i + 2])::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295)"


EXACT_DEDUP = r"""
    WITH d AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
        FROM documents
    ), g AS (
        SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
    FROM d JOIN g USING (text_sha256)
"""

#: Near words meet where both give the same word without one letter, at the same place or as one of them.
SPELLING = f"""
    WITH RECURSIVE {_CRC_TABLE}, runs AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
        WHERE length(run) >= 5
        GROUP BY ALL
    ), hashed AS (
        SELECT run, n, {_crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs, crc_steps
    ), words AS (
        SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
            sum(n)::BIGINT AS n
        FROM hashed GROUP BY 1 HAVING sum(n) >= 3 AND length(word) >= 5
    ), shorter AS (
        SELECT word, n, place, left(word, place) || substr(word, place + 2) AS part
        FROM (SELECT word, n, unnest(range(length(word))) AS place FROM words)
    ), near AS (
        SELECT DISTINCT a.word, b.word AS other, b.n AS other_n
        FROM shorter a JOIN shorter b ON a.part = b.part AND a.place = b.place AND a.word <> b.word
        UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.part = w.word
        UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.part = w.word
    ), best AS (
        SELECT word, count(*) AS n_near, arg_min(other, (-other_n, encode(other))) AS other, max(other_n) AS other_n
        FROM near GROUP BY word
    ), forms AS (
        SELECT w.word, CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form, w.n, coalesce(n_near, 0) AS n_near,
            CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
        FROM words w LEFT JOIN best b USING (word)
    ), steps AS (
        SELECT word, word AS at FROM forms
        UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.at WHERE f.form IS NOT NULL
    )
    SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n
    FROM forms f JOIN steps s USING (word) JOIN forms e ON e.word = s.at WHERE e.form IS NULL
"""

_WORDS = r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
#: Every window of a document, of each length that occurs, meets the items' windows as text.
CONTAMINATION = f"""
    WITH d AS (
        SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS w FROM documents
    ), items AS (
        SELECT item_id, w, least(10, len(w)) AS k FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0
    ), windows AS (
        SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS part
        FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM items)
    ), placed AS (
        SELECT row, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM windows)
    ), met AS (
        SELECT p.row, p.p, p.k, i.item_id
        FROM placed p JOIN windows i ON p.k = i.k AND array_to_string(p.w[p.p:p.p + p.k - 1], ' ') = i.part
    ), hit AS (
        SELECT row, count(DISTINCT q) AS n_hit FROM (SELECT row, unnest(range(p, p + k)) AS q FROM met) GROUP BY row
    ), named AS (
        SELECT row, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
        FROM (SELECT DISTINCT row, item_id::VARCHAR AS name FROM met WHERE item_id IS NOT NULL) GROUP BY row
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""

#: Cheapest edits row by row: per row and state the cheapest edits so far, of equal ones the
#: least. State 0 is nothing yet, 1 a system row, 2 a user's, 3 an assistant's.
CONVERSATIONS = f"""
    WITH RECURSIVE {_CRC_TABLE}, raw AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
        FROM conversations, crc_steps
    ), damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM raw WHERE kind <> 0
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS k,
            rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
        FROM damaged
    ), judged AS (
        SELECT *, left(role, 1) AS initial, trimmed = '' AS blank,
            trimmed <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS duplicate,
            lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal
        FROM placed
    ), faults AS (
        SELECT *, NOT blank AND NOT duplicate AND right(trimmed, 1) NOT IN ('.', '!', '?') AS truncated FROM judged
    ), summed AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
            count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
        FROM faults GROUP BY conv_id
    ), talks AS (
        SELECT row_number() OVER () AS c, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)
    ), steps AS (
        SELECT t.c, k, role, initial, text, blank OR duplicate AS gone, CASE WHEN truncated THEN 3 ELSE 0 END AS extra
        FROM faults f JOIN talks t ON t.conv_id IS NOT DISTINCT FROM f.conv_id
    ), inserts(state, cost, letters, rows, "to") AS (
        VALUES (0, 0, '', [], 0), (0, 3, 'I', ['user:'], 2), (0, 6, 'II', ['user:', 'assistant:'], 3),
            (1, 0, '', [], 1), (1, 3, 'I', ['user:'], 2), (1, 6, 'II', ['user:', 'assistant:'], 3),
            (2, 0, '', [], 2), (2, 3, 'I', ['assistant:'], 3), (3, 0, '', [], 3), (3, 3, 'I', ['user:'], 2)
    ), moves(state, letter, initial, "to") AS (
        VALUES (0, 'D', NULL, 0), (1, 'D', NULL, 1), (2, 'D', NULL, 2), (3, 'D', NULL, 3),
            (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (2, 'K', 'a', 3), (3, 'K', 'u', 2),
            (0, 'R', NULL, 2), (1, 'R', NULL, 2), (2, 'R', NULL, 3), (3, 'R', NULL, 2)
    ), costs AS (
        SELECT c, 0::BIGINT AS k, 0 AS state, {{'cost': 0, 'audit': '', 'lines': []::VARCHAR[]}} AS best FROM talks
        UNION ALL
        SELECT w.c, s.k, m."to", min({{
            'cost': w.best.cost + i.cost + CASE m.letter WHEN 'D' THEN 4 WHEN 'K' THEN s.extra ELSE 3 + s.extra END,
            'audit': w.best.audit || i.letters || m.letter,
            'lines': w.best.lines || i.rows || CASE m.letter WHEN 'D' THEN [] WHEN 'K' THEN [s.role || ':' || s.text]
                ELSE [CASE m."to" WHEN 2 THEN 'user:' ELSE 'assistant:' END || s.text] END
        }})
        FROM costs w JOIN steps s ON s.c = w.c AND s.k = w.k + 1
        JOIN inserts i ON i.state = w.state
        JOIN moves m ON m.state = i."to" AND (m.letter = 'D' OR NOT s.gone) AND (m.initial IS NULL OR m.initial = s.initial)
        GROUP BY w.c, s.k, m."to"
    ), ends AS (
        SELECT w.c, w.k, min({{'cost': w.best.cost + i.cost, 'audit': w.best.audit || i.letters, 'lines': w.best.lines || i.rows}}) AS best
        FROM costs w JOIN inserts i ON i.state = w.state AND i."to" IN (0, 3)
        GROUP BY w.c, w.k
    ), final AS (
        SELECT c, arg_max(best, k) AS best FROM ends GROUP BY c
    )
    SELECT t.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
        coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, f.best.cost::BIGINT AS cost,
        f.best.audit AS audit, sha256(array_to_string(f.best.lines, chr(10))) AS repaired_sha256
    FROM talks t JOIN final f USING (c) LEFT JOIN summed s ON s.conv_id IS NOT DISTINCT FROM t.conv_id
"""


def oracles() -> dict[str, str]:
    return {
        "op4_heavy_hitter_dedup": EXACT_DEDUP,
        "op11_pivotal_grams": SPELLING,
        "op12_suffix_automaton": CONTAMINATION,
        "op13_block_tables": CONVERSATIONS,
    }
