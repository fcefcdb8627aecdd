"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

from lakegate.llm import line_quality

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_LINE = line_quality


def _any(test: str, values: tuple[str, ...]) -> str:
    return " OR ".join(test.format("'" + v.replace("'", "''") + "'") for v in values)


_BLANKS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
_WORD = r"[^\x20\x09-\x0D]+"

ORACLES = {
    "op3_decontaminate": rf"""
WITH item AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
item_window AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)
),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
doc_window AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM item_window))
),
found AS (SELECT doc_id, i, item_window.n, item_id FROM doc_window JOIN item_window USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY ALL),
owner AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY ALL)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN owner USING (doc_id)
""",
    "op4_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
    doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""",
    "op9_warc": """
WITH page AS (
    SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS keep
    FROM pages
)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
        (CAST('0x' || substr(h, 1 + 5 * CAST(i // 4 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31
    AS BIGINT), 1) for i in range(0, 32)], '') AS payload_digest,
    CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM page
""",
    "op11_line_quality": rf"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
line AS (
    SELECT r, i, raw, trim(raw, {_BLANKS}) AS line, regexp_extract_all(raw, '{_WORD}') AS w
    FROM (SELECT r, unnest(range(1, len(ls) + 1)) AS i, unnest(ls) AS raw
          FROM (SELECT r, string_split(text, chr(10)) AS ls FROM doc))
    WHERE regexp_matches(raw, '{_WORD}')
),
ruled AS (
    SELECT r, w, row_number() OVER (PARTITION BY r, raw ORDER BY i) > 1 AS again,
        CASE WHEN len(w) < 30 AND NOT ({_any("ends_with(line, {})", _LINE.LINE_ENDS)}) THEN 1
             WHEN 100 * len(regexp_extract_all(line, '[#*$%&|<>]')) > 10 * len(w) THEN 1
             WHEN len(regexp_extract_all(line, '[!?]{{2,}}')) >= 3 THEN 1
             WHEN len(regexp_extract_all(line, '[{"".join(_LINE.SEPARATORS)}]')) >= 2 THEN 2
             WHEN len(w) <= 4 AND ({_any("starts_with(low, {})", _LINE.MENU_WORDS)}) THEN 2
             WHEN {_any("contains(low, {})", _LINE.BOILERPLATE)} THEN 3 ELSE 0 END AS rule
    FROM (SELECT *, translate(line, '{_UPPER}', '{_LOWER}') AS low FROM line)
),
lines AS (
    SELECT r, count(*) AS n_lines, count(*) FILTER (again) AS n_dup_lines, count(*) FILTER (rule = 1) AS n_punctuation,
        count(*) FILTER (rule = 2) AS n_navigation, count(*) FILTER (rule = 3) AS n_boilerplate,
        coalesce(CAST(sum(length(array_to_string(w, ''))) FILTER (rule > 0) AS BIGINT), 0) AS lost_chars
    FROM ruled GROUP BY r
),
win AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, g) AS times
    FROM (
        SELECT r, i, n, concat_ws(' ', t, {", ".join(f"lead(t, {k}) OVER word" for k in range(1, 8))}) AS g
        FROM (SELECT r, len(w) AS n, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS i FROM doc)
        WINDOW word AS (PARTITION BY r ORDER BY i)
    ) WHERE i <= n - 7
),
again AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM win WHERE times > 1) GROUP BY r
),
base AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_punctuation, 0) AS n_punctuation, coalesce(n_navigation, 0) AS n_navigation,
        coalesce(n_boilerplate, 0) AS n_boilerplate, coalesce(lost_chars, 0) AS lost_chars
    FROM doc LEFT JOIN lines USING (r) LEFT JOIN again USING (r)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * lost_chars <= 50 * word_chars AS kept
FROM base
""",
    "op12_lexical_search": rf"""
WITH item AS (SELECT item_id, text, unnest({_WORDS}) AS t FROM (SELECT DISTINCT item_id, coalesce(text, '') AS text FROM benchmark)),
query AS (SELECT item_id, text, t, count(*) AS times FROM item GROUP BY ALL),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
total AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM doc WHERE len(w) > 0),
held AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM doc) GROUP BY r, t),
found AS (SELECT * FROM held WHERE t IN (SELECT t FROM query)),
weight AS (
    SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT t, count(*) AS df FROM found GROUP BY t), total
),
part AS (
    SELECT r, doc_id, t, weight.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(doc.w) * docs) // terms))) AS v
    FROM found JOIN doc USING (r) JOIN weight USING (t), total
),
score AS (
    SELECT item_id, text, r, doc_id, CAST(sum(times * v) AS BIGINT) AS score FROM part JOIN query USING (t)
    GROUP BY item_id, text, r, doc_id
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INTEGER) AS rank
    FROM score WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""",
}


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
