"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from .chat_format import CONTROLS
from .mixing import LARGE, MAX_COPIES, WEIGHTS
from .quality_rules import MAX_REPEAT_PERCENT, MIN_WORDS, STOP_WORDS, THRESHOLDS

_SPLIT = r"regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+')"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _escaped(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c, k in CONTROLS.items():
        out = f"replace({out}, {_quote(c)}, {_quote(chr(92) + k)})"
    return out


OP2 = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length({_escaped('role')}) + length({_escaped('text')}) + {len('<||>') + 1 + len('<|end|>') + 1}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

OP4 = f"""
WITH sized AS (
    SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS tie,
        len(list_filter({_SPLIT}, lambda x: x <> '')) AS size FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
    SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)}
        {' '.join(f'WHEN {i} THEN CAST({w} AS DOUBLE)' for i, w in enumerate(WEIGHTS))} END AS w FROM per),
levels AS (
    SELECT *, {MAX_COPIES} * source_size / w AS ratio,
        CAST(sum(source_size) OVER () AS BIGINT) - CAST(coalesce(sum({MAX_COPIES} * source_size) OVER before, 0) AS BIGINT) AS rest,
        sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS open
    FROM weighed WINDOW before AS (ORDER BY {MAX_COPIES} * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT arg_min(rest / open, (ratio, rest / open)) AS level FROM levels WHERE rest / open <= ratio),
targets AS (
    SELECT source, source_size, least(CAST({MAX_COPIES} * source_size AS DOUBLE), level * w) AS target,
        ('0x' || substr(md5(coalesce('s:' || source, '')), 1, 6))::INTEGER / 16777216.0::DOUBLE AS apart,
        ('0x' || substr(md5(coalesce('s:' || source, '')), 7, 6))::INTEGER / 16777216.0::DOUBLE AS start
    FROM levels, level),
ranked AS (
    SELECT s.*, t.source_size, t.target, t.apart, t.start, s.size * {LARGE} > t.source_size AS large,
        CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
        row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.tie, s.doc_id) - 1 AS rank
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
firsts AS (
    SELECT *, CASE WHEN large THEN least(floor(rate * (rank + 1) + apart) - floor(rate * rank + apart), {MAX_COPIES}) END AS first FROM ranked),
settled AS (
    SELECT source, any_value(target) AS target, coalesce(sum(size * first) FILTER (large), 0) AS gone, coalesce(sum(size) FILTER (NOT large), 0) AS rest
    FROM firsts GROUP BY source),
left_over AS (
    SELECT source, CASE WHEN rest > 0 THEN least(greatest((target - gone) / rest, 0.0::DOUBLE), {MAX_COPIES}::DOUBLE) ELSE 0.0::DOUBLE END AS rate FROM settled),
taken AS (
    SELECT f.*, coalesce(first, least(floor(l.rate * (rank + 1) + start) - floor(l.rate * rank + start), {MAX_COPIES})) AS copies
    FROM firsts f JOIN left_over l ON f.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(size * copies AS BIGINT) AS taken FROM taken
"""

OP5 = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM p JOIN f USING (payload_digest)
"""


def _rule(over: str, under: str, least: float | None, most: float | None) -> str:
    out = []
    if least is not None:
        out.append(f"({under} = 0 OR {over} >= {least}::DOUBLE * {under})")
    if most is not None:
        out.append(f"({under} = 0 OR {over} <= {most}::DOUBLE * {under})")
    return " AND ".join(out)


OP10 = f"""
WITH w AS (
    SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, list_filter({_SPLIT}, lambda x: x <> '') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
g AS (SELECT k, unnest(range(len(words) - 2)) AS pos, words FROM w WHERE len(words) >= 3),
t AS (SELECT k, pos, count(*) OVER (PARTITION BY k, words[pos + 1], words[pos + 2], words[pos + 3]) AS n FROM g),
r AS (SELECT k, count(DISTINCT pos + o) AS n FROM t, (VALUES (0), (1), (2)) AS v(o) WHERE n > 1 GROUP BY k),
c AS (
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(length(array_to_string(words, '')), 0) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
        len(lines) AS n_lines, len(list_filter(words, lambda x: x IN ({', '.join(map(_quote, dict.fromkeys(STOP_WORDS)))}))) AS n_stop_words
    FROM w LEFT JOIN r USING (k)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {' AND '.join(_rule(a, u, lo, hi) for _, a, u, lo, hi in THRESHOLDS)} AS kept
FROM b
"""

ORACLE_SQL = {"op2_chat_formatting": OP2, "op4_mixing": OP4, "op5_warc": OP5, "op10_quality_rules": OP10}
