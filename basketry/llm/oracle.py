"""The operators as SQL, for those that SQL can express."""

from __future__ import annotations

STATEMENTS: dict[str, str] = {}

# Half of a node's draws, in the order of random digits, are its left child's. The six levels of
# the tree are those of a mix of up to 2**30 words.
_LEVELS = "".join(
    f"""s{k} AS (
  SELECT node, source, number, md5('mix|' || coalesce(source, '-') || '|slot|{k}|' || node || '|' || number) AS key
  FROM (SELECT node, source, unnest(range(1, quota + 1)) AS number FROM l{k})
), r{k} AS (
  SELECT node, source, row_number() OVER (PARTITION BY node ORDER BY key, source, number)
    > count(*) OVER (PARTITION BY node) // 2 AS is_right FROM s{k}
), l{k + 1} AS (
  SELECT node * 2 + is_right::BIGINT AS node, source, count(*) AS quota FROM r{k} GROUP BY 1, 2
), """
    for k in range(6)
)

STATEMENTS["op9_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix|' || coalesce(CAST(doc_id AS VARCHAR), '-')) AS key
  FROM documents
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs,
         row_number() OVER (ORDER BY source ASC NULLS LAST) AS turn
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CAST([5, 2, 1][(turn - 1) % 3 + 1] AS BIGINT) AS weight FROM sums
), levels AS (
  SELECT *,
    (sum(source_size) OVER () * 150
      - 100 * coalesce(sum(source_size * 2) OVER (ORDER BY source_size * (10 // weight), turn
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (100 * sum(weight) OVER (ORDER BY source_size * (10 // weight), turn
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS own_level
  FROM weighed
), aims AS (
  SELECT *, least(source_size * 2.0::DOUBLE, weight * max(own_level) OVER ()) AS target FROM levels
), sources AS (
  SELECT source, source_size, target, least((n_docs + 499) // 500, 4096) AS n_blocks,
    CASE WHEN source_size > 0
      THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS passes,
    CAST(floor(target + 0.5) AS BIGINT) AS words
  FROM aims
), rowed AS (
  SELECT d.*, s.* EXCLUDE (source),
         CAST('0x' || substr(key, 1, 8) AS BIGINT) % n_blocks AS block
  FROM sized d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source
), blocks AS (
  SELECT source, block, CAST(sum(size) AS BIGINT) AS words, any_value(passes) AS passes,
         any_value(words - passes * source_size) AS rest
  FROM rowed GROUP BY source, block
), turns AS (
  SELECT source, block, words, passes, rest, unnest(range(0, passes + 1)) AS turn FROM blocks
), ordered AS (
  SELECT *, md5('mix|' || coalesce(source, '-') || '|block|' || block || '|' || turn) AS place
  FROM turns
), portions AS (
  SELECT *, CASE WHEN turn < passes THEN words ELSE least(words, rest
      - coalesce(sum(words) OVER (PARTITION BY source, turn ORDER BY place, block
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) END AS portion
  FROM ordered
), draws AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY turn, place, block) AS draw_no
  FROM portions WHERE portion > 0
), l0 AS (
  SELECT 0::BIGINT AS node, source, count(*) AS quota FROM draws GROUP BY source
), __LEVELS__ leaves AS (
  SELECT node AS shard, source, unnest(range(last - quota + 1, last + 1)) AS draw_no
  FROM (SELECT *, sum(quota) OVER (PARTITION BY source ORDER BY node)::BIGINT AS last FROM l6)
), dealt AS (
  SELECT d.*, l.shard FROM draws d
  JOIN leaves l ON d.source IS NOT DISTINCT FROM l.source AND d.draw_no = l.draw_no
), rows_in_block AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source, block ORDER BY key, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    row_number() OVER () AS row_no
  FROM rowed
), drawn AS (
  SELECT r.row_no, r.doc_id, r.size, r.source_size, r.target, d.turn, d.shard,
    CASE WHEN d.portion < d.words THEN greatest(least(r.size, d.portion - r.before), 0)
      ELSE r.size END AS taken
  FROM rows_in_block r
  LEFT JOIN dealt d ON r.source IS NOT DISTINCT FROM d.source AND r.block = d.block
)
SELECT any_value(doc_id) AS doc_id, any_value(size) AS size,
  any_value(source_size) AS source_size, any_value(target) AS target,
  CAST(coalesce(sum(taken), 0) AS BIGINT) AS taken,
  coalesce(string_agg(CAST(shard AS VARCHAR), ',' ORDER BY turn) FILTER (taken > 0), '') AS shards
FROM drawn GROUP BY row_no
""".replace("__LEVELS__", _LEVELS)

_MEASURES = [
    ("symbols_per_word", 30),
    ("dup_lines_per_line", 100),
    ("repeats_per_word", 50),
    ("chars_per_word", 500),
]


def _fences(level: str, keys: str, least_count: int) -> str:
    """Quartiles of the passing documents of a group, widened by three spreads."""
    columns = []
    for measure, least in _MEASURES:
        low, high = (
            f"list_sort(list({measure}) FILTER (NOT base_failed))"
            f"[CAST(ceil(count(*) FILTER (NOT base_failed) * {share}) AS BIGINT)]"
            for share in (0.25, 0.75)
        )
        reach = f"3 * greatest({high} - {low}, {least})"
        enough = f"count(*) FILTER (NOT base_failed) >= {least_count}"
        columns.append(f"CASE WHEN {enough} THEN {low} - {reach} END AS {level}_{measure}_low")
        columns.append(f"CASE WHEN {enough} THEN {high} + {reach} END AS {level}_{measure}_high")
    head = f"{keys}, " if keys else ""
    tail = f"GROUP BY {keys}" if keys else ""
    return f"SELECT {head}{', '.join(columns)} FROM measured {tail}"


def _fence(measure: str, end: str) -> str:
    return "coalesce(" + ", ".join(f"{x}_{measure}_{end}" for x in ("grp", "lng", "whole")) + ")"


# The sketches of the operator are exact for values below 2**14, as this is throughout.
STATEMENTS["op6_quality_rules"] = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row_no, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), parts AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), places AS (
  SELECT row_no, words, unnest(range(1, len(words) - 1)) AS i FROM parts
), windows AS (
  SELECT row_no, i, count(*) OVER (PARTITION BY row_no,
    words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) AS times FROM places
), covered AS (
  SELECT row_no, count(DISTINCT i + k) AS n_repeat_words
  FROM windows CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) WHERE times > 1 GROUP BY row_no
), counts AS (
  SELECT p.*, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM parts p LEFT JOIN covered USING (row_no)
), measured AS (
  SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
    n_symbols * 1000 // greatest(n_words, 1) AS symbols_per_word,
    n_dup_lines * 1000 // greatest(len(lines), 1) AS dup_lines_per_line,
    n_repeat_words * 1000 // greatest(n_words, 1) AS repeats_per_word,
    word_chars * 1000 // greatest(n_words, 1) AS chars_per_word
  FROM counts
), by_group AS ({_fences("grp", "lang, source", 100)}),
by_lang AS ({_fences("lng", "lang", 100)}),
of_all AS ({_fences("whole", "", 1)})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
    AND {" AND ".join(f"{m} <= {_fence(m, 'high')}" for m, _ in _MEASURES)}
    AND chars_per_word >= {_fence("chars_per_word", "low")} AS kept
FROM measured d
JOIN by_group g ON d.lang IS NOT DISTINCT FROM g.lang AND d.source IS NOT DISTINCT FROM g.source
JOIN by_lang l ON d.lang IS NOT DISTINCT FROM l.lang CROSS JOIN of_all
"""
