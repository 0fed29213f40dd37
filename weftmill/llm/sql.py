"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

MIX = r"""
WITH doc AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS BIGINT) AS size
  FROM documents
), src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source IS NULL, CAST(encode(source) AS BLOB)) - 1 AS place
  FROM doc GROUP BY source
), needs AS (
  SELECT *, [3.0, 1.0, 2.0][place % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS top,
         2.0::DOUBLE * source_size / [3.0, 1.0, 2.0][place % 3 + 1]::DOUBLE AS need
  FROM src
), upto AS (
  SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS all_words,
         sum(top) OVER (ORDER BY need, place ROWS UNBOUNDED PRECEDING) - top AS before,
         sum(weight) OVER () - sum(weight) OVER (ORDER BY need, place ROWS UNBOUNDED PRECEDING) + weight AS weights_left
  FROM needs
), flags AS (
  SELECT *, all_words - before >= need * weights_left AS capped FROM upto
), levels AS (
  SELECT *, (all_words - coalesce(sum(CASE WHEN capped THEN top END) OVER (), 0))
            / sum(CASE WHEN NOT capped THEN weight END) OVER () AS level
  FROM flags
), targets AS (
  SELECT source, source_size, place, CASE WHEN capped THEN top ELSE weight * level END AS target FROM levels
), sums AS (
  SELECT d.*, t.source_size, t.target, t.place,
         sum(size) OVER (PARTITION BY d.source
           ORDER BY CASE WHEN size > t.source_size / 256.0 THEN 0 ELSE 1 END,
                    CASE WHEN size > t.source_size / 256.0 THEN -size ELSE 0 END, key, size
           ROWS UNBOUNDED PRECEDING) - size AS start
  FROM doc d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), demands AS (
  SELECT *, (start + size / 2.0::DOUBLE) / target AS d0, (source_size + start + size / 2.0::DOUBLE) / target AS d1 FROM sums
), times AS (
  SELECT *, {first} AS t0, {second} AS t1 FROM demands
)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies,
       round(list_extract(held, 1), 9) AS position, round(list_extract(held, 2), 9) AS second_position
FROM (SELECT *, len(held) AS copies FROM (SELECT *, list_filter([t0, t1], lambda t: t IS NOT NULL) AS held FROM times))
"""



def _time(d: str) -> str:
    """The schedules (steady, falling, rising) integrated and inverted: the time of demand `d`, null from 1 on."""
    falling = f"""CASE WHEN 2 * {d} - 0 < 1.25 THEN 0 + (sqrt(9 + 2.0 * -2.0 * greatest(2 * {d} - 0, 0)) - 3) / -2.0
         WHEN 2 * {d} - 1.25 < 0.75 THEN 0.5 + (sqrt(4 + 2.0 * -2.0 * greatest(2 * {d} - 1.25, 0)) - 2) / -2.0 END"""
    rising = f"""CASE WHEN 2 * {d} - 0 < 0.75 THEN 0 + (sqrt(1 + 2.0 * 2.0 * greatest(2 * {d} - 0, 0)) - 1) / 2.0
         WHEN 2 * {d} - 0.75 < 1.25 THEN 0.5 + (sqrt(4 + 2.0 * 2.0 * greatest(2 * {d} - 0.75, 0)) - 2) / 2.0 END"""
    return f"CASE WHEN target > 0 THEN CASE place % 3 WHEN 0 THEN CASE WHEN {d} < 1 THEN {d} END WHEN 1 THEN {falling} ELSE {rising} END END"


DEDUP = r"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


RULES = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w
  FROM documents
), tok AS (
  SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM doc
), win AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n
  FROM (SELECT r, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o || ' ' || lead(word, 5) OVER o || ' ' || lead(word, 6) OVER o || ' ' || lead(word, 7) OVER o AS g
        FROM tok WINDOW o AS (PARTITION BY r ORDER BY i))
  WHERE g IS NOT NULL
), rep AS (
  SELECT r, sum(least(8, coalesce(i - before, 8))) AS n_repeat_words
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM win WHERE n > 1) GROUP BY r
), counts AS (
  SELECT d.r, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines FROM doc) d
  LEFT JOIN rep ON d.r = rep.r
), flags AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         100 * n_symbols > 50 * n_words OR 100 * n_dup_lines > 10 * n_words
         OR word_chars < 2 * n_words OR word_chars > 20 * n_words AS soft
  FROM counts
), hosts AS (
  SELECT source, count(*) AS n, sum(CASE WHEN base_failed OR soft THEN 1 ELSE 0 END) AS f FROM flags GROUP BY source
), prior AS (
  SELECT sum(f) / sum(n) AS mean, var_pop(f / n) - (sum(f) / sum(n)) * (1 - sum(f) / sum(n)) * avg(1.0::DOUBLE / n) AS between_
  FROM hosts
), weights AS (
  SELECT mean, CASE WHEN between_ > 0 THEN least(greatest(mean * (1 - mean) / between_ - 1, 1.0), 1e6) ELSE 1e6 END AS weight FROM prior
), rates AS (
  SELECT source, (f + weight * mean) / (n + weight) AS rate,
         least(greatest(mean + 2.0::DOUBLE * sqrt(mean * (1 - mean) / (weight + 1)), 0.3::DOUBLE), 0.8::DOUBLE) AS bar
  FROM hosts, weights
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate <= bar AS kept
FROM flags JOIN rates ON flags.source IS NOT DISTINCT FROM rates.source
"""


NEGATIVES = r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(coalesce(list_sum(list_transform(range(1, least(len(a.v), len(b.v)) + 1), lambda i: a.v[i] * b.v[i])), 0) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same
  AND 100 * score BETWEEN 30 * positive_score AND 90 * positive_score
QUALIFY rank <= 10
"""


def statements() -> dict[str, str]:
    return {"op3_curriculum_mix": MIX.replace("{first}", _time("d0")).replace("{second}", _time("d1")), "op7_host_rules": RULES, "op9_cuckoo_dedup": DEDUP, "op12_threshold_negatives": NEGATIVES}
