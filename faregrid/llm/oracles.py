"""SQL of the corpus queries that SQL can express, written from their definitions."""

from __future__ import annotations

from faregrid.llm.mixing import BITS, BLOCK, GOLDEN, MOST_EPOCHS, WEIGHTS
from faregrid.llm.phrases import FIRST, FREQUENT, LONGEST, UND
from faregrid.llm.quality import RULES, STOP_WORDS, SYMBOLS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _bounds(rule) -> str:
    parts = [f"{rule.measure} >= {rule.low}"] if rule.low is not None else []
    parts += [f"{rule.measure} <= {rule.high}"] if rule.high is not None else []
    return " AND ".join(parts)


def quality_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    measures = {
        "n_letter_words": r"len(list_filter(ws, lambda w: regexp_matches(w, '\p{L}')))",
        "n_stop_words": f"len(list_filter(ws, lambda w: rtrim(lower(w), '.,!?;:') IN ({stop})))",
        "n_shouts": "length(t) - length(replace(t, '!', ''))",
        "n_lines": "len(ls)",
    }
    extra = ", ".join(f"{sql} AS {name}" for name, sql in measures.items())
    rules = " AND ".join(f"({_bounds(r)})" for r in RULES)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {WORDS} AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), three AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM three) WHERE n > 1
), covered AS (
  SELECT r, count(*) AS n FROM
    (SELECT DISTINCT r, i + k AS p FROM twice, (VALUES (0), (1), (2)) AS o(k)) GROUP BY r
), counts AS (
  SELECT doc_id, len(ws) AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[{SYMBOLS}]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(covered.n, 0) AS n_repeat_words, {extra}
  FROM d LEFT JOIN covered USING (r)
), based AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       CASE WHEN base_failed THEN FALSE ELSE {rules} END AS kept
FROM based"""


def mix_sql() -> str:
    weights = "[" + ", ".join(map(str, WEIGHTS)) + "]"
    modulus = 1 << BITS
    return f"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS}) AS size, md5(coalesce(doc_id::VARCHAR, '')) AS o
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         {weights}[((row_number() OVER (ORDER BY source IS NULL, source) - 1)
                    % {len(WEIGHTS)} + 1)::INT] AS weight
  FROM sized GROUP BY source
), ranked AS (
  SELECT *, {MOST_EPOCHS} * source_size AS cap, sum(source_size) OVER () AS total,
         row_number() OVER (
           ORDER BY {MOST_EPOCHS} * source_size / weight, source IS NULL, source) AS k
  FROM per
), levels AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING
             AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW
             AND UNBOUNDED FOLLOWING) AS level
  FROM ranked
), aimed AS (
  SELECT *, least(cap::DOUBLE, weight * (SELECT level FROM levels WHERE level <= cap / weight
                                         ORDER BY k LIMIT 1)) AS target
  FROM levels
), stretched AS (
  SELECT *, floor(target * {modulus} / greatest(total, 1))::BIGINT AS stretch FROM aimed
), bounds AS (
  SELECT *, (sum(stretch) OVER (ORDER BY source IS NULL, source))::BIGINT AS high FROM stretched
), per_total AS (SELECT coalesce(max(total), 0)::BIGINT AS total FROM ranked
), points AS (
  SELECT i, (i % {modulus} * {GOLDEN}) % {modulus} AS point
  FROM range(((SELECT max(total) FROM per_total) + {BLOCK - 1})::BIGINT // {BLOCK}) AS s(i)
), ordered AS (
  SELECT source, i, row_number() OVER (PARTITION BY source ORDER BY i) - 1 AS rank FROM points
  JOIN bounds ON point >= high - stretch AND point < high
), slots AS (
  SELECT source, count(*) AS n FROM ordered GROUP BY source
), plan AS (
  SELECT b.source, b.source_size, b.target,
         least(coalesce(n, 0) * {BLOCK}, {MOST_EPOCHS} * b.source_size) AS given
  FROM bounds b LEFT JOIN slots s ON b.source IS NOT DISTINCT FROM s.source
), placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY o, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM sized
), mix AS (
  SELECT p.*, source_size, target,
         CASE WHEN source_size = 0 THEN 0
              ELSE given // source_size * size
                   + greatest(0, least(size, given % source_size - place)) END::BIGINT AS taken
  FROM placed p JOIN plan ON p.source IS NOT DISTINCT FROM plan.source
)
SELECT doc_id, size, source_size, target, taken, i AS first_slot
FROM mix m LEFT JOIN ordered o
  ON taken > 0 AND m.source IS NOT DISTINCT FROM o.source AND place // {BLOCK} = rank"""


def phrases_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH p AS (
  SELECT coalesce(lang, '{UND}') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
total AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM w GROUP BY lang),
spans AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
          FROM (SELECT lang, ws, unnest(range(1, {LONGEST + 1})) AS k FROM w) WHERE len(ws) >= k),
f AS (SELECT lang, k, ws[i:i + k - 1] AS words, count(*)::HUGEINT AS a FROM spans
      GROUP BY 1, 2, 3 HAVING count(*) >= {FREQUENT}),
cuts AS (SELECT lang, words, a, c, words[1:c] AS lw, words[c + 1:k] AS rw
         FROM (SELECT lang, k, words, a, unnest(range(1, k)) AS c FROM f WHERE k >= 2)),
scored AS (SELECT c.lang, c.words, c.a, c.c, x.a AS l, y.a AS r, t.n,
                  (1000 * c.a * t.n) // (x.a * y.a) AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.words = c.lw
                JOIN f y ON y.lang = c.lang AND y.words = c.rw JOIN total t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, c) = 1),
inner_spans AS (SELECT lang, a, words[i:i + s - 1] AS part
                FROM (SELECT lang, k, a, words, s, unnest(range(1, k - s + 2)) AS i
                      FROM (SELECT lang, k, a, words, unnest(range(2, k)) AS s FROM f WHERE k >= 3))),
inside AS (SELECT lang, part, max(a) AS most FROM inner_spans GROUP BY 1, 2),
alone AS (SELECT b.*, array_to_string(b.words, ' ') AS phrase
          FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.part = b.words
          WHERE i.most IS NULL OR 100 * i.most < 100 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM alone QUALIFY rank <= {FIRST}
"""


ORACLES = {
    "op2_quality_rules": quality_sql(),
    "op10_source_mix": mix_sql(),
    "op11_phrase_tries": phrases_sql(),
}
