"""SQL of the queries on learned sentence boundaries; patterns and constants are stated here anew."""

from __future__ import annotations

from collections.abc import Callable

BLANK = r"[ \t\r\n\f]"
WORD = r"[^ \t\r\n\f]+"

ABBREVIATED = """
docs AS (
  SELECT doc_id, CASE doc_id % 4
    WHEN 0 THEN 'Mr. Brown of the U.S. office met J. Adams on no. 5 of the list. The talk ended. '
    WHEN 1 THEN 'Dr. Green paid 5. The rest went to Mr. White and Mr. Brown. "It is done." The U.S. The end. '
    WHEN 2 THEN 'It costs 5. or less, etc. and J. Smith left... Then the U.S. market closed. The (small) no. 7 won! '
    ELSE '' END || text AS text FROM documents)"""


def _bare(token: str) -> str:
    return rf"""regexp_replace(CASE WHEN length({token}) <= 64 THEN {token} ELSE '' END, '^["''(\[{{]+|["'')\]}}]+\z', '', 'g')"""


def _type(bare: str) -> str:
    return rf"lower(regexp_replace({bare}, '[.!?,;:]+\z', ''))"


def _log(p: str) -> str:
    return f"ln(greatest(least({p}, 1 - 1e-9), 1e-9))"


def _likely(hits: str, tries: str, p: str) -> str:
    return f"({hits} * {_log(p)} + ({tries} - {hits}) * {_log(f'(1 - {p})')})"


def _association(a: str, b: str, together: str) -> str:
    rest = f"({b} - {together})"
    p, p1, p2 = f"({b} / total)", f"({together} / {a})", f"({rest} / (total - {a}))"
    return (
        f"-2 * ({_likely(together, a, p)} + {_likely(rest, f'(total - {a})', p)}"
        f" - {_likely(together, a, p1)} - {_likely(rest, f'(total - {a})', p2)})"
    )


PERIOD = r"'(^|[^.])\.\z'"
LETTERS = "length(replace(type, '.', ''))"

LEARNED = rf"""{ABBREVIATED},
bare AS (
  SELECT {_bare('raw')} AS t FROM (SELECT unnest(regexp_extract_all(text, '{WORD}')) AS raw FROM docs)),
types AS (
  SELECT {_type('t')} AS type, count(*)::DOUBLE AS n, (count(*) FILTER (regexp_matches(t, {PERIOD})))::DOUBLE AS n_period
  FROM bare GROUP BY 1),
sums AS (SELECT sum(n) AS total, sum(n_period) AS periods FROM types),
words AS (SELECT * FROM types WHERE regexp_matches(type, '\p{{L}}')),
abbreviations AS (
  SELECT * FROM (
    SELECT type, -2 * ({_likely('n_period', 'n', '(periods / total)')} - {_likely('n_period', 'n', '0.99::DOUBLE')})
      * exp(-{LETTERS}) * (length(type) - {LETTERS} + 1) * pow({LETTERS}, n_period - n) AS score
    FROM words, sums WHERE n_period > 0) WHERE score >= 0.3),
cut AS (
  SELECT doc_id, string_split(regexp_replace(trim(text, ' '), '([.!?]["'')\]}}]*)({BLANK}+)', '\1' || chr(1) || '\2', 'g'), chr(1)) AS p
  FROM docs WHERE text IS NOT NULL),
cut_pieces AS (SELECT doc_id, unnest(generate_series(1, len(p))) AS i, unnest(p) AS piece FROM cut),
edges AS (
  SELECT doc_id, i, piece, {_bare(f"regexp_extract(piece, '{WORD}$')")} AS last,
    {_bare(f"regexp_extract(lead(piece) OVER (PARTITION BY doc_id ORDER BY i), '{WORD}')")} AS first,
    i = max(i) OVER (PARTITION BY doc_id) AS ending FROM cut_pieces),
candidates AS (
  SELECT doc_id, i, {_type('last')} AS type, regexp_matches(last, {PERIOD}) AS period,
    CASE WHEN regexp_matches(last, '^\p{{L}}\.\z') THEN 'initial'
      WHEN regexp_matches(last, '^[0-9][0-9.,]*\.\z') AND regexp_matches(last, {PERIOD}) THEN 'number' END AS sure_kind,
    {_type('first')} AS next_type, regexp_matches(first, '^\p{{Lu}}') AS next_upper, regexp_matches(first, '^\p{{Ll}}') AS next_lower
  FROM edges WHERE NOT ending),
judged AS (
  SELECT c.*, CASE WHEN period THEN coalesce(sure_kind, CASE WHEN a.type IS NOT NULL THEN 'abbreviation' END) END AS kind
  FROM candidates c LEFT JOIN abbreviations a USING (type)),
followers AS (SELECT next_type AS type, count(*)::DOUBLE AS together FROM judged WHERE kind IS NULL GROUP BY 1),
ends AS (SELECT sum(together) AS ends FROM followers),
starters AS (
  SELECT * FROM (
    SELECT type, {_association('ends', 'n', 'together')} AS score, together / ends > n / total AS often
    FROM followers JOIN words USING (type), ends, sums) WHERE score >= 30 AND often),
bound AS (
  SELECT type, next_type, count(*)::DOUBLE AS together FROM judged WHERE kind IS NOT NULL GROUP BY ALL HAVING count(*) > 1),
collocations AS (
  SELECT * FROM (
    SELECT b.type, b.next_type, {_association('t.n', 'w.n', 'together')} AS score, together / t.n > w.n / total AS often
    FROM bound b JOIN types t ON t.type = b.type JOIN words w ON w.type = b.next_type, sums
    WHERE b.next_type NOT IN (SELECT type FROM starters)) WHERE score >= 7.88 AND often),
decided AS (
  SELECT j.doc_id, j.i, CASE WHEN kind IS NULL THEN false WHEN c.type IS NOT NULL THEN true
    WHEN kind = 'number' THEN next_lower ELSE NOT (s.type IS NOT NULL AND next_upper) END AS joined
  FROM judged j LEFT JOIN starters s ON s.type = j.next_type
    LEFT JOIN collocations c ON c.type = j.type AND c.next_type = j.next_type),
learned_lists AS (
  SELECT doc_id, list_filter(list_transform(
    string_split(string_agg(piece || CASE WHEN coalesce(joined, false) THEN '' ELSE chr(1) END, '' ORDER BY e.i), chr(1)),
    lambda s: trim(s, ' ' || chr(9) || chr(13) || chr(10) || chr(12))), lambda s: s <> '') AS list
  FROM edges e LEFT JOIN decided d USING (doc_id, i) GROUP BY doc_id),
learned_sentences AS (
  SELECT doc_id, unnest(list) AS sentence, unnest(generate_series(0, len(list) - 1)) AS idx, len(list) AS n
  FROM learned_lists WHERE len(list) > 0)"""


def learned_oracles(summary_ctes: Callable[..., str], tokens: Callable[[str], str]) -> dict[str, str]:
    """``summary_ctes`` is the summary over CTE ``docs``, given how its sentences are found."""
    found = "sentences AS (SELECT s.* FROM learned_sentences s JOIN long_texts USING (doc_id))"
    return {
        "sentence_boundaries": f"""WITH {LEARNED}
SELECT 'abbreviation' AS kind, type, NULL::VARCHAR AS next_type, round(score, 6) AS score FROM abbreviations
UNION ALL SELECT 'starter', type, NULL, round(score, 6) FROM starters
UNION ALL SELECT 'collocation', type, next_type, round(score, 6) FROM collocations""",
        "sentences_learned": f"""WITH {LEARNED}
SELECT doc_id, idx::INT AS idx, md5(sentence) AS sentence_md5,
  len(regexp_extract_all(sentence, '\\S+'))::INT AS n_words FROM learned_sentences""",
        "summary_learned": f"""WITH {LEARNED}, {summary_ctes('docs', 'doc_id', found)}
SELECT doc_id, md5(summary) AS summary_md5, {tokens('summary')} AS n_tokens FROM summaries""",
    }
