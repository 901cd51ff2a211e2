"""The registered queries once more, as SQL for DuckDB over the same tables.

Word lists, patterns and texts come from the fixed values; the logic is stated anew.
"""

from __future__ import annotations

from pressroom import fixed_values as V
from pressroom.functions import text as X
from pressroom.plans.text_oracles import learned_oracles


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(words) -> str:
    return "(" + ", ".join(q(word) for word in words) + ")"


# -- text expressions ------------------------------------------------------------------------


def squeeze(text: str) -> str:
    return f"trim(regexp_replace({text}, {q(V.WHITESPACE)}, ' ', 'g'))"


def clean(text: str) -> str:
    source, target, several = X.transliteration()
    result = f"regexp_replace({text}, {q(X.CONTROL)}, '', 'g')"
    for char, plain in several.items():
        result = f"replace({result}, {q(char)}, {q(plain)})"
    result = f"translate({result}, {q(source)}, {q(target)})"
    result = f"regexp_replace({result}, {q(X.EMOJI_OR_OTHER)}, '\\1', 'g')"
    result = f"regexp_replace({result}, {q(V.URL)}, '<URL>', 'g')"
    phone = r"(^|[^\w)])" + V.PHONE_BODY + r"(\W|$)"
    for _ in range(2):
        result = f"regexp_replace({result}, {q(phone)}, '\\1<PHONE>\\2', 'g')"
    return squeeze(result)


def words(text: str) -> str:
    return f"len(regexp_extract_all({text}, {q(V.WORD)}))::INT"


def tokens(text: str) -> str:
    return f"len(regexp_extract_all({text}, {q(V.TOKEN)}))::INT"


def spam(text: str) -> str:
    punctuation = q(V.ASCII_PUNCTUATION.replace("!", ""))
    kept = (
        f"list_filter(regexp_extract_all(translate(lower({text}), {punctuation}, ''), {q(V.WORD)}), "
        f"lambda w: w NOT IN {in_list(V.STOP_WORDS)})"
    )
    emoji = f"len(regexp_extract_all({text}, {q('[' + X.emoji_class() + ']')}))"
    promo = f"len(list_filter({kept}, lambda w: w IN {in_list(V.PROMO_WORDS)}))"
    runs = f"len(regexp_extract_all({text}, {q(V.EXCLAMATION_RUN)}))"
    total = f"greatest(len({kept}), 1)"
    return (
        f"least((least({emoji} / (0.1::DOUBLE * {total}), 1) + least({promo} / (0.25::DOUBLE * {total}), 1) "
        f"+ least({runs} / (0.05::DOUBLE * {total}), 1)) / 2, 1)::DOUBLE"
    )


def curated_ctes(source: str, key: str) -> str:
    """CTEs cleaned and curated(key, text, error, spam_score) over ``source(key, raw, ...)``."""
    return f"""
cleaned AS (SELECT {key}, {clean('raw')} AS text FROM {source}),
scored AS (SELECT {key}, text, {words('text')} AS n, {spam('text')} AS score FROM cleaned),
curated AS (
  SELECT {key},
    CASE WHEN n >= 100 AND score <= 0.25 THEN text END AS text,
    CASE WHEN n < 100 THEN 'text too short' WHEN score > 0.25 THEN 'high spam score' END AS error,
    CASE WHEN n >= 100 THEN score END AS spam_score
  FROM scored)"""


# -- pages -----------------------------------------------------------------------------------

DROPPED_ELEMENTS = "head script style noscript template iframe svg canvas nav footer aside form button select table figure".split()
BLOCK_ELEMENTS = "p div h1 h2 h3 h4 h5 h6 ul ol li dl dt dd br hr article section main header blockquote pre body html".split()
DROPPED_CLASSES = (
    "ad ads advert advertisement banner breadcrumb comment comments cookie footer menu nav navbar navigation newsletter "
    "promo related share sharing sidebar social sponsored"
).split()
DROPPED = "(?is)<!--.*?-->|" + "|".join(
    rf"<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>" for tag in DROPPED_ELEMENTS
)
DROPPED_BOX = (
    r"(?is)<(?:div|section|ul)\s(?:[^>]*\s)?(?:class|id)=\"(?:[^\">]*[\s_-])?(?:"
    + "|".join(DROPPED_CLASSES)
    + r")(?:[\s_-][^\">]*)?\"[^>]*>.*?</(?:div|section|ul)\s*>"
)
ARTICLE = r"(?is)<article(?:\s[^>]*)?>(.*)</article"
MAIN = r"(?is)<main(?:\s[^>]*)?>(.*)</main"
BLOCK_TAG = r"(?i)</?(?:" + "|".join(BLOCK_ELEMENTS) + r")(?:\s[^>]*)?/?>"
PARAGRAPH = r"(?is)<p(?:\s[^>]*)?>(.*?)</p"
ANY_TAG = r"(?s)<[^>]*>"


def unescape(text: str) -> str:
    for name, char in V.HTML_ENTITIES.items():
        text = f"replace({text}, {q('&' + name + ';')}, {q(char)})"
    return text


def block_ctes(source: str, key: str) -> str:
    """CTEs kept and blocks(key, pos, block) over ``source(key, html)``."""
    body = "regexp_replace(regexp_replace(html, " + f"{q(DROPPED)}, ' ', 'g'), {q(DROPPED_BOX)}, ' ', 'g')"
    cut = f"regexp_replace(body, {q(BLOCK_TAG)}, chr(1), 'g')"
    cut = f"regexp_replace({cut}, '(?i)<a(?:\\s[^>]*)?>', chr(2), 'g')"
    cut = f"regexp_replace({cut}, '(?i)</a\\s*>', chr(3), 'g')"
    cut = f"regexp_replace({cut}, {q(ANY_TAG)}, '', 'g')"
    return f"""
kept AS (SELECT {key}, {body} AS kept FROM {source}),
bodies AS (
  SELECT {key}, kept, coalesce(nullif(regexp_extract(kept, {q(ARTICLE)}, 1), ''),
    nullif(regexp_extract(kept, {q(MAIN)}, 1), ''), kept) AS body FROM kept),
pieces AS (
  SELECT {key}, unnest(string_split({unescape(cut)}, chr(1))) AS piece,
    unnest(generate_series(1, len(string_split({cut}, chr(1))))) AS pos FROM bodies),
blocks AS (
  SELECT {key}, pos, {squeeze("translate(piece, chr(2) || chr(3), '')")} AS block FROM pieces
  WHERE regexp_matches(translate(piece, chr(2) || chr(3), ''), {q(V.WORD)})
    AND (length(piece) - length(regexp_replace(piece, '\\x02[^\\x02\\x03]*', '', 'g'))) * 2
        <= length(translate(piece, chr(2) || chr(3), '')))"""


def page_text_ctes(source: str, key: str, blocks: str = "blocks") -> str:
    """CTEs as above and page_text(key, full_text)."""
    paragraph = squeeze(unescape(f"regexp_replace(p, {q(ANY_TAG)}, ' ', 'g')"))
    return f"""
joined AS (SELECT {key}, string_agg(block, chr(10) ORDER BY pos) AS text FROM {blocks} GROUP BY {key}),
fallback AS (
  SELECT {key}, array_to_string(list_filter(list_transform(
    regexp_extract_all(kept, {q(PARAGRAPH)}, 1), lambda p: {paragraph}), lambda p: p <> ''), chr(10)) AS text
  FROM kept),
page_text AS (
  SELECT s.{key}, nullif(coalesce(j.text, f.text), '') AS full_text
  FROM {source} s LEFT JOIN joined j USING ({key}) LEFT JOIN fallback f USING ({key}))"""


def density_ctes() -> str:
    """CTE dense(page_id, full_text) over ``source(page_id, html)``."""
    cut = f"regexp_replace(body, {q(BLOCK_TAG)}, chr(1), 'g')"
    cut = f"regexp_replace({cut}, '(?i)<a(?:\\s[^>]*)?>', chr(2), 'g')"
    cut = f"regexp_replace({cut}, '(?i)</a\\s*>', chr(3), 'g')"
    cut = f"regexp_replace({cut}, {q(ANY_TAG)}, chr(4), 'g')"
    return f"""{block_ctes('source', 'page_id')},
{page_text_ctes('source', 'page_id')},
marked AS (
  SELECT page_id, unnest(string_split({unescape(cut)}, chr(1))) AS piece,
    unnest(generate_series(1, len(string_split({cut}, chr(1))))) AS pos FROM bodies),
worded AS (
  SELECT page_id, pos, translate(piece, chr(2) || chr(3) || chr(4), '') AS text,
    length(piece) - length(translate(piece, chr(2) || chr(3) || chr(4), '')) AS tags,
    length(translate(piece, chr(4), '')) - length(regexp_replace(translate(piece, chr(4), ''), '\\x02[^\\x02\\x03]*', '', 'g')) AS linked
  FROM marked),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS i, linked * 2 > length(text) AS links
  FROM worded WHERE regexp_matches(text, '[\\p{{L}}\\p{{N}}_]')),
worths AS (
  SELECT *, (CASE WHEN links THEN -1 ELSE 1 END) * len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+')) - 8 - 2 * tags AS worth
  FROM numbered),
smoothed AS (
  SELECT *, coalesce(lag(worth) OVER w, 0) + 2 * worth + coalesce(lead(worth) OVER w, 0) AS value
  FROM worths WINDOW w AS (PARTITION BY page_id ORDER BY i)),
sums AS (SELECT *, sum(value) OVER (PARTITION BY page_id ORDER BY i) AS total FROM smoothed),
lows AS (
  SELECT *, least(0, coalesce(min(total) OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS low
  FROM sums),
last_of AS (
  SELECT page_id, arg_min(i, (-(total - low), i)) AS last, arg_min(low, (-(total - low), i)) AS low, max(total - low) AS best
  FROM lows GROUP BY page_id HAVING max(total - low) > 0),
runs AS (
  SELECT l.page_id, l.last, coalesce(max(s.i) FILTER (s.i < l.last AND s.total = l.low), 0) + 1 AS first
  FROM last_of l JOIN sums s USING (page_id) GROUP BY ALL),
dense AS (
  SELECT r.page_id, string_agg({squeeze('b.text')}, chr(10) ORDER BY b.i) AS text
  FROM runs r JOIN numbered b ON b.page_id = r.page_id AND b.i BETWEEN r.first AND r.last AND NOT b.links GROUP BY 1)"""


FETCHED = """
fetched AS (
  SELECT page_id, url AS news_url,
    CASE page_id % 11 WHEN 4 THEN '' WHEN 5 THEN '<html><body><div></div></body></html>' ELSE html END AS raw_html,
    CASE WHEN page_id % 11 = 0 THEN 'http' WHEN page_id % 11 IN (1, 2, 3) THEN 'failed' END AS kind
  FROM pages),
answered AS (SELECT page_id, CASE WHEN kind IS NULL AND raw_html <> '' THEN raw_html END AS html FROM fetched)"""


def outcome_ctes() -> str:
    return f"""{FETCHED},
{block_ctes('answered', 'page_id')},
{page_text_ctes('answered', 'page_id')},
outcomes AS (
  SELECT page_id, news_url, full_text,
    (CASE page_id % 11 WHEN 0 THEN 404 WHEN 1 THEN 503 WHEN 2 THEN 500 WHEN 3 THEN NULL ELSE 200 END)::INT AS status_code,
    CASE page_id % 11 WHEN 0 THEN '404 Not Found' WHEN 1 THEN 'timed out' WHEN 2 THEN 'broken'
      WHEN 3 THEN 'Error: lost' WHEN 4 THEN 'empty response' END AS error,
    full_text IS NOT NULL AS success,
    CASE WHEN page_id % 11 = 3 THEN 0.0 ELSE (page_id % 11) / 10 END::DOUBLE AS elapsed_time
  FROM fetched JOIN page_text USING (page_id))"""


# -- feed ------------------------------------------------------------------------------------

FEED = """
feed AS (
  SELECT (event_id // 100 + 1)::INT AS page, (event_id % 100)::INT AS pos,
    (event_id // 100 + 1) * 100 + event_id % 100 AS ordinal, event_id::VARCHAR AS news_id,
    'https://news.example/' || user_id || '/' || event_type || '/' || (event_id % 10) AS news_url,
    CASE WHEN event_id % 97 <> 0 THEN date_trunc('second', ts) END AS date_utc,
    value AS rank_score, CASE WHEN event_id % 3 <> 0 THEN 1 ELSE 0 END AS n_topics,
    'Title ' || event_id AS title_text, props AS preview_text
  FROM events)"""

FEED_SPLIT = FEED + """,
stored AS (SELECT * FROM feed WHERE date_utc < '2024-01-20'),
fetched AS (SELECT * FROM feed WHERE date_utc >= '2024-01-15'),
fresh AS (SELECT * FROM fetched WHERE news_id NOT IN (SELECT news_id FROM stored))"""

BOUNDS = """
bounds AS (
  SELECT timezone('US/Eastern', timezone('UTC', max(ts) - INTERVAL 24 HOUR)) AS start_date,
    timezone('US/Eastern', timezone('UTC', TIMESTAMP '2024-02-01 03:00:00')) AS end_date
  FROM events)"""

DATE_RANGE = "strftime(start_date, '%m%d%Y') || '-' || strftime(end_date, '%m%d%Y')"

STATUS = """
status AS (
  SELECT d.doc_id AS news_id, true AS raw_data, l.quality IS NOT NULL AS scraped_data,
    coalesce(l.quality = 1, false) AS cleaned_data, coalesce(l.toxic = 1, false) AS llm_data
  FROM documents d LEFT JOIN labels l USING (doc_id))"""


def pending(condition: str) -> str:
    return f"""WITH {STATUS}
SELECT d.doc_id AS news_id, d.lang, d.n_chars FROM documents d
WHERE d.doc_id IN (SELECT news_id FROM status WHERE {condition})"""


ORDER_HALVES = """
older AS (SELECT * FROM orders WHERE o_orderdate < '1999-07-01'),
newer AS (SELECT * REPLACE (round(o_totalprice + 1, 2) AS o_totalprice) FROM orders WHERE o_orderdate >= '1997-01-01')"""

# -- sentences -------------------------------------------------------------------------------


def sentence_ctes(source: str, key: str) -> str:
    """CTE sentences(key, idx, sentence, n) over ``source(key, text)``."""
    pieces = (
        f"list_filter(string_split(regexp_replace(trim(text), {q(V.SENTENCE_END)}, '\\1' || chr(1), 'g'), chr(1)), "
        "lambda s: s <> '')"
    )
    return f"""
split_texts AS (SELECT {key}, {pieces} AS list FROM {source}),
sentences AS (
  SELECT {key}, unnest(list) AS sentence, unnest(generate_series(0, len(list) - 1)) AS idx, len(list) AS n
  FROM split_texts WHERE len(list) > 0)"""


def space_words(text: str) -> str:
    return f"len(regexp_extract_all({text}, '\\S+'))::INT"


LENGTHS = f"""
lengths AS (SELECT *, {space_words('sentence')} AS n_words FROM sentences)"""


def weight_ctes(key: str) -> str:
    return f"""
quantiles AS (SELECT {key}, quantile_cont(n_words, 0.9) AS q90 FROM lengths GROUP BY {key}),
weighted AS (SELECT l.*, q90, least(n_words / q90, 1)::DOUBLE AS weight FROM lengths l JOIN quantiles USING ({key}))"""


def centrality_ctes(key: str) -> str:
    """CTE central(key, idx, n, centrality) over weighted and similarity(key, i, j, sim)."""
    return f"""
rows_of_matrix AS (
  SELECT w.{key}, w.idx, w.n, w.weight, list_sort(list(s.sim) FILTER (s.sim <> 0)) AS found,
    coalesce(sum(s.sim) FILTER (s.j <> s.i AND abs(s.j - s.i) <= least(3, w.n - 1)), 0) AS near
  FROM weighted w LEFT JOIN similarity s ON s.{key} = w.{key} AND s.i = w.idx GROUP BY ALL),
padded AS (
  SELECT *, n - coalesce(len(found), 0) AS zeros, (n - 1) // 2 AS low, n // 2 AS high,
    least(idx, 3, n - 1) + least(n - 1 - idx, 3, n - 1) AS n_near FROM rows_of_matrix),
raw_scores AS (
  SELECT *, weight * ((CASE WHEN low < zeros THEN 0 ELSE found[low - zeros + 1] END)
      + (CASE WHEN high < zeros THEN 0 ELSE found[high - zeros + 1] END)) / 2 AS wide,
    weight * near / greatest(n_near, 1) AS local FROM padded),
central AS (
  SELECT {key}, idx, n,
    0.7::DOUBLE * (wide - min(wide) OVER d) / (max(wide) OVER d - min(wide) OVER d + 1e-8)
    + 0.3::DOUBLE * (local - min(local) OVER d) / (max(local) OVER d - min(local) OVER d + 1e-8) AS centrality
  FROM raw_scores WINDOW d AS (PARTITION BY {key}))"""


INTRO = "CASE WHEN n > 3 AND idx = 0 THEN 1.0 WHEN n > 3 AND idx = 1 THEN 0.75 WHEN n > 3 AND idx = 2 THEN 0.5 ELSE 0.0 END::DOUBLE"
CONCLUSION = "CASE WHEN n >= 5 AND idx = n - 2 THEN 0.5 WHEN n >= 5 AND idx = n - 1 THEN 1.0 ELSE 0.0 END::DOUBLE"


def tfidf_ctes(key: str) -> str:
    return f"""
terms AS (
  SELECT {key}, idx, n, term, count(*) AS tf FROM (
    SELECT {key}, idx, n, unnest(regexp_extract_all(lower(sentence), {q(V.WORD)})) AS term FROM weighted)
  WHERE term NOT IN {in_list(w for w in V.STOP_WORDS if "'" not in w)} GROUP BY ALL),
spread AS (SELECT {key}, term, count(*) AS sf FROM terms GROUP BY ALL),
tfidf AS (
  SELECT t.{key}, idx, t.term, tf * (ln((1 + n)::DOUBLE / (1 + sf)) + 1) AS w
  FROM terms t JOIN spread s ON t.{key} = s.{key} AND t.term = s.term),
normed AS (SELECT {key}, idx, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key}, idx)) AS w FROM tfidf),
similarity AS (
  SELECT a.{key}, a.idx AS i, b.idx AS j, sum(a.w * b.w) AS sim
  FROM normed a JOIN normed b ON a.{key} = b.{key} AND a.term = b.term GROUP BY ALL)"""


def summary_ctes(source: str, key: str, found: str | None = None) -> str:
    """CTE summaries(key, summary) over ``source(key, text)``: short texts as they are.

    ``found`` may be another CTE sentences(key, idx, sentence, n) of ``long_texts``.
    """
    return f"""
sized AS (SELECT {key}, text, {tokens('text')} AS n_tokens FROM {source}),
long_texts AS (SELECT {key}, text FROM sized WHERE n_tokens >= 1000),
{found or sentence_ctes('long_texts', key)},
lengths AS (SELECT *, {space_words('sentence')} AS n_words, {tokens('sentence')} AS n_tokens FROM sentences WHERE n >= 3),
{weight_ctes(key)},
{tfidf_ctes(key)},
{centrality_ctes(key)},
finals AS (
  SELECT c.{key}, c.idx, round(0.75 * centrality + 0.2 * {INTRO.replace('n ', 'c.n ').replace('idx', 'c.idx')}
    + 0.05 * {CONCLUSION.replace('n ', 'c.n ').replace('idx', 'c.idx')}, 9) AS score, l.sentence, l.n_tokens
  FROM central c JOIN lengths l ON l.{key} = c.{key} AND l.idx = c.idx),
running AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY {key} ORDER BY score DESC, idx DESC ROWS UNBOUNDED PRECEDING) AS total
  FROM finals),
chosen AS (SELECT {key}, string_agg(sentence, ' ' ORDER BY idx) AS text FROM running WHERE total <= 1000 GROUP BY {key}),
summaries AS (
  SELECT s.{key}, CASE WHEN s.n_tokens < 1000 THEN s.text
    WHEN {tokens('c.text')} <= 1100 AND c.text <> '' THEN c.text END AS summary
  FROM sized s LEFT JOIN chosen c USING ({key}))"""


# -- analysis --------------------------------------------------------------------------------


def user_message() -> str:
    parts = V.USER_MESSAGE
    values = ["doc_id::VARCHAR", "lang || ' ' || source", "text", q(V.ANALYSIS_REQUIREMENTS), "doc_id::VARCHAR"]
    pieces = [piece for fixed, value in zip(parts, values) for piece in (q(fixed), value)]
    return " || ".join(pieces + [q(parts[-1])])


MESSAGES = f"""
messages AS (
  SELECT doc_id, 0 AS pos, 'system' AS role, {q(V.SYSTEM_MESSAGE)} AS content FROM documents
  UNION ALL SELECT doc_id, 1, 'user', {user_message()} FROM documents)"""

REQUESTS = f"""{MESSAGES},
requests AS (
  SELECT 'article_' || doc_id AS custom_id, count(*) AS n_messages,
    {tokens("string_agg(content, chr(10) ORDER BY pos)")} AS token_count
  FROM messages GROUP BY doc_id)"""

ANSWERS = """
answers AS (
  SELECT doc_id // 20 AS batch_id, doc_id AS news_id, doc_id % 10 AS kind, lang, source,
    (n_chars % 100) / 100 AS positive, (99 - n_chars % 100) / 100 AS negative,
    (doc_id // 20) % 7 = 3 AS broken
  FROM documents)"""

# -- prices ----------------------------------------------------------------------------------

BARS = """
bars AS (
  SELECT event_type || '-USD' AS ticker, ts::DATE AS date, arg_min(value, (ts, event_id)) AS open,
    max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, count(*) AS volume
  FROM events GROUP BY ALL),
stored AS (
  SELECT * REPLACE (open / 2 AS open, high / 2 AS high, low / 2 AS low, close / 2 AS close)
  FROM bars WHERE date <= '2024-01-20' OR ticker = 'view-USD')"""

BAR_COLUMNS = """ticker, date, round(open, 6) AS open, round(high, 6) AS high, round(low, 6) AS low,
  round(close, 6) AS close, volume"""


def news_ctes() -> str:
    return f"""{outcome_ctes()},
articles AS (
  SELECT o.page_id, TIMESTAMP '2024-01-01' + to_hours((o.page_id % 240)::INT) AS date_utc, d.text AS preview,
    o.full_text AS raw
  FROM outcomes o LEFT JOIN documents d ON d.doc_id = o.page_id),
{curated_ctes('articles', 'page_id')},
selected AS (
  SELECT a.page_id, a.date_utc, CASE WHEN coalesce({words('a.preview')}, 0) > coalesce({words('c.text')}, 0)
    AND coalesce({words('a.preview')} >= 100, false) THEN a.preview ELSE c.text END AS text
  FROM articles a JOIN curated c USING (page_id))"""


def all_oracles() -> dict[str, str]:
    docs_raw = "docs AS (SELECT doc_id, text AS raw FROM documents)"
    docs = "docs AS (SELECT doc_id, text FROM documents)"
    sql = {}

    sql["text_normalize"] = f"""WITH c AS (SELECT doc_id, {clean('text')} AS text FROM documents)
SELECT doc_id, md5(text) AS text_md5, length(text)::INT AS n_chars FROM c"""
    endings = {
        "text_repair": [" ete deja, etude! \"ok\" naive \"E\"", " Bitkoin e uber 比特"],
        "text_scripts": [" Chapter IV costs 2/3 of No 5 at 20dC .. end ABC", " Bitkoin rastet, Ellada 比特币 hangug katakana ok fin"],
    }
    for name, (even, odd) in endings.items():
        sql[name] = f"""WITH c AS (
  SELECT doc_id, {clean('text')} || CASE WHEN doc_id % 2 = 0 THEN {q(even)} ELSE {q(odd)} END AS text FROM documents)
SELECT doc_id, md5(trim(text)) AS text_md5, right(trim(text), 40) AS ending FROM c"""
    bare = squeeze(f"translate(regexp_replace({clean('text')}, '[0-9]+(?:[.,][0-9]+)*', '<NUMBER>', 'g'), {q(V.ASCII_PUNCTUATION)}, '')")
    emails = bare.replace(clean("text"), f"regexp_replace({clean('text')}, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{{2,}}', '<EMAIL>', 'g')")
    sql["text_flags"] = f"""WITH c AS (
  SELECT doc_id, {emails} || CASE WHEN doc_id % 2 = 0 THEN ' See URL or URL now' ELSE ' mail EMAIL or pay NUMBER for NUMBER' END AS text
  FROM documents)
SELECT doc_id, md5(trim(text)) AS text_md5, right(trim(text), 40) AS ending FROM c"""
    sql["text_measure"] = f"""SELECT doc_id, {words('text')} AS text_word_count,
  {tokens('text')} AS text_token_count FROM documents"""
    sql["spam_score"] = f"SELECT doc_id, round({spam('text')}, 6) AS spam_score FROM documents"
    sql["curated_text"] = f"""WITH {docs_raw}, {curated_ctes('docs', 'doc_id')}
SELECT doc_id, md5(text) AS text_md5, error, round(spam_score, 6) AS spam_score FROM curated"""
    sql["quality_report"] = f"""WITH {docs_raw}, {curated_ctes('docs', 'doc_id')}
SELECT lang, source, count(*) AS n_docs, count(c.text) AS n_kept,
  count(*) FILTER (error = 'text too short') AS n_short, count(*) FILTER (error = 'high spam score') AS n_spam,
  coalesce(sum(length(c.text)), 0)::BIGINT AS kept_chars, round(max(spam_score), 6) AS max_spam_score
FROM curated c JOIN documents d USING (doc_id) GROUP BY lang, source"""
    sql["best_text"] = f"""WITH {docs_raw}, {curated_ctes('docs', 'doc_id')},
both_texts AS (
  SELECT c.doc_id, c.text AS full_text, p.text AS preview, {words('p.text')} AS pw, {words('c.text')} AS fw
  FROM curated c LEFT JOIN documents p ON p.doc_id = c.doc_id + 1)
SELECT doc_id, pw AS preview_text_word_count, fw AS full_cleaned_text_word_count,
  md5(CASE WHEN coalesce(pw, 0) > coalesce(fw, 0) AND coalesce(pw, 0) >= 100 THEN preview ELSE full_text END)
    AS selected_md5 FROM both_texts"""
    sql["article_features"] = f"""WITH source AS (SELECT page_id, html FROM pages),
{block_ctes('source', 'page_id')}, {page_text_ctes('source', 'page_id')},
m AS (SELECT doc_id AS news_id, CASE WHEN doc_id % 5 <> 0 THEN 'u' || doc_id % 7 END AS news_url, text FROM documents),
s AS (SELECT page_id AS news_id, CASE WHEN page_id % 5 <> 0 THEN 'u' || page_id % 3 END AS news_url, full_text FROM page_text),
j AS (
  SELECT m.news_id, m.news_url, text, full_text, {words('text')} AS pw, {words('full_text')} AS fw
  FROM m LEFT JOIN s ON m.news_id = s.news_id AND m.news_url IS NOT DISTINCT FROM s.news_url),
c AS (SELECT *, CASE WHEN pw > coalesce(fw, 0) AND pw >= 100 THEN text ELSE full_text END AS chosen FROM j)
SELECT news_id, news_url, fw AS full_cleaned_text_word_count, {words('chosen')} AS selected_text_word_count,
  {tokens('chosen')} AS selected_text_token_count FROM c"""

    sql["feed_dedup_first"] = """SELECT user_id, event_type, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1"""
    sql["feed_pages_until_empty"] = f"""WITH {FEED}
SELECT page, pos, ordinal, news_id, news_url FROM feed WHERE page < (SELECT max(page) * 9 // 10 FROM feed)"""
    dates = "year(date_utc)::INT AS year_utc, month(date_utc)::INT AS month_utc, day(date_utc)::INT AS day_utc"
    sql["feed_landings"] = """WITH items AS (
  SELECT event_id, event_id % 3 AS run, event_id // 300 + 1 AS page, event_id % 100 AS pos,
    concat_ws('/', user_id, event_type, event_id % 10) AS url FROM events),
stops AS (SELECT run, CASE WHEN run = 1 THEN max(page) // 2 ELSE max(page) + 1 END AS stop FROM items GROUP BY run),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY run, url ORDER BY page, pos) AS copy
  FROM items JOIN stops USING (run) WHERE page < stop),
sizes AS (SELECT run, count(*) FILTER (copy = 1 AND event_id % 97 <> 0) AS n_rows FROM firsts GROUP BY run)
SELECT run::INT AS run, again, CASE WHEN again THEN 0 ELSE n_rows END::BIGINT AS n_rows, (NOT again)::BIGINT AS n_landings
FROM sizes, (VALUES (true), (false)) v(again)"""
    sql["feed_dates"] = f"WITH {FEED} SELECT news_id, date_utc, {dates} FROM feed WHERE date_utc IS NOT NULL"
    sql["feed_date_nulls"] = f"WITH {FEED} SELECT count(*) AS date_nulls FROM feed WHERE date_utc IS NULL"
    sql["metadata_rows"] = f"""WITH {FEED}, firsts AS (
  SELECT * FROM feed QUALIFY row_number() OVER (PARTITION BY news_url ORDER BY ordinal) = 1)
SELECT news_id, date_utc, news_url, round(rank_score, 6) AS rank_score, n_topics, title_text,
  md5(preview_text) AS preview_md5 FROM firsts WHERE date_utc IS NOT NULL"""
    sql["high_water_mark"] = f"WITH {BOUNDS} SELECT start_date, end_date, {DATE_RANGE} AS date_range FROM bounds"
    request = ", ".join(
        f"{q(v) if isinstance(v, str) else v} AS {k.replace('-', '_')}" for k, v in V.FEED_REQUEST.items()
    )
    sql["feed_request"] = f"WITH {BOUNDS} SELECT {DATE_RANGE} AS date, {request} FROM bounds"
    sql["new_rows_anti"] = f"WITH {FEED_SPLIT} SELECT news_id, news_url, date_utc FROM fresh"
    sql["new_status_rows"] = f"""WITH {FEED_SPLIT}
SELECT news_id, true AS raw_data, false AS scraped_data, false AS cleaned_data, false AS llm_data FROM fresh"""

    sql["pending_scrape"] = pending("raw_data AND NOT scraped_data")
    sql["pending_clean"] = pending("raw_data AND scraped_data AND NOT cleaned_data")
    sql["pending_analysis"] = pending("cleaned_data AND NOT llm_data")
    sql["status_advance"] = f"""WITH {STATUS}
SELECT news_id, raw_data, scraped_data OR news_id IN (SELECT page_id FROM pages) AS scraped_data, cleaned_data, llm_data
FROM status"""

    sql["upsert"] = f"""WITH {ORDER_HALVES}
SELECT * FROM newer UNION ALL SELECT * FROM older WHERE o_orderkey NOT IN (SELECT o_orderkey FROM newer)"""
    sql["upsert_metrics"] = f"""WITH {ORDER_HALVES}
SELECT count(*) FILTER (o.o_orderkey IS NULL) AS rows_inserted, count(o.o_orderkey) AS rows_updated
FROM newer n LEFT JOIN older o USING (o_orderkey)"""
    sql["stored_upsert"] = f"""WITH {ORDER_HALVES}
SELECT o_orderkey, o_totalprice, o_orderdate,
  (year(o_orderdate) + CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END)::INT AS year FROM newer
UNION ALL SELECT o_orderkey, o_totalprice, o_orderdate, year(o_orderdate)::INT FROM older
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM newer)"""
    sql["filtered_read"] = """SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')"""
    sql["list_normalize"] = f"""WITH turns AS (
  SELECT conv_id, turn, role, list_filter(string_split(
    regexp_replace(trim(text), {q(V.SENTENCE_END)}, '\\1' || chr(1), 'g'), chr(1)), lambda s: s <> '') AS said
  FROM conversations)
SELECT conv_id, turn, (CASE WHEN role = 'user' THEN len(said) ELSE 0 END)::INT AS n_asked,
  (CASE WHEN role = 'assistant' THEN len(said) ELSE 0 END)::INT AS n_answered,
  md5(CASE WHEN role = 'assistant' THEN array_to_string(said, '|') ELSE '' END) AS answer_md5 FROM turns"""

    sql["natural_left_join"] = """WITH d AS (
  SELECT doc_id, (CASE WHEN doc_id % 4 <> 0 THEN 1 END)::INT AS quality, n_chars FROM documents),
l AS (SELECT doc_id, CASE WHEN doc_id % 4 <> 0 THEN quality END AS quality, toxic FROM labels)
SELECT d.doc_id, d.quality, d.n_chars, l.toxic FROM d
LEFT JOIN l ON d.doc_id = l.doc_id AND d.quality IS NOT DISTINCT FROM l.quality"""
    sql["url_left_join"] = f"""WITH {outcome_ctes()}
SELECT e.event_id AS news_id, p.url AS news_url, day(e.ts)::INT AS day_utc, o.status_code, o.success
FROM events e LEFT JOIN pages p ON p.page_id = e.user_id LEFT JOIN outcomes o ON o.news_url = p.url"""
    sql["distinct_urls"] = f"WITH {FEED} SELECT DISTINCT news_url FROM feed"
    text_columns = "page_id, md5(full_text) AS text_md5, length(full_text)::INT AS n_chars"
    sql["extract_text"] = f"""WITH {block_ctes('pages', 'page_id')}, {page_text_ctes('pages', 'page_id')}
SELECT {text_columns} FROM page_text"""
    host = "regexp_extract(url, '://([^/?#:]+)', 1) AS host"
    repeated = f"""repeated AS (
  SELECT host, md5(block) AS block_md5, count(DISTINCT page_id) AS n_pages
  FROM blocks JOIN (SELECT page_id, {host} FROM pages) USING (page_id) GROUP BY ALL
  HAVING count(DISTINCT page_id) >= 2)"""
    sql["extract_traps"] = f"""WITH source AS (SELECT page_id, html FROM pages),
{block_ctes('source', 'page_id')}, {page_text_ctes('source', 'page_id')}
SELECT page_id, md5(full_text) AS text_md5, length(full_text)::INT AS n_chars FROM page_text"""
    sql["extract_density"] = f"""WITH source AS (
  SELECT page_id, CASE WHEN page_id % 2 = 0 THEN replace(replace(html, '<article', '<div'), '</article', '</div') ELSE html END AS html
  FROM pages),
{density_ctes()}
SELECT page_id, md5(coalesce(d.text, full_text)) AS text_md5, length(coalesce(d.text, full_text))::INT AS n_chars
FROM page_text LEFT JOIN dense d USING (page_id)"""
    sql["boilerplate_blocks"] = f"""WITH {block_ctes('pages', 'page_id')}, {repeated}
SELECT host, block_md5, n_pages FROM repeated"""
    sql["extract_text_unrepeated"] = f"""WITH {block_ctes('pages', 'page_id')}, {repeated},
rare AS (
  SELECT b.* FROM blocks b JOIN (SELECT page_id, {host} FROM pages) USING (page_id)
  WHERE (host, md5(block)) NOT IN (SELECT (r.host, r.block_md5) FROM repeated r)),
{page_text_ctes('pages', 'page_id', 'rare')}
SELECT {text_columns} FROM page_text"""
    sql["fetch_outcome"] = f"""WITH {outcome_ctes()}
SELECT news_url, md5(full_text) AS text_md5, status_code, error, success, elapsed_time FROM outcomes"""
    sql["fetch_summary"] = f"""WITH {outcome_ctes()}
SELECT count(*) AS articles_scraped, count(*) FILTER (success) AS successful_scrapes,
  printf('%.1f%%', count(*) FILTER (success) / count(*) * 100) AS success_rate FROM outcomes"""
    sql["fetch_progress"] = f"""WITH {outcome_ctes()},
numbered AS (SELECT (row_number() OVER (ORDER BY page_id * 1000003) - 1) // 100 AS chunk, success FROM outcomes),
chunks AS (SELECT chunk, count(*) AS chunk_size, count(*) FILTER (success) AS chunk_success FROM numbered GROUP BY chunk),
totals AS (
  SELECT *, sum(chunk_size) OVER (ORDER BY chunk)::BIGINT AS total_done,
    sum(chunk_success) OVER (ORDER BY chunk)::BIGINT AS total_success FROM chunks)
SELECT *, printf('%.1f%%', total_success / total_done * 100) AS success_rate FROM totals"""

    sql["sentences"] = f"""WITH {docs}, {sentence_ctes('docs', 'doc_id')}
SELECT doc_id, idx::INT AS idx, md5(sentence) AS sentence_md5, {space_words('sentence')} AS n_words FROM sentences"""
    sql["sentence_weights"] = f"""WITH {docs}, {sentence_ctes('docs', 'doc_id')}, {LENGTHS}, {weight_ctes('doc_id')}
SELECT doc_id, idx::INT AS idx, round(q90, 6) AS q90, round(weight, 6) AS weight, {INTRO} AS intro,
  {CONCLUSION} AS conclusion FROM weighted"""
    sql["dense_centrality"] = f"""WITH vectors AS (
  SELECT vec_id // 50 AS doc_id, vec_id % 50 AS idx, embedding::DOUBLE[] AS v, label + 1 AS n_words,
    count(*) OVER (PARTITION BY vec_id // 50) AS n FROM embeddings),
lengths AS (SELECT * FROM vectors), {weight_ctes('doc_id')},
similarity AS (
  SELECT a.doc_id, a.idx AS i, b.idx AS j, list_cosine_similarity(a.v, b.v) AS sim
  FROM vectors a JOIN vectors b USING (doc_id)),
medians AS (SELECT doc_id, i, median(sim) AS mid, sum(sim) FILTER (i <> j AND abs(i - j) <= 3) AS near FROM similarity GROUP BY ALL),
raw_scores AS (
  SELECT w.doc_id, w.idx, weight * mid AS wide,
    weight * coalesce(near, 0) / greatest(least(idx, 3, n - 1) + least(n - 1 - idx, 3, n - 1), 1) AS local
  FROM weighted w JOIN medians m ON m.doc_id = w.doc_id AND m.i = w.idx)
SELECT doc_id, idx::INT AS idx, round(
  0.7 * (wide - min(wide) OVER d) / (max(wide) OVER d - min(wide) OVER d + 1e-8)
  + 0.3 * (local - min(local) OVER d) / (max(local) OVER d - min(local) OVER d + 1e-8), 6) AS centrality
FROM raw_scores WINDOW d AS (PARTITION BY doc_id)"""
    sql["tfidf_centrality"] = f"""WITH long_docs AS (SELECT doc_id, text FROM documents WHERE {tokens('text')} >= 1000),
{sentence_ctes('long_docs', 'doc_id')},
lengths AS (SELECT *, {space_words('sentence')} AS n_words FROM sentences WHERE n >= 3),
{weight_ctes('doc_id')}, {tfidf_ctes('doc_id')}, {centrality_ctes('doc_id')}
SELECT doc_id, idx::INT AS idx, round(centrality, 6) AS centrality,
  round(0.75 * centrality + 0.2 * {INTRO} + 0.05 * {CONCLUSION}, 9) AS score FROM central"""
    sql["summary"] = f"""WITH {docs}, {summary_ctes('docs', 'doc_id')}
SELECT doc_id, md5(summary) AS summary_md5, {tokens('summary')} AS n_tokens FROM summaries"""

    sql |= learned_oracles(summary_ctes, tokens)

    sql["prompt_messages"] = f"""WITH {MESSAGES}
SELECT doc_id::VARCHAR AS news_id, pos, role, md5(content) AS content_md5 FROM messages"""
    sql["batch_requests"] = f"""WITH {REQUESTS}
SELECT custom_id, 'POST' AS method, '/v1/chat/completions' AS url, 'gpt-4o' AS model, 0.4::DOUBLE AS temperature,
  3000 AS max_tokens, n_messages::INT AS n_messages, token_count FROM requests"""
    sql["batch_tokens"] = f"""WITH {REQUESTS}
SELECT CASE WHEN length(custom_id) <= 10 THEN 'short id' ELSE 'long id' END AS batch, count(*) AS n_requests,
  sum(token_count)::BIGINT AS total_tokens FROM requests GROUP BY ALL"""
    half = ", ".join(
        f"0.5::DOUBLE AS {name}"
        for name in V.REQUIRED_SCORES
        if name not in ("positive", "negative", "neutral", "confidence_score")
    )
    sql["parse_responses"] = f"""WITH {ANSWERS}
SELECT batch_id, news_id::VARCHAR AS news_id, 'Fearful' AS emotion_category, 'Market|DeFi' AS events,
  positive::DOUBLE AS positive, negative::DOUBLE AS negative,
  (CASE kind WHEN 5 THEN 0.5 ELSE 0.01 END)::DOUBLE AS neutral, 0.75::DOUBLE AS confidence_score, {half},
  lang || '|' || source AS topics, 'About ' || news_id AS free_text_summary,
  CASE WHEN kind <> 4 THEN 'None' END AS historical_analogy, kind = 5 AS sentiment_warning
FROM answers WHERE NOT broken AND kind NOT IN (0, 1, 2, 6)"""
    sql["rejected_responses"] = f"""WITH {ANSWERS}
SELECT batch_id, news_id::VARCHAR AS news_id, CASE kind WHEN 0 THEN 'invalid emotion_category'
    WHEN 1 THEN 'invalid confidence_score' WHEN 2 THEN 'missing virality_score' ELSE 'invalid event_category' END AS reason
FROM answers WHERE NOT broken AND kind IN (0, 1, 2, 6)
UNION ALL SELECT DISTINCT batch_id, NULL, 'invalid JSON' FROM answers WHERE broken"""
    sql["decode_single"] = """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'Empty response from API'
    WHEN event_id % 7 = 0 THEN 'API response is not valid JSON' END AS decode_error,
  event_id % 5 <> 0 AND event_id % 7 <> 0 AS decoded FROM events"""

    sql["price_bars"] = f"WITH {BARS} SELECT {BAR_COLUMNS} FROM bars"
    sql["price_last_date"] = f"WITH {BARS} SELECT ticker, max(date) AS last_date FROM stored GROUP BY ticker"
    sql["price_stale"] = f"""WITH {BARS} SELECT DISTINCT ticker FROM bars WHERE ticker NOT IN (
  SELECT ticker FROM stored GROUP BY ticker HAVING max(date) >= '2024-01-30')"""
    sql["price_keep_last"] = f"""WITH {BARS}, merged AS (
  SELECT *, 1 AS batch FROM bars WHERE date >= '2024-01-15' UNION ALL SELECT *, 0 FROM stored)
SELECT {BAR_COLUMNS} FROM merged QUALIFY row_number() OVER (PARTITION BY ticker, date ORDER BY batch DESC) = 1"""
    sql["price_refresh"] = f"""WITH {BARS},
ends AS (SELECT ticker, max(date) AS last_date FROM stored GROUP BY ticker),
fresh AS (
  SELECT b.* FROM bars b LEFT JOIN ends e USING (ticker)
  WHERE b.date <= '2024-01-30' AND (last_date IS NULL OR (last_date < '2024-01-30' AND b.date > last_date))),
merged AS (SELECT * FROM fresh UNION ALL SELECT * FROM stored WHERE ticker IN (SELECT ticker FROM fresh))
SELECT {BAR_COLUMNS} FROM merged"""
    wide = ", ".join(
        f"{'max' if f == 'volume' else 'round(max'}({f}) FILTER (ticker = '{t}-USD'){'' if f == 'volume' else ', 6)'} AS {f}_{t}"
        for t in ("click", "error", "purchase", "signup", "view")
        for f in ("open", "high", "low", "close", "volume")
    )
    sql["price_wide"] = f"WITH {BARS} SELECT date, {wide} FROM bars GROUP BY date"
    sql["price_files"] = f"""WITH {BARS}
SELECT 'csv' AS source, {BAR_COLUMNS} FROM bars WHERE ticker = 'click-USD'
UNION ALL SELECT 'parquet', {BAR_COLUMNS} FROM bars
WHERE ticker IN ('view-USD', 'error-USD') AND date >= '2024-01-05' AND date < '2024-01-20'"""
    sql["request_file"] = f"""WITH {MESSAGES}
SELECT 'article_' || doc_id AS custom_id, 'POST' AS method, '/v1/chat/completions' AS url, 'gpt-4o' AS model,
  0.4::DOUBLE AS temperature, 3000 AS max_tokens, md5(string_agg(role, ' ' ORDER BY pos)) AS roles_md5,
  md5(arg_max(content, pos)) AS content_md5 FROM messages GROUP BY doc_id"""
    sql["unscraped_articles"] = "SELECT doc_id::VARCHAR AS news_id, source, true AS no_text, true AS no_outcome FROM documents"
    sql["price_one"] = f"WITH {BARS} SELECT {BAR_COLUMNS} FROM bars WHERE ticker = 'click-USD'"
    sql["price_flow"] = f"WITH {BARS} SELECT {BAR_COLUMNS} FROM bars"

    sql["news_flow"] = f"""WITH {news_ctes()}, {summary_ctes('selected', 'page_id')}
SELECT s.page_id::VARCHAR AS news_id, s.date_utc, md5(s.text) AS selected_md5, {words('s.text')} AS selected_text_word_count,
  md5(summary) AS ready_md5, {tokens('summary')} AS llm_ready_text_token_count
FROM selected s JOIN summaries USING (page_id)"""
    sql["news_stages"] = f"""WITH {outcome_ctes()}
SELECT 'import' AS stage, 'success' AS status, count(*) AS n_rows, NULL::BIGINT AS n_success, NULL::VARCHAR AS success_rate,
  '2024-01-01 to 2024-01-31' AS date_range, NULL::VARCHAR AS error FROM outcomes
UNION ALL SELECT 'scrape', 'success', count(*), count(*) FILTER (success),
  printf('%.1f%%', count(*) FILTER (success) / count(*) * 100), NULL, NULL FROM outcomes
UNION ALL SELECT 'clean', 'success', count(*), NULL, NULL, NULL, NULL FROM outcomes"""
    sql["analysis_flow"] = f"""WITH {ANSWERS}, {REQUESTS},
good AS (SELECT * FROM answers WHERE NOT broken AND kind NOT IN (0, 1, 2, 6))
SELECT d.doc_id::VARCHAR AS news_id, g.news_id IS NOT NULL AS llm_data,
  CASE WHEN g.news_id IS NOT NULL THEN (d.doc_id % 10 + 1)::INT END AS day_utc, g.positive::DOUBLE AS positive,
  g.kind = 5 AS sentiment_warning,
  CASE WHEN g.news_id IS NULL THEN
    {tokens(q(V.SYSTEM_MESSAGE) + " || chr(10) || " + user_message().replace("lang || ' ' || source", "d.lang || ' ' || d.source"))} END AS token_count
FROM documents d LEFT JOIN good g ON g.news_id = d.doc_id"""
    sql["stream_import"] = """SELECT page_id::VARCHAR AS news_id, url AS news_url,
  TIMESTAMP '2024-01-01' + to_hours((page_id % 240)::INT) AS date_utc, 'Page ' || page_id AS title_text FROM pages"""
    return sql
