"""DuckDB statements of the queries that SQL can express over whole tables, by brute force."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    bits = (
        f"flatten(list_transform(string_split({text}, ''), "
        "lambda ch: list_transform(range(8), lambda i: (ascii(ch)::BIGINT >> i::INT) & 1)))"
    )
    start = "list_concat([4294967295::BIGINT], " + bits + ")"
    return f"xor(list_reduce({start}, lambda c, b: xor(c >> 1, 3988292384::BIGINT * (xor(c, b) & 1))), 4294967295::BIGINT)"


def _base32(digest: str) -> str:
    """Base 32 of 40 hexadecimal digits: four letters for each five of them."""
    number = f"('0x' || substr({digest}, 5 * g::INT + 1, 5))::BIGINT"
    letter = f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({number} >> (15 - 5 * k::INT)) & 31)::INT + 1, 1)"
    return (
        "array_to_string(flatten(list_transform(range(8), lambda g: "
        f"list_transform(range(4), lambda k: {letter}))), '')"
    )


OP1 = f"""WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
keepers AS (SELECT payload, max(page_id) AS keeper FROM payloads GROUP BY payload),
rows_ AS (SELECT p.page_id, strlen(p.payload)::BIGINT AS payload_bytes, sha1(p.payload) AS digest, keeper FROM payloads p JOIN keepers USING (payload))
SELECT page_id, payload_bytes, {_base32('digest')} AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to, true AS intact
FROM rows_"""

_REACH = """
reach AS (
  SELECT a AS node, a AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node)"""

OP7 = f"""WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (
  SELECT * FROM vectors WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.9),
{_REACH}
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, coalesce(root, e.vec_id) AS component_id,
  coalesce(root, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN roots r ON r.node = e.vec_id"""

OP8 = f"""WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '(?:[0-9a-z_]|[^\\x00-\\x7F])+') AS w FROM documents),
shingled AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(greatest(len(w) - 4, 1)),
    lambda i: hash(array_to_string(w[i + 1 : i + 5], ' '))))) AS s FROM worded WHERE len(w) > 0),
sets AS (SELECT min(doc_id) AS id, s, count(*) AS copies FROM shingled GROUP BY s),
items AS (SELECT id, len(s) AS n, copies, unnest(s) AS shingle FROM sets),
common AS (
  SELECT x.id AS a, y.id AS b, any_value(x.n) AS na, any_value(y.n) AS nb, any_value(y.copies) AS copies, count(*) AS both_
  FROM items x JOIN items y ON x.shingle = y.shingle AND x.id <> y.id GROUP BY x.id, y.id),
links AS (SELECT a, b, copies FROM common WHERE both_ >= 0.8 * (na + nb - both_) - 1e-6),
{_REACH},
linked AS (SELECT a, sum(copies) AS n FROM links GROUP BY a),
classed AS (
  SELECT d.doc_id, coalesce(r.root, t.id, d.doc_id) AS class_id, coalesce(t.copies - 1 + coalesce(l.n, 0), 0)::BIGINT AS n_links
  FROM documents d LEFT JOIN shingled h ON h.doc_id = d.doc_id LEFT JOIN sets t ON t.s = h.s
    LEFT JOIN roots r ON r.node = t.id LEFT JOIN linked l ON l.a = t.id)
SELECT doc_id, class_id, n_links, doc_id = class_id AS kept FROM classed"""

OP11 = f"""WITH own AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
headed AS (SELECT *, ({_crc32('conv_id::VARCHAR')} % 6)::INT AS h FROM own),
paths AS (
  SELECT c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, c.h), []), list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
  FROM headed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
prefixes AS (
  SELECT conv_id, d, sha256(to_json(list_slice(turns, 1, d))::VARCHAR) AS key, len(turns) = d AS ends,
    CASE WHEN d > 0 THEN length(turns[d]['text']) ELSE 0 END AS chars,
    CASE WHEN d > 0 THEN sha256(to_json(list_slice(turns, 1, d - 1))::VARCHAR) END AS above
  FROM (SELECT conv_id, turns, unnest(generate_series(0, len(turns))) AS d FROM paths)),
nodes AS (
  SELECT key, d AS depth, min(conv_id) AS conv_id, any_value(above) AS above, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY key, d),
children AS (SELECT above AS key, count(*) AS n FROM nodes WHERE above IS NOT NULL GROUP BY 1),
subtrees AS (SELECT DISTINCT p.key, q.key AS below FROM prefixes p JOIN prefixes q ON p.conv_id = q.conv_id AND p.d <= q.d),
sums AS (
  SELECT s.key, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((m.n_convs - 1) * m.chars)::BIGINT AS saved_tokens
  FROM subtrees s JOIN nodes m ON m.key = s.below LEFT JOIN children c ON c.key = s.below GROUP BY s.key)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, n_leaves,
  saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes u ON u.key = n.above LEFT JOIN children c ON c.key = n.key JOIN sums s ON s.key = n.key"""

def _op4() -> str:
    rounds = "".join(
        f"""
walk{i + 1} AS (
  SELECT s.host, any_value(s.trust) + coalesce(sum(0.7 * w.share * r.trust) FILTER (w.way = 0), 0) AS trust,
    any_value(s.distrust) + coalesce(sum(0.7 * w.share * r.distrust) FILTER (w.way = 1), 0) AS distrust
  FROM walk0 s LEFT JOIN ways w ON w.target = s.host LEFT JOIN walk{i} r ON r.host = w.host GROUP BY s.host),"""
        for i in range(10)
    )
    address = r"""\\s(?:href|src)\\s*=\\s*["'']?((?:[a-z][a-z0-9+.-]*:)?//[^\\s"''<>]+)""".replace("\\\\", "\\")
    return rf"""WITH parsed AS (
  SELECT page_id, coalesce(html, '') AS html,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
rules(action, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
met AS (
  SELECT p.*, (SELECT max_by(struct_pack(rule := r.host || r.path, action := r.action), length(r.host || r.path)) FROM rules r
    WHERE p.host <> '' AND (p.host = r.host OR ends_with(p.host, '.' || r.host))
      AND starts_with(CASE WHEN p.path = '' THEN '/' ELSE p.path END, r.path)) AS found FROM parsed p),
own AS (
  SELECT host, avg((coalesce(found.action, '') = 'allow')::INT) AS trust, avg((coalesce(found.action, '') = 'block')::INT) AS distrust
  FROM met WHERE host <> '' GROUP BY host),
found_links AS (SELECT host AS src, unnest(regexp_extract_all(html, '(?i){address}', 1)) AS url FROM parsed),
links AS (
  SELECT src, translate(regexp_extract(url, '//([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
  FROM found_links),
edges AS (SELECT src, dst, count(*)::DOUBLE AS weight FROM links WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY ALL),
ways AS (
  SELECT 0 AS way, src AS host, dst AS target, weight / sum(weight) OVER (PARTITION BY src) AS share FROM edges
  UNION ALL SELECT 1, dst, src, weight / sum(weight) OVER (PARTITION BY dst) FROM edges),
walk0 AS (
  SELECT host, sum(trust) AS trust, sum(distrust) AS distrust FROM (
    SELECT * FROM own UNION ALL SELECT DISTINCT host, 0.0::DOUBLE, 0.0::DOUBLE FROM ways) GROUP BY host),{{rounds}}
done AS (SELECT * FROM walk10)
SELECT m.page_id, m.host, m.path, found.rule AS rule,
  coalesce(found.action, CASE WHEN d.distrust - d.trust > 0.5 THEN 'block' ELSE 'allow' END) AS verdict, d.trust, d.distrust
FROM met m LEFT JOIN done d USING (host)""".replace("{rounds}", rounds)


ORACLES: dict[str, str] = {"op1_warc": OP1, "op4_url_filter": _op4(), "op7_vectors": OP7, "op8_jaccard": OP8, "op11_prefix_trie": OP11}
