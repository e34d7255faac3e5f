"""DuckDB SQL of the registered ``opN_*`` queries that SQL can express."""

OP4 = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, sh FROM (
    SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
      WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
      ELSE [array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)] END) AS sh
    FROM w WHERE words IS NOT NULL)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_of AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM both_of JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(root, node) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.root, e.b FROM reach r JOIN edge e ON e.a = r.node),
comp AS (SELECT root AS doc_id, min(node) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id,
       d.doc_id = c.component_id AS kept
FROM documents d JOIN comp c USING (doc_id) LEFT JOIN n USING (doc_id)
"""

OP8 = """
WITH lowered AS (
  SELECT 'd' AS side, doc_id AS id, translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL
  SELECT 'b', item_id, translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
w AS (SELECT side, id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM lowered),
item AS (
  SELECT id AS item_id, least(10, len(words)) AS size,
         unnest([array_to_string(words[i:i + least(10, len(words)) - 1], ' ')
                 for i in range(1, greatest(len(words) - 9, 1) + 1)]) AS win
  FROM w WHERE side = 'b' AND len(words) > 0),
place AS (
  SELECT id AS doc_id, z.size, unnest(range(1, len(words) - z.size + 2)) AS i, words
  FROM w, (SELECT DISTINCT size FROM item) z WHERE side = 'd' AND len(words) >= z.size),
gram AS (SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS win FROM place),
found AS (SELECT g.doc_id, g.i, g.size, t.item_id
          FROM gram g JOIN (SELECT DISTINCT item_id, size, win FROM item) t
            ON t.size = g.size AND t.win = g.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM found) GROUP BY 1)
SELECT w.id AS doc_id, len(w.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit ON hit.doc_id = w.id LEFT JOIN items ON items.doc_id = w.id
WHERE w.side = 'd'
"""

OP7 = """
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rule, rule_host, rule_path, action) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
site AS (
  SELECT host, path,
    (SELECT arg_max(struct_pack(rule := r.rule, action := r.action), length(r.rule)) FROM rules r
     WHERE (host = r.rule_host OR ends_with(host, '.' || r.rule_host))
       AND starts_with(path, r.rule_path)) AS best
  FROM (SELECT DISTINCT host, path FROM parts))
SELECT p.page_id, p.host, p.path, s.best.rule AS rule,
  coalesce(s.best.action, CASE WHEN regexp_matches(p.host,
    '(^|[.:-])(casino|pills|spam|porn|viagra|warez|betting|lottery)([.:-]|$)')
    THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p JOIN site s ON s.host = p.host AND s.path = p.path
"""

OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label,
    list_dot_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id AND len(a.q) = len(b.q)),
p AS (
  SELECT anchor_id, own, vec_id AS positive_id, score AS positive_score FROM s WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.own
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 10
"""

ORACLE = {
    "op4_minhash": OP4,
    "op7_url_rules": OP7,
    "op8_decontaminate": OP8,
    "op13_hard_negatives": OP13,
}
