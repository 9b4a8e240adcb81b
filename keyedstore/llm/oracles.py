"""DuckDB twins of those queries that SQL can express over whole tables."""

from __future__ import annotations

RULES = "(VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')) r(h, p, v)"

URL_FILTER = f"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
m AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v FROM u JOIN {RULES} ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY 1)
SELECT u.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN m ON u.page_id = m.page_id
"""

#: Words: A-Z in lower case, cut at ASCII white space.
WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def runs(width: str) -> str:
    """Distinct runs of some words of w, each as one text."""
    return f"list_distinct(list_transform(range(1, len(w) - {width} + 2), lambda i: array_to_string(w[i : i + {width} - 1], ' ')))"


#: id -> least id reachable over links (i, j); every node reaches itself.
COMPONENTS = """
both_ways AS (SELECT i, j FROM links UNION SELECT j, i FROM links),
reach(id, c) AS (SELECT id, id FROM nodes UNION SELECT l.j, r.c FROM reach r JOIN both_ways l ON l.i = r.id WHERE r.c < l.j),
labels AS (SELECT id, min(c) AS component_id FROM reach GROUP BY 1)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE {runs('4')} END AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s WHERE doc_id IS NOT NULL),
links AS (SELECT a.doc_id AS i, b.doc_id AS j FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
nodes AS (SELECT DISTINCT doc_id AS id FROM documents WHERE doc_id IS NOT NULL),
{COMPONENTS}
SELECT doc_id, cast(len(g) AS bigint) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM s LEFT JOIN labels ON id = doc_id
"""

CONTAINED = f"""
WITH items AS (SELECT item_id, {WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
own AS (SELECT item_id, least(5, len(w)) AS k, {runs('least(5, len(w))')} AS g FROM items WHERE len(w) > 0),
wanted AS (SELECT item_id, k, len(g) AS n, unnest(g) AS g FROM own),
docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
held AS (SELECT doc_id, k, unnest({runs('k')}) AS g FROM docs, (SELECT DISTINCT k FROM own) WHERE len(w) >= k)
SELECT doc_id, item_id, cast(n AS bigint) AS item_shingles, count(*) AS shared, count(*) / n AS containment FROM held JOIN wanted USING (k, g) GROUP BY doc_id, item_id, n HAVING 10 * count(*) >= 8 * n
"""

REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, p, substr(h, 2 * p - 1, 100) AS g FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 48)) AS p FROM d)),
f AS (SELECT g, min(doc_id) AS first FROM s GROUP BY 1 HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT doc_id, p, p > lag(p, 1, -100) OVER (PARTITION BY doc_id ORDER BY p) + 50 AS fresh FROM s JOIN f USING (g) WHERE doc_id > first),
numbered AS (SELECT doc_id, p, sum(fresh::int) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM hit),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 49 AS b FROM numbered GROUP BY doc_id, span),
cut AS (SELECT doc_id, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b, sum(b - a + 1) AS gone FROM spans GROUP BY 1),
kept AS (SELECT d.doc_id, h, a, gone, CASE WHEN a IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(a) + 1), lambda i: substr(h, 2 * CASE WHEN i = 0 THEN 0 ELSE b[i] END + 1, 2 * (CASE WHEN i = len(a) THEN length(h) // 2 + 1 ELSE a[i + 1] END - CASE WHEN i = 0 THEN 0 ELSE b[i] END - 1))), '') END AS left_over FROM d LEFT JOIN cut ON cut.doc_id = d.doc_id)
SELECT doc_id, cast(length(h) // 2 AS bigint) AS n_bytes, cast(coalesce(gone, 0) AS bigint) AS n_removed, cast(coalesce(len(a), 0) AS bigint) AS n_spans, sha256(unhex(left_over)) AS kept_sha256 FROM kept
"""

EMBEDDINGS = f"""
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: cast(x AS double)) AS x FROM embeddings),
good AS (SELECT * FROM v WHERE label IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
links AS (SELECT a.vec_id AS i, b.vec_id AS j FROM good a JOIN good b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id < b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
nodes AS (SELECT vec_id AS id FROM v),
{COMPONENTS},
n AS (SELECT i, count(*) AS n FROM both_ways GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN labels ON id = vec_id LEFT JOIN n ON i = vec_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_minhash_near_dedup": NEAR_DUPLICATES, "op5_decontamination": CONTAINED, "op7_suffix_array_dedup": REPEATS, "op8_url_filter": URL_FILTER, "op10_embedding_near_dedup": EMBEDDINGS}
