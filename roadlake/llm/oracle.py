"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

SUBSTRING_DEDUP = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM places),
owners AS (SELECT k, min(doc_id) AS owner FROM windows GROUP BY k),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j
  FROM windows JOIN owners USING (k) WHERE owner < doc_id
),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept FROM words ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)
"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0),
starts AS (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM sized),
patterns AS (SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS k FROM starts),
sizes AS (SELECT DISTINCT size FROM patterns),
places AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d JOIN sizes ON len(w) >= size
),
hits AS (
  SELECT doc_id, i, size, item_id
  FROM (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS k FROM places) JOIN patterns USING (size, k)
),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS j FROM hits),
words AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
good AS (
  SELECT vec_id, e FROM v
  WHERE len(e) > 0 AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN e IF x <> 0]) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
),
reach(vec_id, c) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.vec_id
),
component AS (SELECT vec_id, min(c) AS component_id FROM reach GROUP BY vec_id),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM component LEFT JOIN counted USING (vec_id)
"""

_REPAIR_STEP = """
  SELECT g, i - 1 AS i,
         list_min([{'c': 3 + z.c, 'a': 'D' || z.a}, {'c': f + 2 + t + u.c, 'a': 'R' || u.a},
                   {'c': f + t + if(x = 'u', u.c, if(x = 's', s.c, 1000000000)), 'a': 'K' || if(x = 'u', u.a, s.a)}]) AS z,
         list_min([{'c': 3 + s.c, 'a': 'D' || s.a}, {'c': f + 2 + t + u.c, 'a': 'R' || u.a},
                   {'c': f + t + if(x = 'u', u.c, 1000000000), 'a': 'K' || u.a}]) AS s,
         list_min([{'c': 3 + u.c, 'a': 'D' || u.a}, {'c': f + 2 + t + e.c, 'a': 'R' || e.a},
                   {'c': f + t + if(x = 'a', e.c, 1000000000), 'a': 'K' || e.a}]) AS u,
         list_min([{'c': 3 + e.c, 'a': 'D' || e.a}, {'c': f + 2 + t + u.c, 'a': 'R' || u.a},
                   {'c': f + t + if(x = 'u', u.c, 1000000000), 'a': 'K' || u.a}]) AS e
  FROM (SELECT back.*, if(blank OR copy, 1000000000, 0) AS f, if(cut, 1, 0) AS t, x
        FROM back JOIN flags ON flags.g = back.g AND flags.i = back.i - 1)"""
_REPAIR_CLOSE = """
  SELECT g, i, list_min([z, {{'c': 2 + u.c, 'a': 'I' || u.a}}]) AS z, list_min([s, {{'c': 2 + u.c, 'a': 'I' || u.a}}]) AS s,
         list_min([u, {{'c': 2 + e.c, 'a': 'I' || e.a}}]) AS u, list_min([e, {{'c': 2 + u.c, 'a': 'I' || u.a}}]) AS e
  FROM ({0})"""
_CLOSED = _REPAIR_CLOSE.format(_REPAIR_CLOSE.format(_REPAIR_CLOSE.format(_REPAIR_STEP)))

CONVERSATION_REPAIR = rf"""
WITH RECURSIVE crcs AS (
  SELECT list(v ORDER BY n) AS crc FROM (
    SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, y: if(c % 2 = 1, xor(c // 2, 3988292384), c // 2)) AS v FROM range(256) r(n))
),
groups AS (SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
faults AS (
  SELECT g, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(
             string_split(coalesce(CAST(c.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
             lambda y: CAST(ascii(y) AS BIGINT))),
           lambda c, b: xor(c // 256, crc[xor(c, b) % 256 + 1]))) % 20 AS fault
  FROM conversations c JOIN groups ON groups.conv_id IS NOT DISTINCT FROM c.conv_id, crcs
),
damaged AS (
  SELECT g, turn, if(fault = 4, 'user', role) AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(if(fault = 3, 2, 1)))
  FROM faults WHERE fault <> 0
),
numbered AS (
  SELECT g, turn, role, text, substr(role, 1, 1) AS x,
         row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, left(role, 32), left(text, 32),
                            sha256(length(role) || ':' || role || text)) AS i
  FROM damaged
),
flags AS (
  SELECT *, NOT regexp_matches(text, '[^ 	-
]') AS blank,
         row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS copy,
         regexp_matches(text, '[^ 	-
.!?][ 	-
]*$') AS cut,
         lag(x) OVER (PARTITION BY g ORDER BY i) || x AS pair
  FROM numbered
),
back AS (
  SELECT g, max(i) + 1 AS i, {{'c': 0::BIGINT, 'a': ''}} AS z, {{'c': 4::BIGINT, 'a': 'II'}} AS s,
         {{'c': 2::BIGINT, 'a': 'I'}} AS u, {{'c': 0::BIGINT, 'a': ''}} AS e FROM numbered GROUP BY g
  UNION ALL {_CLOSED}
),
best AS (SELECT g, z.c AS cost, z.a AS audit FROM back WHERE i = 1),
letters AS (
  SELECT g, unnest(string_split(audit, '')) AS letter, unnest(range(1, length(audit) + 1)) AS k,
         length(replace(audit, 'D', '')) % 2 AS shift
  FROM best WHERE audit <> ''
),
placed AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS o
  FROM letters WINDOW w AS (PARTITION BY g ORDER BY k)
),
repaired AS (
  SELECT g, string_agg(if(letter = 'K', role, if((o - shift) % 2 = 0, 'assistant', 'user')) || ':'
                       || if(letter = 'I', '', text), chr(10) ORDER BY k) AS text
  FROM placed LEFT JOIN numbered USING (g, i) WHERE letter <> 'D' GROUP BY g
),
counts AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (NOT blank AND copy) AS duplicate, count(*) FILTER (NOT blank AND NOT copy AND cut) AS truncated,
         count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM flags GROUP BY g
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(repaired.text, '')) AS repaired_sha256
FROM groups LEFT JOIN counts USING (g) LEFT JOIN best USING (g) LEFT JOIN repaired USING (g)
"""

def _clustering(k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> str:
    """Inner products of these integers are exact in doubles."""
    nearest = """
  SELECT n, vec_id, v, d.i AS cluster, d.d AS distance FROM (
    SELECT n, vec_id, v, list_min(list_transform(cs, lambda c: {{
      'd': CAST(list_inner_product(v, v) - 2 * list_inner_product(v, c.c) + list_inner_product(c.c, c.c) AS BIGINT),
      'i': c.i}})) AS d
    FROM whole, (SELECT list({{'i': i, 'c': c}} ORDER BY i) AS cs FROM c{0}))"""
    steps = "".join(
        f"""
a{r} AS MATERIALIZED ({nearest.format(r)}),
s{r} AS (SELECT cluster, j, CAST(sum(CAST(v[j] AS BIGINT)) AS BIGINT) AS s, count(*) AS n
       FROM a{r}, range(1, {dims + 1}) x(j) GROUP BY cluster, j),
m{r} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY j) AS c FROM s{r} GROUP BY cluster),
c{r + 1} AS MATERIALIZED (SELECT i, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} ON cluster = i),"""
        for r in range(rounds)
    )
    return f"""
WITH whole AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
c0 AS MATERIALIZED (
  SELECT i, v AS c FROM (
    SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, v) - 1 AS i FROM whole)
  WHERE i < {k}
),{steps}
last AS MATERIALIZED ({nearest.format(rounds)})
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
       CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM last JOIN c{rounds} ON i = cluster
"""


CENTROID_CLUSTERING = _clustering()

SQL = {
    "op1_substring_dedup": SUBSTRING_DEDUP,
    "op3_decontamination": DECONTAMINATION,
    "op6_embedding_dedup": EMBEDDING_DEDUP,
    "op11_clustering": CENTROID_CLUSTERING,
    "op13_conversation_repair": CONVERSATION_REPAIR,
}
