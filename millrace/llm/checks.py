"""DuckDB SQL that checks the queries of this package whose results SQL can express."""

from __future__ import annotations

# Vectors whose components are all there and finite, as integers.
_VECTORS = """WITH f AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})) AS v FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
k AS (SELECT vec_id, label, list_transform(v, lambda x: x::BIGINT) AS v, row_number() OVER (ORDER BY vec_id, v, label) AS pos FROM f)"""


def vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Plain k-means per part with all distances, one block of tables per round."""
    width = f"(len(v) // {parts})"
    sql = [_VECTORS.format(scale=scale) + f""",
p AS MATERIALIZED (SELECT pos, part, v[part * {width} + 1:(part + 1) * {width}] AS x FROM k, range({parts}) r(part)),
b0 AS MATERIALIZED (SELECT part, pos - 1 AS entry, x AS e FROM p WHERE pos <= {entries})"""]
    for i in range(rounds + 1):
        sql.append(f"""a{i} AS MATERIALIZED (SELECT pos, part, x, min(list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {entries} + entry) AS best
  FROM p JOIN b{i} USING (part) GROUP BY 1, 2, 3)""")
        if i < rounds:
            sql.append(f"""c{i} AS (SELECT part, best % {entries} AS entry, unnest(x) AS x, generate_subscripts(x, 1) AS i FROM a{i}),
m{i} AS (SELECT part, entry, list(q ORDER BY i) AS e FROM (SELECT part, entry, i, floor(sum(x) / count(*))::BIGINT AS q FROM c{i} GROUP BY 1, 2, 3) GROUP BY 1, 2),
b{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{i}.e, b{i}.e) AS e FROM b{i} LEFT JOIN m{i} USING (part, entry))""")
    sql.append(f"""h AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds}),
o AS (SELECT pos, string_agg(lower(printf('%02x', best % {entries})), '' ORDER BY part) AS code, sum(best // {entries})::BIGINT AS error FROM a{rounds} GROUP BY 1)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM k JOIN o USING (pos), h""")
    return ",\n".join(sql[:-1]) + ",\n" + sql[-1]


LINE_DEDUP = r"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
m AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, m.key IS NOT NULL AND doc_id <> last AS gone FROM k LEFT JOIN m ON m.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM j GROUP BY 1"""

# The crc32 of every distinct word, byte by byte over the table of the polynomial.
RESAMPLING = r"""WITH RECURSIVE t AS (SELECT list(c ORDER BY i) AS crc FROM (SELECT i, list_reduce(range(8), lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS c FROM range(256) r(i))),
w AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS word FROM documents),
g AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS word FROM benchmark),
v AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM w UNION SELECT word FROM g)),
b AS MATERIALIZED (SELECT word, xor(list_reduce(list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT), lambda c, y: xor(c >> 8, crc[(xor(c, y) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket FROM v, t),
s AS (SELECT bucket, count(*) AS n FROM w JOIN b USING (word) GROUP BY 1), u AS (SELECT bucket, count(*) AS n FROM g JOIN b USING (word) GROUP BY 1),
z AS (SELECT (SELECT count(*) FROM w)::DOUBLE + 10000 AS big, (SELECT count(*) FROM g)::DOUBLE + 10000 AS small),
gain AS (SELECT r.bucket, floor(1000 * ln(((coalesce(u.n, 0) + 1)::DOUBLE * big) / ((coalesce(s.n, 0) + 1)::DOUBLE * small)))::BIGINT AS gain FROM range(10000) r(bucket) LEFT JOIN s USING (bucket) LEFT JOIN u USING (bucket), z),
f AS (SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM w JOIN b USING (word) JOIN gain USING (bucket) GROUP BY 1),
c AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM documents LEFT JOIN f USING (doc_id)),
p AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM c WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM p) THEN place END AS rank FROM c LEFT JOIN p USING (doc_id)"""

TOP_K = """WITH k AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM k q JOIN k c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 20"""

DECONTAMINATION = r"""WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, w, least(len(w), 5) AS k FROM (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark) WHERE len(w) > 0),
a AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda n: array_to_string(w[n:n + k - 1], ' '))) AS run FROM i),
b AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda n: array_to_string(w[n:n + k - 1], ' '))) AS run FROM d, (SELECT DISTINCT k FROM i) WHERE len(w) >= k),
n AS (SELECT item_id, count(*) AS n_item FROM a GROUP BY 1),
s AS (SELECT doc_id, item_id, count(*) AS n_shared FROM a JOIN b USING (k, run) GROUP BY 1, 2)
SELECT doc_id, item_id, n_item, n_shared, n_shared / CAST(n_item AS DOUBLE) AS containment FROM s JOIN n USING (item_id) WHERE n_shared / CAST(n_item AS DOUBLE) >= 0.8"""
