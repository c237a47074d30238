"""Vector search and embedding reuse."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import vectors
from millrace.operators import quality, retrieval, vectorindex
from millrace.sources import catalog
from millrace.workload import roles
from millrace.workload.quality import SUITE_SQL, suite
from millrace.workload.registry import register

DIMS = 256

CENTROIDS = """p AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT label, i, avg(x) AS x FROM p GROUP BY 1, 2),
s AS (SELECT label, sqrt(sum(x * x)) AS n FROM m GROUP BY 1),
c AS (SELECT label, list(x / n ORDER BY i) AS vec FROM m JOIN s USING (label) GROUP BY 1)"""


def label_centroids(spark, root):
    """One unit vector per label, out of all vectors."""
    cells = roles.embeddings(spark, root).select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda cell: cell["x"])
    return means.groupBy("label").agg(ordered.alias("_v")).select("label", vectors.unit(F.col("_v")).alias("vector"))


@register("V1 F22", sql="""SELECT vec_id, round(sqrt(list_dot_product(e, e)), 6) AS size, round(list_dot_product(u, u), 6) AS unit_size, round(u[1], 6) AS first FROM (
SELECT vec_id, e, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS u FROM (
SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * (1 + label)) AS e FROM embeddings))""")
def unit_vectors(spark, root):
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.lit(1) + F.col("label")))
    rows = roles.embeddings(spark, root).select("vec_id", scaled.alias("e")).withColumn("u", vectors.unit(F.col("e")))
    return rows.select(
        "vec_id", F.round(vectors.norm(F.col("e")), 6).alias("size"), F.round(vectors.dot(F.col("u"), F.col("u")), 6).alias("unit_size"),
        F.round(F.col("u")[0], 6).alias("first"),
    )


@register("V2 V3", sql=f"""WITH {CENTROIDS}
SELECT vec_id, e.label, round(list_dot_product(embedding::DOUBLE[], vec), 6) AS dot,
       round(list_dot_product(embedding::DOUBLE[], vec) / (sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_dot_product(vec, vec))), 6) AS cosine
FROM embeddings e JOIN c ON c.label = e.label""")
def similarity_to_own_label(spark, root):
    rows = roles.embeddings(spark, root).join(label_centroids(spark, root), "label")
    a, b = F.col("embedding"), F.col("vector")
    return rows.select("vec_id", "label", F.round(vectors.dot(a, b), 6).alias("dot"), F.round(vectors.cosine(a, b), 6).alias("cosine"))


def _shown(found):
    return found.withColumn("score", F.round("score", 6))


SCORED = f"""{CENTROIDS}, x AS (SELECT c.label AS query_id, vec_id AS item_id, round(list_dot_product(embedding::DOUBLE[], vec), 12) AS score FROM c, embeddings),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM x"""


@register("V4 T3 W13", sql=f"WITH {SCORED}) SELECT query_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5")
def nearest_to_label_centroids(spark, root):
    items = roles.embeddings(spark, root).withColumnRenamed("embedding", "vector")
    return _shown(retrieval.top_matches(label_centroids(spark, root), items, "label", "vec_id", k=5, min_score=None))


@register("V7 T2 J14", sql=f"WITH {SCORED} WHERE score >= 0.3) SELECT query_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3")
def search_with_floor(spark, root):
    items = roles.embeddings(spark, root).withColumnRenamed("embedding", "vector")
    return _shown(retrieval.top_matches(label_centroids(spark, root), items, "label", "vec_id"))


@register("V4 V6 T3 J14 W13", sql="""WITH x AS (SELECT a.vec_id AS query_id, b.vec_id AS item_id, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 12) AS score FROM embeddings a, embeddings b),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM x)
SELECT query_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""")
def nearest_vectors(spark, root):
    """The five nearest vectors of every vector, over a stored index of the same table."""
    rows = roles.embeddings(spark, root)
    index = vectorindex.build_index(rows, "vec_id", "embedding")
    return _shown(vectorindex.search(index, rows, "vec_id", "embedding", k=5))


def _terms(name: str, table: str, key: str, text: str = "text") -> str:
    return f"""{name}_t AS (SELECT {key} AS id, unnest(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+')) AS w FROM {table}),
{name}_c AS (SELECT id, ('0x' || left(md5(w), 8))::BIGINT % {DIMS} AS b, CAST(count(*) AS DOUBLE) AS n FROM {name}_t GROUP BY 1, 2),
{name}_n AS (SELECT id, sqrt(sum(n * n)) AS s FROM {name}_c GROUP BY 1),
{name} AS (SELECT c.id, b, n / s AS x FROM {name}_c c JOIN {name}_n USING (id))"""


TEXT_SEARCH = f"""{_terms('q', 'benchmark', 'item_id')}, {_terms('d', 'documents', 'doc_id')},
x AS (SELECT q.id AS query_id, d.id AS item_id, round(sum(q.x * d.x), 12) AS score FROM q JOIN d USING (b) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM x WHERE score >= 0.3)"""


def _document_matches(spark, root):
    embed = retrieval.term_embedder(DIMS)
    questions = retrieval.embed_column(roles.benchmark(spark, root), "text", embed, DIMS)
    items = retrieval.embed_column(roles.documents(spark, root).select("doc_id", "text"), "text", embed, DIMS)
    return retrieval.top_matches(questions, items, "item_id", "doc_id")


@register("V7 K1 V10", sql=f"WITH {TEXT_SEARCH} SELECT query_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3")
def passages_in_documents(spark, root):
    return _shown(_document_matches(spark, root))


@register("V9", sql=f"""WITH {TEXT_SEARCH}, c AS (SELECT item_id, CASE WHEN score IS NULL THEN 0.0 ELSE least(score * 1.1::DOUBLE, 1.0::DOUBLE) END AS confidence FROM benchmark
LEFT JOIN (SELECT query_id, score FROM r WHERE rank = 1) t ON t.query_id = benchmark.item_id) SELECT *, confidence < 0.3 AS declined FROM c""")
def question_confidence(spark, root):
    questions = roles.benchmark(spark, root).select("item_id")
    return retrieval.with_confidence(questions, "item_id", _document_matches(spark, root))


# Every supplier is a catalogue entry whose columns are the part types it ships.
ENTRIES_SQL = """e AS (SELECT concat('supply.', s_name) AS table_name, concat('Parts shipped by supplier ', s_suppkey) AS description, s_suppkey,
  (SELECT list({'name': p_type, 'n': n} ORDER BY p_type) FROM (SELECT p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_suppkey = s_suppkey GROUP BY 1)) AS cols
  FROM supplier)"""


def supplier_entries(spark, root):
    parts = roles.part(spark, root).select(F.col("p_partkey").alias("l_partkey"), "p_type")
    types = (
        roles.lineitem(spark, root).join(parts, "l_partkey").groupBy(F.col("l_suppkey").alias("s_suppkey"), "p_type").agg(F.count("*").alias("n"))
        .groupBy("s_suppkey")
        .agg(F.sort_array(F.collect_list(F.struct(F.col("p_type").alias("name"), F.concat("n", F.lit(" lines")).alias("description")))).alias("columns"))
    )
    samples = F.array(*[F.concat(F.lit(f"SELECT {i} FROM "), "s_name") for i in range(1, 5)])
    return roles.supplier(spark, root).join(types, "s_suppkey").select(
        F.concat(F.lit("supply."), "s_name").alias("table_name"), F.concat(F.lit("Parts shipped by supplier "), "s_suppkey").alias("description"),
        "columns", F.when(F.col("s_suppkey") % 2 == 0, samples).otherwise(F.array().cast("array<string>")).alias("sample_queries"), "s_name", "s_suppkey",
    )


@register("V5 F9 F21", sql=f"""WITH {ENTRIES_SQL} SELECT table_name, concat('Table: ', table_name, '. ', description, '. Columns: ',
  array_to_string(list_transform(cols, lambda c: concat(c.name, ' (', c.n, ' lines)')), ', '),
  CASE WHEN s_suppkey % 2 = 0 THEN concat(' Example queries: ', array_to_string(list_transform([1, 2, 3], lambda i: concat('SELECT ', i, ' FROM ', substring(table_name, 8))), '; ')) ELSE '' END) AS text
FROM e WHERE cols IS NOT NULL""")
def catalogue_texts(spark, root):
    c = F.col
    text = retrieval.entry_text(c("table_name"), c("description"), c("columns"), c("sample_queries"))
    return supplier_entries(spark, root).select("table_name", text.alias("text"))


@register("V8", sql=f"""WITH {ENTRIES_SQL}, r AS (SELECT l_orderkey AS query_id, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY count(*) DESC, l_suppkey) AS rank FROM lineitem GROUP BY 1, 2),
t AS (SELECT s_suppkey, concat('Table: ', table_name, chr(10), 'Description: ', description, chr(10), 'Columns:', chr(10),
  array_to_string(list_transform(cols, lambda c: concat('  - ', c.name, ': ', c.n, ' lines', chr(10))), ''),
  CASE WHEN s_suppkey % 2 = 0 THEN concat('Example queries:', chr(10), array_to_string(list_transform([1, 2], lambda i: concat('  - SELECT ', i, ' FROM ', substring(table_name, 8), chr(10))), '')) ELSE '' END) AS x FROM e)
SELECT query_id, string_agg(x, concat(chr(10), '---', chr(10)) ORDER BY rank) AS context FROM r JOIN t ON s_suppkey = l_suppkey WHERE rank <= 3 GROUP BY 1""")
def rendered_context(spark, root):
    """Catalogue entries of the three suppliers that matter most to each order."""
    from millrace.operators.ordered import first_per_key

    ranked = first_per_key(
        roles.lineitem(spark, root).groupBy(F.col("l_orderkey").alias("query_id"), F.col("l_suppkey").alias("item_id")).agg(F.count("*").alias("n")),
        ["query_id"], [F.desc("n"), F.col("item_id")], 3, "rank",
    )
    c = F.col
    shown = retrieval.entry_context(c("table_name"), c("description"), c("columns"), c("sample_queries"))
    contexts = supplier_entries(spark, root).select("s_suppkey", shown.alias("text"))
    return retrieval.context_per_query(ranked, contexts, "s_suppkey", "text")


def _rendered(name, description, columns, samples):
    listed = ", ".join(f"{c} ({d})" for c, d in columns)
    examples = f" Example queries: {'; '.join(samples[:3])}" if samples else ""
    return f"Table: {name}. {description}. Columns: {listed}{examples}".replace("'", "''")


TABLE_VALUES = ", ".join(f"('{t[0]}', '{_rendered(*t)}')" for t in catalog.BUSINESS_TABLES)


@register("V6 V7 V10 C4", sql=f"""WITH tabs AS (SELECT * FROM (VALUES {TABLE_VALUES}) v(table_name, text)),
turns AS (SELECT conv_id * 1000 + turn AS turn_id, text FROM conversations WHERE role = 'user'),
{_terms('q', 'turns', 'turn_id')}, {_terms('d', 'tabs', 'table_name')},
x AS (SELECT q.id AS query_id, d.id AS item_id, round(sum(q.x * d.x), 12) AS score FROM q JOIN d USING (b) GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS rank FROM x WHERE score >= 0.05)
SELECT query_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3""")
def tables_for_user_turns(spark, root):
    """Business tables that match each user turn, over an index that is rendered, embedded and stored."""
    from millrace.workspace import scratch_path

    embed = retrieval.term_embedder(DIMS)
    c = F.col
    entries = catalog.business_tables(spark).withColumn(
        "text", retrieval.entry_text(c("table_name"), c("description"), c("columns"), c("sample_queries"))
    )
    path = scratch_path(spark, "schema-index")
    retrieval.embed_column(entries, "text", embed, DIMS).write.parquet(path)
    turns = roles.conversations(spark, root).where("role = 'user'").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("turn_id"), "text"
    )
    asked = retrieval.embed_column(turns, "text", embed, DIMS)
    return _shown(retrieval.top_matches(asked, spark.read.parquet(path), "turn_id", "table_name", min_score=0.05))


@register("V11 J15 U3 F7", sql="""WITH s AS (SELECT DISTINCT left(sha256(text), 16) AS key FROM benchmark),
r AS (SELECT 'document' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'benchmark', item_id, text FROM benchmark),
k AS (SELECT kind, id, left(sha256(text), 16) AS key FROM r)
SELECT kind, id, key, key IN (SELECT key FROM s) AS reused, false AS rejected, 1.0::DOUBLE AS size FROM k""")
def embedding_reuse(spark, root):
    embed = retrieval.term_embedder(64)
    wanted = roles.benchmark(spark, root).select(F.lit("benchmark").alias("kind"), F.col("item_id").alias("id"), "text")
    requests = roles.documents(spark, root).select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text").unionByName(wanted)
    empty = spark.createDataFrame([], "key string, vector array<double>")
    stored, _ = retrieval.embed_missing(wanted, empty, "text", embed, 64)
    complete, flagged = retrieval.embed_missing(requests, stored, "text", embed, 64)
    sized = complete.select("key", F.round(vectors.norm(F.col("vector")), 6).alias("size"))
    return flagged.select("kind", "id", "key", "reused", "rejected").join(sized, "key", "left")


@register("V12", sql="""WITH l AS (SELECT text IN (SELECT text FROM documents GROUP BY 1 HAVING count(*) > 1) AS hit, CAST(n_chars AS DOUBLE) AS latency_ms, lang = 'de' AND n_chars > 5000 AS error FROM documents)
SELECT count(*) AS total_requests, count(*) FILTER (hit) AS cache_hits, count(*) FILTER (NOT hit) AS cache_misses, count(*) FILTER (hit) / CAST(count(*) AS DOUBLE) AS cache_hit_rate,
sum(latency_ms) / count(*) AS avg_latency_ms, count(*) FILTER (error) / CAST(count(*) AS DOUBLE) AS error_rate FROM l""")
def embedding_call_metrics(spark, root):
    docs = roles.documents(spark, root).withColumn("key", F.sha2("text", 256))
    copies = docs.groupBy("key").count().where("count > 1").select("key", F.lit(True).alias("_copied"))
    log = docs.join(copies, "key", "left").select(
        F.coalesce("_copied", F.lit(False)).alias("hit"), F.col("n_chars").cast("double").alias("latency_ms"),
        ((F.col("lang") == "de") & (F.col("n_chars") > 5000)).alias("error"),
    )
    return retrieval.reuse_metrics(log)


RECORDS_SQL = f"""{SUITE_SQL}, recs AS (SELECT concat_ws(' ', check_name, message) AS item, concat_ws(' ', check_name, 'events', message, severity) AS text FROM r),
{_terms('asked', 'benchmark', 'item_id')}, {_terms('found', 'recs', 'item')},
y AS (SELECT asked.id AS query_id, found.id AS item_id, sum(asked.x * found.x) AS score FROM asked JOIN found USING (b) GROUP BY 1, 2),
x AS (SELECT i.item_id AS query_id, item, round(coalesce(score, 0), 12) AS score FROM benchmark i CROSS JOIN recs LEFT JOIN y ON y.query_id = i.item_id AND y.item_id = item),
z AS (SELECT query_id, item AS item_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item) AS rank FROM x)
SELECT query_id, item_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM z WHERE rank <= 5"""


@register("V13", sql=RECORDS_SQL)
def audit_records_for_questions(spark, root):
    """Quality-audit records that match the benchmark questions."""
    embed = retrieval.term_embedder(DIMS)
    records = quality.audit_log(suite(spark, root)).select(
        F.concat_ws(" ", "check", "message").alias("item"), F.concat_ws(" ", "check", "table", "message", "severity").alias("text")
    )
    questions = retrieval.embed_column(roles.benchmark(spark, root), "text", embed, DIMS)
    return _shown(retrieval.top_matches(questions, retrieval.embed_column(records, "text", embed, DIMS), "item_id", "item", k=5, min_score=0.0))
