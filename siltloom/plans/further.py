"""Further queries of the core with their SQL: sources and sinks over written files, filters, text rules, searches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltloom.common import map_rows, table, table_stream
from siltloom.functions import code as C
from siltloom.functions import html as H
from siltloom.functions import text as T
from siltloom.operators import dataset, dedup, graph, relational, retrieval
from siltloom.plans.catalogue import _BM25, _IMPORTS_SQL, _JACCARD, _TOK, _document_terms, _imports, _search_queries, _stream_dir, query
from siltloom.sources import files, pictures, sinks
from siltloom.streaming import feeds

# sinks and sources: written to the shared folder, read again


@query("SELECT lang, count(*) AS documents, sum(doc_id)::BIGINT AS ids FROM documents GROUP BY lang")
def sink_per_group(spark: SparkSession, d: str) -> DataFrame:
    path = _stream_dir(spark)
    sinks.per_group_json(table(spark, d, "documents").select("doc_id", "lang"), path, "lang")
    return spark.read.schema("doc_id long, lang string").json(path).groupBy("lang").agg(F.count("*").alias("documents"), F.sum("doc_id").alias("ids"))


@query("SELECT o_orderstatus AS status, count(*) AS orders FROM orders GROUP BY o_orderstatus")
def sink_by_category(spark: SparkSession, d: str) -> DataFrame:
    path = _stream_dir(spark)
    sinks.by_category(table(spark, d, "orders").select("o_orderkey", F.col("o_orderstatus").alias("category")), path)
    return spark.read.schema("o_orderkey long, category string").json(path).groupBy(F.col("category").alias("status")).agg(F.count("*").alias("orders"))


@query("SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey % 2 = 0")
def sink_appended(spark: SparkSession, d: str) -> DataFrame:
    """All rows, then the even ones once more."""
    path, rows = _stream_dir(spark), table(spark, d, "supplier").select("s_suppkey", "s_name")
    sinks.append(rows, path)
    sinks.append(rows.where("s_suppkey % 2 = 0"), path)
    return spark.read.parquet(path)


@query("SELECT r_name AS folder_name, CAST(NULL AS VARCHAR) AS png_content, CAST(NULL AS VARCHAR) AS jpg_content, CAST(NULL AS VARCHAR) AS ets_content, r_regionkey::VARCHAR AS txt_content, CAST(NULL AS VARCHAR) AS generated_xml FROM region")
def sink_explicit_schema(spark: SparkSession, d: str) -> DataFrame:
    path = _stream_dir(spark)
    sinks.explicit_parquet(table(spark, d, "region").select(F.col("r_name").alias("folder_name"), F.col("r_regionkey").alias("txt_content"), F.lit(1).alias("more")), path)
    return spark.read.parquet(path)


@query("SELECT vec_id AS id FROM embeddings")
def vector_collection(spark: SparkSession, d: str) -> DataFrame:
    """A collection filled by a third of the vectors, then by all: each is stored once."""
    path, rows = _stream_dir(spark), table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    sinks.vector_collection(rows.where("id % 3 = 0"), path)
    sinks.vector_collection(rows, path)
    return spark.read.parquet(path).select("id")


@query("SELECT min(doc_id) AS doc_id, md5(text) AS h FROM documents WHERE text IS NOT NULL GROUP BY text")
def resumed_batches(spark: SparkSession, d: str) -> DataFrame:
    """A stream run twice from the start into one folder: the second run finds every key stored and adds nothing."""
    folder = _stream_dir(spark)

    def work(rows: DataFrame) -> DataFrame:
        return rows.where("text is not null").groupBy(F.md5("text").alias("h")).agg(F.min("doc_id").alias("doc_id"))

    for run in (1, 2):
        feeds.run_into(table_stream(spark, d, "documents"), f"{folder}/out", f"{folder}/checkpoint{run}", work, "h").awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("doc_id", "h")


def _written_tree(spark: SparkSession, d: str) -> str:
    """Supplier names as text files: one folder per nation below an application's sources, and the same below a pruned folder."""
    path = _stream_dir(spark)
    rows = table(spark, d, "supplier").select("s_name", F.col("s_nationkey").alias("nation"))
    for below in ("main/ets/pages", "build/main/ets/pages", "main/ets/common"):
        rows.repartition("nation").sortWithinPartitions("nation", "s_name").write.partitionBy("nation").text(f"{path}/app/{below}")
    return path


_TREE_SQL = "SELECT s_nationkey::INT AS nation, sum(length(s_name) + 1)::BIGINT AS chars FROM supplier GROUP BY s_nationkey"


@query(_TREE_SQL)
def ui_source_texts(spark: SparkSession, d: str) -> DataFrame:
    """The files of the UI folders outside pruned ones, decoded."""
    found = files.decoded(files.ui_sources(files.source_files(spark, _written_tree(spark, d), "*.txt")))
    return found.groupBy(F.regexp_extract("path", r"nation=(\d+)", 1).cast("int").alias("nation")).agg(F.sum(F.length("text")).alias("chars"))


@query("SELECT count(*) AS lines, count(DISTINCT s_name) AS names FROM supplier")
def line_lists(spark: SparkSession, d: str) -> DataFrame:
    path = _stream_dir(spark)
    table(spark, d, "supplier").select(F.concat(F.lit("  "), "s_name", F.lit("\t"))).unionByName(spark.createDataFrame([(" ",), ("",)], "s string").toDF("concat(  , s_name, \t)")).write.text(path)
    return files.line_list(spark, path).agg(F.count("*").alias("lines"), F.count_distinct("line").alias("names"))


@query("SELECT s_suppkey AS id, s_name AS repo_name, 'u' || s_suppkey AS repo_url, (s_suppkey % 2)::INT AS cloned FROM supplier")
def repo_lists(spark: SparkSession, d: str) -> DataFrame:
    path = _stream_dir(spark)
    line = F.concat_ws(",", "s_suppkey", "s_name", F.concat(F.lit("u"), "s_suppkey"), F.col("s_suppkey") % 2)
    marks = spark.createDataFrame([("# COMPLETED",), ("",)], "line string")
    table(spark, d, "supplier").select(line.alias("line")).unionByName(marks).write.text(path)
    return files.repo_list(spark, path)


@query("SELECT n_name AS key, k AS pos, CASE WHEN n_nationkey % 3 = 0 THEN NULL WHEN k = 0 THEN n_regionkey ELSE n_nationkey END AS item, n_nationkey % 3 = 0 AS failed FROM nation, (VALUES (0), (1)) v(k) WHERE k = 0 OR n_nationkey % 3 <> 0")
def json_elements(spark: SparkSession, d: str) -> DataFrame:
    """Lists with a comma too many; every third text breaks off and is one failed row."""
    made = F.when(F.col("n_nationkey") % 3 == 0, F.lit("[1, {")).otherwise(F.concat(F.lit("["), "n_regionkey", F.lit(",\n"), "n_nationkey", F.lit(",\n]")))
    got = files.json_items(table(spark, d, "nation").select(F.col("n_name").alias("path"), made.alias("text")))
    return got.select(F.col("path").alias("key"), "pos", F.col("item").cast("int").alias("item"), F.col("failed").isNotNull().alias("failed"))


@query("SELECT n_name AS path, (i - 1)::INT AS pos, CASE i WHEN 1 THEN n_regionkey ELSE n_nationkey END AS item FROM nation, (VALUES (1), (2)) v(i) WHERE n_nationkey % 4 <> 0 UNION ALL SELECT n_name, 0, NULL FROM nation WHERE n_nationkey % 4 = 0")
def json_nested_elements(spark: SparkSession, d: str) -> DataFrame:
    """Elements two levels down; a text that cannot be read is one row without an item."""
    made = F.when(F.col("n_nationkey") % 4 == 0, F.lit("{")).otherwise(F.concat(F.lit('{"a": {"x": '), "n_regionkey", F.lit('}, "b": ['), "n_nationkey", F.lit("]}")))
    return files.nested_items(table(spark, d, "nation").select(F.col("n_name").alias("path"), made.alias("text"))).select("path", "pos", F.col("item").cast("int").alias("item"))


@query("SELECT o_orderkey, o_orderkey % 9 AS version, o_orderstatus AS status FROM orders")
def json5_read(spark: SparkSession, d: str) -> DataFrame:
    """Configuration texts with comments, bare keys, single quotes and a comma too many."""
    made = F.concat(F.lit("{ // settings\n  version: "), F.col("o_orderkey") % 9, F.lit(", 'status': '"), "o_orderstatus", F.lit("',\n}"))
    fixed = F.regexp_replace(made, r",\s*([}\]])", "$1")
    return table(spark, d, "orders").select("o_orderkey", F.from_json(fixed, "version long, status string", T.json5_options()).alias("c")).select("o_orderkey", "c.version", "c.status")


# filters


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 2")
def config_with_key(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey") % 3
    made = F.when(k == 0, '{"app": {"compatibleSdkVersion": 9}}').when(k == 1, "{app: {compatibleSdkVersion : '5'}}").otherwise('{"note": "compatibleSdkVersion"}')
    return relational.has_key(table(spark, d, "orders").select("o_orderkey", made.alias("config")), "config").select("o_orderkey")


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '4.0.0(10)' WHEN 1 THEN '5.0.0(12)' ELSE '11' END AS version, CASE WHEN o_orderkey % 3 < 2 THEN 'HarmonyOS' ELSE 'OpenHarmony' END AS runtime, o_orderkey % 3 < 2 AS bare FROM orders")
def rewritten_products(spark: SparkSession, d: str) -> DataFrame:
    sdk = F.element_at(F.array(F.lit(10), F.lit(12), F.lit(11)), (F.col("o_orderkey") % 3 + 1).cast("int"))
    product = F.struct(sdk.alias("compileSdkVersion"), sdk.alias("compatibleSdkVersion"), F.lit("OpenHarmony").alias("runtimeOS"))
    p = F.get(relational.rewrite_products(F.array(product)), F.lit(0))
    return table(spark, d, "orders").select("o_orderkey", p["compatibleSdkVersion"].alias("version"), p["runtimeOS"].alias("runtime"), p["compileSdkVersion"].isNull().alias("bare"))


@query("SELECT event_id FROM events WHERE event_type IN ('click', 'view')")
def platform_calls(spark: SparkSession, d: str) -> DataFrame:
    made = F.when(F.col("event_type") == "click", "android.view.View").when(F.col("event_type") == "view", "androidx.core.App").otherwise("androidy.Other")
    return relational.api_calls_only(table(spark, d, "events").select("event_id", made.alias("class"))).select("event_id")


_USED = "u AS (SELECT DISTINCT u.unit_id, i.analysis_id * 1000 + i.pos AS pos, i.module_name, i.name FROM function_info u JOIN " + _IMPORTS_SQL + " i USING (file) WHERE i.name <> '' AND i.module_name IS NOT NULL AND contains(u.content, i.name)), "
_VARS = "v AS (SELECT u.unit_id, count(*) AS n FROM function_info u JOIN (SELECT file, x.name AS name FROM (SELECT file, unnest(variables) AS x FROM ets_file_analysis) WHERE x IS NOT NULL) y USING (file) WHERE y.name <> '' AND contains(u.content, y.name) GROUP BY u.unit_id)"
_CONTEXT = "WITH " + _USED + _VARS + ", m AS (SELECT unit_id, count(DISTINCT module_name) AS modules FROM u GROUP BY unit_id) SELECT f.unit_id, coalesce(m.modules, 0)::INT AS modules, coalesce(v.n, 0)::INT AS variables FROM function_info f LEFT JOIN m USING (unit_id) LEFT JOIN v USING (unit_id) WHERE (m.modules IS NOT NULL OR v.n IS NOT NULL)"


def _with_context(spark: SparkSession, d: str, origin: bool) -> DataFrame:
    own = table(spark, d, "ets_file_analysis")
    variables = own.select("file", F.posexplode("variables").alias("pos", "v")).where("v is not null").select("file", "pos", F.col("v.name").alias("name"), F.col("v.full_variable").alias("full_variable"))
    imports = _imports(spark, d).where("module_name is not null").withColumn("pos", F.col("analysis_id") * 1000 + F.col("pos")).drop("analysis_id")
    found = relational.code_with_context(table(spark, d, "function_info").select("unit_id", "file", "content"), imports, variables, origin)
    return found.select("unit_id", F.size("imports").alias("modules"), F.size("variables").alias("variables"))


@query(_CONTEXT)
def context_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many import statements and variables each unit gets with it."""
    return _with_context(spark, d, False)


@query(_CONTEXT + " AND f.unit_id NOT IN (SELECT unit_id FROM u WHERE starts_with(module_name, '.'))")
def context_counts_origin(spark: SparkSession, d: str) -> DataFrame:
    """The same without units that use a relative import."""
    return _with_context(spark, d, True)


# text rules


@query("SELECT pair_id, replace(coalesce(description, ''), chr(92) || 'n', chr(10)) AS text FROM instruction_pairs")
def unescaped_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "instruction_pairs").select("pair_id", T.unescape_newlines(F.coalesce("description", F.lit(""))).alias("text"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 0.0 ELSE 1.0 / (2 + c_custkey % 5) END AS likeness FROM customer")
def set_likeness(spark: SparkSession, d: str) -> DataFrame:
    """Sets that share one element; every fifth pair is empty on both sides."""
    k = (F.col("c_custkey") % 5).cast("int")
    none = F.array().cast("array<string>")
    a = F.when(k == 0, none).otherwise(F.array(F.lit("x"), F.lit("a")))
    b = F.when(k == 0, none).otherwise(F.concat(F.array(F.lit("x")), F.transform(F.sequence(F.lit(1), F.greatest(k, F.lit(1))), lambda i: F.concat(F.lit("b"), i))))
    return table(spark, d, "customer").select("c_custkey", T.jaccard(a, b).alias("likeness"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'find import a from ''b''' || chr(10) || 'x import a from ''b''import a from ''b''' ELSE 'find ' || o_orderkey END AS text FROM orders")
def boosted_queries(spark: SparkSession, d: str) -> DataFrame:
    made = F.when(F.col("o_orderkey") % 2 == 0, F.lit("find import a from 'b'\nx")).otherwise(F.concat(F.lit("find "), "o_orderkey"))
    lines = F.when(F.col("o_orderkey") % 2 == 0, F.lit("import a from 'b'")).otherwise(F.lit(""))
    whole = F.when(lines != "", T.boosted_query(F.concat(lines, F.lit("\n"), made))).otherwise(T.boosted_query(made))
    return table(spark, d, "orders").select("o_orderkey", F.regexp_replace(whole, "^import a from 'b'\n", "").alias("text"))


@query("SELECT s_suppkey, n AS name, a AS alias, 'm' || s_suppkey AS path FROM supplier, (VALUES ('A', 'A'), ('B', 'C')) v(n, a)")
def named_imports(spark: SparkSession, d: str) -> DataFrame:
    made = F.concat(F.lit("import { A, B as C } from 'm"), "s_suppkey", F.lit("';\nimport D from 'x';"))
    return table(spark, d, "supplier").select("s_suppkey", F.explode(T.aliased_imports(made)).alias("i")).select("s_suppkey", "i.name", "i.alias", "i.path")


@query("SELECT s_suppkey, 'import a from ''@kit/' || s_suppkey || '''' || chr(10) || '@Entry' || chr(10) || '@Component' || chr(10) || 'struct Index {' || chr(10) || '  v: number = ' || s_nationkey || chr(10) || 'build() {}' || chr(10) || '}' AS page, 1 AS others FROM supplier")
def template_pages(spark: SparkSession, d: str) -> DataFrame:
    imports = F.array(F.concat(F.lit("import a from '@kit/"), "s_suppkey", F.lit("'")), F.lit("import b from './b'"))
    page = T.template_page(F.lit("build() {}"), imports, F.array(F.concat(F.lit("v: number = "), "s_nationkey")))
    return table(spark, d, "supplier").select("s_suppkey", page.alias("page"), F.size(T.cross_file_context(imports)).alias("others"))


@query("SELECT s_suppkey, '// updated now' || chr(10) || 'a // <slot>' || chr(10) || s_nationkey || chr(10) || '// </slot> b' AS text, 'distributionUrl=https://mirror.example/d' || s_suppkey AS wrapper FROM supplier")
def replaced_texts(spark: SparkSession, d: str) -> DataFrame:
    text = T.replace_marked(F.lit("a // <slot>old\nmore// </slot> b"), F.col("s_nationkey").cast("string"), F.lit("now"))
    wrapper = T.distribution_mirror(F.concat(F.lit("distributionUrl=https\\://services.gradle.org/distributions/d"), "s_suppkey"), "https://mirror.example")
    return table(spark, d, "supplier").select("s_suppkey", text.alias("text"), wrapper.alias("wrapper"))


@query("SELECT s_suppkey, 2 AS found, 2 AS previews FROM supplier")
def composable_functions(spark: SparkSession, d: str) -> DataFrame:
    made = F.concat(F.lit("@Preview(showBackground = true)\n@Composable\nfun A"), "s_suppkey", F.lit("() { Text(\"a\") }\n@Composable\nfun B(x: Int) { Text(\"b\") }\nfun c() {}"))
    found = T.composables(made)
    return table(spark, d, "supplier").select("s_suppkey", F.size(found).alias("found"), F.size(F.filter(found, lambda x: x.startswith("@Preview"))).alias("previews"))


@query("SELECT repo_id, min(regexp_replace(repo_name, '_[0-9]+$', '')) AS prefix FROM repo_list GROUP BY repo_id")
def folder_prefixes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "repo_list").groupBy("repo_id").agg(F.min(T.folder_prefix(F.col("repo_name"))).alias("prefix"))


@query("SELECT sum(CASE WHEN imports IS NULL THEN 0 ELSE len(imports) END + CASE WHEN variables IS NULL THEN 0 ELSE len(variables) END)::BIGINT AS entries FROM ets_file_analysis")
def map_entries(spark: SparkSession, d: str) -> DataFrame:
    lists = [F.coalesce(F.transform(c, lambda x: F.lit(1)), F.array().cast("array<int>")) for c in ("imports", "variables")]
    return relational.map_list_count(table(spark, d, "ets_file_analysis").select(F.create_map(F.lit("i"), lists[0], F.lit("v"), lists[1]).alias("m")), "m").select(F.col("entries").cast("long"))


# datasets


@query("SELECT 'Draw it' AS instruction, CASE WHEN n_nationkey % 4 = 0 THEN 'p' ELSE 'p' || chr(10) || n_name END AS input, r_name AS output FROM nation JOIN region ON n_regionkey = r_regionkey")
def sft_records(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return dataset.sft_records(both.select(F.lit("p").alias("prompt"), F.when(F.col("n_nationkey") % 4 != 0, F.col("n_name")).alias("ets"), F.col("r_name").alias("txt")), "Draw it")


@query("SELECT p_partkey::VARCHAR AS key, upper(p_name) AS output FROM part WHERE p_partkey % 5 <> 0")
def generated_outputs(spark: SparkSession, d: str) -> DataFrame:
    """An injected client that answers in capitals and fails on every fifth prompt."""

    def client(prompts: list[str]) -> list[str | None]:
        return [None if p.startswith("!") else p.upper() for p in prompts]

    prompt = F.when(F.col("p_partkey") % 5 == 0, F.lit("!")).otherwise(F.col("p_name"))
    return dataset.generate(table(spark, d, "part"), prompt, client, "p_partkey")


@query("SELECT s_suppkey AS unit_id, s_name AS target, CASE WHEN s_suppkey % 2 = 0 THEN 'b' || s_suppkey || ',a' ELSE '' END AS context FROM supplier")
def fim_context(spark: SparkSession, d: str) -> DataFrame:
    """Splits with the contents of other files in path order."""
    own = table(spark, d, "supplier")
    context = own.where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("unit_id"), F.explode(F.array(F.struct(F.lit("p/2").alias("path"), F.lit("a").alias("content")), F.struct(F.lit("p/1").alias("path"), F.concat(F.lit("b"), "s_suppkey").alias("content")))).alias("c")).select("unit_id", "c.*")
    return dataset.fim_records(own.select(F.col("s_suppkey").alias("unit_id"), F.col("s_name").alias("target")), context).select("unit_id", "target", F.array_join("xl_context", ",").alias("context"))


# searches and graphs


_TEN = f"{_TOK}, {_JACCARD}, {_BM25}".replace("rank <= 5", "rank <= 10")


@query(f"WITH {_TEN}, s AS (SELECT query_id, doc_id, rank AS r1, CASE WHEN max(score) OVER w > min(score) OVER w THEN (score - min(score) OVER w) / (max(score) OVER w - min(score) OVER w) ELSE 1 END AS s1 FROM bk WINDOW w AS (PARTITION BY query_id)), m AS (SELECT query_id, doc_id, 0.6 * coalesce(s1, 0) + 0.4 * coalesce(jk.score, 0) AS score, r1, jk.rank AS r2 FROM s FULL OUTER JOIN jk USING (query_id, doc_id)) SELECT query_id, doc_id, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, r1 NULLS LAST, r2 NULLS LAST) AS n FROM m) WHERE n <= 5")
def blended_topk(spark: SparkSession, d: str) -> DataFrame:
    """Term weights scaled per query, blended with the likeness of term sets."""
    docs = _document_terms(spark, d)
    queries = _search_queries(docs)
    found = retrieval.blend(retrieval.bm25_topk(queries, docs, 10), retrieval.jaccard_topk(queries, docs, 10), cut=5)
    return found.select("query_id", "doc_id", F.round("score", 4).alias("score"))


@query("WITH w AS (SELECT doc_id, unnest(range(0, (length(text) + 199) // 200)) AS i, text FROM documents WHERE length(text) > 0) SELECT doc_id, sum(length(regexp_replace(substr(text, (i * 200 + 1)::INT, 200), '[^a-z]', '', 'g')))::BIGINT AS score FROM w GROUP BY doc_id")
def chunk_sums(spark: SparkSession, d: str) -> DataFrame:
    """Windows of 200 signs scored by their letters, summed per document."""
    docs = table(spark, d, "documents").where("length(text) > 0").select("doc_id", "text")
    parts = docs.withColumn("i", F.explode(F.sequence(F.lit(0), F.ceil(F.length("text") / 200).cast("int") - 1)))
    hits = parts.select(F.lit(0).alias("query_id"), "doc_id", F.col("i").alias("chunk_index"), F.length(F.regexp_replace(F.substring("text", F.col("i") * 200 + 1, F.lit(200)), "[^a-z]", "")).cast("long").alias("score"))
    return retrieval.regroup_chunks(hits, "sum").select("doc_id", F.col("score").cast("long").alias("score"))


_L2 = "1 - list_sum(list_transform(list_zip(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), lambda x: (x[1] - x[2]) * (x[1] - x[2])))"


@query(f"WITH s AS (SELECT q.vec_id AS query_id, v.vec_id, {_L2} AS score FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0), t AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s), g AS (SELECT query_id, vec_id // 4 AS doc_id, max(score) AS score, count(*) AS chunks FROM t WHERE n <= 15 GROUP BY ALL) SELECT query_id, doc_id, round(score, 5) AS score, chunks::INT AS chunks FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS n FROM g) WHERE n <= 5")
def vector_documents(spark: SparkSession, d: str) -> DataFrame:
    """Vectors as chunks of documents of four: the best documents by their best chunk."""
    vectors = table(spark, d, "embeddings")
    queries = vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    hits = retrieval.vector_topk(queries, vectors, 15, metric="l2").select("query_id", F.floor(F.col("vec_id") / 4).alias("doc_id"), F.col("vec_id").alias("chunk_id"), (F.col("vec_id") % 4).alias("chunk_index"), "score")
    return retrieval.chunk_search(hits, 5).select("query_id", "doc_id", F.round("score", 5).alias("score"), F.size("chunks").alias("chunks"))


_PATHS = (
    "i AS (SELECT DISTINCT file AS src, module_name AS m FROM " + _IMPORTS_SQL + " WHERE starts_with(module_name, '.')), "
    "p AS (SELECT src, string_split(regexp_replace(src, '[^/]*$', ''), '/')[:-2] AS base, list_filter(string_split(m, '/'), lambda x: x NOT IN ('', '.')) AS s FROM i), "
    "q AS (SELECT src, base, len(list_filter(s, lambda x: x = '..')) AS up, list_filter(s, lambda x: x <> '..') AS rest FROM p), "
    "r AS (SELECT src, array_to_string(list_concat(base[:len(base) - up], rest), '/') AS path FROM q), "
    "e AS (SELECT DISTINCT src, CASE WHEN regexp_matches(path, '\\.(ets|ts|js)$') THEN path ELSE path || '.ets' END AS dst FROM r), "
    "x AS (SELECT src, dst FROM e WHERE dst IN (SELECT file FROM ets_file_analysis))"
)


@query("WITH " + _PATHS + " SELECT src, dst FROM x")
def resolved_imports(spark: SparkSession, d: str) -> DataFrame:
    """The relative imports that lead to an analysed file."""
    return graph.import_edges(_imports(spark, d), table(spark, d, "ets_file_analysis"))


@query("WITH RECURSIVE " + _PATHS + ", c(root, node) AS (SELECT src, src FROM x UNION SELECT root, dst FROM c JOIN x ON node = src) SELECT root, count(*) AS reached FROM c GROUP BY root")
def reached_files(spark: SparkSession, d: str) -> DataFrame:
    """How many files each importing file reaches, itself included."""
    edges = graph.import_edges(_imports(spark, d), table(spark, d, "ets_file_analysis"))
    return graph.closure(edges, edges.select(F.col("src").alias("root")).distinct()).groupBy("root").agg(F.count("*").alias("reached"))


@query("WITH e AS (SELECT s_suppkey AS src, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey - 2 ELSE s_suppkey + 1 END AS dst FROM supplier WHERE s_suppkey % 12 <> 0) SELECT s_suppkey AS node FROM supplier WHERE s_suppkey % 12 NOT IN (0, 10, 11) AND (s_suppkey - 1) // 3 * 3 + 3 <= (SELECT max(s_suppkey) FROM supplier)")
def nodes_on_cycles(spark: SparkSession, d: str) -> DataFrame:
    """Rings of three with a link from one ring to the next; every fourth ring is open."""
    own = table(spark, d, "supplier").where("s_suppkey % 12 <> 0")
    k = F.col("s_suppkey")
    ring = own.select(k.alias("src"), F.when(k % 3 == 0, k - 2).otherwise(k + 1).alias("dst"))
    onward = own.where("s_suppkey % 3 = 0").select(k.alias("src"), (k + 1).alias("dst"))
    return graph.cyclic_nodes(ring.unionByName(onward))


@query("SELECT doc_id FROM (SELECT doc_id, text, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS n FROM documents WHERE length(text) < 40) WHERE n = 1")
def short_texts_kept(spark: SparkSession, d: str) -> DataFrame:
    """Short texts deduplicated by exact greedy order within their length, a threshold that only equal texts reach."""
    short = table(spark, d, "documents").where("length(text) < 40").select("doc_id", "text", F.length("text").alias("size"))
    return dedup.ratio_dedup(short, "doc_id", "text", 0.9999, within="size").select("doc_id")


# Java calls and pictures


@query("SELECT s_suppkey, c AS class, m AS method, l AS line FROM supplier, (VALUES ('android.widget.Toast', 'show', 6), ('androidx.core.Box', 'get', 7), ('android.util.Log', 'd', 9)) v(c, m, l)")
def java_calls(spark: SparkSession, d: str) -> DataFrame:
    """Calls on a field, on a generic parameter and on a class; names in literals and comments are none."""
    made = F.concat(F.lit("import android.widget.Toast;\nimport androidx.core.Box;\nimport android.util.Log;\nclass A"), "s_suppkey", F.lit(" { private Toast[] t, u;\n  void f(Map<String, Box<? extends T>> m, Box<T> b) {\n    u.show(1);\n    b.<String>get(2); // b.put(3)\n    String s = \"t.show()\";\n    Log.d(s); m.clear();\n  }\n}"))

    def run(rows):
        for key, text in rows:
            for r in C.java_api_calls(text):
                yield key, r["class"], r["method"], r["line"]

    return map_rows(table(spark, d, "supplier").select("s_suppkey", made.alias("t")), run, "s_suppkey long, class string, method string, line int")


@query("SELECT vec_id, h::INT AS height, w::INT AS width, round(list_sum(list_transform(embedding[1:h * w], lambda x: least(greatest(floor(abs(x::DOUBLE) * 100), 0), 255))), 3) AS light, false AS failed FROM (SELECT vec_id, embedding, 4 AS h, 16 AS w FROM embeddings WHERE vec_id % 10 <> 0) UNION ALL SELECT vec_id, NULL, NULL, NULL, true FROM embeddings WHERE vec_id % 10 = 0")
def decoded_pictures(spark: SparkSession, d: str) -> DataFrame:
    """Vectors as grey pictures of 4 by 16, written as PNG bytes and read again; every tenth breaks off."""

    def run(rows):
        for key, vector in rows:
            grey = np.clip(np.floor(np.abs(np.array(vector[:64], dtype=np.float64)) * 100), 0, 255).reshape(4, 16)
            data = pictures.encode_png(grey)
            yield str(key), data[: len(data) // 2] if key % 10 == 0 else data

    made = map_rows(table(spark, d, "embeddings").select("vec_id", "embedding"), run, "path string, content binary")
    got = pictures.decoded_images(made)
    light = F.round(F.aggregate("image.pixels", F.lit(0.0), lambda a, x: a + x), 3)
    return got.select(F.col("path").cast("long").alias("vec_id"), "image.height", "image.width", light.alias("light"), F.col("failed").isNotNull().alias("failed"))


@query("""SELECT r_name AS url, n_name AS name, 'about ' || n_nationkey AS text, '[{"参数名": "a", "类型": "' || n_nationkey || '"}, {"参数名": "b", "类型": "T"}]' AS parameters, CASE WHEN n_nationkey % 2 = 0 THEN '[{"类型": "R' || n_nationkey || '"}]' END AS returns, '[{"错误码ID": "401", "错误信息": "bad"}]' AS errors, 'API ' || n_regionkey AS since, 'call(' || n_nationkey || ')' AS example FROM nation JOIN region ON n_regionkey = r_regionkey""")
def page_functions(spark: SparkSession, d: str) -> DataFrame:
    """Functions of reference pages with their facts, parameters, results, errors and examples; one page per region."""
    both = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("n_nationkey").cast("string")
    returns = F.when(key.cast("int") % 2 == 0, F.concat(F.lit("<p>返回值：</p><table><tr><th>类型</th></tr><tr><td>R"), key, F.lit("</td></tr></table>"))).otherwise("")
    part = F.concat(
        F.lit("<div class='section'><h4>"), "n_name", F.lit("</h4><p>about "), key, F.lit("</p><p><strong>起始版本：</strong>API "), F.col("n_regionkey").cast("string"),
        F.lit("</p><p>参数：</p><table><tr><th>参数名</th><th>类型</th></tr><tr><td>a</td><td>"), key, F.lit("</td></tr><tr><td>b</td><td>T</td></tr></table>"), returns,
        F.lit("<p>错误码：</p><table><tr><th>错误码ID</th><th>错误信息</th></tr><tr><td>401</td><td>bad</td></tr></table><p>示例：</p><pre>call("), key, F.lit(")</pre></div>"),
    )
    pages = both.groupBy(F.col("r_name").alias("url")).agg(F.concat(F.lit("<div id='函数说明'>"), F.array_join(F.collect_list(part), ""), F.lit("</div>")).alias("html"))
    found = H.record_rows(pages).where("kind = 'function'")
    return found.select("url", "name", *[F.col("fields")[k].alias(k) for k in ("text", "parameters", "returns", "errors", "since", "example")])


@query("SELECT doc_id, i::INT AS chunk_index, n::INT AS total_chunks, md5(trim(substr(t, (i * 7 * 2 + 1)::INT, 14))) AS hash FROM (SELECT s_suppkey AS doc_id, repeat('word' || lpad((s_suppkey % 100)::VARCHAR, 2, '0') || ' ', 9) AS t, unnest(range(0, 5)) AS i, 5 AS n FROM supplier)")
def document_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Nine words of six signs in pieces of at most 14 signs, cut at blanks: two words each, one in the last."""
    word = F.concat(F.lit("word"), F.lpad((F.col("s_suppkey") % 100).cast("string"), 2, "0"), F.lit(" "))
    docs = table(spark, d, "supplier").select(F.col("s_suppkey").alias("doc_id"), F.repeat(word, 9).alias("text"))
    found = retrieval.chunks(docs, size=14, overlap=0, separators=retrieval.DOCUMENT_SEPARATORS)
    return found.select("doc_id", "chunk_index", "total_chunks", F.md5("document").alias("hash"))


@query("SELECT DISTINCT u.unit_id AS src, 'import' AS ref_type, i.name AS dst FROM function_info u JOIN " + _IMPORTS_SQL + " i USING (file) WHERE i.name <> '' AND contains(u.content, i.name)")
def reference_edges_all(spark: SparkSession, d: str) -> DataFrame:
    """References without the exclusion of the unit's and the file's own names."""
    units = table(spark, d, "function_info").select("unit_id", "file", "name", "content")
    return graph.reference_edges(units, _imports(spark, d).select("file", "name", F.lit("import").alias("ref_type")), exclude=False)


@query("SELECT n_name AS url, '40' || n_nationkey AS name, 'Title ' || n_nationkey AS title, 'bad ' || n_regionkey AS info, 'cause' AS causes, 'retry' AS steps FROM nation")
def page_error_codes(spark: SparkSession, d: str) -> DataFrame:
    """Error codes with what they say, why and what to do."""
    key = F.col("n_nationkey").cast("string")
    html = F.concat(F.lit("<body><div class='section'><h4>40"), key, F.lit(" Title "), key, F.lit("</h4><p>错误信息</p><p>bad "), F.col("n_regionkey").cast("string"), F.lit("</p>\n<p>可能原因</p><p>cause</p>\n<p>处理步骤</p><p>retry</p></div></body>"))
    pages = table(spark, d, "nation").select(F.concat(F.lit("https://docs.example/errorcode-"), "n_name").alias("url"), html.alias("html"))
    found = H.record_rows(pages).where("kind = 'errorcode'")
    f = F.col("fields")
    return found.select(F.regexp_replace("url", "^.*errorcode-", "").alias("url"), "name", f["title"].alias("title"), f["错误信息"].alias("info"), f["可能原因"].alias("causes"), f["处理步骤"].alias("steps"))


@query("SELECT r_name AS url, r_name AS name, '起始版本：API ' || r_regionkey AS since FROM region")
def page_modules(spark: SparkSession, d: str) -> DataFrame:
    """Modules by their heading and the version they began with."""
    html = F.concat(F.lit("<body><h1>"), "r_name", F.lit("</h1><p><strong>起始版本：</strong>API "), F.col("r_regionkey").cast("string"), F.lit("</p><h4>导入模块</h4></body>"))
    found = H.record_rows(table(spark, d, "region").select(F.col("r_name").alias("url"), html.alias("html"))).where("kind = 'module'")
    return found.select("url", "name", F.col("fields")["since"].alias("since"))


@query("SELECT n_name AS url, (i - 1)::INT AS pos, 'x' || i AS a, CASE i WHEN 1 THEN 'y' END AS b FROM nation, (VALUES (1), (2)) v(i)")
def page_tables_lenient(spark: SparkSession, d: str) -> DataFrame:
    """Rows of another length than the head are kept: short ones as they are, long ones cut."""
    html = F.lit("<table><tr><th>a</th><th>b</th></tr><tr><td>x1</td><td>y</td><td>z</td></tr><tr><td>x2</td></tr></table>")
    found = H.table_rows(table(spark, d, "nation").select(F.col("n_name").alias("url"), html.alias("html")), strict=False)
    return found.select("url", "pos", F.col("cells")["a"].alias("a"), F.col("cells")["b"].alias("b"))
