"""All queries of the core with their SQL.

A query reads whole tables.  Searches take as their queries every row whose id is divisible by 100, against all rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltloom.common import checkpoint_dir, durable, map_rows, spread, table, table_stream
from siltloom.functions import code as C
from siltloom.functions import text as T
from siltloom.functions import html as H
from siltloom.functions.html import numbered
from siltloom.operators import dataset, dedup, graph, images, mutate, nested, relational, retrieval
from siltloom.streaming import feeds

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its name, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _imports(spark: SparkSession, d: str) -> DataFrame:
    """Imports of all file analyses with their file: analysis_id, file, pos, import_type, module_name, name."""
    found = nested.imports_table(table(spark, d, "ets_file_analysis"), "analysis_id", "file")
    return found.select(F.col("row_id").alias("analysis_id"), "file", "pos", "import_type", "module_name", "name")


_IMPORTS_SQL = """(SELECT analysis_id, file, i - 1 AS pos, e.import_type AS import_type, e.module_name AS module_name, coalesce(nullif(e.name, ''), e.component_name, '') AS name
FROM (SELECT analysis_id, file, unnest(range(1, len(imports) + 1)) AS i, unnest(imports) AS e FROM ets_file_analysis) WHERE e IS NOT NULL)"""

# nested records

_DEPS = ("imports", "variables", "functions", "classes", "interfaces")
_REPAIR = r"regexp_replace(regexp_replace({0}, '[\x00-\x1f]', ' ', 'g'), ',\s*([}}\]])', '\1', 'g')"
_FIXED = "CASE WHEN json_valid({0}) THEN {0} WHEN json_valid(" + _REPAIR + ") THEN " + _REPAIR + " END"
_P3 = (
    "WITH a AS (SELECT unit_id, " + _FIXED.format("dependencies") + " AS t FROM ui_info), "
    "b AS (SELECT unit_id, CASE WHEN json_type(t) = 'VARCHAR' THEN " + _FIXED.format("(t::JSON ->> '$')") + " ELSE t END AS t FROM a), "
    "c AS (SELECT unit_id, CASE WHEN json_type(t) = 'OBJECT' AND json_type(t, '$.dependencies') IS NOT NULL THEN json_extract(t, '$.dependencies') ELSE t::JSON END AS v FROM b WHERE t IS NOT NULL), "
    "lists AS ("
    + " UNION ALL ".join(f"SELECT unit_id, 'dependencies.{k}' AS path, CASE WHEN json_type(v, '$.{k}') = 'ARRAY' THEN json_extract(v, '$.{k}[*]') WHEN json_type(v, '$.{k}') IS NULL OR json_type(v, '$.{k}') = 'NULL' THEN [] ELSE [json_extract(v, '$.{k}')] END AS l FROM c WHERE json_type(v) = 'OBJECT'" for k in _DEPS)
    + "), parts AS (SELECT unit_id, path, unnest(range(0, len(l))) AS pos, unnest(l) AS e FROM lists), "
    "ui AS (SELECT 'ui_info' AS source_table, unit_id AS row_id, path, -1 AS parent_pos, pos, CASE json_type(e) WHEN 'VARCHAR' THEN e ->> '$' WHEN 'OBJECT' THEN coalesce(nullif(e ->> '$.name', ''), e ->> '$.component_name', '') ELSE '' END AS child_name FROM parts WHERE e IS NOT NULL AND json_type(e) <> 'NULL'), "
    "v AS (SELECT analysis_id, unnest(range(0, len(variables))) AS p, unnest(variables) AS x FROM ets_file_analysis), "
    "below AS (SELECT analysis_id, 'variables.modifiers' AS path, p, unnest(range(0, len(x.modifiers))) AS pos, unnest(x.modifiers) AS child_name FROM v WHERE x IS NOT NULL "
    + "".join(f" UNION ALL SELECT analysis_id, 'variables.dependencies.{k}', p, pos, coalesce(e.name, '') FROM (SELECT analysis_id, p, unnest(range(0, len(x.dependencies.{k}))) AS pos, unnest(x.dependencies.{k}) AS e FROM v WHERE x IS NOT NULL) WHERE e IS NOT NULL" for k in _DEPS)
    + ") SELECT source_table, row_id, path, parent_pos::INT AS parent_pos, pos::INT AS pos, child_name FROM ui "
    "UNION ALL SELECT 'ets_file_analysis', analysis_id, 'imports', -1, pos::INT, name FROM " + _IMPORTS_SQL +
    " UNION ALL SELECT 'ets_file_analysis', analysis_id, 'variables', -1, p::INT, coalesce(x.name, '') FROM v WHERE x IS NOT NULL "
    "UNION ALL SELECT 'ets_file_analysis', analysis_id, path, p::INT, pos::INT, child_name FROM below WHERE child_name IS NOT NULL"
)


@query(_P3)
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.child_tables(table(spark, d, "ets_file_analysis"), table(spark, d, "ui_info"))


@query("SELECT analysis_id AS row_id, p::INT AS pos, x.name AS name, x.type AS var_type, x.value AS value, coalesce(len(x.modifiers), 0)::INT AS modifiers FROM (SELECT analysis_id, unnest(range(0, len(variables))) AS p, unnest(variables) AS x FROM ets_file_analysis) WHERE x IS NOT NULL")
def p3_variables(spark: SparkSession, d: str) -> DataFrame:
    return nested.variables_table(table(spark, d, "ets_file_analysis"))


@query("SELECT analysis_id AS row_id, (i - 1)::INT AS pos, e.import_type AS import_type, e.module_name AS module_name, coalesce(nullif(e.name, ''), e.component_name, '') AS name, e.alias AS alias FROM (SELECT analysis_id, unnest(range(1, len(imports) + 1)) AS i, unnest(imports) AS e FROM ets_file_analysis) WHERE e IS NOT NULL")
def p3_imports(spark: SparkSession, d: str) -> DataFrame:
    return nested.imports_table(table(spark, d, "ets_file_analysis"))


# deduplication


@query("SELECT lang, count(*) AS documents FROM (SELECT lang, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS n FROM documents WHERE text IS NOT NULL) WHERE n = 1 GROUP BY lang")
def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: first rows of equal texts, counted per language.  The smallest id per hash carries its language along,
    so the rows are aggregated before the one shuffle and never joined back."""
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "lang", F.md5("text").alias("h"))
    first = docs.groupBy("h").agg(F.min(F.struct("doc_id", "lang")).alias("f")).select("f.lang")
    return first.groupBy("lang").agg(F.count("*").alias("documents"))


@query("SELECT doc_id, source FROM (SELECT doc_id, source, text, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS n FROM documents) WHERE n = 1 OR text IS NULL")
def exact_kept(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exact(table(spark, d, "documents").select("doc_id", "source", "text"), "text", "doc_id").select("doc_id", "source")


@query("SELECT lang, count(*) AS total, count(DISTINCT md5(text)) AS distinct_texts, count(*) FILTER (text IS NULL) AS missing, count(*) - count(*) FILTER (text IS NULL) - count(DISTINCT md5(text)) AS duplicates FROM documents GROUP BY lang")
def dedup_statistics(spark: SparkSession, d: str) -> DataFrame:
    return dedup.dedup_statistics(table(spark, d, "documents"), "text", "lang")


@query("SELECT text, min(doc_id) AS doc_id FROM documents WHERE text IS NOT NULL GROUP BY text")
def first_seen_distinct(spark: SparkSession, d: str) -> DataFrame:
    return relational.first_seen(table(spark, d, "documents").where("text is not null").select("text", "doc_id"), ["text"], "doc_id")


@query("SELECT unit_id, repo_id FROM (SELECT unit_id, repo_id, row_number() OVER (PARTITION BY repo_id, md5(content) ORDER BY unit_id) AS n FROM function_info) WHERE n = 1")
def exact_in_group(spark: SparkSession, d: str) -> DataFrame:
    return dedup.exact_in_group(table(spark, d, "function_info").select("repo_id", "content", "unit_id"), "repo_id", "content", "unit_id").select("unit_id", "repo_id")


@query()
def simhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.simhash_dedup(table(spark, d, "documents").select("doc_id", "text"), "doc_id", "text").select("doc_id")


@query()
def ratio_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup.ratio_dedup(table(spark, d, "moderation_samples").select("sample_id", "text"), "sample_id", "text").select("sample_id")


@query()
def ratio_dedup_units(spark: SparkSession, d: str) -> DataFrame:
    """The functions kept of each file; every pair of a file whose lengths allow the ratio is compared."""
    return dedup.ratio_dedup(table(spark, d, "function_info").select("unit_id", "file", "content"), "unit_id", "content", within="file").select("unit_id")


@query()
def comment_blind_dedup(spark: SparkSession, d: str) -> DataFrame:
    """The functions kept of each file when their comments are left out of the comparison."""
    return dedup.comment_blind_dedup(table(spark, d, "function_info").select("unit_id", "file", "content"), "unit_id", "content", within="file").select("unit_id")


@query()
def ratio_audit(spark: SparkSession, d: str) -> DataFrame:
    return dedup.audit(table(spark, d, "moderation_samples"), "sample_id", "text").select("earlier", "later", F.round("ratio", 6).alias("ratio"))


# filters and projections


@query("SELECT doc_id, title, CAST(NULL AS VARCHAR) AS author FROM documents")
def field_project(spark: SparkSession, d: str) -> DataFrame:
    return relational.project_fields(table(spark, d, "documents"), ["doc_id", "title", "author"])


@query("SELECT unit_id, file FROM function_info WHERE file LIKE 'projects/a%' OR file LIKE 'projects/order-%'")
def prefix_filter(spark: SparkSession, d: str) -> DataFrame:
    return relational.prefix_filter(table(spark, d, "function_info"), "file", ["projects/a", "projects/order-"]).select("unit_id", "file")


@query("SELECT unit_id FROM function_info WHERE NOT coalesce(contains(file, '.test'), false)")
def test_file_filter(spark: SparkSession, d: str) -> DataFrame:
    return relational.test_files(table(spark, d, "function_info"), "file").select("unit_id")


@query("SELECT o_orderkey FROM (SELECT o_orderkey, o_orderkey % 4 AS k, o_orderkey % 23 AS v FROM orders) WHERE CASE k WHEN 0 THEN v >= 10 WHEN 1 THEN v IN (0, 1, 2, 3) ELSE false END")
def sdk_gate(spark: SparkSession, d: str) -> DataFrame:
    """Version texts made from order keys: a number, one of the exact texts or another, and two without a version."""
    v = F.col("o_orderkey") % 23
    exact = F.get(F.array(*[F.lit(x) for x in T.SDK_TEXT_VERSIONS]), v.cast("int"))
    made = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit('{ "compileSdkVersion": '), v, F.lit(" }"))).when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit('{ "compatibleSdkVersion" : "'), F.coalesce(exact, F.lit("4.1.0(11)")), F.lit('" }'))).otherwise(F.lit("{ }"))
    return relational.sdk_gate(table(spark, d, "orders").select("o_orderkey", made.alias("config")), "config").select("o_orderkey")


@query("SELECT analysis_id FROM ets_file_analysis WHERE len(list_filter(coalesce(imports, []), lambda e: e IS NOT NULL AND e.module_name IS NOT NULL AND NOT starts_with(e.module_name, '@'))) = 0")
def origin_only(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "ets_file_analysis")
    named = own.select("analysis_id", F.filter(F.transform("imports", lambda e: e["module_name"]), lambda m: m.isNotNull()).alias("modules"))
    return relational.origin_only(named).select("analysis_id")


@query("SELECT doc_id FROM documents WHERE length(coalesce(text, '')) < 30")
def tiny_units(spark: SparkSession, d: str) -> DataFrame:
    return relational.tiny(table(spark, d, "documents"), "text").select("doc_id")


@query("SELECT event_id, value FROM events WHERE value >= 50")
def at_least(spark: SparkSession, d: str) -> DataFrame:
    return relational.at_least(table(spark, d, "events"), "value", 50).select("event_id", "value")


@query("SELECT pair_id, coalesce(query[2], '') AS second FROM instruction_pairs")
def second_element(spark: SparkSession, d: str) -> DataFrame:
    return relational.second_elements(table(spark, d, "instruction_pairs"), "query").select("pair_id", "second")


@query(r"SELECT record_id, CASE WHEN url IS NULL THEN NULL ELSE replace(regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9_+.-]*://', ''), '/+$', ''), '/', '_') || '.html' END AS file_name, split_part(url, '/', -1) AS object_id FROM fim_records")
def url_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "fim_records").select("record_id", T.url_file_name(F.col("url")).alias("file_name"), T.url_object_id(F.col("url")).alias("object_id"))


@query(r"SELECT CASE WHEN regexp_matches(content, '@Entry\s*@Component\s*struct') THEN 'Page' WHEN regexp_matches(content, '@Component\s*(export)?\s*struct') THEN 'Component' ELSE 'Service' END AS file_type, count(*) AS units FROM ui_info GROUP BY 1")
def file_types(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ui_info").groupBy(T.file_type(F.col("content")).alias("file_type")).agg(F.count("*").alias("units"))


@query("SELECT category, count(*) AS rows FROM (SELECT CASE WHEN contains(lower(file), 'test') THEN 'test' ELSE 'ui' END AS category FROM ui_info UNION ALL SELECT CASE WHEN contains(lower(file), 'test') THEN 'test' ELSE 'function' END FROM function_info) GROUP BY category")
def classify_units(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "ui_info").select("file", F.lit(True).alias("ui")).unionByName(table(spark, d, "function_info").select("file", F.lit(False).alias("ui")))
    return relational.category_counts(both, T.code_category(F.col("file"), F.col("ui")))


@query(r"SELECT unit_id, length(regexp_replace(regexp_replace(regexp_replace(content, '(?s)/\*.*?\*/', '', 'g'), '(?m)//.*$', '', 'g'), '(?m)^\s*\n', '', 'g')) AS chars FROM function_info WHERE content IS NOT NULL")
def comments_removed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "function_info").where("content is not null").select("unit_id", F.length(T.remove_comments_naive(F.col("content"))).cast("long").alias("chars"))


@query(r"SELECT unit_id, length(regexp_replace(regexp_replace(content, '(?m)//.*?$', '', 'g'), '(?s)/\*.*?\*/', '', 'g')) AS chars FROM function_info WHERE content IS NOT NULL")
def comments_removed_line_first(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "function_info").where("content is not null").select("unit_id", F.length(T.remove_comments_line_first(F.col("content"))).cast("long").alias("chars"))


@query()
def code_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "function_info").where("content is not null").select("unit_id", F.size(T.code_tokens(F.col("content"))).alias("tokens"))


@query(r"SELECT name, count(*) AS files FROM (SELECT unnest(regexp_extract_all(original_code, 'export\s+(?:default\s+)?(?:async\s+)?(?:function|class|interface)\s+(\w+)', 1)) AS name FROM fim_records) GROUP BY name")
def exported_names(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "fim_records").select(F.explode(T.exported_names(F.col("original_code"))).alias("name")).groupBy("name").agg(F.count("*").alias("files"))


@query("SELECT repo_id, bool_or(ends_with(file, '.java')) AS has FROM function_info GROUP BY repo_id")
def having_extension(spark: SparkSession, d: str) -> DataFrame:
    return relational.having_extension(table(spark, d, "function_info"), "repo_id", "file", ".java")


# joins


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM repo_list r WHERE r.repo_id = d.repo_id AND r.cloned = 1)")
def unprocessed(spark: SparkSession, d: str) -> DataFrame:
    return relational.unprocessed(table(spark, d, "documents"), table(spark, d, "repo_list").where("cloned = 1"), ["repo_id"]).select("doc_id")


@query("SELECT unit_id FROM function_info WHERE id IN (SELECT function_id FROM instruction_pairs)")
def described_functions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "function_info").join(table(spark, d, "instruction_pairs").select(F.col("function_id").alias("id")), "id", "left_semi").select("unit_id")


@query("SELECT analysis_id, pos, module_name FROM " + _IMPORTS_SQL + " WHERE module_name IS NOT NULL AND module_name NOT IN (SELECT module_name FROM sdk_modules)")
def unlisted_modules(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "sdk_modules").select(F.col("module_name").alias("word"))
    return relational.without_reserved(_imports(spark, d).where("module_name is not null").withColumn("pos", F.col("pos").cast("long")), listed, "module_name").select("analysis_id", "pos", "module_name")


@query("SELECT DISTINCT u.unit_id, i.name FROM function_info u JOIN " + _IMPORTS_SQL + " i USING (file) WHERE i.name <> '' AND contains(u.content, i.name)")
def used_imports(spark: SparkSession, d: str) -> DataFrame:
    return relational.uses(table(spark, d, "function_info"), _imports(spark, d)).select("unit_id", "name").distinct()


@query("SELECT DISTINCT u.unit_id, i.name FROM function_info u JOIN " + _IMPORTS_SQL + " i USING (file) WHERE i.name <> '' AND regexp_matches(u.content, '(^|[^A-Za-z0-9_])' || i.name || '($|[^A-Za-z0-9_])')")
def used_imports_whole(spark: SparkSession, d: str) -> DataFrame:
    return relational.uses(table(spark, d, "function_info"), _imports(spark, d), boundary=True).select("unit_id", "name").distinct()


@query("WITH u AS (SELECT u.unit_id, i.analysis_id * 1000 + i.pos AS pos, i.module_name, i.name FROM function_info u JOIN " + _IMPORTS_SQL + " i USING (file) WHERE i.name <> '' AND i.module_name IS NOT NULL AND contains(u.content, i.name)), m AS (SELECT unit_id, min(pos) AS first, 'import { ' || string_agg(name, ', ' ORDER BY pos, name) || ' } from ''' || module_name || ''';' AS line FROM u GROUP BY unit_id, module_name) SELECT unit_id, string_agg(line, chr(10) ORDER BY first, line) AS imports FROM m GROUP BY unit_id")
def merged_imports(spark: SparkSession, d: str) -> DataFrame:
    symbols = _imports(spark, d).where("module_name is not null").withColumn("pos", F.col("analysis_id") * 1000 + F.col("pos"))
    merged = relational.merged_imports(relational.uses(table(spark, d, "function_info"), symbols))
    return merged.select("unit_id", F.array_join("imports", "\n").alias("imports"))


@query("SELECT module_name, min(CASE WHEN import_type = 'default' THEN name END) AS default_name, coalesce(string_agg(DISTINCT CASE WHEN import_type <> 'default' THEN name END, ',' ORDER BY CASE WHEN import_type <> 'default' THEN name END), '') AS names FROM " + _IMPORTS_SQL + " GROUP BY module_name")
def united_imports(spark: SparkSession, d: str) -> DataFrame:
    united = relational.union_imports(_imports(spark, d))
    return united.select("module_name", "default_name", F.array_join("names", ",").alias("names"))


@query()
def code_with_context(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "ets_file_analysis")
    variables = own.select("file", F.posexplode("variables").alias("pos", "v")).where("v is not null").select("file", "pos", F.col("v.name").alias("name"), F.col("v.full_variable").alias("full_variable"))
    imports = _imports(spark, d).where("module_name is not null").drop("analysis_id")
    return relational.code_with_context(table(spark, d, "function_info").select("unit_id", "file", "content"), imports, variables)


@query("SELECT id, unit_id, loaded_at FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC, unit_id DESC) AS n FROM function_info) WHERE n = 1")
def latest_delivery(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "function_info").select("id", "unit_id", "loaded_at").withColumn("version", F.struct("loaded_at", "unit_id"))
    return relational.merged_maps(rows.where("false"), rows, "id").select("id", "unit_id", "loaded_at")


# aggregates, windows, sets


@query("SELECT sum(len(ui_code))::BIGINT AS ui_code, sum(len(functions))::BIGINT AS functions FROM ets_file_analysis")
def nested_counts(spark: SparkSession, d: str) -> DataFrame:
    return relational.nested_counts(table(spark, d, "ets_file_analysis"), ["ui_code", "functions"])


@query("SELECT count(*) AS total, count(*) FILTER (content IS NOT NULL AND content <> '') AS processed, count(*) FILTER (content IS NULL OR content = '') AS failed FROM function_info")
def run_statistics(spark: SparkSession, d: str) -> DataFrame:
    return relational.run_statistics(table(spark, d, "function_info"), F.coalesce(F.col("content") != "", F.lit(False)))


@query("SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS last_purchase FROM events")
def carried_forward(spark: SparkSession, d: str) -> DataFrame:
    return relational.carried_forward(table(spark, d, "events").select("event_id", "user_id", "event_type", "value"), "user_id", "event_id", F.when(F.col("event_type") == "purchase", F.col("value")), "last_purchase").select("event_id", "user_id", "last_purchase")


@query("SELECT event_id, user_id FROM (SELECT event_id, user_id, coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM events) WHERE s < 3")
def until_successes(spark: SparkSession, d: str) -> DataFrame:
    return relational.until_successes(table(spark, d, "events").select("event_id", "user_id", "event_type"), "user_id", ["event_id"], F.col("event_type") == "purchase", 3).select("event_id", "user_id")


@query("SELECT bucket, count(*) AS rows, min(doc_id) AS low, max(doc_id) AS high FROM (SELECT doc_id, ntile(7) OVER (ORDER BY doc_id) AS bucket FROM documents) GROUP BY bucket")
def balanced_split(spark: SparkSession, d: str) -> DataFrame:
    parts = relational.balanced_split(table(spark, d, "documents").select("doc_id"), "doc_id", 7)
    return parts.groupBy("bucket").agg(F.count("*").alias("rows"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))


@query("SELECT doc_id FROM documents ORDER BY md5(doc_id::VARCHAR || '7'), doc_id LIMIT 50")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return relational.seeded_sample(table(spark, d, "documents").select("doc_id"), "doc_id", 50, "7")


@query("SELECT repo_id, listed_at, repo_name || '_' || row_number() OVER (PARTITION BY repo_name ORDER BY listed_at, repo_id) AS unique_name FROM repo_list")
def numbered_names(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "repo_list").withColumn("o", F.struct("listed_at", "repo_id"))
    return relational.numbered_names(rows, "repo_name", "o").select("repo_id", "listed_at", "unique_name")


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS id FROM documents")
def numbered_rows(spark: SparkSession, d: str) -> DataFrame:
    return numbered(table(spark, d, "documents").select("doc_id"), ["doc_id"]).select("doc_id", "id")


@query("SELECT DISTINCT file FROM function_info EXCEPT SELECT file FROM ui_info")
def new_listing(spark: SparkSession, d: str) -> DataFrame:
    return feeds.new_listing(table(spark, d, "function_info").select("file").distinct(), table(spark, d, "ui_info").select("file"))


@query("SELECT event_type, sum(CASE WHEN json_valid(props) THEN len(json_keys(props)) ELSE 0 END)::BIGINT AS keys FROM events GROUP BY event_type")
def json_key_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type").agg(F.sum(F.coalesce(F.size(F.json_object_keys("props")), F.lit(0))).cast("long").alias("keys"))


# retrieval


def _document_terms(spark: SparkSession, d: str) -> DataFrame:
    """Documents as tokens and distinct terms, written once, since searches count, weigh and deal them."""
    docs = spread(table(spark, d, "documents").where("text is not null").select("doc_id", "text"))
    cut = docs.select("doc_id", F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9_]+"), F.lit(0)).alias("tokens"))
    return durable(cut.where("size(tokens) > 0").withColumn("terms", F.array_distinct("tokens")))


def _search_queries(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id % 100 = 0").withColumnRenamed("doc_id", "query_id")


_TOK = "tok AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9_]+') AS tokens FROM documents WHERE text IS NOT NULL), doc AS (SELECT * FROM tok WHERE len(tokens) > 0)"
_JACCARD = "t AS (SELECT doc_id, unnest(list_distinct(tokens)) AS t FROM doc), n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id), c AS (SELECT q.doc_id AS query_id, x.doc_id, count(*) AS c FROM t q JOIN t x USING (t) WHERE q.doc_id % 100 = 0 GROUP BY ALL), j AS (SELECT query_id, c.doc_id, c / (a.n + b.n - c)::DOUBLE AS score FROM c JOIN n a ON a.doc_id = query_id JOIN n b ON b.doc_id = c.doc_id), jk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM j QUALIFY rank <= 5)"
_BM25 = "f AS (SELECT doc_id, len(tokens) AS dl, unnest(tokens) AS t FROM doc), tf AS (SELECT t, doc_id, count(*) AS tf, any_value(dl) AS dl FROM f GROUP BY ALL), st AS (SELECT count(*) AS n, avg(len(tokens)) AS avgdl FROM doc), w AS (SELECT t, ln(n - df + 0.5) - ln(df + 0.5) AS idf FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), st), ww AS (SELECT t, CASE WHEN idf < 0 THEN 0.25 * (SELECT avg(idf) FROM w) ELSE idf END AS idf FROM w), b AS (SELECT q.doc_id AS query_id, x.doc_id, sum(q.tf * idf * x.tf * 2.5 / (x.tf + 1.5 * (0.25 + 0.75 * x.dl / avgdl))) AS score FROM tf q JOIN ww USING (t) JOIN tf x USING (t), st WHERE q.doc_id % 100 = 0 GROUP BY ALL), bk AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM b QUALIFY rank <= 5)"


@query(f"WITH {_TOK}, {_JACCARD} SELECT query_id, doc_id, round(score, 6) AS score, rank::INT AS rank FROM jk")
def jaccard_topk(spark: SparkSession, d: str) -> DataFrame:
    docs = _document_terms(spark, d)
    return retrieval.jaccard_topk(_search_queries(docs), docs, 5).select("query_id", "doc_id", F.round("score", 6).alias("score"), "rank")


@query(f"WITH {_TOK}, {_BM25} SELECT query_id, doc_id, round(score, 4) AS score FROM bk")
def bm25_topk(spark: SparkSession, d: str) -> DataFrame:
    docs = _document_terms(spark, d)
    return retrieval.bm25_topk(_search_queries(docs), docs, 5).select("query_id", "doc_id", F.round("score", 4).alias("score"))


@query(f"WITH {_TOK}, {_JACCARD}, {_BM25} SELECT query_id, doc_id, round(0.6 * coalesce(jk.score, 0) + 0.4 * coalesce(bk.score, 0), 4) AS score FROM jk FULL OUTER JOIN bk USING (query_id, doc_id)")
def fused_search(spark: SparkSession, d: str) -> DataFrame:
    docs = _document_terms(spark, d)
    queries = _search_queries(docs)
    return retrieval.fuse(retrieval.jaccard_topk(queries, docs, 5), retrieval.bm25_topk(queries, docs, 5)).select("query_id", "doc_id", F.round("score", 4).alias("score"))


@query("SELECT query_id, vec_id, round(score, 6) AS score, rank::INT AS rank FROM (SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) DESC, v.vec_id) AS rank FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0) WHERE rank <= 5")
def vector_topk(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    queries = vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.vector_topk(queries, vectors, 5).select("query_id", "vec_id", F.round("score", 6).alias("score"), "rank")


@query("WITH w AS (SELECT doc_id, unnest(range(0, (length(text) + 199) // 200)) AS i, text FROM documents WHERE length(text) > 0), c AS (SELECT doc_id, i, length(regexp_replace(substr(text, (i * 200 + 1)::INT, 200), '[^a-z]', '', 'g')) AS score FROM w) SELECT doc_id, max(score) AS best, sum(score)::BIGINT AS total, count(*) AS chunks FROM c GROUP BY doc_id")
def chunk_regroup(spark: SparkSession, d: str) -> DataFrame:
    """Windows of 200 signs scored by their letters, gathered per document."""
    docs = table(spark, d, "documents").where("length(text) > 0").select("doc_id", "text")
    parts = docs.withColumn("i", F.explode(F.sequence(F.lit(0), F.ceil(F.length("text") / 200).cast("int") - 1))).withColumn("piece", F.substring("text", F.col("i") * 200 + 1, F.lit(200)))
    hits = parts.select(F.lit(0).alias("query_id"), "doc_id", F.col("i").alias("chunk_index"), F.length(F.regexp_replace("piece", "[^a-z]", "")).cast("long").alias("score"))
    best = retrieval.regroup_chunks(hits, "max")
    return best.select("doc_id", F.col("score").alias("best"), F.aggregate("chunks", F.lit(0).cast("long"), lambda a, x: a + x["score"]).alias("total"), F.size("chunks").cast("long").alias("chunks"))


@query()
def recursive_chunks(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.chunks(table(spark, d, "documents")).select("chunk_id", "doc_id", "chunk_index", "total_chunks", "document")


_FEATURES = r"""a AS (SELECT analysis_id AS doc_id, array_to_string(list_transform(list_filter(imports, lambda x: x.full_import IS NOT NULL), lambda x: x.full_import), chr(10)) AS pre FROM ets_file_analysis),
w AS (SELECT doc_id, unnest(regexp_extract_all(pre, '(?s)import\s+.+?\s+from\s+[''"].*?[''"]\s*;')) AS w FROM a),
c AS (SELECT doc_id, regexp_replace(regexp_extract(w, '(?s)import\s+(.+?)\s+from\s+[''"]', 1), '[{}]', ',', 'g') AS c, trim(regexp_extract(w, '(?s)\sfrom\s+[''"](.*?)[''"]\s*;$', 1)) AS m FROM w),
p AS (SELECT doc_id, m, unnest(list_transform(string_split(c, ','), lambda x: regexp_replace(regexp_replace(x, '(?s) as .*$', ''), '^\s+|\s+$', '', 'g'))) AS x FROM c),
t AS (SELECT DISTINCT doc_id, x || '@' || m AS t FROM p WHERE x <> ''), n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
k AS (SELECT q.doc_id AS query_id, d.doc_id, count(*) AS c FROM t q JOIN t d USING (t) WHERE q.doc_id % 100 = 0 GROUP BY ALL),
s AS (SELECT query_id, k.doc_id, c / (a.n + b.n - c)::DOUBLE AS score FROM k JOIN n a ON a.doc_id = query_id JOIN n b ON b.doc_id = k.doc_id)"""


@query("WITH " + _FEATURES + " SELECT query_id, doc_id, round(score, 6) AS score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s) WHERE rank <= 5")
def import_feature_topk(spark: SparkSession, d: str) -> DataFrame:
    """The files most alike by what they import."""
    texts = F.filter(F.transform("imports", lambda e: e["full_import"]), lambda t: t.isNotNull())
    made = table(spark, d, "ets_file_analysis").select(F.col("analysis_id").alias("doc_id"), F.array_join(texts, "\n").alias("pre"))
    examples = retrieval.import_examples(made).where("size(terms) > 0")
    return retrieval.jaccard_topk(examples.where("doc_id % 100 = 0").withColumnRenamed("doc_id", "query_id"), examples, 5).select("query_id", "doc_id", F.round("score", 6).alias("score"), "rank")


# datasets


@query("SELECT pair_id, coalesce(description, '') || coalesce(code, '') || coalesce(solution, '') AS content FROM instruction_pairs")
def corpus_text(spark: SparkSession, d: str) -> DataFrame:
    return dataset.corpus_text(table(spark, d, "instruction_pairs"), "description", "code", "solution").select("pair_id", "content")


@query(r"""SELECT record_id, regexp_replace(coalesce(above_context_without_fim_start, '') || coalesce(fim_task_sector_start, '') || coalesce(fim_target, '') || coalesce(fim_task_sector_end, '') || coalesce(follow_context_without_fim_end, ''), '[\s''"`]+', '', 'g') = regexp_replace(original_code, '[\s''"`]+', '', 'g') AS whole FROM fim_records""")
def fim_check(spark: SparkSession, d: str) -> DataFrame:
    return dataset.fim_check(table(spark, d, "fim_records")).select("record_id", "whole")


@query()
def fim_split(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "function_info").select(F.concat(F.lit("f"), "unit_id").alias("unit_id"), "content").unionByName(table(spark, d, "ui_info").select(F.concat(F.lit("u"), "unit_id").alias("unit_id"), "content"))
    return dataset.fim_split(both)


@query()
def fim_prioritised(spark: SparkSession, d: str) -> DataFrame:
    return dataset.fim_prioritised(table(spark, d, "function_info"))


@query()
def fim_candidates(spark: SparkSession, d: str) -> DataFrame:
    return dataset.fim_candidates(table(spark, d, "fim_records"), "record_id", "original_code")


@query()
def code_structure(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "ui_info").select(F.concat(F.lit("ui/"), "unit_id").alias("path"), "content").unionByName(table(spark, d, "function_info").select(F.concat(F.lit("function/"), "unit_id").alias("path"), "content"))
    return C.analyse_files(both)


@query()
def java_methods(spark: SparkSession, d: str) -> DataFrame:
    def run(rows):
        for key, body in rows:
            for i, r in enumerate(C.java_functions(body or "")):
                yield key, i, r["name"], r["content"]

    return map_rows(table(spark, d, "function_info").where("file like '%.java'").select("unit_id", "content"), run, "unit_id long, pos int, name string, content string")


@query()
def mutated_pages(spark: SparkSession, d: str) -> DataFrame:
    return mutate.mutated(table(spark, d, "ui_info"))


@query()
def merged_pages(spark: SparkSession, d: str) -> DataFrame:
    return mutate.merged(table(spark, d, "ui_info"), pairs=500)


# graphs


@query("SELECT n_name AS node FROM nation UNION ALL SELECT r_name FROM region WHERE r_regionkey NOT IN (SELECT n_regionkey FROM nation)")
def tree_leaves(spark: SparkSession, d: str) -> DataFrame:
    region, nation = table(spark, d, "region"), table(spark, d, "nation")
    nodes = region.select(F.col("r_name").alias("id"), F.lit(None).cast("string").alias("parent")).unionByName(nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(F.col("n_name").alias("id"), F.col("r_name").alias("parent")))
    return graph.leaves(nodes).select(F.col("id").alias("node"))


_EDGES = "e AS (SELECT s_suppkey AS src, (s_suppkey * 7 + 3) % (SELECT count(*) FROM supplier) + 1 AS dst FROM supplier)"


@query(f"WITH RECURSIVE {_EDGES}, r(root, node, depth) AS (SELECT s_suppkey, s_suppkey, 0 FROM supplier WHERE s_suppkey % 100 = 0 UNION SELECT root, dst, depth + 1 FROM r JOIN e ON node = src WHERE depth < 6) SELECT root, node, min(depth)::INT AS depth FROM r GROUP BY root, node")
def closure(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "supplier")
    count = own.agg(F.count("*").alias("n"))
    edges = own.join(F.broadcast(count)).select(F.col("s_suppkey").alias("src"), ((F.col("s_suppkey") * 7 + 3) % F.col("n") + 1).alias("dst"))
    return graph.closure(edges, own.where("s_suppkey % 100 = 0").select(F.col("s_suppkey").alias("root")), max_depth=6)


@query()
def import_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.import_edges(_imports(spark, d), table(spark, d, "ets_file_analysis"))


@query()
def import_closure(spark: SparkSession, d: str) -> DataFrame:
    edges = graph.import_edges(_imports(spark, d), table(spark, d, "ets_file_analysis"))
    return graph.closure(edges, edges.select(F.col("src").alias("root")).distinct())


@query("SELECT DISTINCT u.unit_id AS src, 'import' AS ref_type, i.name AS dst FROM function_info u JOIN " + _IMPORTS_SQL + r" i USING (file) WHERE i.name <> '' AND contains(u.content, i.name) AND coalesce(u.name, '') <> i.name AND i.name <> regexp_extract(file, '([^/]*?)(?:\.[^./]*)?$', 1)")
def reference_edges(spark: SparkSession, d: str) -> DataFrame:
    units = table(spark, d, "function_info").select("unit_id", "file", "name", "content")
    return graph.reference_edges(units, _imports(spark, d).select("file", "name", F.lit("import").alias("ref_type")))


@query("WITH RECURSIVE " + _EDGES + ", r(node, depth) AS (SELECT s_suppkey, 0 FROM supplier WHERE s_suppkey = 1 UNION SELECT dst, depth + 1 FROM r JOIN e ON node = src WHERE depth < 3) SELECT node::VARCHAR AS url, min(depth)::INT AS depth FROM r GROUP BY node")
def frontier_crawl(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "supplier")
    links = own.join(F.broadcast(own.agg(F.count("*").alias("n")))).select(F.col("s_suppkey").cast("string").alias("src"), ((F.col("s_suppkey") * 7 + 3) % F.col("n") + 1).cast("string").alias("dst"))
    return graph.frontier_crawl(links, own.where("s_suppkey = 1").select(F.col("s_suppkey").cast("string").alias("url"))).select("url", "depth")


# streams


def _stream_dir(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"


@query("SELECT event_type, count(*) AS events FROM events GROUP BY event_type")
def stream_new_rows(spark: SparkSession, d: str) -> DataFrame:
    counts = table_stream(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("events"))
    return feeds.drain(counts, _stream_dir(spark), "complete")


@query("SELECT * FROM (SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS events FROM events GROUP BY ALL) WHERE start + INTERVAL 3 HOUR <= (SELECT max(ts) FROM events)")
def stream_windows(spark: SparkSession, d: str) -> DataFrame:
    """The windows that the watermark has closed: those that end two hours before the last event."""
    return feeds.drain(feeds.windows(table_stream(spark, d, "events"), "ts"), _stream_dir(spark)).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "events")


# pages, configurations and files, made from rows of the tables


@query("SELECT doc_id, source || chr(10) || doc_type AS text FROM documents")
def article_texts(spark: SparkSession, d: str) -> DataFrame:
    page = F.concat(F.lit("<html><body><nav>x</nav><article><h1>"), "source", F.lit("</h1>\n<p>&nbsp;"), "doc_type", F.lit("<p></article><script>var a = '</p>';</script></body>"))
    return H.articles(table(spark, d, "documents").select("doc_id", page.alias("html")), "doc_id")


@query("SELECT doc_id, unnest(['https://docs.example/' || source || '/' || doc_id, 'https://docs.example/all']) AS link FROM documents")
def page_links(spark: SparkSession, d: str) -> DataFrame:
    page = F.concat(F.lit("<a href=\"/"), "source", F.lit("/"), "doc_id", F.lit("\">1</a> <a class='b' href='//docs.example/all'>2</a> <a href=\"#top\">3</a> <a href=\"https://other.example/\">4</a>"))
    return table(spark, d, "documents").select("doc_id", F.explode(H.links(page, "https://docs.example/")).alias("link"))


def _nation_pages(spark: SparkSession, d: str) -> DataFrame:
    """One page per region with a table of its nations in key order, and a row too short."""
    both = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    row = F.concat(F.lit("<tr><td>"), "n_name", F.lit("</td><td> "), "n_nationkey", F.lit(" </td></tr>"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", row.alias("r")))), lambda x: x["r"]), "")
    return both.groupBy(F.col("r_name").alias("url")).agg(F.concat(F.lit("<div id=\\\"枚举\\\"><table><tr><th>名称</th><th>值</th></tr>"), rows, F.lit("<tr><td>short</td></tr></table></div>")).alias("html"))


@query("SELECT r_name AS url, (row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) - 1)::INT AS pos, n_name AS name, n_nationkey::VARCHAR AS value FROM nation JOIN region ON n_regionkey = r_regionkey")
def page_tables(spark: SparkSession, d: str) -> DataFrame:
    return H.table_rows(_nation_pages(spark, d)).select("url", "pos", F.col("cells")["名称"].alias("name"), F.col("cells")["值"].alias("value"))


@query("SELECT r_name AS url, 'enum' AS kind, name FROM (SELECT r_name, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT DISTINCT r_name, 'short' FROM nation JOIN region ON n_regionkey = r_regionkey)")
def page_records(spark: SparkSession, d: str) -> DataFrame:
    return H.record_rows(_nation_pages(spark, d)).select("url", "kind", "name")


@query("SELECT 'doc' || lpad(doc_id::VARCHAR, 12, '0') AS file_path, k AS pos, CASE k WHEN 0 THEN 'Import' ELSE 'Reference' END AS type, CASE k WHEN 0 THEN NULL ELSE 'import { a' || doc_id || ' } from ''b'';' END AS import_module, 2 * row_number() OVER (PARTITION BY k ORDER BY doc_id) - 1 + k AS id FROM documents, (VALUES (0), (1)) v(k)")
def page_references(spark: SparkSession, d: str) -> DataFrame:
    """An import and a reference per page: the import is carried to the reference, the rows are numbered through all pages."""
    page = F.concat(F.lit("<div class=\"section\"><p>导入模块</p><pre class=\"ts\">import { a"), "doc_id", F.lit(" } from 'b';</pre></div><div class=\"section\"><h4>run</h4><pre class=\"typescript\">run(a: number) { "), F.repeat(F.lit("x"), F.lit(70)), F.lit(" }</pre></div>"))
    pages = table(spark, d, "documents").select(F.concat(F.lit("doc"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("file_path"), page.alias("html"))
    return H.reference_rows(pages).select("file_path", "pos", "type", "import_module", "id")


@query("SELECT DISTINCT 'p' || repo_id || CASE WHEN repo_id % 2 = 0 THEN '' ELSE '/sub' END AS root FROM repo_list")
def project_roots(spark: SparkSession, d: str) -> DataFrame:
    """Every repository has markers in a subfolder, every second one also at its top, which hides the subfolder."""
    top, sub = F.concat(F.lit("p"), "repo_id"), F.concat(F.lit("p"), "repo_id", F.lit("/sub"))
    made = table(spark, d, "repo_list").select("repo_id", F.explode(F.array(*[F.concat(a, F.lit(m)) for a in (top, sub) for m in ("/build-profile.json5", "/hvigorfile.ts")])).alias("path"))
    return relational.project_roots(made.where("repo_id % 2 = 0 or path like '%/sub/%' or path like '%.ts'"))


@query("SELECT o_orderkey AS folder FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0")
def ready_folders(spark: SparkSession, d: str) -> DataFrame:
    made = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("folder"), F.explode(F.array(F.when(F.col("o_orderkey") % 2 == 0, "ets"), F.when(F.col("o_orderkey") % 3 == 0, "txt"), F.when(F.col("o_orderkey") % 5 == 0, "json"))).alias("ext"))
    return relational.ready_folders(made.where("ext is not null"))


@query("SELECT file, name::INT AS name, arg_max(class, o)::VARCHAR AS full FROM (SELECT l_orderkey AS file, l_linenumber % 3 AS name, l_partkey AS class, l_linenumber::BIGINT * 10000000000 + l_partkey AS o FROM lineitem) GROUP BY file, name")
def last_declared(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("file"), (F.col("l_linenumber") % 3).cast("string").alias("name"), F.col("l_partkey").cast("string").alias("class"), (F.col("l_linenumber") * 10_000_000_000 + F.col("l_partkey")).alias("order"))
    nothing = lines.where("false").select("file", "name", F.col("class").alias("full"))
    return relational.last_declared(lines, lines.select("file", "name").distinct(), nothing).select("file", F.col("name").cast("int").alias("name"), "full")


@query("SELECT user_id::VARCHAR AS folder, arg_max(CASE WHEN event_type = 'purchase' THEN value END, CASE WHEN event_type = 'purchase' THEN event_id END) AS purchase, arg_max(CASE WHEN event_type = 'click' THEN value END, CASE WHEN event_type = 'click' THEN event_id END) AS click FROM events GROUP BY user_id HAVING count(*) FILTER (event_type = 'purchase') > 0 AND count(*) FILTER (event_type = 'click') > 0")
def sibling_rows(spark: SparkSession, d: str) -> DataFrame:
    made = table(spark, d, "events").select(F.col("user_id").cast("string").alias("folder"), F.col("event_type").alias("ext"), F.col("event_id").alias("name"), F.col("value").alias("content"))
    return relational.sibling_files(made, ("purchase", "click"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '<a>' || o_orderstatus || '</a>' WHEN 1 THEN o_orderstatus ELSE 'plain ' || o_orderstatus END AS text FROM orders")
def fenced_texts(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey") % 3
    made = F.when(k == 0, F.concat(F.lit("see ```xml\n<a>"), "o_orderstatus", F.lit("</a>\n``` end"))).when(k == 1, F.concat(F.lit("```\n"), "o_orderstatus", F.lit("\n```"))).otherwise(F.concat(F.lit("plain "), "o_orderstatus"))
    return table(spark, d, "orders").select("o_orderkey", T.fenced(made).alias("text"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE o_orderkey % 7 END AS a, CASE WHEN o_orderkey % 4 IN (0, 1) THEN '{\"a\": ' || o_orderkey % 7 || '}' END AS slice FROM orders")
def repaired_json(spark: SparkSession, d: str) -> DataFrame:
    """Good JSON, JSON within other text, unquoted keys with a comma too many, and no JSON."""
    k, v = F.col("o_orderkey") % 4, F.col("o_orderkey") % 7
    good = F.concat(F.lit('{"a": '), v, F.lit("}"))
    made = F.when(k < 2, good).when(k == 2, F.concat(F.lit("{a: "), v, F.lit(",}"))).otherwise(F.lit("none"))
    around = F.when(k == 1, F.concat(F.lit("text "), made, F.lit(" tail"))).otherwise(made)
    return table(spark, d, "orders").select("o_orderkey", T.safe_json(made, "a bigint")["a"].alias("a"), T.json_slice(around).alias("slice"))


@query("SELECT s_suppkey, 'Use the notes.' || chr(10) || chr(10) || s_nationkey || chr(10) || '---' || chr(10) || s_suppkey || chr(10) || chr(10) || 'Question: why' AS prompt FROM supplier")
def prompts(spark: SparkSession, d: str) -> DataFrame:
    own = table(spark, d, "supplier")
    contexts = F.array(F.col("s_nationkey").cast("string"), F.col("s_suppkey").cast("string"))
    return own.select("s_suppkey", retrieval.prompt(F.lit("why"), contexts, "Use the notes.").alias("prompt"))


@query("SELECT a.vec_id AS id, round(list_sum(list_transform(list_zip(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) / 64, 5) AS mse FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def image_reports(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of 64 taken as pictures of 8 by 8, each against the next."""
    made = table(spark, d, "embeddings").select("vec_id", F.struct(F.col("embedding").cast("array<double>").alias("pixels"), F.lit(8).alias("height"), F.lit(8).alias("width")).alias("image"))
    pairs = made.select(F.col("vec_id").alias("id"), F.col("image").alias("a")).join(made.select((F.col("vec_id") - 1).alias("id"), F.col("image").alias("b")), "id")
    return images.reports(pairs).select("id", F.round("mse", 5).alias("mse"))


@query()
def image_matches(spark: SparkSession, d: str) -> DataFrame:
    made = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.struct(F.col("embedding").cast("array<double>").alias("pixels"), F.lit(8).alias("height"), F.lit(8).alias("width")).alias("image"))
    return dedup.perceptual_match(images.hashes(made), [0, -1])


@query(f"WITH {_TOK}, {_JACCARD} SELECT query_id, len(list_filter(list(jk.rank ORDER BY jk.rank), lambda x: x > 0))::INT AS hits, coalesce(string_agg(CASE WHEN doc_type <> 'reference' THEN jk.doc_id::VARCHAR END, ',' ORDER BY jk.rank), '') AS ids FROM jk JOIN documents USING (doc_id) GROUP BY query_id")
def enriched_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Every document whose id is divisible by 100 with the documents most alike; references are left out only afterwards."""
    docs = _document_terms(spark, d)
    queries = _search_queries(docs)
    found = retrieval.jaccard_topk(queries, docs, 5)
    info = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_type") == "reference", "Import").otherwise("Reference").alias("type"), F.col("title").alias("code_snippet"), F.col("source").alias("parent_text"))
    enriched = retrieval.enrich(queries.select("query_id"), found, info)
    hits = found.groupBy("query_id").agg(F.count("*").cast("int").alias("hits"))
    return enriched.join(hits, "query_id").select("query_id", "hits", F.array_join(F.transform("similar_examples", lambda e: e["id"].cast("string")), ",").alias("ids"))


@query()
def vector_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Vectors as chunks of documents of four: the best chunks per query, gathered per document."""
    vectors = table(spark, d, "embeddings")
    queries = vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    hits = retrieval.vector_topk(queries, vectors, 15, metric="l2").select("query_id", F.floor(F.col("vec_id") / 4).alias("doc_id"), F.col("vec_id").alias("chunk_id"), (F.col("vec_id") % 4).alias("chunk_index"), "score")
    return retrieval.chunk_search(hits, 5)


@query()
def blended_search(spark: SparkSession, d: str) -> DataFrame:
    docs = _document_terms(spark, d)
    queries = _search_queries(docs)
    return retrieval.blend(retrieval.bm25_topk(queries, docs, 10), retrieval.jaccard_topk(queries, docs, 10), cut=5)


@query("SELECT DISTINCT md5(text) AS hash FROM documents WHERE text IS NOT NULL")
def stream_first_texts(spark: SparkSession, d: str) -> DataFrame:
    stream = table_stream(spark, d, "documents").where("text is not null").select("doc_id", "text")
    return feeds.drain(feeds.first_texts(stream), _stream_dir(spark)).select(F.md5("text").alias("hash"))
