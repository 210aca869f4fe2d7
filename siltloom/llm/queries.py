"""The queries of the training-data problems, each over its whole tables with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltloom.common import table
from siltloom.llm import abuse_ops, code_ops, neardup, packing, pair_ops, tokens


def _units(spark: SparkSession, d: str) -> DataFrame:
    return code_ops.code_units(table(spark, d, "ui_info"), table(spark, d, "function_info"))


def _texts(spark: SparkSession, d: str) -> DataFrame:
    fim = table(spark, d, "fim_records").select(F.lit("fim_records").alias("source_table"), F.col("record_id").alias("row_id"), F.col("original_code").alias("text"))
    return _units(spark, d).select("source_table", "row_id", "text").unionByName(fim)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return code_ops.not_handmade(table(spark, d, "fim_records")).select("record_id")


def p1_kinds(spark: SparkSession, d: str) -> DataFrame:
    """How many files of each kind every repository holds."""
    found = code_ops.not_handmade(table(spark, d, "fim_records"))
    repos = table(spark, d, "fim_records").select("record_id", "repo_id")
    return found.join(repos, "record_id").groupBy("repo_id", "kind").agg(F.count("*").alias("files"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return code_ops.secret_lines(_units(spark, d))


def p2_redacted(spark: SparkSession, d: str) -> DataFrame:
    return code_ops.redacted(_units(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return code_ops.prose_spans(_units(spark, d)).select("source_table", "row_id", "line_no", "kind", "lang").distinct()


def p4_shares(spark: SparkSession, d: str) -> DataFrame:
    return code_ops.prose_shares(_units(spark, d))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    units = _units(spark, d).unionByName(code_ops.fim_texts(table(spark, d, "fim_records")))
    return code_ops.parse_errors(units).select("source_table", "row_id")


def p5_rates(spark: SparkSession, d: str) -> DataFrame:
    ui = table(spark, d, "ui_info").select("repo_id", "file", F.col("content").alias("text"))
    functions = table(spark, d, "function_info").select("repo_id", "file", F.col("content").alias("text"))
    fim = code_ops.fim_texts(table(spark, d, "fim_records"), "repo_id").select("repo_id", "file", "text")
    return code_ops.parse_rates(ui.unionByName(functions).unionByName(fim))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return pair_ops.pair_defects(table(spark, d, "instruction_pairs"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.similar_pairs(_texts(spark, d))


def p7_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.groups(_texts(spark, d))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.document_ids(table(spark, d, "documents"))


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.containers(table(spark, d, "documents"))


def p9_waste(spark: SparkSession, d: str) -> DataFrame:
    return packing.waste(packing.containers(table(spark, d, "documents")))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return abuse_ops.abuse_scores(table(spark, d, "documents")).where(F.col("score") >= abuse_ops.THRESHOLD).select("doc_id")


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return abuse_ops.abuse_verdicts(table(spark, d, "documents"))


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return abuse_ops.abuse_rates(table(spark, d, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_kinds, p2_found, p2_redacted, p4_found, p4_shares, p5_found, p5_rates, p6_found, p7_found, p7_groups, p8_ids, p9_containers, p9_waste, p10_found, p10_scores, p10_rates)
}

SQL: dict[str, str] = {
    "p7_found": """WITH x AS (SELECT 'ui_info' AS source_table, unit_id AS row_id, content AS text FROM ui_info UNION ALL SELECT 'function_info', unit_id, content FROM function_info UNION ALL SELECT 'fim_records', record_id, original_code FROM fim_records),
w AS (SELECT source_table, row_id, regexp_extract_all(text, '[A-Za-z0-9_]+') AS w FROM x WHERE text IS NOT NULL),
t AS (SELECT DISTINCT source_table, row_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM w)),
n AS (SELECT source_table, row_id, count(*) AS n FROM t GROUP BY ALL),
c AS (SELECT source_table, a.row_id AS row_a, b.row_id AS row_b, count(*) AS c FROM t a JOIN t b USING (source_table, g) WHERE a.row_id < b.row_id GROUP BY ALL)
SELECT c.source_table, row_a, row_b FROM c JOIN n a ON a.source_table = c.source_table AND a.row_id = row_a JOIN n b ON b.source_table = c.source_table AND b.row_id = row_b WHERE c / (a.n + b.n - c)::DOUBLE >= 0.7""",
}
