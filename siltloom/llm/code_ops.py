"""The code operators as DataFrame functions (problems 1, 2, 4 and 5): one narrow Arrow pass over each table.

Every operator takes any DataFrame that has the named columns; further columns are left out of the scan.  Null
texts give no rows, or the defined values stated below; repeated rows give repeated results under their own keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltloom.common import durable, map_rows
from siltloom.llm import generated, prose, secrets, syntax

#: The parts of a fill-in-the-middle record in their order.
FIM_PARTS = ("above_context_without_fim_start", "fim_task_sector_start", "fim_target", "fim_task_sector_end", "follow_context_without_fim_end")


def _units(df: DataFrame, source_table: str, key: str, text: str, file: str | None) -> DataFrame:
    path = F.col(file) if file else F.lit(None).cast("string")
    return df.select(F.lit(source_table).alias("source_table"), F.col(key).cast("long").alias("row_id"), path.alias("file"), F.col(text).alias("text"))


def code_units(ui: DataFrame, functions: DataFrame) -> DataFrame:
    """The contents of both unit tables under (source_table, row_id, file, text)."""
    return _units(ui, "ui_info", "unit_id", "content", "file").unionByName(_units(functions, "function_info", "unit_id", "content", "file"))


def _is_java(file: str | None) -> bool:
    return bool(file) and file.lower().endswith(".java")


def secret_lines(units: DataFrame) -> DataFrame:
    """(source_table, row_id, line_no): the lines on which the value of a credential begins, each once."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for source, key, text in rows:
            for line in secrets.lines(text):
                yield source, key, line

    return map_rows(units.select("source_table", "row_id", "text"), run, "source_table string, row_id long, line_no int")


def redacted(units: DataFrame) -> DataFrame:
    """(source_table, row_id, text): every text with its credentials masked; null stays null."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for source, key, text in rows:
            yield source, key, secrets.redact(text)

    return map_rows(units.select("source_table", "row_id", "text"), run, "source_table string, row_id long, text string", block=512)


def prose_spans(units: DataFrame) -> DataFrame:
    """(source_table, row_id, line_no, kind, lang, chars): the comments and literals that hold prose."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for source, key, file, text in rows:
            at, line = 0, 1
            for a, size, kind, lang in sorted(prose.spans(text, _is_java(file))):
                line += text.count("\n", at, a)
                at = a
                yield source, key, line, kind, lang, size

    return map_rows(units.select("source_table", "row_id", "file", "text"), run, "source_table string, row_id long, line_no int, kind string, lang string, chars int")


def prose_shares(units: DataFrame) -> DataFrame:
    """(source_table, row_id, lang, chars, share): how much of each unit's text is prose of each language.

    A unit without prose has one row with a null language and share 0.0; so have null and empty texts.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for source, key, file, text in rows:
            size: dict[str, int] = {}
            for _, n, _, lang in prose.spans(text, _is_java(file)):
                size[lang] = size.get(lang, 0) + n
            if not size:
                yield source, key, None, 0, 0.0
            for lang, n in sorted(size.items()):
                yield source, key, lang, n, round(n / len(text), 6)

    return map_rows(units.select("source_table", "row_id", "file", "text"), run, "source_table string, row_id long, lang string, chars int, share double")


def fim_texts(records: DataFrame, *more: str) -> DataFrame:
    """The five parts of each record put together, a null part as an empty one, with further columns of the record."""
    whole = F.concat(*[F.coalesce(F.col(p), F.lit("")) for p in FIM_PARTS])
    return records.select(F.lit("fim_records").alias("source_table"), F.col("record_id").cast("long").alias("row_id"), F.lit(None).cast("string").alias("file"), whole.alias("text"), *more)


def parse_errors(units: DataFrame) -> DataFrame:
    """(source_table, row_id, position): the first unrecoverable error of each text that does not parse.

    The language follows the file's extension, Java for .java and script otherwise.  Null, empty and blank
    texts are valid.  The position counts characters from 0; a text that breaks off has its length.
    """

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for source, key, file, text in rows:
            at = syntax.first_error(text, _is_java(file)) if text else -1
            if at >= 0:
                yield source, key, at

    return map_rows(units.select("source_table", "row_id", "file", "text"), run, "source_table string, row_id long, position int")


def parse_rates(units: DataFrame) -> DataFrame:
    """(repo_id, language, units, invalid, rate) over units with repo_id; counts are combined before the shuffle."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for repo, file, text in rows:
            java = _is_java(file)
            yield repo, "java" if java else "arkts", int(bool(text) and syntax.first_error(text, java) >= 0)

    flags = map_rows(units.select("repo_id", "file", "text"), run, "repo_id long, language string, bad int")
    return flags.groupBy("repo_id", "language").agg(F.count("*").alias("units"), F.sum("bad").alias("invalid")).withColumn("rate", F.round(F.col("invalid") / F.col("units"), 6))


def handmade_signs(records: DataFrame) -> DataFrame:
    """(record_id, repo_id, kind, rules): what each file shows by itself, and the hashes of the rules that equal texts share."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        while block := list(islice(rows, 256)):
            signs = [generated.signs(path, text) for _, _, path, text in block]
            for (key, repo, _, _), s, found in zip(block, signs, generated.shared_rules([s.words for s in signs])):
                yield key, repo, generated.kind(s), found

    return map_rows(records.select(F.col("record_id").cast("long"), F.col("repo_id").cast("long"), "file_path", "original_code"), run, "record_id long, repo_id long, kind string, rules array<long>")


def not_handmade(records: DataFrame, min_repos: int = 5, cover: float = 0.6) -> DataFrame:
    """(record_id, kind): generated, packed and vendored files and blobs.

    A file without signs of its own is third-party code when ``cover`` of its rules (``generated.shared_rules``) occur in
    a file that is third-party code by its own signs, or, of three rules at least, in ``min_repos`` repositories or more.
    Repositories are counted over all rows, those with signs too, with partial aggregation on (rule, repository), so that a
    rule that a third of all files share is one row per repository.
    """
    signs = durable(handmade_signs(records))
    rules = signs.select("record_id", "repo_id", "kind", F.explode("rules").alias("rule"), F.size("rules").alias("of"))
    by_repo = rules.groupBy("rule", "repo_id").agg(F.max(F.col("kind").eqNullSafe("vendored")).alias("known"))
    shared = by_repo.groupBy("rule").agg(F.count("*").alias("repos"), F.max("known").alias("known")).where((F.col("repos") >= min_repos) | F.col("known")).select("rule", "known")
    silent = rules.where("kind is null").join(shared, "rule").groupBy("record_id").agg(F.count("*").alias("n"), F.count_if("known").alias("known"), F.max("of").alias("of"))
    vendored = silent.where((F.col("known") >= cover * F.col("of")) | (F.col("of") >= 3) & (F.col("n") >= cover * F.col("of")))
    return signs.where("kind is not null").select("record_id", "kind").unionByName(vendored.select("record_id", F.lit("vendored").alias("kind")))
