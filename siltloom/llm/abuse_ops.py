"""Problem 10 as DataFrame functions."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltloom.common import map_rows
from siltloom.llm import abuse

THRESHOLD = 0.5


def abuse_scores(documents: DataFrame) -> DataFrame:
    """(doc_id, source, score): a score from 0 to 1 for every document; 0.0 for null and empty texts."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, source, text in rows:
            yield key, source, abuse.score(text)

    return map_rows(documents.select(F.col("doc_id").cast("long"), "source", "text"), run, "doc_id long, source string, score double")


def abuse_verdicts(documents: DataFrame, review: float = THRESHOLD, exclude: float = 0.8) -> DataFrame:
    """(doc_id, source, score, verdict): keep, review or exclude by the score."""
    verdict = F.when(F.col("score") >= exclude, "exclude").when(F.col("score") >= review, "review").otherwise("keep")
    return abuse_scores(documents).withColumn("verdict", verdict)


def abuse_rates(documents: DataFrame) -> DataFrame:
    """(source, documents, cases, rate); documents without a source are counted under null."""
    scores = abuse_scores(documents)
    grouped = scores.groupBy("source").agg(F.count("*").alias("documents"), F.count(F.when(F.col("score") >= THRESHOLD, 1)).alias("cases"))
    return grouped.withColumn("rate", F.round(F.col("cases") / F.col("documents"), 6))
