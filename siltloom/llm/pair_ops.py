"""Problem 6 as a DataFrame function."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltloom.common import map_rows
from siltloom.llm import pairs


def pair_defects(records: DataFrame) -> DataFrame:
    """(pair_id, defect): one row per defect of each pair; sound pairs have none.  Null fields count as empty."""

    def run(rows: Iterator[tuple]) -> Iterator[tuple]:
        for key, query, description, code, solution in rows:
            for defect in pairs.defects(query, description, code, solution):
                yield key, defect

    return map_rows(records.select(F.col("pair_id").cast("long"), "query", "description", "code", "solution"), run, "pair_id long, defect string")
