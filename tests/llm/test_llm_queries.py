import os

import pytest

from siltloom.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_runs(spark, name):
    queries.QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save()


def test_defined_columns(spark):
    want = {
        "p1_found": ["record_id"],
        "p2_found": ["source_table", "row_id", "line_no"],
        "p4_found": ["source_table", "row_id", "line_no", "kind", "lang"],
        "p5_found": ["source_table", "row_id"],
        "p6_found": ["pair_id", "defect"],
        "p7_found": ["source_table", "row_a", "row_b"],
        "p8_ids": ["doc_id", "ids"],
        "p10_found": ["doc_id"],
    }
    for name, columns in want.items():
        assert queries.QUERIES[name](spark, SF).columns == columns
