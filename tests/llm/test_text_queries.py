"""Text queries that SQL can express, next to their SQL on the smallest data folder."""

import pytest
from compare import check_engine, difference

from tillback.llm.queries import QUERIES, STATEMENTS

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_query(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), check_engine(FOLDER), STATEMENTS[name]) == ""


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in STATEMENTS])
def test_query_without_sql(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
