import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as driver  # noqa: E402
from check import compare, connect  # noqa: E402

from regista import workload  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(workload.queries()) == set(workload.oracle_sql())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[-1] == "total_capacit"
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(workload.queries()))
def test_query_agrees_with_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER) is None


def test_operator_index_names_exist():
    import re

    path = os.path.join(os.path.dirname(driver.__file__), "OPERATORS.md")
    with open(path, encoding="utf-8") as index:
        rows = [line.split("|") for line in index if re.match(r"\| [A-Z]\d+ ", line)]
    named = {q for row in rows for q in re.findall(r"`(\w+)`", row[3])}
    assert named == set(workload.queries())
    assert len(rows) == len({row[1] for row in rows})
