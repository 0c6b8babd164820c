import datetime
import json
import os
from types import SimpleNamespace
from urllib.parse import urlparse

from regista.workload.storage import _landed_register


def test_pages_land_by_name_from_the_tasks(spark):
    """Each page is written once, under its dated folder and its own name; nothing else lands."""
    day = datetime.date
    orders = spark.createDataFrame(
        [(1, day(1992, 3, 1)), (999, day(1992, 5, 1)), (1000, day(1992, 6, 1)), (2500, day(1993, 1, 2))],
        "o_orderkey long, o_orderdate date",
    ).selectExpr("o_orderkey", "o_orderdate", "7L AS o_custkey", "'1-URGENT' AS o_orderpriority", "'F' AS o_orderstatus")
    landed = urlparse(_landed_register(SimpleNamespace(spark=spark, orders=orders), 1000)).path
    found = {}
    for folder, _, names in os.walk(landed):
        for name in names:
            with open(os.path.join(folder, name)) as page:
                found[os.path.relpath(os.path.join(folder, name), landed)] = sorted(r["registre"] for r in json.load(page))
    assert found == {
        "downloaded_date=19920101/00000000.json": ["S00000001", "S00000999"],
        "downloaded_date=19920101/00001000.json": ["S00001000"],
        "downloaded_date=19930101/00002000.json": ["S00002500"],
    }
