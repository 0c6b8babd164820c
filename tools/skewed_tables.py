"""Copies the test tables with a third of the rows moved to one key.

    python tools/skewed_tables.py <sf folder> <new folder>

Every third line item goes to one order, part and supplier, every third order to one customer,
every third customer and supplier to one nation, every third part to one name and brand, every
third event to one day and type, and every third document to one text.
"""

import os
import sys

import duckdb

CHANGES = {
    "lineitem": ("l_orderkey", {"l_orderkey": "1", "l_partkey": "1", "l_suppkey": "1"}),
    "orders": ("o_orderkey", {"o_custkey": "1"}),
    "customer": ("c_custkey", {"c_nationkey": "7"}),
    "supplier": ("s_suppkey", {"s_nationkey": "7"}),
    "part": ("p_partkey", {"p_name": "'small ring'", "p_brand": "'Brand#3'"}),
    "events": ("event_id", {"ts": "TIMESTAMP '2024-01-05 12:00:00'", "event_type": "'error'"}),
    "documents": ("doc_id", {"text": "(SELECT min(text) FROM source)"}),
    "conversations": ("conv_id", {}),
}
OTHERS = ("region", "nation", "embeddings", "pages", "benchmark", "labels")


def main(source: str, target: str) -> None:
    os.makedirs(target)
    con = duckdb.connect()
    for name, (key, changes) in CHANGES.items():
        con.execute(f"CREATE OR REPLACE VIEW source AS FROM read_parquet('{source}/{name}.parquet')")
        moved = ", ".join(
            f"CASE WHEN hash({key}) % 3 = 0 THEN {v} ELSE {c} END AS {c}" for c, v in changes.items()
        )
        replace = f"* REPLACE ({moved})" if moved else "*"
        con.execute(f"COPY (SELECT {replace} FROM source) TO '{target}/{name}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 20480)")
    for name in OTHERS:
        con.execute(f"COPY (FROM read_parquet('{source}/{name}.parquet')) "
                    f"TO '{target}/{name}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 20480)")


if __name__ == "__main__":
    main(*sys.argv[1:])
