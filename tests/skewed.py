"""A copy of the test tables in which a third of the rows share one key."""

import os

import duckdb

# One table each: the columns made alike in a third of the rows.
HOT = {
    "orders": {"o_custkey": 7, "o_orderstatus": "'P'", "o_totalprice": 1000.0},
    "events": {"user_id": 3, "event_type": "'view'"},
    "lineitem": {"l_orderkey": 5, "l_linenumber": 1, "l_quantity": 9.0},
    "customer": {"c_nationkey": 1, "c_acctbal": 10.0, "c_mktsegment": "'BUILDING'"},
    "documents": {"text": "'the same text'", "lang": "'en'"},
    "part": {"p_name": "'12'", "p_brand": "'Brand#1'"},
}


def write(source, target):
    con = duckdb.connect()
    for name in os.listdir(source):
        if not name.endswith(".parquet"):
            continue
        table, path = name[:-8], f"{source}/{name}"
        hot = HOT.get(table, {})
        columns = [c[0] for c in con.execute(f"DESCRIBE SELECT * FROM '{path}'").fetchall()]
        kinds = {c[0]: c[1] for c in con.execute(f"DESCRIBE SELECT * FROM '{path}'").fetchall()}
        picks = ", ".join(
            f"CASE WHEN rowid % 3 = 0 THEN CAST({hot[c]} AS {kinds[c]}) ELSE {c} END AS {c}" if c in hot else c
            for c in columns)
        con.execute(f"CREATE OR REPLACE TABLE t AS SELECT * FROM '{path}'")
        con.execute(f"COPY (SELECT {picks} FROM t) TO '{target}/{name}' (FORMAT parquet)")
    return str(target)
