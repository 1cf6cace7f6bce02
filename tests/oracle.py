"""Run queries and their SQL side by side: ``python tests/oracle.py [folder] [name …]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def differences(frame, relation) -> list[str]:
    """Empty when both sides hold the same columns and the same values."""
    found = []
    if sorted(frame.columns) != sorted(relation.columns):
        return [f"columns {sorted(frame.columns)} != {sorted(relation.columns)}"]
    ours = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    theirs = _rows(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} != {len(theirs)}")
    a, b = set(ours), set(theirs)
    only, missing = sorted(a - b)[:2], sorted(b - a)[:2]
    if only or missing:
        found.append(f"columns {sorted(frame.columns)}\n  ours {only}\n  sql  {missing}")
    elif ours != theirs and not found:
        found.append("same distinct rows in different numbers")
    return found


def main() -> None:
    from barloom import catalog
    from barloom.session import get_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    whole = catalog.load()
    names = sys.argv[2:] or list(whole.queries)
    spark = get_session(
        "oracle",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": 8,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name in names:
        started = time.time()
        try:
            frame = whole.queries[name](spark, folder)
            if name in whole.sql:
                found = differences(frame, connection.sql(whole.sql[name]))
                note = "ok" if not found else "; ".join(found)
            else:
                note, found = f"rows only: {frame.count()}", []
        except Exception as error:  # noqa: BLE001 - a report over all queries
            found, note = [str(error)], f"error {str(error)[:900]}"
        bad += bool(found)
        print(f"{name:28s} {time.time() - started:6.2f}s {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree, {len(names) - len(set(names) & set(whole.sql))} without SQL")
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
