"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import connect, differences

from barloom import catalog

WHOLE = catalog.load()


@pytest.fixture(scope="module")
def connection():
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(WHOLE.queries))
def test_query_matches_sql(spark, folder, connection, name):
    frame = WHOLE.queries[name](spark, folder)
    assert differences(frame, connection.sql(WHOLE.sql[name])) == []


def test_every_query_has_sql():
    assert set(WHOLE.queries) == set(WHOLE.sql)


def test_no_query_is_empty():
    """By their SQL, on larger tables: a result without rows proves nothing."""
    larger = connect("/root/testdata/sf0.01")
    assert [name for name, sql in WHOLE.sql.items() if not larger.sql(sql).limit(1).fetchall()] == []


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(WHOLE.queries) <= set(entry.queries())
    assert set(WHOLE.sql) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_ordered_results_come_in_order(spark, folder):
    days = [r.holiday_start for r in WHOLE.queries["sort_by_date"](spark, folder).collect()]
    assert days == sorted(days) and len(days) > 25
    terms = [(-r.term_count, r.term) for r in WHOLE.queries["text_term_freq"](spark, folder).collect()]
    assert terms == sorted(terms) and len(terms) == 200
