"""Every registered query against the same result from another engine."""

import re

import pytest

import __spark_entry__ as contract
from clearbrook.sources.sales import sales_staged

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
DUCK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    """But for those over training data, of which SQL expresses few."""
    without = set(QUERIES) - set(ORACLES)
    assert set(ORACLES) <= set(QUERIES) and all(n == "pipeline" or re.match(r"op\d+_", n) for n in without)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_oracle(name, spark, folder, duck):
    frame = QUERIES[name](spark, folder)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert {c: DUCK_TYPES[t] for c, t in frame.dtypes} == {d[0]: str(d[1]) for d in cursor.description}
    assert by_name(frame.columns, frame.collect()) == by_name(columns, cursor.fetchall())


def test_entry_runs(spark):
    frame = contract.entry(spark)
    staged = sales_staged(spark, contract.SMOKE_FOLDER)
    assert frame.count() == staged.select("order_id", "date_parsed").distinct().count() > 900
    assert frame.columns[-2:] == ["was_winsorized", "was_relabeled"]
