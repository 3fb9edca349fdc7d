"""Every query with an oracle, on the smallest tables; the others return rows."""

import pytest

from evidra import catalog

from .helpers import oracle, rows_of

SF = "/root/testdata/sf0.001"
ORACLES = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, name):
    df = catalog.queries()[name](spark, SF)
    mine = [tuple(r) for r in df.collect()]
    if name in ORACLES:
        names, rows = oracle(ORACLES[name], SF)
        assert sorted(df.columns) == sorted(names)
        assert rows_of(df.columns, mine) == rows_of(names, rows)
    else:
        assert mine and df.columns


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
