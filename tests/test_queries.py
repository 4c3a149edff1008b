"""Every query of the bar library against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import against_sql

from tapeloom import catalog


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_its_sql(spark, tables, name):
    frame, sql = catalog.queries()[name](spark, tables), catalog.oracle_sql().get(name)
    if sql:
        assert against_sql(frame, tables, sql) is None
    else:
        frame.collect()


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_every_sql_has_a_query():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_the_comparison_is_exact_for_all_but_floats():
    import pyarrow as pa
    from compare import difference

    table = lambda **columns: pa.table({k: pa.array(v) for k, v in columns.items()})
    assert difference(table(a=[1, 10**15], b=[0.1, 0.2]), table(b=[0.2, 0.1 + 1e-12], a=[10**15, 1])) is None
    assert difference(table(a=[10**15]), table(a=[10**15 + 1])) is not None
    assert difference(table(a=[1]), table(a=[1.5])) is not None and difference(table(a=[True]), table(a=[1])) is not None
    assert difference(table(a=[1, None]), table(a=[None, 2])) is not None
    assert difference(table(a=[0.1]), table(a=[0.1001])) is not None
    assert difference(table(a=[[1, 2]]), table(a=[[1, 3]])) is not None
