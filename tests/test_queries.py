"""Every registered campaign query against its SQL twin, over whole tables."""

import pytest

from leadmill.jobs import registry


def plain(rows, columns):
    return sorted((tuple(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in columns) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, data, duck, name):
    df = registry.QUERIES[name](spark, data)
    rows, columns = df.collect(), sorted(df.columns)
    assert rows
    if name not in registry.ORACLES:
        return
    result = duck.execute(registry.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert plain(rows, columns) == plain([dict(zip(names, r)) for r in result.fetchall()], columns)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert "greedy_dock_pick" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
