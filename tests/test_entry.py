from __future__ import annotations

import __spark_entry__ as entry


def test_entry_and_names(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["s1_id", "t_id", "score", "rn"] and rows.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
