import __spark_entry__ as E
from furlong import registry


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) == 191
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
