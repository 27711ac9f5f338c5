"""Every registered query equals its DuckDB oracle at sf0.01: rows, columns, types, values."""

import math

import pytest

from furlong import registry as E
from conftest import SF01

TYPE_NAMES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
              "date": "DATE", "boolean": "BOOLEAN"}


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    return v


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF01)
    want_cols, want_rows, want_types = duck(E.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(want_cols)
    pick = [want_cols.index(c) for c in cols]
    spark_types = {f.name: TYPE_NAMES.get(f.dataType.simpleString()) for f in df.schema.fields}
    got = sorted((tuple(canon(r[c]) for c in cols) for r in df.collect()), key=repr)
    exp = sorted((tuple(canon(row[i]) for i in pick) for row in want_rows), key=repr)
    assert len(got) == len(exp)
    assert got == exp
    assert spark_types == dict(zip(want_cols, want_types))
