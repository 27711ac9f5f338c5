"""Key checks.

The feature script re-attaches every feature block with a LEFT JOIN on the run
key, which silently multiplies rows when a key occurs twice.  We never
multiply: duplicate keys are an error.  Two forms:

* ``duplicate_keys`` / ``assert_unique`` -- an aggregate (partial aggregation
  on the map side, so even a key held by a third of all rows costs one small
  record per task) for tables that are not otherwise shuffled on the key;
* ``adjacent_duplicate`` -- a window-time check used inside the feature pass:
  rows with the same run key sit next to each other in the (horse, date,
  race) order, so a ``lag`` comparison finds them without any extra shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    pass


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys (all non-NULL) that occur more than once, with their count ``n_rows``."""
    keys = list(keys)
    non_null = F.lit(True)
    for k in keys:
        non_null = non_null & F.col(k).isNotNull()
    return (df.select(*keys).where(non_null)
            .groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> None:
    """Raise ``DuplicateKeyError`` when some non-NULL key occurs twice.

    Only one offending key travels to the driver (``limit(1)``).
    """
    hit = duplicate_keys(df, keys).limit(1).collect()
    if hit:
        raise DuplicateKeyError(f"{what}: key {tuple(keys)} is not unique, e.g. {hit[0].asDict()}")


def adjacent_duplicate(keys: Sequence[str], window: WindowSpec) -> Column:
    """True on a row whose key equals the previous row's key in ``window``.

    ``window`` must order by the key columns (after its partition columns), so
    equal keys are neighbours.  NULL keys never count as equal, matching SQL
    join semantics.
    """
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.lag(F.col(k), 1).over(window) == F.col(k))
    return F.coalesce(cond, F.lit(False))

