"""Rows in the order of an id, dealt into ranges of it, without a global sort."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LOWEST = -(1 << 63)


def count_not_above(bounds: list[int], value: Column) -> Column:
    """How many of the ascending ``bounds`` are at most ``value``, by binary search."""
    if not bounds:
        return F.lit(0)
    array = F.lit(bounds).cast("array<bigint>")

    def halve(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        right = F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi"))
        left = F.struct(acc["lo"].alias("lo"), mid.alias("hi"))
        step = F.when(F.get(array, mid) <= value, right).otherwise(left)
        return F.when(acc["lo"] < acc["hi"], step).otherwise(acc)

    steps = math.ceil(math.log2(len(bounds) + 1)) + 1
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)),
                       F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi")), halve, lambda acc: acc["lo"])


def spread_labels(spark: SparkSession, n: int) -> list[int]:
    """``n`` distinct longs of which Spark's hash deals one to each of ``n`` partitions."""
    place = F.pmod(F.hash("id"), F.lit(n))
    rows = spark.range(32 * n + 64).groupBy(place.alias("place")).agg(F.min("id").alias("id")).collect()
    found = {r["place"]: r["id"] for r in rows}
    return [found.get(i, -1 - i) for i in range(n)]  # one in e^32 has none of its own and shares


def with_next(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``rows`` with bucket, place, own and ``next_<text_col>``, the text of the row that follows in id order.

    Ranges of the id hold about the same number of rows.  Their bounds and
    first ids are what the driver learns: two numbers a range, as literals, so
    that a stage that is run again deals the rows the same way.  A range's label
    is chosen so that each has a partition of its own.  The first row
    of a range also goes to the range before (and the first of all to the last
    range) as a guest, ``own`` = false.  (bucket, place) is unique.  One
    exchange on bucket, which the result keeps.
    """
    spark = rows.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ids = rows.select(id_col)
    shares = [i / n for i in range(1, n)]
    bounds = ids.agg(F.percentile_approx(id_col, shares, 10_000).alias("b")).first()["b"] if shares else None
    bounds = sorted(set(bounds or []))
    key = F.coalesce(F.col(id_col), F.lit(LOWEST))
    bucket = count_not_above(bounds, key)
    firsts = {r["bucket"]: r["first"] for r in
              ids.groupBy(bucket.alias("bucket")).agg(F.min(key).alias("first")).collect()}
    if not firsts:
        firsts = {0: LOWEST}
    full = sorted(firsts)
    before = dict(zip(full[1:], full[:-1]))
    at = F.col("bucket") + 1
    first = F.element_at(F.lit([firsts.get(b, 0) for b in range(len(bounds) + 1)]).cast("array<bigint>"), at)
    guest_of = F.element_at(F.lit([before.get(b, full[-1]) for b in range(len(bounds) + 1)]).cast("array<int>"), at)

    labels = F.lit(spread_labels(spark, max(n, len(bounds) + 1))).cast("array<bigint>")

    def copy(to, own, wraps):
        return F.struct(F.element_at(labels, to.cast("int") + 1).alias("bucket"), F.lit(own).alias("own"), wraps.alias("wraps"))

    own = copy(F.col("bucket"), True, F.lit(False))
    guest = copy(guest_of, False, F.col("bucket") == full[0])
    copies = F.when(key == first, F.array(own, guest)).otherwise(F.array(own))
    order = Window.partitionBy("bucket").orderBy("wraps", F.col(id_col).asc_nulls_first(), text_col, F.desc("own"))
    return (rows.withColumn("bucket", bucket).select(*rows.columns, F.explode(copies).alias("_to"))
            .select(*rows.columns, "_to.*").repartition(n, "bucket")
            .withColumn("place", F.row_number().over(order))
            .withColumn(f"next_{text_col}", F.lead(text_col).over(order)).drop("wraps"))
