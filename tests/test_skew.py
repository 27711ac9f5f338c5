"""The skew path equals the direct path, also with one horse holding a third of all runs."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF01, rows_of
from furlong.operators import base as B
from furlong.operators import skew as K
from furlong.operators import trailing as T
from furlong.plans import jobs as J
from furlong.sources import fixtures


@pytest.fixture(scope="module")
def base(spark):
    return B.base_features(fixtures.races(spark, SF01)).cache()


def third(base, value):
    return F.when(F.abs(F.hash("race_id")) % 3 == 0, value)


def one_hot(base):
    return base.withColumn("horse_id", third(base, F.lit("HOT")).otherwise(F.col("horse_id")))


CASES = {
    "many hot horses": lambda b: b,
    "one horse with a third of all runs": one_hot,
    "a third without a horse": lambda b: b.withColumn("horse_id", third(b, F.lit(None)).otherwise(F.col("horse_id"))),
    "all dates missing": lambda b: one_hot(b).withColumn("held_date", F.when(F.col("horse_id") != "HOT", F.col("held_date"))),
    "one date": lambda b: one_hot(b).withColumn(
        "held_date", F.when(F.col("horse_id") == "HOT", F.lit("2020-01-01").cast("date")).otherwise(F.col("held_date"))),
    "some dates and race ids missing": lambda b: one_hot(b)
    .withColumn("held_date", F.when(F.abs(F.hash("race_id", F.lit(1))) % 5 > 0, F.col("held_date")))
    .withColumn("race_id", F.when(F.abs(F.hash("race_id", F.lit(2))) % 5 > 0, F.col("race_id"))),
    "repeated rows without a race id": lambda b: one_hot(b).withColumn("race_id", F.when(
        F.abs(F.hash("race_id", F.lit(2))) % 2 > 0, F.col("race_id"))).withColumn("n", F.explode(F.sequence(
            F.lit(0), F.when(F.col("race_id").isNull(), 1).otherwise(0)))).drop("n"),
}


@pytest.mark.parametrize("case,limit,chunk", [*((c, 500, 250) for c in list(CASES)[1:]), (list(CASES)[-1], 8, 400)])
def test_skew_path_equals_direct_path(spark, base, case, limit, chunk):
    runs = CASES[case](base)
    groups = (None, "weather", "held_month")
    direct = T.race_features(runs, groups)
    cols = sorted(direct.columns)
    skewed = K.race_features_skew_safe(runs, groups, max_rows_per_horse=limit, chunk_rows=chunk)
    assert skewed.columns == direct.columns
    assert rows_of(skewed, cols) == rows_of(direct, cols)


def test_repeated_full_keys_without_the_check(spark, base):
    runs = one_hot(base).union(one_hot(base).where("horse_id = 'HOT'"))
    direct = T.race_features(runs, [None], check_keys=False)
    cols = sorted(direct.columns)
    skewed = K.race_features_skew_safe(runs, [None], max_rows_per_horse=500, chunk_rows=100, check_keys=False)
    assert rows_of(skewed, cols) == rows_of(direct, cols)
    with pytest.raises(PySparkException, match="duplicate run key"):
        K.race_features_skew_safe(runs, [None], max_rows_per_horse=500, chunk_rows=100).select("horse_id").collect()


@pytest.mark.parametrize("case", ["one horse with a third of all runs", "all dates missing", "one date"])
def test_chunks_are_bounded_and_in_run_order(spark, base, case):
    runs = CASES[case](base)
    hot, other, n = K.hot_runs(runs, 500)
    assert n == hot.count() and n + other.count() == runs.count()
    tagged = K.assign_chunks(hot, n, 250)
    sizes = [r["count"] for r in tagged.groupBy(K.CHUNK).count().collect()]
    assert max(sizes) <= 3 * 250 and len(sizes) >= 8
    ends = tagged.groupBy("horse_id", K.CHUNK).agg(
        F.min(F.struct("held_date", "race_id", T.TIE)).alias("lo"), F.max(F.struct("held_date", "race_id", T.TIE)).alias("hi"))
    assert ends.selectExpr("lo", "lag(hi) over (partition by horse_id order by _chunk) as before").where("before > lo").count() == 0


def test_one_giant_does_not_shred_small_hot_horses(spark, base):
    runs = one_hot(base)
    hot, _, n = K.hot_runs(runs, 8)
    context = K.context_rows(K.assign_chunks(hot, n, 100), [None], 5).count()
    assert context <= 5 * (n // 100 + 2)


def test_nothing_hot_is_the_plain_plan(spark, base):
    hot, other, n = K.hot_runs(base, 10**9)
    assert hot is None and n == 0


def test_ids_beyond_the_broadcast_limit(spark, base):
    runs = one_hot(base)
    direct = T.race_features(runs, [None])
    cols = sorted(direct.columns)
    skewed = K.race_features_skew_safe(runs, [None], max_rows_per_horse=100, chunk_rows=1000, broadcast_limit_bytes=0)
    assert rows_of(skewed, cols) == rows_of(direct, cols)


@pytest.mark.parametrize("group", [None, "weather"])
def test_one_block_with_a_hot_horse_and_missing_ids(spark, base, group):
    runs = CASES["a third without a horse"](CASES["one horse with a third of all runs"](base).withColumn(
        "horse_id", F.when(F.abs(F.hash("race_id", F.lit(9))) % 4 == 0, F.lit("HOT")).otherwise(F.col("horse_id"))))
    plain = K.trailing_average(runs, group)
    split = K.trailing_average(runs, group, max_rows_per_horse=100, chunk_rows=50)
    assert rows_of(plain) == rows_of(split) and split.count() == runs.count()


@pytest.mark.parametrize("limit", [2_000_000, 100])
def test_horse_join_with_hot_and_missing_ids(spark, base, limit):
    horses = fixtures.horses(spark, SF01)
    hot_id = base.select("horse_id").first()[0]
    runs = base.withColumn("horse_id", third(base, F.lit(hot_id)).when(F.abs(F.hash("race_id")) % 3 == 1, F.lit(None))
                           .otherwise(F.col("horse_id")))
    want = runs.join(horses.select("horse_id", "mother"), "horse_id", "left")
    got = B.attach_horses(runs, horses, ["mother"], max_rows_per_horse=limit)
    assert got.columns == want.columns and rows_of(got) == rows_of(want)


def test_window_tasks_follow_the_number_of_runs(spark, base, monkeypatch):
    """A task holds a bounded number of runs, whatever few bytes of them are shuffled."""
    monkeypatch.setattr(T, "TASK_RUNS", 300)
    n = base.count()
    for runs in (J.feature_table(fixtures.races(spark, SF01)), J.feature_table(fixtures.races(spark, SF01), skew="off"),
                 K.trailing_average(base)):
        sizes = [r["n"] for r in runs.groupBy(F.spark_partition_id()).agg(F.count("held_date").alias("n")).collect()]
        assert max(sizes) < 2 * 300 and len(sizes) >= n // 300


def test_chunks_of_few_runs_share_tasks(spark, base):
    """Chunks have their number of runs exactly, and are not a partition each."""
    hot, _, n = K.hot_runs(base, 8)
    tagged = K.assign_chunks(hot, n, 3)
    sizes = [r["count"] for r in tagged.groupBy(K.CHUNK).count().collect()]
    assert max(sizes) == 3 and len(sizes) <= n // 3 + 9 and len(tagged.inputFiles()) <= 9
    runs = tagged.select("horse_id", K.ROW, K.CHUNK).orderBy(K.ROW).collect()
    assert [r["horse_id"] for r in runs] == sorted(r["horse_id"] for r in runs)
    want = {(r[K.ROW], r[K.CHUNK]) for r in K.context_rows(tagged, [None, "weather"], 5).select(K.ROW, K.CHUNK).collect()}
    few = K.context_rows(tagged, [None, "weather"], 5, chunk_rows=3)
    assert {(r[K.ROW], r[K.CHUNK]) for r in few.select(K.ROW, K.CHUNK).collect()} == want and few.count() == len(want)
