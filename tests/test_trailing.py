"""Trailing averages: worked example, NULL mask, key checks, frame modes, plan shape."""

import datetime as dt
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import SF001, rows_of
from furlong.constants import CENTRAL_PLACES as CENTRAL
from furlong.constants import GROUPS, LENGTHS, METRICS
from furlong.operators import base as B
from furlong.operators import checks as C
from furlong.operators import trailing as T
from furlong.plans import jobs as J
from furlong.sources import fixtures
from join_form import race_features_join_form

MINI = "race_id string, horse_id string, held_date date, weather string, goal_times double"


def mini(spark, rows):
    return spark.createDataFrame(rows, MINI)


def d(day):
    return dt.date(2020, 1, day)


def feats(df, group=None, lengths=(1, 3), frame="trailing"):
    out = T.race_features(df, groups=[group], lengths=lengths, metrics=["goal_times"], frame=frame)
    names = [T.feature_name(group, k, "goal_times") for k in lengths]
    return [tuple(r[n] for n in names) for r in out.orderBy("held_date").collect()]


def test_worked_example(spark):
    df = mini(spark, [("r1", "h", d(1), "w", 10.0), ("r2", "h", d(2), "w", 20.0),
                      ("r3", "h", d(3), "w", None), ("r4", "h", d(4), "w", 40.0)])
    assert feats(df) == [(None, None), (10.0, 10.0), (20.0, 15.0), (None, 15.0)]
    assert feats(df, frame="as_written") == [(None, None), (10.0, None), (20.0, None), (None, None)]
    assert feats(df, group="weather") == [(None, None), (10.0, 10.0), (20.0, 15.0), (None, 15.0)]


def test_null_group_value_gives_null_features(spark):
    df = mini(spark, [("r1", "h", d(1), None, 10.0), ("r2", "h", d(2), None, 20.0),
                      ("r3", "h", d(3), None, 30.0)])
    assert feats(df, group="weather") == [(None, None)] * 3
    # ...while the overall block still sees those runs
    assert feats(df) == [(None, None), (10.0, 10.0), (20.0, 15.0)]


def test_null_key_gives_null_but_still_counts_for_others(spark):
    df = mini(spark, [(None, "h", d(1), "w", 10.0), ("r2", "h", d(2), "w", 20.0)])
    assert feats(df) == [(None, None), (10.0, 10.0)]


def test_groups_are_separate(spark):
    df = mini(spark, [("r1", "h", d(1), "a", 10.0), ("r2", "h", d(2), "b", 20.0),
                      ("r3", "h", d(3), "a", 30.0), ("r4", "h2", d(4), "a", 99.0)])
    out = feats(df, group="weather")
    assert out == [(None, None), (None, None), (10.0, 10.0), (None, None)]


def test_date_ties_broken_by_race_id(spark):
    df = mini(spark, [("r2", "h", d(1), "w", 20.0), ("r1", "h", d(1), "w", 10.0)])
    out = T.race_features(df, groups=[None], lengths=[1], metrics=["goal_times"])
    got = {r.race_id: r.previous_1_goal_times_avgs for r in out.collect()}
    assert got == {"r1": None, "r2": 10.0}


def test_duplicate_run_key_fails(spark):
    df = mini(spark, [("r1", "h", d(1), "w", 10.0), ("r1", "h", d(1), "w", 10.0)])
    with pytest.raises(PySparkException, match="duplicate run key"):
        T.race_features(df, groups=[None], lengths=[1], metrics=["goal_times"]).collect()


def test_duplicate_run_key_fails_whatever_is_read(spark):
    df = mini(spark, [("r1", "h", d(1), "w", 10.0), ("r1", "h", d(1), "w", 10.0), ("r2", "h", d(2), "w", 10.0)])
    out = T.race_features(df, groups=[None], lengths=[1], metrics=["goal_times"])
    for read in (out.select("horse_id", "previous_1_goal_times_avgs").collect, out.count):
        with pytest.raises(PySparkException, match="duplicate run key"):
            read()


def test_duplicate_horse_fails(spark):
    runs = spark.createDataFrame([("r1", "h")], "race_id string, horse_id string")
    horses = spark.createDataFrame([(h, None, None, None, None, None, None, None, None, None)
                                    for h in ["h", "h"]],
                                   ", ".join(f"{c} string" for c in B.HORSE_INPUT_COLUMNS))
    with pytest.raises(C.DuplicateKeyError):
        B.attach_horses(runs, horses)


def test_output_columns_follow_using_join_order(spark):
    base = B.base_features(fixtures.races(spark, SF001))
    cols = T.race_features(base).columns
    assert cols[:26] == [
        "race_id", "horse_id", "held_day_of_week", "held_date", "held_month",
        "course_length_category", "race_number", "course_direction", "course_condition",
        "course_type", "jockey_names", "weather", "held_place", "trainer_names", "horse_owners",
        "horse_ages", "jockey_weights", "goal_times", "half_times", "horse_weights",
        "horse_weight_diffs", "course_length", "weight_ratio", "avg_velocity",
        "avg_half_velocity", "arrival_orders"]
    assert cols[26:] == T.feature_names()
    assert len(cols) == 26 + len(GROUPS) * len(LENGTHS) * len(METRICS) == 191


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning", plan)), len(re.findall(r"\bWindow\b", plan))


def test_plan_has_one_shuffle_and_eleven_windows(spark):
    df = J.feature_table(fixtures.races(spark, SF001))
    assert exchanges(df) == (1, 11)


def test_join_form_plan_is_much_larger(spark):
    base = B.base_features(fixtures.races(spark, SF001))
    n_exchange, n_window = exchanges(race_features_join_form(base))
    assert n_window == 33 and n_exchange >= 33


def test_direct_equals_join_form_and_input_order(spark):
    races = fixtures.races(spark, SF001)
    direct = J.feature_table(races)
    shuffled = J.feature_table(races.orderBy(F.rand(7)))
    joined = race_features_join_form(B.base_features(races))
    cols = sorted(direct.columns)
    assert rows_of(direct, cols) == rows_of(joined, cols) == rows_of(shuffled, cols)


def test_k1_equals_lag_and_as_written(spark):
    races = fixtures.races(spark, SF001)
    trailing = J.feature_table(races)
    written = J.feature_table(races, frame="as_written")
    w = T.run_window("weather")
    trailing = trailing.withColumn(T.TIE, F.lit(0))
    lagged = trailing.select(
        "race_id", "same_weather_previous_1_goal_times_avgs",
        F.when(T.key_mask("weather"), F.lag("goal_times", 1).over(w)).alias("lag1"))
    assert all(r[1] == r[2] for r in lagged.collect())
    k1 = [n for n in T.feature_names(lengths=[1])]
    k35 = [n for n in T.feature_names(lengths=[3, 5])]
    assert rows_of(trailing, ["race_id"] + k1) == rows_of(written, ["race_id"] + k1)
    nulls = written.select([F.count(F.col(n)).alias(n) for n in k35]).first()
    assert all(v == 0 for v in nulls)


def test_filter_and_columns_reach_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "races")
    fixtures.races(spark, SF001).write.parquet(path)
    df = J.feature_table(spark.read.parquet(path), skew="off")
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    assert re.search(r"PushedFilters: \[.*In\(held_place, ", plan)
    read_schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    # unused input columns are never read
    for unused in ("race_url", "box_numbers", "horse_numbers", "horse_sexes", "odds",
                   "popularities", "order_transitions", "race_start_time"):
        assert unused not in read_schema
    assert "held_place" in read_schema and "goal_times" in read_schema


def test_feature_table_with_horse_join_equals_without(spark):
    races = fixtures.races(spark, SF001)
    horses = fixtures.horses(spark, SF001)
    with_join = J.feature_table(races, horses)
    without = J.feature_table(races)
    cols = sorted(without.columns)
    assert rows_of(with_join, cols) == rows_of(without, cols)


@pytest.mark.parametrize("column,bad,feature", [
    ("goal_times", "94.5", "goal_times"),           # clock time without a colon
    ("horse_weights", "0", "weight_ratio"),          # zero divisor
    ("horse_ages", "3.0", "horse_ages"),             # not an integer text
    ("held_date", "2020年13月1日", "held_date"),       # impossible date
])
def test_bad_values_fail_strict_and_null_lenient(spark, column, bad, feature):
    races = fixtures.races(spark, SF001)
    first = races.agg(F.min("race_id")).first()[0]
    spoiled = races.withColumn(column, F.when(F.col("race_id") == first, F.lit(bad)).otherwise(F.col(column)))
    spoiled = spoiled.withColumn("held_place", F.when(F.col("race_id") == first, F.lit("東京"))
                                 .otherwise(F.col("held_place")))
    with pytest.raises(Exception):
        J.feature_table(spoiled, skew="off").collect()
    out = J.feature_table(spoiled, skew="off", lenient=True)
    assert out.where(F.col("race_id") == first).first()[feature] is None
    assert out.count() == B.base_features(races).count() + (0 if races.where(
        (F.col("race_id") == first) & F.col("held_place").isin(*CENTRAL)).count() else 1)
