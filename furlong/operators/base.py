"""Projections, the track filter, the horse join and the base feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import CENTRAL_PLACES, HORSE_INPUT_COLUMNS, RACE_INPUT_COLUMNS
from ..functions import exprs as X
from .checks import assert_unique

# Pedigree and other horse columns offered by categorical_features.
HORSE_DIMENSION_COLUMNS = ("producer", "origin_place", "mother", "father", "mother_of_mother",
                           "father_of_mother", "mother_of_father", "father_of_father")


def race_projection(races: DataFrame) -> DataFrame:
    """The 29 race columns; ``horse_ids`` becomes the text key ``horse_id``."""
    cols = [F.col("horse_ids").cast("string").alias("horse_id") if c == "horse_ids" else F.col(c)
            for c in RACE_INPUT_COLUMNS]
    return races.select(*cols)


def horse_projection(horses: DataFrame) -> DataFrame:
    """The 10 horse columns."""
    return horses.select(*HORSE_INPUT_COLUMNS)


def central_filter(df: DataFrame, places: Sequence[str] = CENTRAL_PLACES) -> DataFrame:
    """Keep runs held at one of ``places``; a NULL place is dropped.

    ``IN`` on a plain column reaches the Parquet scan as a pushed filter.
    """
    return df.where(X.central_place("held_place", places))


def horse_slot(runs: DataFrame) -> Column:
    """One number per horse id; runs without an id get one from what else is known of them."""
    others = [c for c in ("race_id", "held_date", "jockey_names", "trainer_names", "horse_owners", "held_place",
                          "goal_times", "arrival_orders") if c in runs.columns]
    return F.when(F.col("horse_id").isNull(), F.xxhash64(*others)).otherwise(F.xxhash64("horse_id"))


def attach_horses(runs: DataFrame, horses: DataFrame, columns: Sequence[str] = (),
                  check_unique: bool = True, max_rows_per_horse: int = 2_000_000) -> DataFrame:
    """LEFT JOIN runs to horses USING (horse_id), keeping ``columns`` of the horse side.

    The dimension must be unique on ``horse_id`` (checked), otherwise runs
    would be multiplied.  Runs without an id match nothing and skip the join.
    No broadcast hint: AQE turns the join into a broadcast join at run time
    only when the measured horse side is under Spark's threshold.  When some
    horse has more than ``max_rows_per_horse`` runs, both sides get a salt, the
    run's by a hash of it and the horse's one copy per salt, so that a task
    gets about that many runs of a horse.
    """
    dim = horse_projection(horses).select("horse_id", *columns)
    if check_unique:
        assert_unique(dim, ["horse_id"], "horses")
    keyed, others = runs.where(F.col("horse_id").isNotNull()), runs.where(F.col("horse_id").isNull())
    order = ["horse_id", *[c for c in runs.columns if c != "horse_id"], *columns]
    most = keyed.groupBy("horse_id").count().agg(F.max("count")).first()[0] or 0
    n_salts = -(-most // max_rows_per_horse)
    if n_salts > 1:
        salt = F.pmod(F.xxhash64(*runs.columns), F.lit(n_salts)).cast("int")
        copies = F.explode(F.sequence(F.lit(0), F.lit(n_salts - 1)))
        joined = keyed.withColumn("_salt", salt).join(dim.withColumn("_salt", copies), ["horse_id", "_salt"], "left")
    else:
        joined = keyed.join(dim, on="horse_id", how="left")
    types = dict(dim.dtypes)
    missing = others.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in columns])
    return joined.select(*order).union(missing.select(*order))


def base_features(races: DataFrame, horses: DataFrame | None = None,
                  places: Sequence[str] = CENTRAL_PLACES, lenient: bool = False,
                  check_horses: bool = True, partition_by: str | None = None, slot: str | None = None,
                  n_tasks: int | None = None) -> DataFrame:
    """The 26 typed base columns of every central run.

    One select parses each source column once; a second one divides the parsed
    numbers.  The script's horse join selects no horse column; with a
    unique dimension it changes nothing.  So it is not run; when ``horses`` is
    given, its uniqueness is checked.

    ``partition_by="horse_id"`` hash-partitions the filtered runs *before* the
    parsing projection.  The feature windows need exactly that exchange, so
    it costs nothing extra, and the regex and cast work then runs in the
    post-shuffle tasks -- all cores busy even when the scan yields few splits.
    With ``slot`` they are dealt by a column of that name instead, which the
    result keeps last: a hash of the horse id, or of the run where there is none,
    so that runs without an id spread over all tasks.  ``n_tasks`` says over how
    many; otherwise the session does.
    """
    runs = central_filter(race_projection(races), places)
    if horses is not None and check_horses:
        assert_unique(horse_projection(horses).select("horse_id"), ["horse_id"], "horses")
    if partition_by is not None:
        runs = runs if slot is None else runs.withColumn(slot, horse_slot(runs))
        runs = runs.repartition(*[n_tasks] * (n_tasks is not None), partition_by if slot is None else slot)
    texts = {c for c, t in runs.dtypes if t == "string"}

    def number(name):
        return X.to_double(name, lenient) if name in texts else F.col(name).cast("double")

    numbers = ("jockey_weights", "half_times", "horse_weights", "horse_weight_diffs", "course_length")
    kept = ["race_id", "horse_id", "held_place", "weather", "jockey_names", "trainer_names", "horse_owners",
            "course_type", "course_condition", "course_direction", "race_number"]
    slots = [] if slot is None else [slot]
    held, date = F.col("held_date"), X.parse_held_date("held_date", lenient)
    parsed = runs.select(
        *kept, *slots,
        X.held_month(held, date).alias("held_month"),
        X.held_day_of_week(held, lenient, date).alias("held_day_of_week"),
        date.alias("held_date"),
        X.to_long("horse_ages", lenient).alias("horse_ages"),
        X.parse_clock("goal_times", lenient).alias("goal_times"),
        *[number(c).alias(c) for c in numbers],
        X.length_band("course_length").alias("course_length_category"),
        X.safe_to_long("arrival_orders").alias("arrival_orders"))
    return parsed.select(
        *kept, "held_month", "held_day_of_week",
        "course_length_category", "held_date", "horse_ages", "jockey_weights", "goal_times", "half_times",
        "horse_weights", "horse_weight_diffs", "course_length",
        X.divide(F.col("jockey_weights"), F.col("horse_weights"), lenient).alias("weight_ratio"),
        X.divide(F.col("course_length"), F.col("goal_times"), lenient).alias("avg_velocity"),
        X.divide(F.col("course_length") / F.lit(2), F.col("half_times"), lenient).alias("avg_half_velocity"),
        "arrival_orders", *slots)


def categorical_features(races: DataFrame, horses: DataFrame,
                         places: Sequence[str] = CENTRAL_PLACES, lenient: bool = False,
                         check_horses: bool = True) -> DataFrame:
    """The switched-off categorical block: race categories plus pedigree columns.

    ``held_place`` appears once (the disabled block lists it twice).
    """
    runs = central_filter(race_projection(races), places)
    runs = attach_horses(runs, horses, HORSE_DIMENSION_COLUMNS, check_unique=check_horses)
    hd = F.col("held_date")
    return runs.select(
        "race_id", "horse_id", "held_place", "held_date", "box_numbers", "horse_numbers",
        "horse_sexes", "jockey_names", "trainer_names", "horse_owners", "race_number",
        "course_type", "course_direction", "weather", "course_condition", "race_start_time",
        X.held_month(hd).alias("held_month"),
        X.held_day_of_week(hd, lenient).alias("held_day_of_week"),
        X.length_band("course_length").alias("course_length_category"),
        *HORSE_DIMENSION_COLUMNS,
    )
