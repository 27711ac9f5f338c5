"""Trailing averages over a horse's previous runs, overall and per condition group.

For every run the script adds ``AVG(metric)`` over the previous k runs of the
same horse (and, in ten blocks, of the same horse under the same condition:
track, weather, jockey, ...), for k = 1, 3, 5 and five metrics: 165 columns.
It builds each block as a window CTE and LEFT JOINs all 33 blocks back on the
run key.

Here the features are computed directly on the base table:

* every grouping refines ``horse_id``, so one hash exchange on the horse's slot
  (a hash of its id) serves all eleven window specs (the 33 self-joins and
  their 33+ exchanges are gone); runs without a horse id, whose features are
  NULL, have slots of their own and spread over all tasks of the same exchange;
* a feature is one ``avg`` over a sliding frame, the previous run's value one
  ``lag``: 165 small expressions in two selects, so the plan is built quickly;
* the join's NULL semantics are kept with a mask: a run whose key or group
  value is NULL gets NULL features, exactly as an unmatched LEFT JOIN row;
* duplicate run keys, which would multiply rows in the join form, raise an
  error, checked with a ``lag`` in the first group's window (no extra window or
  job) and a row filter after it, so it also runs when no key column is read.

Runs are ordered by date and race id; runs that these do not decide (a missing
date or race id) are ordered by a hash of all their columns, so results are
repeatable.

``frame="trailing"`` (default) averages rows ``k PRECEDING .. 1 PRECEDING``.
``frame="as_written"`` reproduces the script literally: its 3- and 5-run
frames are written start-after-end and are empty, so those features are NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ..constants import FEATURE_NAME, GROUP_FEATURE_NAME, GROUPS, LENGTHS, METRICS, RUN_KEY
from .base import horse_slot
from .checks import adjacent_duplicate

FRAMES = ("trailing", "as_written")
ORDER_COLUMNS = ("held_date", "race_id")
TIE = "_tie"                     # orders runs that these do not decide
SLOT = "_slot"                   # what runs are dealt by, see base.horse_slot
TASK_RUNS = 1 << 16              # runs of one task: its eleven sorts hold some 10 kB of each


def feature_name(group: str | None, k: int, metric: str) -> str:
    if group is None:
        return FEATURE_NAME.format(k=k, metric=metric)
    return GROUP_FEATURE_NAME.format(group=group, k=k, metric=metric)


def feature_names(groups: Sequence[str | None] = GROUPS, lengths: Sequence[int] = LENGTHS,
                  metrics: Sequence[str] = METRICS) -> list[str]:
    """Feature columns in the script's join order (group, then k, then metric)."""
    return [feature_name(g, k, m) for g in groups for k in lengths for m in metrics]


def join_keys(group: str | None) -> list[str]:
    """The USING list with which the script re-attaches a block."""
    return ["race_id", "horse_id"] + ([group] if group else []) + ["held_date"]


def with_tie(base: DataFrame, unique_keys: bool = False) -> DataFrame:
    """``base`` with the column that orders runs of one date and race id.

    With ``unique_keys`` only runs without a date or race id need it; others have NULL.
    """
    tie = F.xxhash64(*[c for c in base.columns if c != SLOT])
    undecided = F.lit(not unique_keys)
    for c in ORDER_COLUMNS:
        undecided = undecided | F.col(c).isNull()
    return base.withColumn(TIE, F.when(undecided, tie))


def run_order() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in (*ORDER_COLUMNS, TIE)]


def run_window(group: str | None, extra_partition: Sequence[str] = ()) -> WindowSpec:
    """Runs of one horse (and group), oldest first."""
    parts = [*extra_partition, "horse_id"] + ([group] if group else [])
    return Window.partitionBy(*parts).orderBy(*run_order())


def key_mask(group: str | None) -> Column:
    """True where every join key of the block is non-NULL (else the join misses)."""
    cond = F.lit(True)
    for k in join_keys(group):
        cond = cond & F.col(k).isNotNull()
    return cond


def trailing_columns(group: str | None, lengths: Sequence[int] = LENGTHS, metrics: Sequence[str] = METRICS,
                     frame: str = "trailing", extra_partition: Sequence[str] = ()) -> list[Column]:
    """The ``len(lengths) * len(metrics)`` feature columns of one group block."""
    if frame not in FRAMES:
        raise ValueError(f"frame must be one of {FRAMES}, got {frame!r}")
    w = run_window(group, extra_partition)
    mask = key_mask(group)
    columns = []
    for k in lengths:
        for m in metrics:
            if frame == "as_written" and k != 1:  # a frame that starts after its end is empty
                value = F.lit(None).cast("double")
            elif k == 1:
                value = F.when(mask, F.lag(F.col(m).cast("double"), 1).over(w))
            else:
                value = F.when(mask, F.avg(m).over(w.rowsBetween(-k, -1)))
            columns.append(value.alias(feature_name(group, k, m)))
    return columns


def using_join_order(base_columns: Sequence[str], groups: Sequence[str | None]) -> list[str]:
    """Column order of ``select *`` after the chained LEFT JOIN ... USING.

    Each USING join puts its keys first, then the remaining left columns,
    then the right side's new columns.
    """
    order = list(base_columns)
    for g in groups:
        keys = join_keys(g)
        order = keys + [c for c in order if c not in keys]
    return order


def task_count(spark: SparkSession, n_runs: int) -> int:
    """Over how many tasks the windows of ``n_runs`` runs go: ``TASK_RUNS`` a task at most, and some for every core.

    The features widen a run to more than ten times what is shuffled of it, so sizes of shuffled bytes, which
    Spark would go by, do not bound what a task holds.
    """
    return max(1, -(-n_runs // TASK_RUNS), min(spark.sparkContext.defaultParallelism, -(-n_runs // 4096)))


def race_features(base: DataFrame, groups: Sequence[str | None] = GROUPS,
                  lengths: Sequence[int] = LENGTHS, metrics: Sequence[str] = METRICS,
                  frame: str = "trailing", check_keys: bool = True,
                  extra_partition: Sequence[str] = (), n_tasks: int | None = None) -> DataFrame:
    """Base columns plus every feature block, in the script's output order.

    One shuffle, by ``SLOT`` (to ``n_tasks``, or as the session says), which is left out if
    ``base`` has that column and so is dealt by it already, and then one sort +
    Window per group spec inside each partition.
    ``extra_partition`` adds partition columns to every window and the shuffle
    (used by the skew path, where a hot horse is split into chunks).
    """
    columns = [c for c in base.columns if c not in (TIE, SLOT)]
    dealt = SLOT in base.columns and not extra_partition
    df = base if SLOT in base.columns else base.withColumn(SLOT, horse_slot(base))
    df = df if TIE in df.columns else with_tie(df, check_keys)
    if not dealt:
        df = df.repartition(*[n_tasks] * (n_tasks is not None), SLOT, *extra_partition)
    parts = [SLOT, *extra_partition]

    def block(g):
        return trailing_columns(g, lengths, metrics, frame, parts)

    groups = list(groups)
    checked = groups[:1] if check_keys else []
    if check_keys:
        repeated = adjacent_duplicate(list(RUN_KEY), run_window(None, parts)).alias("_repeated")
        message = f"duplicate run key {RUN_KEY}: the re-attach join would multiply rows"
        df = df.select("*", repeated, *[c for g in checked for c in block(g)])
        df = df.where(F.assert_true(~F.col("_repeated"), message).isNull())
    return df.select(*using_join_order(columns, groups), *feature_names(checked, lengths, metrics),
                     *[c for g in groups[len(checked):] for c in block(g)])
