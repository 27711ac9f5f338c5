"""Trailing features when one horse may hold a large share of all runs.

``race_features`` shuffles on ``horse_id``, so a horse with a third of all
runs would land in a single task.  Here the runs of such hot horses are dealt
in (horse, run order) ranges of about ``chunk_rows`` runs, Spark's own range
partitioning, whatever their dates: chunks are parts of that order, so a chunk
only needs, per (horse, group value), the last ``max(lengths)`` runs before
it, which are brought in as *context rows* that take part in the windows but
are not output.

1. ``count`` per horse with partial aggregation finds the hot horses (more
   than ``max_rows_per_horse`` runs).  If there is none, the plain plan runs.
   Their ids are broadcast only when their measured bytes are under a limit;
   beyond it, all runs with an id take the chunked path, which is right for
   any horse.
2. The hot runs are range-partitioned by (horse, date, race id, tie), sorted,
   numbered in that order and written to the shared folder, so a recomputed
   stage cannot move a boundary.  Every ``chunk_rows`` runs of a range are a
   chunk, named by its first row's number: a range holds many small chunks, or
   about one of many runs.
3. Tails: per chunk and group value, the last ``K`` runs, found where the chunk
   lies (a limited rank needs no shuffle of the runs).  In chunks of at most ``K``
   runs every run is one, so there they are dealt by horse instead, once for all
   groups.  The last ``K`` runs
   of a (horse, value) before a chunk are always among the tails of earlier
   chunks; walking the tails in run order, a tail row is sent to the chunks
   that begin within its next ``K`` tail rows (one window with a bounded
   frame, at most ``K`` copies per row; no join, no chunk pairs).  Context
   rows are made unique by their row number and hold only what frames read.
4. One pass of ``race_features`` over all runs, hot ones in their chunks with
   their context rows, the others in a chunk of their own: one exchange and
   one plan for both.  Context rows of another group never reach a frame of
   length <= K (at least K rows of that group sit between them and the chunk),
   so one shared context set per chunk is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import GROUPS, LENGTHS, METRICS
from ..session import scratch_dir
from .trailing import ORDER_COLUMNS, TIE, feature_names, race_features, run_order, task_count, with_tie

CHUNK, CONTEXT, ROW = "_chunk", "_context", "_row"


def horse_load(base: DataFrame) -> DataFrame:
    """Runs per horse, ``(horse_id, n_runs)``; partial aggregation on the map side."""
    return base.groupBy("horse_id").agg(F.count(F.lit(1)).alias("n_runs"))


def _group_value(g: str | None) -> Column:
    return F.lit("") if g is None else F.col(g).cast("string")


def hot_runs(base: DataFrame, max_rows_per_horse: int,
             broadcast_limit_bytes: int = 64 << 20) -> tuple[DataFrame | None, DataFrame, int]:
    """``(hot, other, number of hot runs)``; hot is None when no horse is."""
    load = horse_load(base).where(F.col("horse_id").isNotNull())
    hot = load.where(F.col("n_runs") > max_rows_per_horse)
    size = hot.agg(F.coalesce(F.sum("n_runs"), F.lit(0)).alias("runs"),
                   F.coalesce(F.sum(F.octet_length("horse_id") + 32), F.lit(0)).alias("bytes")).first()
    if not size["runs"]:
        return None, base, 0
    if size["bytes"] > broadcast_limit_bytes:
        keyed = F.col("horse_id").isNotNull()
        return base.where(keyed), base.where(~keyed), load.agg(F.sum("n_runs")).first()[0]
    ids = F.broadcast(hot.select("horse_id"))
    return base.join(ids, "horse_id", "left_semi"), base.join(ids, "horse_id", "left_anti"), size["runs"]


def assign_chunks(hot: DataFrame, n_runs: int, chunk_rows: int) -> DataFrame:
    """``hot`` with the columns TIE, CHUNK (ascending in run order within a horse) and ROW, from a written table.

    A table and not a checkpoint: a checkpoint keeps what Spark inferred of its columns, and a hash of all
    of them makes that inference grow with the power set of the columns wherever they are renamed.
    """
    spark = hot.sparkSession
    folder = scratch_dir(spark, "hot-runs")
    n = max(1, min(task_count(spark, n_runs), -(-n_runs // chunk_rows)))
    order = [F.col("horse_id"), *run_order()]
    dealt = with_tie(hot).repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = dealt.withColumn(ROW, F.monotonically_increasing_id())
    in_range = F.col(ROW).bitwiseAND(F.lit((1 << 33) - 1))  # of a row number, what counts rows
    dealt.withColumn(CHUNK, F.col(ROW) - in_range % F.lit(chunk_rows)).write.parquet(folder)
    return spark.read.parquet(folder)


def context_rows(tagged: DataFrame, groups: Sequence[str | None], k_max: int,
                 metrics: Sequence[str] = METRICS, chunk_rows: int | None = None) -> DataFrame:
    """For every chunk, the earlier runs its frames can reach (see module doc, step 3)."""
    needed = list(dict.fromkeys(["horse_id", *ORDER_COLUMNS, TIE, ROW, *[g for g in groups if g], *metrics]))
    needed = [c for c in needed if c in tagged.columns]
    marks = []
    for i, g in enumerate(groups):
        mark = F.struct(F.lit(i).alias("_g"), _group_value(g).alias("_v"))
        marks.append(mark if g is None else F.when(F.col(g).isNotNull(), mark))
    all_tails = chunk_rows is not None and chunk_rows <= k_max
    runs = tagged.select(*needed, CHUNK)
    if all_tails:
        runs = runs.repartition(task_count(tagged.sparkSession, len(groups) * tagged.count()), "horse_id")
    tails = (runs.select(*needed, CHUNK, F.explode(F.array_compact(F.array(*marks))).alias("_m"))
             .select(*needed, CHUNK, "_m.*"))
    if not all_tails:
        rank = F.row_number().over(Window.partitionBy("horse_id", CHUNK, "_g", "_v").orderBy(F.desc(ROW)))
        tails = tails.withColumn("_rank", rank).where(F.col("_rank") <= k_max).drop("_rank")
    w = Window.partitionBy("horse_id", "_g", "_v").orderBy(ROW)  # row numbers are in run order
    begins = F.coalesce(F.lag(CHUNK, 1).over(w) != F.col(CHUNK), F.lit(True))
    targets = F.collect_list(F.when(F.col("_begins"), F.col(CHUNK))).over(w.rowsBetween(1, k_max))
    # A tail row is needed by every chunk whose first tail row is among its next K.
    return (tails.withColumn("_begins", begins).select(*needed, CHUNK, targets.alias("_targets"))
            .select(*needed, F.col(CHUNK).alias("_from"), F.explode("_targets").alias(CHUNK))
            .where(F.col("_from") != F.col(CHUNK)).drop("_from").dropDuplicates(["horse_id", ROW, CHUNK]))


def race_features_skew_safe(base: DataFrame, groups: Sequence[str | None] = GROUPS,
                            lengths: Sequence[int] = LENGTHS, metrics: Sequence[str] = METRICS,
                            frame: str = "trailing", check_keys: bool = True,
                            max_rows_per_horse: int = 2_000_000, chunk_rows: int | None = None,
                            broadcast_limit_bytes: int = 64 << 20,
                            by_horse: Callable[[int], DataFrame] | None = None) -> DataFrame:
    """``race_features`` with hot horses split into parallel chunks (see module doc).

    ``by_horse`` may give the rows of ``base`` dealt by ``SLOT`` over a number of
    tasks; the plain plan then starts from it.
    """
    spark, n_all = base.sparkSession, base.count()
    hot, other, n_runs = hot_runs(base, max_rows_per_horse, broadcast_limit_bytes)
    if hot is None:
        n_tasks = task_count(spark, n_all)
        dealt = base if by_horse is None else by_horse(n_tasks)
        return race_features(dealt, groups, lengths, metrics, frame, check_keys, n_tasks=n_tasks)
    chunk_rows = chunk_rows or max_rows_per_horse
    tagged = assign_chunks(hot, n_runs, chunk_rows)
    context = context_rows(tagged, groups, max(lengths), metrics, chunk_rows).withColumn(CONTEXT, F.lit(True))
    n_tasks = task_count(spark, n_all + 2 * max(lengths) * -(-n_runs // chunk_rows))  # context rows: as many, roughly
    runs = (with_tie(other, check_keys).withColumns({CHUNK: F.lit(-1).cast("long"), CONTEXT: F.lit(False)})
            .unionByName(tagged.drop(ROW).withColumn(CONTEXT, F.lit(False)))
            .unionByName(context.drop(ROW), allowMissingColumns=True))
    out = race_features(runs, groups, lengths, metrics, frame, check_keys, extra_partition=[CHUNK], n_tasks=n_tasks)
    return out.where(~F.col(CONTEXT)).drop(CHUNK, CONTEXT)


def trailing_average(base: DataFrame, group: str | None = None, lengths: Sequence[int] = LENGTHS,
                     metrics: Sequence[str] = METRICS, frame: str = "trailing",
                     max_rows_per_horse: int = 2_000_000, chunk_rows: int | None = None) -> DataFrame:
    """One block: the run key (plus the group column) and its features, hot horses split as above."""
    out = race_features_skew_safe(base, [group], lengths, metrics, frame, False, max_rows_per_horse, chunk_rows)
    keys = ["race_id", "horse_id"] + ([group] if group else []) + ["held_date"]
    return out.select(*keys, *feature_names([group], lengths, metrics))
