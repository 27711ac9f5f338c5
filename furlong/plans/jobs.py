"""User-level jobs: the steps of the surveyed workflow as single calls.

* ``stack_crawl``  -- crawled CSV folders -> one deduplicated text table with ids
* ``load_table``  -- stacked CSV -> typed Parquet or managed table
* ``feature_table`` -- race (and horse) tables -> base columns + 165 features
* ``crawl_to_features`` -- all of it

They only compose the operators; the plan choices live here:

* ``skew="auto"`` (default) first counts runs per horse (one narrow scan,
  partial aggregation).  With no hot horse the plain plan runs: the filtered
  runs are hash-partitioned on the horse's slot *before* parsing, so the one
  exchange the windows need also spreads the regex/cast work over all
  post-shuffle tasks.  With hot horses the skew path partitions by
  (horse, chunk) instead;
* ``skew="off"`` skips the count per horse (the plain plan, for data known to be flat);
* either way the runs are counted, and the windows' tasks follow their number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..constants import CENTRAL_PLACES, GROUPS, LENGTHS, METRICS, horse_input_schema, race_input_schema
from ..operators.base import base_features
from ..operators.skew import race_features_skew_safe
from ..operators.trailing import SLOT, race_features, task_count
from ..sources.csv_stack import read_typed, stack_csv, write_csv, write_table


def stack_crawl(spark: SparkSession, paths, url_col: str, id_col: str,
                out: str | None = None, glob: str = "*.csv", header: Sequence[str] | None = None) -> DataFrame:
    """Stack, dedup and derive ids; optionally write the result as CSV parts to ``out``.

    ``header`` names the columns of all files where they are known to be the same; it saves a pass over them.
    """
    df = stack_csv(spark, paths, url_col=url_col, id_col=id_col, glob=glob, header=header)
    if out is not None:
        write_csv(df, out)
    return df


def feature_table(races: DataFrame, horses: DataFrame | None = None,
                  groups: Sequence[str | None] = GROUPS, lengths: Sequence[int] = LENGTHS,
                  metrics: Sequence[str] = METRICS, frame: str = "trailing",
                  places: Sequence[str] = CENTRAL_PLACES, lenient: bool = False,
                  skew: str = "auto", check_keys: bool = True,
                  max_rows_per_horse: int = 2_000_000, chunk_rows: int | None = None,
                  broadcast_limit_bytes: int = 64 << 20) -> DataFrame:
    """The ``race_features`` table: 26 base columns + trailing averages.

    ``max_rows_per_horse`` is the most runs one window task should take for a
    single horse; horses above it are split into chunks of about
    ``chunk_rows`` runs (default: the same number).
    """
    if skew not in ("auto", "off"):
        raise ValueError(f"skew must be 'auto' or 'off', got {skew!r}")
    base = base_features(races, horses, places, lenient)

    def by_horse(n_tasks):
        return base_features(races, None, places, lenient, partition_by="horse_id", slot=SLOT, n_tasks=n_tasks)

    if skew == "off":
        return race_features(by_horse(task_count(races.sparkSession, base.count())), groups, lengths, metrics, frame, check_keys)
    return race_features_skew_safe(base, groups, lengths, metrics, frame, check_keys, max_rows_per_horse, chunk_rows,
                                   broadcast_limit_bytes, by_horse)


def load_table(spark: SparkSession, stacked: str, schema: StructType, path: str | None = None,
               table: str | None = None) -> DataFrame:
    """Load a stacked CSV folder into a typed Parquet folder or managed table and return it."""
    write_table(read_typed(spark, stacked, schema), path=path, table=table)
    return spark.read.parquet(path) if table is None else spark.table(table)


def crawl_to_features(spark: SparkSession, race_paths, horse_paths, folder: str, **settings) -> DataFrame:
    """The whole workflow: crawled races and horses -> stacked CSV -> typed tables -> the feature table.

    Intermediate data goes below ``folder``, which all machines share.
    """
    stack_crawl(spark, race_paths, "race_url", "race_id", out=f"{folder}/stacked-races")
    stack_crawl(spark, horse_paths, "horse_url", "horse_id", out=f"{folder}/stacked-horses")
    races = load_table(spark, f"{folder}/stacked-races", race_input_schema(), path=f"{folder}/races")
    horses = load_table(spark, f"{folder}/stacked-horses", horse_input_schema(), path=f"{folder}/horses")
    return feature_table(races, horses, **settings)


def write_feature_table(df: DataFrame, path: str | None = None, table: str | None = None) -> None:
    """``create or replace table race_features as ...``: overwrite Parquet or a managed table."""
    write_table(df, path=path, table=table, mode="overwrite")
