"""Registered queries (Spark) and their DuckDB oracle texts.

Each query takes ``(spark, sf_dir)`` and reads the driver's tables -- the race
and horse inputs are derived from ``orders`` and ``customer`` by
``sources.fixtures`` -- so its work grows with the scale factor.  Every oracle
text is written in the warehouse script's own shape (window CTEs joined back
with LEFT JOIN USING) so that it checks our plan independently.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .constants import GROUPS, HORSE_INPUT_COLUMNS, RACE_INPUT_COLUMNS, horse_input_schema, race_input_schema
from .functions import exprs as X
from .operators import base as B
from .operators import checks as C
from .operators import skew as K
from .plans import jobs as J
from .plans import oracle_sql as O
from .session import scratch_dir
from .sources import csv_stack as S
from .sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]


def _races(spark, sf):
    return fixtures.races(spark, sf)


def _base(spark, sf):
    return B.base_features(_races(spark, sf))


def _group_key(g):
    return "all" if g is None else g


# ---------------------------------------------------------------- projections

def q_race_projection(spark, sf):
    return B.race_projection(_races(spark, sf))


def q_horse_projection(spark, sf):
    return B.horse_projection(fixtures.horses(spark, sf))


def q_central_filter(spark, sf):
    return B.central_filter(B.race_projection(_races(spark, sf)))


def q_base_features(spark, sf):
    return _base(spark, sf)


def q_horse_left_join(spark, sf):
    runs = B.central_filter(B.race_projection(_races(spark, sf)))
    joined = B.attach_horses(runs, fixtures.horses(spark, sf), ["horse_name", "producer", "mother"])
    return joined.select("race_id", "horse_id", "held_date", "horse_name", "producer", "mother")


def q_categorical_features(spark, sf):
    return B.categorical_features(_races(spark, sf), fixtures.horses(spark, sf))


def q_dedup_rows(spark, sf):
    r = _races(spark, sf)
    return r.unionAll(r).dropDuplicates()


def q_key_uniqueness(spark, sf):
    # (horse, date) is not a key of the runs: ties on a date exist.
    return C.duplicate_keys(_base(spark, sf), ["horse_id", "held_date"])


# ---------------------------------------------------------------- scalar functions

def q_extract_ids(spark, sf):
    pages = fixtures.read_table(spark, sf, "pages")
    return pages.select("page_id", X.extract_url_id("url").alias("url_id"))


def q_length_band(spark, sf):
    r = _races(spark, sf)
    return r.select("race_id", "course_length", X.length_band("course_length").alias("course_length_category"))


def q_parse_clock(spark, sf):
    r = _races(spark, sf)
    return r.select("race_id", "goal_times", X.parse_clock("goal_times").alias("goal_seconds"))


def q_held_month(spark, sf):
    r = _races(spark, sf)
    return r.select("race_id", X.held_month("held_date").alias("held_month"))


def q_held_day_of_week(spark, sf):
    r = _races(spark, sf)
    return r.select("race_id", X.held_day_of_week("held_date").alias("held_day_of_week"))


def q_parse_held_date(spark, sf):
    r = _races(spark, sf)
    return r.select("race_id", X.parse_held_date("held_date").alias("held_date"))


def q_typed_casts(spark, sf):
    r = _races(spark, sf)
    return r.select(
        "race_id",
        X.to_long("horse_ages").alias("horse_ages"),
        X.to_double("jockey_weights").alias("jockey_weights"),
        X.double_to_long(X.to_double("jockey_weights")).alias("jockey_weights_long"),
        X.to_double("horse_weights").alias("horse_weights"),
        X.to_double("horse_weight_diffs").alias("horse_weight_diffs"),
        X.to_double("course_length").alias("course_length"),
        F.col("horse_ids").cast("string").alias("horse_id"),
    )


def q_safe_arrival_order(spark, sf):
    r = _races(spark, sf)
    return r.select("race_id", "arrival_orders", X.safe_to_long("arrival_orders").alias("arrival_order"))


def q_ratios(spark, sf):
    r = _races(spark, sf)
    return r.select(
        "race_id",
        X.weight_ratio("jockey_weights", "horse_weights").alias("weight_ratio"),
        X.avg_velocity("course_length", "goal_times").alias("avg_velocity"),
        X.avg_half_velocity("course_length", "half_times").alias("avg_half_velocity"),
    )


# ---------------------------------------------------------------- windows

def _trailing_query(group):
    def q(spark, sf):
        return K.trailing_average(_base(spark, sf), group)
    q.__name__ = f"q_trailing_{_group_key(group)}"
    return q


def q_race_features(spark, sf):
    return J.feature_table(_races(spark, sf))


def q_race_features_skew_safe(spark, sf):
    # A low threshold so that many horses count as hot and are split into
    # chunks at small scale factors: the whole context machinery runs.
    return J.feature_table(_races(spark, sf), max_rows_per_horse=8, chunk_rows=3)


def q_frame_as_written(spark, sf):
    return J.feature_table(_races(spark, sf), frame="as_written")


def q_sorted_view(spark, sf):
    blk = K.trailing_average(_base(spark, sf), "held_place")
    return blk.orderBy(F.desc_nulls_last("horse_id"), F.desc_nulls_last("held_place"),
                       F.desc_nulls_last("held_date"))


def q_preview(spark, sf):
    # head(): the first five horses, in a repeatable order.
    return S.preview(B.horse_projection(fixtures.horses(spark, sf)), 5, order_by="horse_id")


# ---------------------------------------------------------------- CSV sources and sinks
#
# These write a crawled CSV tree derived from ``orders`` into a fresh folder
# under the session's checkpoint folder, then read it back.

def _crawl(spark, sf):
    return fixtures.write_crawl(_races(spark, sf), scratch_dir(spark, "crawl"))


def q_csv_stack(spark, sf):
    return J.stack_crawl(spark, _crawl(spark, sf), url_col="race_url", id_col="race_id")


def q_csv_na_tokens(spark, sf):
    # Stacked by name with '', 'NA' and 'NULL' read as missing; no dedup.
    return S.read_csv_stack(spark, _crawl(spark, sf))


def _stacked_copy(spark, sf):
    out = scratch_dir(spark, "stacked")
    S.write_csv(S.stack_csv(spark, _crawl(spark, sf), url_col="race_url", id_col="race_id"), out)
    return out


def q_csv_roundtrip(spark, sf):
    return S.read_csv_stack(spark, _stacked_copy(spark, sf))


def q_load_typed(spark, sf):
    return S.read_typed(spark, _stacked_copy(spark, sf), race_input_schema())


def _horse_crawl(spark, sf):
    return fixtures.write_horse_crawl(fixtures.horses(spark, sf), scratch_dir(spark, "horse-crawl"))


def q_csv_stack_horses(spark, sf):
    return J.stack_crawl(spark, _horse_crawl(spark, sf), url_col="horse_url", id_col="horse_id")


def q_load_horses(spark, sf):
    out = scratch_dir(spark, "horses")
    J.stack_crawl(spark, _horse_crawl(spark, sf), "horse_url", "horse_id", out=f"{out}/stacked")
    return J.load_table(spark, f"{out}/stacked", horse_input_schema(), path=f"{out}/table")


def q_crawl_to_features(spark, sf):
    return J.crawl_to_features(spark, _crawl(spark, sf), _horse_crawl(spark, sf), scratch_dir(spark, "workflow"))


def q_write_features(spark, sf):
    out = scratch_dir(spark, "race_features")
    J.write_feature_table(J.feature_table(_races(spark, sf)), path=out)
    return spark.read.parquet(out)


# ---------------------------------------------------------------- registry

def queries() -> dict[str, Query]:
    reg: dict[str, Query] = {
        "race_projection": q_race_projection,
        "horse_projection": q_horse_projection,
        "central_filter": q_central_filter,
        "base_features": q_base_features,
        "horse_left_join": q_horse_left_join,
        "categorical_features": q_categorical_features,
        "dedup_rows": q_dedup_rows,
        "key_uniqueness": q_key_uniqueness,
        "extract_ids": q_extract_ids,
        "length_band": q_length_band,
        "parse_clock": q_parse_clock,
        "held_month": q_held_month,
        "held_day_of_week": q_held_day_of_week,
        "parse_held_date": q_parse_held_date,
        "typed_casts": q_typed_casts,
        "safe_arrival_order": q_safe_arrival_order,
        "ratios": q_ratios,
    }
    for g in GROUPS:
        reg[f"trailing_{_group_key(g)}"] = _trailing_query(g)
    reg.update({
        "race_features": q_race_features,
        "race_features_skew_safe": q_race_features_skew_safe,
        "frame_as_written": q_frame_as_written,
        "sorted_view": q_sorted_view,
        "preview": q_preview,
        "csv_stack": q_csv_stack,
        "csv_na_tokens": q_csv_na_tokens,
        "csv_roundtrip": q_csv_roundtrip,
        "load_typed": q_load_typed,
        "write_features": q_write_features,
        "csv_stack_horses": q_csv_stack_horses,
        "load_horses": q_load_horses,
        "crawl_to_features": q_crawl_to_features,
    })
    return reg


def _races_select(select: str, where: str = "") -> str:
    return O.with_clause(O.input_ctes()) + f"\nselect {select} from races {where}"


def oracle_sql() -> dict[str, str]:
    race_cols = ", ".join("cast(horse_ids as varchar) as horse_id" if c == "horse_ids" else c
                          for c in RACE_INPUT_COLUMNS)
    centre = f"where held_place in ({O.places_sql()})"
    sql = {
        "race_projection": _races_select(race_cols),
        "horse_projection": O.with_clause(O.input_ctes()) + "\nselect horse_id, horse_name, producer, "
        "origin_place, mother, father, mother_of_father, father_of_father, mother_of_mother, "
        "father_of_mother from horses",
        "central_filter": _races_select(race_cols, centre),
        "base_features": O.base_features_sql(),
        "horse_left_join": O.with_clause(O.input_ctes() + [f"race_info as ({O.race_projection_select()})"])
        + f"\nselect race_id, horse_id, held_date, horse_name, producer, mother from race_info "
        f"left join horses using (horse_id) {centre}",
        "categorical_features": O.with_clause(O.input_ctes() + [f"race_info as ({O.race_projection_select()})"])
        + f"""
select race_id, horse_id, held_place, held_date, box_numbers, horse_numbers, horse_sexes,
       jockey_names, trainer_names, horse_owners, race_number, course_type, course_direction,
       weather, course_condition, race_start_time,
       {O.held_month_sql('held_date')} as held_month,
       {O.held_day_of_week_sql('held_date')} as held_day_of_week,
       {O.length_band_sql('course_length')} as course_length_category,
       producer, origin_place, mother, father, mother_of_mother, father_of_mother,
       mother_of_father, father_of_father
from race_info left join horses using (horse_id) {centre}""",
        "dedup_rows": O.with_clause(O.input_ctes())
        + "\nselect distinct * from (select * from races union all select * from races)",
        "key_uniqueness": O.base_features_sql().replace(
            "select * from base_features",
            "select horse_id, held_date, count(*) as n_rows from base_features "
            "where horse_id is not null and held_date is not null "
            "group by horse_id, held_date having count(*) > 1"),
        "extract_ids": f"select page_id, {O.URL_ID_SQL.format(c='url')} as url_id from pages",
        "length_band": _races_select(
            f"race_id, course_length, {O.length_band_sql('course_length')} as course_length_category"),
        "parse_clock": _races_select(f"race_id, goal_times, {O.parse_clock_sql('goal_times')} as goal_seconds"),
        "held_month": _races_select(f"race_id, {O.held_month_sql('held_date')} as held_month"),
        "held_day_of_week": _races_select(f"race_id, {O.held_day_of_week_sql('held_date')} as held_day_of_week"),
        "parse_held_date": _races_select(f"race_id, {O.parse_held_date_sql('held_date')} as held_date"),
        "typed_casts": _races_select(
            "race_id, cast(horse_ages as bigint) as horse_ages, cast(jockey_weights as double) as jockey_weights, "
            "cast(round(cast(jockey_weights as double)) as bigint) as jockey_weights_long, "
            "cast(horse_weights as double) as horse_weights, cast(horse_weight_diffs as double) as horse_weight_diffs, "
            "cast(course_length as double) as course_length, cast(horse_ids as varchar) as horse_id"),
        "safe_arrival_order": _races_select(
            f"race_id, arrival_orders, {O.safe_long_sql('arrival_orders')} as arrival_order"),
        "ratios": _races_select(
            "race_id, cast(jockey_weights as double) / cast(horse_weights as double) as weight_ratio, "
            f"cast(course_length as double) / {O.parse_clock_sql('goal_times')} as avg_velocity, "
            "(cast(course_length as double) / 2) / cast(half_times as double) as avg_half_velocity"),
    }
    for g in GROUPS:
        sql[f"trailing_{_group_key(g)}"] = O.block_sql(g)
    sql["race_features"] = O.features_sql()
    sql["race_features_skew_safe"] = O.features_sql()
    sql["frame_as_written"] = O.features_sql(frame="as_written")
    sql["sorted_view"] = O.block_sql("held_place")
    sql["preview"] = (O.with_clause(O.input_ctes()) + "\nselect horse_id, horse_name, producer, origin_place, "
                      "mother, father, mother_of_father, father_of_father, mother_of_mother, father_of_mother "
                      "from horses order by horse_id limit 5")
    crawl_cols = ", ".join(fixtures.crawl_columns())
    stacked_with_id = (O.with_clause(O.input_ctes() + [fixtures.crawl_union_sql(distinct=True)])
                       + f"\nselect {crawl_cols}, {O.URL_ID_SQL.format(c='race_url')} as race_id from stacked")
    sql["csv_stack"] = stacked_with_id
    sql["csv_na_tokens"] = (O.with_clause(O.input_ctes() + [fixtures.crawl_union_sql(distinct=False)])
                            + f"\nselect {crawl_cols} from stacked")
    sql["csv_roundtrip"] = stacked_with_id
    typed = ", ".join(f"cast({f.name} as bigint) as {f.name}" if f.dataType.typeName() == "long" else f.name
                      for f in race_input_schema().fields)
    sql["load_typed"] = (O.with_clause(O.input_ctes() + [fixtures.crawl_union_sql(distinct=True)])
                         + f"\nselect {typed} from (select {crawl_cols}, "
                         f"{O.URL_ID_SQL.format(c='race_url')} as race_id from stacked)")
    sql["write_features"] = O.features_sql()
    horse_cols = ", ".join(["horse_url", *HORSE_INPUT_COLUMNS])
    horses = O.with_clause(O.input_ctes()) + f"\nselect {horse_cols} from horses"
    sql["csv_stack_horses"] = sql["load_horses"] = horses
    sql["crawl_to_features"] = O.features_sql()
    return sql
