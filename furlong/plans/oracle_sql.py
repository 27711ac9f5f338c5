"""Reference-shaped SQL texts for the DuckDB oracle.

These texts follow the warehouse script's own plan -- window CTEs joined back
with LEFT JOIN ... USING -- so the oracle checks our direct-window plan (and
its NULL mask) independently.  DuckDB dialect notes, each an oracle trap:
NULLs sort last unless asked, ``dayofweek`` counts from 0, ``try_cast('3.0'
as bigint)`` is 3 (guarded by a pattern), ``regexp_replace`` needs the ``g``
flag, ``regexp_extract`` gives '' on no match.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..constants import (CENTRAL_PLACES, DAY_MARK, GROUPS, LENGTH_BANDS, LENGTHS, LONG_BAND,
                         METRICS, MONTH_MARK, RACE_INPUT_COLUMNS, YEAR_MARK)
from ..sources.fixtures import duckdb_horses_sql, duckdb_races_sql

URL_ID_SQL = r"nullif(regexp_extract({c}, '/([\pL\pN_]+)/\n?$', 1), '')"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def parse_clock_sql(c: str) -> str:
    return (f"(cast(left({c}, instr({c}, ':') - 1) as double) * 60 + "
            f"cast(right({c}, length({c}) - instr({c}, ':')) as double))")


def held_month_sql(c: str) -> str:
    return f"nullif(regexp_extract({c}, '\\d+{MONTH_MARK}', 0), '')"


def date_part_sql(c: str, mark: str) -> str:
    return f"cast(nullif(regexp_extract({c}, '(\\d+){mark}', 1), '') as bigint)"


def held_day_of_week_sql(c: str) -> str:
    parts = ", ".join(date_part_sql(c, m) for m in (YEAR_MARK, MONTH_MARK, DAY_MARK))
    return f"cast(dayofweek(make_date({parts})) + 1 as bigint)"


def parse_held_date_sql(c: str) -> str:
    return (f"cast(regexp_replace(replace({c}, '{DAY_MARK}', ''), "
            f"'{YEAR_MARK}|{MONTH_MARK}', '-', 'g') as date)")


def length_band_sql(c: str) -> str:
    whens = " ".join(f"when {c} < {upper} then {q(label)}" for upper, label in LENGTH_BANDS)
    return f"case {whens} else {q(LONG_BAND)} end"


def safe_long_sql(c: str) -> str:
    return f"case when regexp_full_match({c}, '\\s*[+-]?[0-9]+\\s*') then try_cast({c} as bigint) end"


def places_sql(places: Sequence[str] = CENTRAL_PLACES) -> str:
    return ", ".join(q(p) for p in places)


def input_ctes() -> list[str]:
    return [f"races as ({duckdb_races_sql()})", f"horses as ({duckdb_horses_sql()})"]


def race_projection_select(source: str = "races") -> str:
    cols = ["cast(horse_ids as varchar) as horse_id" if c == "horse_ids" else c
            for c in RACE_INPUT_COLUMNS]
    return f"select {', '.join(cols)} from {source}"


BASE_SELECT = f"""
select race_id, horse_id, held_place, weather, jockey_names, trainer_names, horse_owners,
       course_type, course_condition, course_direction, race_number,
       {held_month_sql('held_date')} as held_month,
       {held_day_of_week_sql('held_date')} as held_day_of_week,
       {length_band_sql('course_length')} as course_length_category,
       {parse_held_date_sql('held_date')} as held_date,
       cast(horse_ages as bigint) as horse_ages,
       cast(jockey_weights as double) as jockey_weights,
       {parse_clock_sql('goal_times')} as goal_times,
       cast(half_times as double) as half_times,
       cast(horse_weights as double) as horse_weights,
       cast(horse_weight_diffs as double) as horse_weight_diffs,
       cast(course_length as double) as course_length,
       cast(jockey_weights as double) / cast(horse_weights as double) as weight_ratio,
       cast(course_length as double) / {parse_clock_sql('goal_times')} as avg_velocity,
       (cast(course_length as double) / 2) / cast(half_times as double) as avg_half_velocity,
       {safe_long_sql('arrival_orders')} as arrival_orders
from center_race_info
"""


def base_ctes() -> list[str]:
    return input_ctes() + [
        f"race_info as ({race_projection_select()})",
        f"center_race_info as (select * from race_info where held_place in ({places_sql()}))",
        f"base_features as ({BASE_SELECT})",
    ]


def join_keys(group: str | None) -> list[str]:
    """The USING list of a block, as the script spells it."""
    if group is None:
        return ["race_id", "horse_id", "held_date"]
    return ["race_id", "horse_id", group, "held_date"]


def feature_name(group: str | None, k: int, metric: str) -> str:
    return f"previous_{k}_{metric}_avgs" if group is None else f"same_{group}_previous_{k}_{metric}_avgs"


def block_name(group: str | None, k: int) -> str:
    return f"blk_{group or 'all'}_{k}"


def block_cte(group: str | None, k: int, metrics: Sequence[str] = METRICS,
              frame: str = "trailing") -> str:
    parts = "horse_id" + (f", {group}" if group else "")
    keys = ", ".join(join_keys(group))
    avgs = []
    for m in metrics:
        # the script's own frames start after their end for k = 3 and 5
        rows = f"1 preceding and {k} preceding" if frame == "as_written" and k != 1 else f"{k} preceding and 1 preceding"
        expr = (f"avg({m}) over (partition by {parts} order by held_date asc nulls first, "
                f"race_id asc nulls first rows between {rows})")
        avgs.append(f"{expr} as {feature_name(group, k, m)}")
    return f"{block_name(group, k)} as (select {keys}, {', '.join(avgs)} from base_features)"


def with_clause(ctes: Sequence[str]) -> str:
    return "with " + ",\n".join(ctes)


def base_features_sql() -> str:
    return with_clause(base_ctes()) + "\nselect * from base_features"


def features_sql(groups: Sequence[str | None] = GROUPS, lengths: Sequence[int] = LENGTHS,
                 metrics: Sequence[str] = METRICS, frame: str = "trailing",
                 select: str = "*") -> str:
    """base_features LEFT JOIN every block USING its key, as the script does."""
    ctes = base_ctes() + [block_cte(g, k, metrics, frame) for g in groups for k in lengths]
    joins = "\n".join(f"left join {block_name(g, k)} using ({', '.join(join_keys(g))})"
                      for g in groups for k in lengths)
    return with_clause(ctes) + f"\nselect {select} from base_features\n{joins}"


def block_sql(group: str | None, lengths: Sequence[int] = LENGTHS,
              metrics: Sequence[str] = METRICS, frame: str = "trailing") -> str:
    """One group's features with the block's join keys, for every base row."""
    names = [feature_name(group, k, m) for k in lengths for m in metrics]
    select = ", ".join(join_keys(group) + names)
    return features_sql([group], lengths, metrics, frame, select=select)
