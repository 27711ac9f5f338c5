"""Race and horse inputs derived from the TPC-H-style test tables.

One SQL text serves both Spark (``spark.sql`` with DataFrame arguments, no
global views) and DuckDB (plain table names), so the oracle and our pipeline
see exactly the same input rows.  The rules only map order and customer
columns to race and horse columns; every row of ``orders`` becomes one run.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

RACES_SQL = """
select concat('https://races.example.com/race/', lpad(cast(o_orderkey as string), 12, '0'), '/') as race_url,
       lpad(cast(o_orderkey as string), 12, '0') as race_id,
       o_custkey as horse_ids,
       case when o_orderkey % 23 = 0 then null when o_orderkey % 17 = 0 then '中止'
            when o_orderkey % 19 = 0 then '3(降)' else cast(1 + o_orderkey % 18 as string) end as arrival_orders,
       cast(1 + o_orderkey % 8 as string) as box_numbers,
       cast(1 + o_orderkey % 18 as string) as horse_numbers,
       case o_orderkey % 3 when 0 then '牡' when 1 then '牝' else 'セ' end as horse_sexes,
       cast(2 + o_orderkey % 7 as string) as horse_ages,
       concat(cast(50 + o_orderkey % 9 as string), '.', cast(o_orderkey % 2 * 5 as string)) as jockey_weights,
       concat('J', cast(o_orderkey % 7 as string)) as jockey_names,
       case when o_orderkey % 29 = 0 then null
            else concat(cast(1 + o_orderkey % 2 as string), ':', lpad(cast(o_orderkey * 7 % 60 as string), 2, '0'), '.', cast(o_orderkey % 10 as string)) end as goal_times,
       '1-1-1-1' as order_transitions,
       concat(cast(33 + o_orderkey % 6 as string), '.', cast(o_orderkey % 10 as string)) as half_times,
       cast(1 + o_orderkey % 50 as string) as odds,
       cast(1 + o_orderkey % 18 as string) as popularities,
       cast(420 + o_orderkey % 120 as string) as horse_weights,
       cast(o_orderkey % 21 - 10 as string) as horse_weight_diffs,
       concat('T', cast(o_orderkey % 53 as string)) as trainer_names,
       concat('O', cast(o_custkey % 71 as string)) as horse_owners,
       1 + o_orderkey % 12 as race_number,
       case when o_orderkey % 41 = 0 then null when o_orderkey % 5 < 3 then '芝' else 'ダート' end as course_type,
       case o_orderkey % 3 when 0 then '右' when 1 then '左' else null end as course_direction,
       case when o_orderkey % 31 = 0 then null else 1000 + o_orderkey % 22 * 100 end as course_length,
       case when o_orderkey % 13 = 0 then null when o_orderkey % 4 = 0 then '晴' when o_orderkey % 4 = 1 then '曇' else '雨' end as weather,
       case o_orderkey % 4 when 0 then '良' when 1 then '稍重' when 2 then '重' else '不良' end as course_condition,
       '15:40' as race_start_time,
       concat(cast(year(o_orderdate) as string), '年', cast(month(o_orderdate) as string), '月', cast(day(o_orderdate) as string), '日') as held_date,
       case o_orderkey % 14 when 0 then '札幌' when 1 then '函館' when 2 then '福島' when 3 then '新潟' when 4 then '中山' when 5 then '東京'
            when 6 then '中京' when 7 then '京都' when 8 then '阪神' when 9 then '小倉' when 10 then '大井' when 11 then null else '中山' end as held_place,
       '1' as held_number,
       '1' as held_date_number
from {orders}
"""

# Every tenth horse has an id that no run uses.
HORSE_ID_SQL = "case when c_custkey % 10 = 0 then concat('unraced', cast(c_custkey as string)) else cast(c_custkey as string) end"

HORSES_SQL = """
select concat('https://races.example.com/horse/', {id}, '/') as horse_url,
       {id} as horse_id,
       c_name as horse_name,
       concat('producer', cast(c_nationkey as string)) as producer,
       c_mktsegment as origin_place,
       concat('m', cast(c_custkey % 97 as string)) as mother,
       concat('f', cast(c_custkey % 89 as string)) as father,
       concat('mf', cast(c_custkey % 83 as string)) as mother_of_father,
       concat('ff', cast(c_custkey % 79 as string)) as father_of_father,
       concat('mm', cast(c_custkey % 73 as string)) as mother_of_mother,
       concat('fm', cast(c_custkey % 61 as string)) as father_of_mother
from {customer}
"""


def duckdb_races_sql() -> str:
    return RACES_SQL.format(orders="orders")


def duckdb_horses_sql() -> str:
    return HORSES_SQL.format(id=HORSE_ID_SQL, customer="customer")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def races(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``races`` input (one row per horse per race) derived from ``orders``."""
    return spark.sql(RACES_SQL, orders=read_table(spark, sf_dir, "orders"))


def horses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``horses`` input (one row per horse) derived from ``customer``."""
    return spark.sql(HORSES_SQL.replace("{id}", HORSE_ID_SQL), customer=read_table(spark, sf_dir, "customer"))


# ---------------------------------------------------------------- crawled CSV folders
#
# The notebook's input is a tree of crawled CSV files whose headers differ.
# ``write_crawl`` lays the race input out that way, every row at least once:
# three header layouts (full, reversed, three columns short), three spellings
# of a missing value ('', 'NA', 'NULL'), nested folders, and one year crawled
# twice so that whole-row duplicates exist across files and layouts.

CRAWL_SHORT = ("race_start_time", "held_number", "held_date_number")


def crawl_columns() -> list[str]:
    """The crawled race columns: the input columns with race_url in place of race_id."""
    from ..constants import RACE_INPUT_COLUMNS
    return ["race_url"] + [c for c in RACE_INPUT_COLUMNS if c != "race_id"]


def crawl_layouts() -> list[tuple[str, list[str], str, str]]:
    """``(sub folder, columns, null spelling, SQL year predicate)`` per layout."""
    cols = crawl_columns()
    return [
        ("full", cols, "", "y <= 1996 or y = 1998"),
        ("reversed/1998", list(reversed(cols)), "NA", "y between 1997 and 1998"),
        ("short/late/x", [c for c in cols if c not in CRAWL_SHORT], "NULL", "y >= 1999"),
    ]


YEAR_SQL = r"cast(regexp_extract(held_date, '(\d+)年', 1) as int)"


def write_crawl(races_df: DataFrame, root: str) -> str:
    """Write ``races_df`` under ``root`` as a crawled CSV tree; returns ``root``."""
    from pyspark.sql import functions as F
    text = races_df.select(
        *[F.col(c).cast("string").alias(c) for c in crawl_columns()],
        F.regexp_extract("held_date", r"(\d+)年", 1).cast("int").alias("y"))
    for sub, cols, null, years in crawl_layouts():
        (text.where(F.expr(years)).select(*cols)
         .write.mode("overwrite").option("header", "true").option("escape", '"')
         .option("nullValue", null).option("emptyValue", "")
         .csv(os.path.join(root, sub)))
    return root


def write_horse_crawl(horses_df: DataFrame, root: str) -> str:
    """Write ``horses_df`` under ``root`` as crawled CSV files: two layouts, every third horse in both; returns ``root``.

    The crawl has the horse's URL and no id.
    """
    from pyspark.sql import functions as F
    cols = [c for c in horses_df.columns if c != "horse_id"]
    part = F.pmod(F.xxhash64("horse_url"), F.lit(3))
    for sub, layout, keep in (("a", cols, part < 2), ("b/c", list(reversed(cols)), part > 0)):
        horses_df.where(keep).select(*layout).write.mode("overwrite").option("header", "true").option(
            "escape", '"').csv(os.path.join(root, sub))
    return root


def crawl_union_sql(distinct: bool) -> str:
    """DuckDB text of the stacked crawl (union by name, optional whole-row dedup)."""
    cols = crawl_columns()
    parts = []
    for _, layout_cols, _, years in crawl_layouts():
        sel = ", ".join(f"cast({c} as varchar) as {c}" if c in layout_cols else f"cast(null as varchar) as {c}"
                        for c in cols)
        parts.append(f"select {sel} from crawl_src where {years}")
    body = "\nunion all\n".join(parts)
    if distinct:
        body = f"select distinct * from ({body})"
    return (f"crawl_src as (select *, {YEAR_SQL} as y from races),\n"
            f"stacked as ({body})")
