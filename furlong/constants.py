"""Fixed values that must equal the surveyed feature script for equal results.

They are stated plainly and together here; every operator takes them as
parameters with these values as defaults.
"""

# --- fixed values -----------------------------------------------------------

# The ten central tracks kept by the track filter, in the script's order.
CENTRAL_PLACES = ("札幌", "函館", "福島", "新潟", "中山", "東京", "中京", "京都", "阪神", "小倉")

# Course-length bands: (exclusive upper bound in metres, label); anything
# else, a NULL length included, gets LONG_BAND.
LENGTH_BANDS = ((1400, "短距離"), (1800, "マイル"), (2200, "中距離"), (2800, "中長距離"))
LONG_BAND = "長距離"

# Date marks inside held_date texts such as 2020年4月4日.
YEAR_MARK, MONTH_MARK, DAY_MARK = "年", "月", "日"

# Id of a URL: its last path segment, only when the URL ends in a slash (one
# final newline allowed, like Python's ``$``); the word characters of the
# crawler's rule spelt as Unicode letters, numbers and underscore.
URL_ID_PATTERN = r"/([\p{L}\p{N}_]+)/(?:\n)?\z"

# The five metrics averaged in every feature block, in block order.
METRICS = ("goal_times", "half_times", "avg_velocity", "avg_half_velocity", "arrival_orders")

# Trailing-window lengths (previous k runs).
LENGTHS = (1, 3, 5)

# Names of the feature columns, without and with a condition group.
FEATURE_NAME = "previous_{k}_{metric}_avgs"
GROUP_FEATURE_NAME = "same_{group}_previous_{k}_{metric}_avgs"

# "Same condition" groups, in the order the script joins them.  None is the
# block without a group (partition by horse alone).
GROUPS = (None, "held_place", "weather", "jockey_names", "course_type", "course_condition",
          "course_direction", "race_number", "course_length_category", "held_month",
          "held_day_of_week")

# Missing-value tokens that pandas 2.x read_csv turns into NaN by default
# (the empty field is handled separately).
PANDAS_NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                    "n/a", "nan", "null")

# --- column lists of the two inputs and of the base feature table -----------

RACE_INPUT_COLUMNS = (
    "race_id", "horse_ids", "arrival_orders", "box_numbers", "horse_numbers", "horse_sexes",
    "horse_ages", "jockey_weights", "jockey_names", "goal_times", "order_transitions",
    "half_times", "odds", "popularities", "horse_weights", "horse_weight_diffs",
    "trainer_names", "horse_owners", "race_number", "course_type", "course_direction",
    "course_length", "weather", "course_condition", "race_start_time", "held_date",
    "held_place", "held_number", "held_date_number",
)

HORSE_INPUT_COLUMNS = (
    "horse_id", "horse_name", "producer", "origin_place", "mother", "father",
    "mother_of_father", "father_of_father", "mother_of_mother", "father_of_mother",
)

# Key of one run; the feature re-attach joins on it (plus the group column).
RUN_KEY = ("race_id", "horse_id", "held_date")


def race_input_schema():
    """Typed schema of the stacked race CSV: three numeric columns, the rest text."""
    from pyspark.sql import types as T
    longs = {"horse_ids", "race_number", "course_length"}
    names = ["race_url", *RACE_INPUT_COLUMNS]
    return T.StructType([T.StructField(n, T.LongType() if n in longs else T.StringType(), True)
                         for n in names])


def horse_input_schema():
    """Schema of the stacked horse CSV: all text."""
    from pyspark.sql import types as T
    return T.StructType([T.StructField(n, T.StringType(), True) for n in ["horse_url", *HORSE_INPUT_COLUMNS]])
