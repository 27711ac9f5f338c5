"""The script's own plan as a check: one window block per (group, k), LEFT JOINed back."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furlong.constants import GROUPS, LENGTHS, METRICS
from furlong.operators import trailing as T


def race_features_join_form(base: DataFrame, groups=GROUPS, lengths=LENGTHS, metrics=METRICS) -> DataFrame:
    out = base
    for g in groups:
        for k in lengths:
            keys = T.join_keys(g)
            w = T.run_window(g).rowsBetween(-k, -1)
            avgs = [F.avg(m).over(w).alias(T.feature_name(g, k, m)) for m in metrics]
            out = out.join(T.with_tie(base).select(*keys, *avgs), on=keys, how="left")
    return out
