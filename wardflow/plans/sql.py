"""U8 / A4: the SQL surface.

``register(spark, windowed)`` publishes temp views and a SQL table function
so SQL users can call the feature rows the way the reference's sample call
does::

    SELECT * FROM get_features(261176, 1)
    SELECT f.* FROM stays s, LATERAL get_features(s.icustay_id, 6) f

The function body is a filter over a view of all stays' feature rows for
the five window sizes; with literal arguments Catalyst folds the window
choice (other branches become empty) and pushes the stay filter down, and a
LATERAL call over many stays is decorrelated into one hash join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardflow.plans import features as fx
from wardflow.schemas import WINDOW_HOURS
from wardflow.sources import dictionary as dic

RETURN_COLUMNS = (["icustay_id BIGINT", "tw_hour_idx DOUBLE", "total_sofa_score INT"]
                  + [f"{c} DOUBLE" for c in dic.FEATURE_COLUMNS]
                  + [f"m_{c} INT" for c in dic.FEATURE_COLUMNS])


def register(spark: SparkSession, windowed: DataFrame, hours=WINDOW_HOURS,
             function: str = "get_features") -> None:
    windowed.createOrReplaceTempView("windowed_events")
    per_size = []
    for h in hours:
        f = fx.features(windowed, h).withColumn("time_window", F.lit(h))
        f.createOrReplaceTempView(f"feature_rows_w{h}")
        per_size.append(f)
    reduce(DataFrame.unionByName, per_size).createOrReplaceTempView("feature_rows")
    cols = ", ".join(c.split()[0] for c in RETURN_COLUMNS)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {function}(stay BIGINT, time_window INT)
        RETURNS TABLE ({", ".join(RETURN_COLUMNS)})
        RETURN SELECT {cols} FROM feature_rows
               WHERE feature_rows.icustay_id = stay
                 AND feature_rows.time_window = {function}.time_window""")
