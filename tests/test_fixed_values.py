"""A few fixed values typed here by hand: the queries and their oracle share
the tables in ``sources.dictionary``, so a mistyped value would pass both."""

from wardflow.functions import steps
from wardflow.sources import dictionary as dic


def _codes(table, category):
    return dict(table)[category]


def test_dictionary_rows():
    rows = {r[0]: r for r in dic.FEATURE_ROWS}
    assert len(rows) == 24
    assert rows[5] == (5, "Dopamine", 3.998375349, 4.588829993, "mcg/kg/min")
    assert rows[9] == (9, "GCS", 13.0, 12.0, "points")
    assert rows[12][1:4] == ("Urine", 80.0, 127.1269676)
    assert rows[19][1:] == ("RR", 19.0, 19.58452559, "breath per minute (bpm)")
    assert rows[24] == (24, "BUN", 24.0, 32.57138594, "mg/dl")


def test_chart_codes():
    assert _codes(dic.CHART_CODES, "ABP_mean") == [52, 456, 220181, 220052, 225312]
    assert _codes(dic.CHART_CODES, "RR") == [615, 618, 224688, 220210, 224690, 224689]
    assert _codes(dic.CHART_CODES, "WBC") == [861, 1127, 1542, 220546]
    assert _codes(dic.CHART_CODES, "BUN") == [781, 1162, 225624]
    allowed = dic.whitelist("chart")
    assert len(allowed) == 48 and 227464 in allowed and 198 not in allowed


def test_score_bounds(spark):
    got = spark.createDataFrame([(4.95, 15.0, 12.0, 49.0)], "creatinine double, gcs double, bilirubin double, platelets double") \
        .select(steps.creatinine_points(), steps.gcs_points(), steps.bilirubin_points(), steps.platelets_points()).first()
    assert tuple(got) == (4, 0, 4, 3)
