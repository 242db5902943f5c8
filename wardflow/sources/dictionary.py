"""The feature dictionary, the code -> category maps and the feature spec.

All reference-defined values live in this one module, stated as plain data.
Everything else in the library derives from these tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow import schemas

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference for equal results)
# ---------------------------------------------------------------------------

# Feature dictionary: (idx, category, median, mean, unit).
FEATURE_ROWS = [
    (1, "ABP_mean", 77.0, 79.12687232, "mmHg"),
    (2, "Bilirubin", 0.9, 6.379532751, "mg/dl"),
    (3, "CREATININE", 1.0, 1.576054889, "mg/dl"),
    (4, "Dobutamine", 4.0, 5.72484777, "mcg/kg/min"),
    (5, "Dopamine", 3.998375349, 4.588829993, "mcg/kg/min"),
    (6, "Epinephrine", 0.020014851, 0.078062223, "mcg/kg/min"),
    (7, "Norepinephrine", 0.096969701, 0.506031792, "mcg/kg/min"),
    (8, "FiO2", 40.0000006, 49.55805475, "%"),
    (9, "GCS", 13.0, 12.0, "points"),
    (10, "PaO2", 110.0, 134.0670289, "mmHg"),
    (11, "Platelets", 207.0, 233.4090379, "counts"),
    (12, "Urine", 80.0, 127.1269676, "ml"),
    (13, "Arterial_pH", 7.39, 7.394519556, "units"),
    (14, "HCO3", 25.0, 25.75305926, "mEq/liter"),
    (15, "HCT", 29.5, 29.95059522, "%"),
    (16, "HR", 86.0, 87.01622922, "BPM"),
    (17, "PaCO2", 40.0, 42.08470579, "mmHg"),
    (18, "POTASSIUM", 4.0, 4.1234176, "mEq/liter"),
    (19, "RR", 19.0, 19.58452559, "breath per minute (bpm)"),
    (20, "SODIUM", 139.0, 138.9445677, "mEq/liter"),
    (21, "Temperature", 37.0, 37.02296219, "C"),
    (22, "WBC", 10.9, 12.37677763, "per cubic mm"),
    (23, "ABP_systolic", 119.0, 121.0931478, "mmHg"),
    (24, "BUN", 24.0, 32.57138594, "mg/dl"),
]

# Output column order of the wide feature row (lower-cased category names).
FEATURE_COLUMNS = [
    "abp_mean", "bilirubin", "creatinine", "dobutamine", "dopamine", "epinephrine",
    "fio2", "gcs", "norepinephrine", "pao2", "platelets", "urine",
    "arterial_ph", "hco3", "hct", "hr", "paco2", "potassium", "rr", "sodium",
    "temperature", "wbc", "abp_systolic", "bun",
]

# Chart-event codes -> category (first match wins; order as in the CASE).
CHART_CODES = [
    ("ABP_mean", [52, 456, 220181, 220052, 225312]),
    ("Bilirubin", [848, 1538, 225690]),
    ("CREATININE", [791, 220615]),
    ("PaO2", [779, 220224]),
    ("Platelets", [828, 227457]),
    ("Arterial_pH", [780, 1126, 223830]),
    ("HCO3", [812, 227443]),
    ("HCT", [813, 220545]),
    ("HR", [211, 220045]),
    ("PaCO2", [778, 220235]),
    ("POTASSIUM", [829, 1535, 227442, 227464]),
    ("RR", [615, 618, 224688, 220210, 224690, 224689]),
    ("SODIUM", [837, 1536, 220645, 226534]),
    ("WBC", [861, 1127, 1542, 220546]),
    ("ABP_systolic", [51, 455, 220050, 220179]),
    ("BUN", [781, 1162, 225624]),
]
# Mapped by the chart CASE but absent from the chart whitelist (rows dropped).
CHART_NOT_WHITELISTED = [828, 227457]

LAB_CODES = [
    ("Bilirubin", [50885]),
    ("CREATININE", [50912]),
    ("PaO2", [50821]),
    ("Platelets", [51265]),
    ("Arterial_pH", [50820]),
    ("HCO3", [50804]),
    ("HCT", [50810, 51221]),
    ("PaCO2", [50818]),
    ("POTASSIUM", [50971, 50822]),
    ("SODIUM", [50983, 50824]),
    ("WBC", [51301]),
    ("BUN", [51006]),
]
LAB_NOT_WHITELISTED = [51006, 51301]

# Infusion logs: "cv" (charted rates) and "mv" (start-time rates).
CV_CODES = [
    ("Dopamine", [30043]),
    ("Dobutamine", [30042, 30306]),
    ("Epinephrine", [30044, 30119]),
    ("Norepinephrine", [30047, 30120]),
]
MV_CODES = [
    ("Dopamine", [221662]),
    ("Dobutamine", [221653]),
    ("Epinephrine", [221289]),
    ("Norepinephrine", [221906]),
]

FIO2_CODES = [189, 190, 223835]
TEMP_CODES = [676, 677, 678, 679, 223761, 223762]
GCS_TOTAL_CODE = 198
GCS_COMPONENT_CODES = [220739, 223900, 223901]
URINE_CODES = [40055, 40056, 40057, 40061, 40065, 40069, 40085, 40094, 40096, 40288,
               40405, 40428, 40473, 40715, 43175, 226559]

# Plausibility bounds (inclusive) per branch.
CHART_LAB_RANGE = (0.0, 3000.0)
URINE_RANGE_ML = (0.0, 10000.0)
GCS_MIN = 3.0

# Cohort bounds: calendar-year age in [16, 75], stay length > 0.5 day.
MIN_AGE, MAX_AGE, MIN_LOS_DAYS = 16, 75, 0.5

# Event-to-stay tolerance: one hour on each side of the stay.
STAY_TOLERANCE_SECONDS = 3600

# ---------------------------------------------------------------------------


def feature_dictionary(spark: SparkSession) -> DataFrame:
    """A2: the 24-row dictionary with NOT NULL idx/category/unit."""
    from wardflow.sources.literal import local_table
    return local_table(spark, FEATURE_ROWS, schemas.FEATURE_DICTIONARY)


def code_map(spark: SparkSession) -> DataFrame:
    """B6 as data: (source, itemid, itemcat, priority, effective).

    ``effective`` is False for codes a CASE maps but the branch whitelist
    drops (Q7).  ``priority`` keeps "first match wins" if codes repeat.
    """
    rows = []
    for source, table, excluded in (("chart", CHART_CODES, CHART_NOT_WHITELISTED),
                                    ("lab", LAB_CODES, LAB_NOT_WHITELISTED),
                                    ("cv", CV_CODES, []), ("mv", MV_CODES, [])):
        seen = set()
        for prio, (cat, codes) in enumerate(table):
            for code in codes:
                if code in seen:
                    continue
                seen.add(code)
                rows.append((source, code, cat, prio, code not in excluded))
    schema = T.StructType([
        T.StructField("source", T.StringType(), False),
        T.StructField("itemid", T.IntegerType(), False),
        T.StructField("itemcat", T.StringType(), False),
        T.StructField("priority", T.IntegerType(), False),
        T.StructField("effective", T.BooleanType(), False),
    ])
    from wardflow.sources.literal import local_table
    return local_table(spark, rows, schema)


def whitelist(source: str) -> list[int]:
    """The codes a branch keeps."""
    table, excluded = {"chart": (CHART_CODES, CHART_NOT_WHITELISTED),
                       "lab": (LAB_CODES, LAB_NOT_WHITELISTED),
                       "cv": (CV_CODES, []), "mv": (MV_CODES, [])}[source]
    return [c for _, codes in table for c in codes if c not in excluded]


def case_map(col, table) -> "F.Column":
    """B6 as a searched CASE (first match wins, no match -> NULL)."""
    expr = None
    for cat, codes in table:
        cond = col.isin(codes) if len(codes) > 1 else (col == codes[0])
        expr = F.when(cond, F.lit(cat)) if expr is None else expr.when(cond, F.lit(cat))
    return expr


def positional_binding(collation: str = "C") -> list[tuple[str, str]]:
    """Q1 as written: (category, output column) pairs of the crosstab.  The
    category query returns lower-cased names ORDER BY the dictionary's
    spelling (under ``collation``); crosstab fills the declared output
    columns (``FEATURE_COLUMNS``, the function's column list) by position."""
    from wardflow.operators.aggregate import sort_categories
    cats = sort_categories([row[1] for row in FEATURE_ROWS], collation)
    return [(c.lower(), col) for c, col in zip(cats, FEATURE_COLUMNS)]


# ---------------------------------------------------------------------------
# Feature spec: one row per output column; the single truth for imputation.
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class FeatureSpec:
    name: str            # output column
    source: str          # pivot column whose LOCF fills this one
    impute: str          # "locf_default" | "locf_zero" | "raw"
    default: str | None  # dictionary category whose median is the default


def _default_spec() -> list[FeatureSpec]:
    raw = {"dobutamine", "dopamine", "epinephrine", "norepinephrine"}
    out = []
    for name in FEATURE_COLUMNS:
        if name in raw:
            out.append(FeatureSpec(name, name, "raw", None))
        elif name == "urine":
            out.append(FeatureSpec(name, name, "locf_zero", None))
        else:
            out.append(FeatureSpec(name, name, "locf_default", name))
    return out


DEFAULT_SPEC = _default_spec()


def as_written_spec() -> list[FeatureSpec]:
    """The imputation exactly as the reference text computes it (Q2, Q3):
    three infusion slots filled from creatinine, the paco2 slot from pao2."""
    out = []
    for s in DEFAULT_SPEC:
        if s.name in ("dobutamine", "dopamine", "epinephrine"):
            out.append(FeatureSpec(s.name, "creatinine", "locf_default", s.name))
        elif s.name == "paco2":
            out.append(FeatureSpec(s.name, "pao2", "locf_default", "pao2"))
        else:
            out.append(s)
    return out
