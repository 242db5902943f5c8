"""Rule-based severity score (S1-S8) built on one generic step function.

No arm has an implicit ELSE unless the rule says so: a value that matches
no arm (or is NULL) gives NULL, and a NULL part makes the total NULL (Q12).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _num(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def case_sql(v: str, rules, otherwise: int | None = None) -> str:
    """SQL text of a step function over column ``v``: first matching
    ``(op, bound, points)`` wins; ``otherwise`` (if given) else NULL."""
    arms = " ".join(f"WHEN `{v}` {op} {_num(bound)} THEN {int(points)}" for op, bound, points in rules)
    tail = f" ELSE {int(otherwise)}" if otherwise is not None else ""
    return f"CAST(CASE {arms}{tail} END AS INT)"


def step_score(v: str, rules, otherwise: int | None = None) -> Column:
    """First matching ``(op, bound, points)`` wins; ``otherwise`` if given."""
    return F.expr(case_sql(v, rules, otherwise))


# FIXED VALUES: bounds and points of the seven score parts, in the order in
# which their arms are tried.
CREATININE_RULES = [("<", 1.2, 0), ("<=", 1.9, 1), ("<=", 3.4, 2), ("<=", 4.9, 3), (">", 4.9, 4)]
GCS_RULES = [("<", 6, 4), ("<=", 9, 3), ("<=", 12, 2), ("<=", 14, 1), ("=", 15, 0)]
BILIRUBIN_RULES = [("<=", 1.2, 0), ("<=", 1.9, 1), ("<=", 5.9, 2), ("<=", 11.9, 3), (">", 11.9, 4)]
PLATELETS_RULES = [("<", 20, 4), ("<", 50, 3), ("<", 100, 2), ("<", 150, 1), (">=", 150, 0)]
RATIO_RULES = [("<", 100, 4), ("<", 200, 3), ("<", 300, 2), ("<", 400, 1), (">=", 400, 0)]


CARDIOVASCULAR_DRUGS = ("dopamine", "dobutamine", "epinephrine", "norepinephrine")
# (points, alternatives); an alternative is a list of (column, op, bound) that
# must all hold, "no drugs" stands for all four drugs being NULL
CARDIOVASCULAR_RULES = [
    (0, [[("abp_mean", ">=", 70), "no drugs"]]),
    (1, [[("abp_mean", "<", 70), "no drugs"]]),
    (2, [[("dopamine", "<=", 5)], [("dobutamine", "IS NOT NULL", None)]]),
    (3, [[("dopamine", ">", 5), ("dopamine", "<=", 15)],
         [("epinephrine", ">", 0), ("epinephrine", "<=", 0.1)],
         [("norepinephrine", ">", 0), ("norepinephrine", "<=", 0.1)]]),
    (4, [[("dopamine", ">", 15)], [("epinephrine", ">", 0.1)], [("norepinephrine", ">", 0.1)]]),
]
CARDIOVASCULAR_OTHERWISE = 0


def cardiovascular_sql(**names) -> str:
    """S1 as SQL text from its rule rows (arm order matters, Q13); ``names``
    renames columns."""
    def column(c):
        return f"`{names.get(c, c)}`"

    def test(t):
        if t == "no drugs":
            return " AND ".join(f"{column(d)} IS NULL" for d in CARDIOVASCULAR_DRUGS)
        c, op, bound = t
        return f"{column(c)} {op}" + ("" if bound is None else f" {_num(bound)}")

    arms = " ".join(
        "WHEN " + " OR ".join("(" + " AND ".join(test(t) for t in every) + ")" for every in any_of)
        + f" THEN {points}" for points, any_of in CARDIOVASCULAR_RULES)
    return f"CAST(CASE {arms} ELSE {CARDIOVASCULAR_OTHERWISE} END AS INT)"


def respiration_sql(pao2="pao2", fio2="fio2") -> str:
    """S2 on the ratio pao2 / (fio2 / 100)."""
    ratio = f"(`{pao2}` / (`{fio2}` / 100.0D))"
    arms = " ".join(f"WHEN {ratio} {op} {_num(b)} THEN {p}" for op, b, p in RATIO_RULES)
    return f"CAST(CASE {arms} END AS INT)"


def urine_rules(window_hours: int):
    """S7 bounds: ``w * 0.2 / 24`` and ``w * 0.5 / 24`` written as one division
    each (``w / 120``, ``w / 48``) so the bound is the double nearest the
    exact decimal, as in the reference."""
    return [("<", window_hours / 120, 4), ("<", window_hours / 48, 3)]


def cardiovascular_points(**cols) -> Column:
    return F.expr(cardiovascular_sql(**cols))


def respiration_points(pao2="pao2", fio2="fio2") -> Column:
    return F.expr(respiration_sql(pao2, fio2))


def creatinine_points(v="creatinine") -> Column:
    """S3."""
    return step_score(v, CREATININE_RULES)


def gcs_points(v="gcs") -> Column:
    """S4 (values in (14, 15) and above 15 match no arm -> NULL)."""
    return step_score(v, GCS_RULES)


def bilirubin_points(v="bilirubin") -> Column:
    """S5."""
    return step_score(v, BILIRUBIN_RULES)


def platelets_points(v="platelets") -> Column:
    """S6."""
    return step_score(v, PLATELETS_RULES)


def urine_points(v="urine", window_hours: int = 24) -> Column:
    """Litres per window against 0.2 and 0.5 l/day scaled to the window."""
    return step_score(v, urine_rules(window_hours), otherwise=0)


SCORE_PARTS = ("cardiovascular_points", "respiration_points", "creatinine_points", "gcs_points",
               "bilirubin_points", "platelets_points", "urine_points")


def score_parts_sql(window_hours: int) -> dict[str, str]:
    """S1-S7 over the imputed feature columns, as SQL text."""
    return {
        "cardiovascular_points": cardiovascular_sql(),
        "respiration_points": respiration_sql(),
        "creatinine_points": case_sql("creatinine", CREATININE_RULES),
        "gcs_points": case_sql("gcs", GCS_RULES),
        "bilirubin_points": case_sql("bilirubin", BILIRUBIN_RULES),
        "platelets_points": case_sql("platelets", PLATELETS_RULES),
        "urine_points": case_sql("urine", urine_rules(window_hours), otherwise=0),
    }


def total_score_sql(window_hours: int) -> str:
    """Null-propagating sum of the seven parts."""
    return "CAST(" + " + ".join(f"({e})" for e in score_parts_sql(window_hours).values()) + \
        " AS INT)"


def score_parts(window_hours: int) -> dict[str, Column]:
    return {k: F.expr(v) for k, v in score_parts_sql(window_hours).items()}


def total_score(window_hours: int) -> Column:
    return F.expr(total_score_sql(window_hours))
