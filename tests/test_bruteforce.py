"""Randomised checks of column logic against plain-Python readings of the rules."""

import random

from wardflow.functions import arrays, steps

COLS = ["abp_mean", "dopamine", "dobutamine", "epinephrine", "norepinephrine", "pao2", "fio2",
        "creatinine", "gcs", "bilirubin", "platelets", "urine"]
EDGES = {"abp_mean": [69.9, 70, 70.1], "dopamine": [0, 5, 5.1, 15, 15.1],
         "dobutamine": [0, 3], "epinephrine": [0, 0.05, 0.1, 0.11],
         "norepinephrine": [0, 0.1, 0.2], "pao2": [40, 100, 400], "fio2": [21, 50, 100],
         "creatinine": [1.19, 1.2, 1.9, 3.4, 4.9, 5], "gcs": [3, 5.9, 6, 9, 12, 14, 14.5, 15, 16],
         "bilirubin": [1.2, 1.9, 5.9, 11.9, 12], "platelets": [19, 20, 50, 100, 150],
         "urine": [0, 0.0083, 0.01, 0.0209, 0.2, 0.5]}


def _steps(v, arms, otherwise=None):
    if v is None:               # no arm matches NULL: the ELSE value (or NULL)
        return otherwise
    for test, pts in arms:
        if test(v):
            return pts
    return otherwise


def py_parts(r, w):
    m, dop, dob, epi, nor = (r[c] for c in COLS[:5])
    no = dop is None and dob is None and epi is None and nor is None

    def gt(a, b):
        return a is not None and a > b

    def le(a, b):
        return a is not None and a <= b
    if m is not None and m >= 70 and no:
        cv = 0
    elif m is not None and m < 70 and no:
        cv = 1
    elif le(dop, 5) or dob is not None:
        cv = 2
    elif (gt(dop, 5) and le(dop, 15)) or (gt(epi, 0) and le(epi, 0.1)) or \
            (gt(nor, 0) and le(nor, 0.1)):
        cv = 3
    elif gt(dop, 15) or gt(epi, 0.1) or gt(nor, 0.1):
        cv = 4
    else:
        cv = 0
    ratio = None if r["pao2"] is None or r["fio2"] is None else r["pao2"] / (r["fio2"] / 100)
    parts = [
        cv,
        _steps(ratio, [(lambda x: x < 100, 4), (lambda x: x < 200, 3), (lambda x: x < 300, 2),
                       (lambda x: x < 400, 1), (lambda x: x >= 400, 0)]),
        _steps(r["creatinine"], [(lambda x: x < 1.2, 0), (lambda x: x <= 1.9, 1),
                                 (lambda x: x <= 3.4, 2), (lambda x: x <= 4.9, 3),
                                 (lambda x: x > 4.9, 4)]),
        _steps(r["gcs"], [(lambda x: x < 6, 4), (lambda x: x <= 9, 3), (lambda x: x <= 12, 2),
                          (lambda x: x <= 14, 1), (lambda x: x == 15, 0)]),
        _steps(r["bilirubin"], [(lambda x: x <= 1.2, 0), (lambda x: x <= 1.9, 1),
                                (lambda x: x <= 5.9, 2), (lambda x: x <= 11.9, 3),
                                (lambda x: x > 11.9, 4)]),
        _steps(r["platelets"], [(lambda x: x < 20, 4), (lambda x: x < 50, 3),
                                (lambda x: x < 100, 2), (lambda x: x < 150, 1),
                                (lambda x: x >= 150, 0)]),
        _steps(r["urine"], [(lambda x: x < w / 120, 4), (lambda x: x < w / 48, 3)], 0),
    ]
    total = None if any(p is None for p in parts) else sum(parts)
    return parts + [total]


def test_scores_match_python_reading(spark):
    rnd = random.Random(11)
    rows = []
    for _ in range(600):
        r = {}
        for c in COLS:
            u = rnd.random()
            r[c] = None if u < 0.2 else (float(rnd.choice(EDGES[c])) if u < 0.6
                                         else round(rnd.uniform(0, max(EDGES[c]) * 1.3), 3))
        rows.append(r)
    schema = ", ".join(f"{c} double" for c in COLS)
    df = spark.createDataFrame([tuple(r[c] for c in COLS) for r in rows], schema)
    for w in (1, 6, 24):
        exprs = [f"{e} AS {n}" for n, e in steps.score_parts_sql(w).items()]
        got = df.selectExpr(*COLS, *exprs, f"{steps.total_score_sql(w)} AS total").collect()
        for g in got:
            r = {c: g[c] for c in COLS}
            assert list(g)[len(COLS):] == py_parts(r, w), (r, w)


def test_pad_and_pairs_match_python(spark):
    rnd = random.Random(5)
    seqs = [[rnd.randint(1, 99) for _ in range(rnd.randint(0, 12))] for _ in range(300)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "i int, s array<int>")
    for n in (1, 4, 10):
        got = {r.i: r.p for r in df.selectExpr("i").join(
            df.select("i", arrays.pad("s", n).alias("p")), "i").collect()}
        for i, s in enumerate(seqs):
            assert got[i] == ([0] * max(n - len(s), 0) + s)[-n:] if n else []
    even = [(i, s) for i, s in enumerate(seqs) if len(s) % 2 == 0]
    d2 = spark.createDataFrame(even, "i int, s array<int>")
    got = {r.i: [(x.first, x.second) for x in r.p]
           for r in d2.select("i", arrays.delta_pairs("s").alias("p")).collect()}
    for i, s in even:
        assert got[i] == list(zip(s[0::2], s[1::2]))
