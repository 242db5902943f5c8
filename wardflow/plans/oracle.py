"""DuckDB oracle SQL for the query catalogue.

Written independently of the Spark code and, where the reference's shape is
expressible, in that shape: a correlated scalar subquery for the daily
lookup, GROUP BY (stay, window, category) before a CASE pivot, LOCF as
``last_value(... IGNORE NULLS)``.  Doubles are rounded to 6 places in the
final projection on both sides.
"""

from __future__ import annotations

from wardflow.sources import analogues as an
from wardflow.sources import dictionary as dic

US_HOUR = 3_600_000_000


def dbl(x: float) -> str:
    """An exact double literal."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def code_values() -> str:
    return ",\n    ".join(f"({k}, '{cat}', {str(eff).lower()}, {dbl(sc)})"
                          for k, cat, eff, sc in an.analogue_code_rows())


def events_windowed_ctes(tolerance_us: int = US_HOUR) -> str:
    """CTEs ev, cm, mapped, lng, spans, win over the ``events`` view."""
    tws = ",\n      ".join(
        f"floor(abs(epoch_us(l.charttime) - epoch_us(s.intime)) / {float(h * US_HOUR)!r}) + 1 "
        f"AS tw_{h}hr" for h in (1, 3, 6, 12, 24))
    return f"""
ev AS (
  SELECT event_id, user_id AS subject_id, user_id AS hadm_id, user_id AS icustay_id,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS itemid,
         ts AS charttime, value - 1.0 AS raw
  FROM events),
cm AS (SELECT * FROM (VALUES
    {code_values()}) AS t(itemid, itemcat, effective, scale)),
mapped AS (
  SELECT ev.*, cm.itemcat, cm.scale FROM ev JOIN cm ON ev.itemid = cm.itemid
  WHERE cm.effective),
lng AS (
  SELECT event_id, subject_id, hadm_id, icustay_id, itemcat, itemid, charttime,
    CASE itemcat
      WHEN 'FiO2' THEN CASE WHEN raw BETWEEN 20 AND 100 THEN raw
                            WHEN raw BETWEEN 0.2 AND 1 THEN raw * 100 END
      WHEN 'Temperature' THEN CASE WHEN raw BETWEEN 20 AND 50 THEN raw
                                   WHEN raw BETWEEN 68 AND 122 THEN (raw - 32) * 5 / 9 END
      WHEN 'Urine' THEN raw / 1000
      ELSE raw * scale END AS valuenum
  FROM mapped
  WHERE CASE itemcat
      WHEN 'FiO2' THEN raw IS NOT NULL AND raw >= 0
      WHEN 'Temperature' THEN true
      WHEN 'Urine' THEN raw IS NOT NULL AND raw >= 0 AND raw <= 10000
      ELSE raw * scale IS NOT NULL AND raw * scale >= 0 AND raw * scale <= 3000 END),
spans AS (
  SELECT user_id AS subject_id, user_id AS hadm_id,
         min(ts) + INTERVAL 1 DAY AS intime, max(ts) - INTERVAL 1 DAY AS outtime
  FROM events GROUP BY user_id),
win AS (
  SELECT l.*, s.intime, s.outtime,
      (epoch_us(l.charttime) - epoch_us(date_trunc('hour', s.intime))) / {float(US_HOUR)!r}
        AS hour_diff,
      {tws}
  FROM lng l JOIN spans s ON l.subject_id = s.subject_id AND l.hadm_id = s.hadm_id
  WHERE epoch_us(l.charttime) - epoch_us(s.intime) >= -{tolerance_us}
    AND epoch_us(s.outtime) - epoch_us(l.charttime) >= -{tolerance_us}
    AND l.valuenum >= 0)"""


def daily_cte() -> str:
    return """
daily AS (
  SELECT icustay_id, tw_24hr, sum(valuenum) AS urine_output_per_24hrs
  FROM win WHERE lower(itemcat) = 'urine' GROUP BY icustay_id, tw_24hr)"""


def pivot_ctes(w: int, day_index: str = "as_written", binding=None) -> str:
    """CTEs daily, means, pv: the reference's per-window query and crosstab."""
    tw = f"tw_{w}hr"
    if day_index == "aligned":
        day = f"d.tw_24hr = floor((win.{tw} - 1) * {w} / 24) + 1"
    elif w == 24:
        # the text compares the daily table's tw_24hr with itself
        day = "d.tw_24hr = floor(d.tw_24hr * 24 / 24) + 1"
    else:
        day = f"d.tw_24hr = floor(win.{tw} * {w} / 24) + 1"
    pairs = binding if binding is not None else [(c, c) for c in dic.FEATURE_COLUMNS]
    cols = ",\n    ".join(f"max(CASE WHEN cat = '{c}' THEN valuenum END) AS {n}"
                          for c, n in pairs)
    return f"""{daily_cte()},
means AS (
  SELECT icustay_id, {tw} AS tw_hour_idx, lower(itemcat) AS cat,
    CASE WHEN lower(itemcat) = 'urine' THEN
      (SELECT d.urine_output_per_24hrs * {w} / 24 FROM daily d
       WHERE d.icustay_id = win.icustay_id AND {day})
    ELSE avg(valuenum) END AS valuenum
  FROM win WHERE valuenum > 0
  GROUP BY icustay_id, {tw}, itemcat),
pv AS (
  SELECT icustay_id, tw_hour_idx,
    {cols}
  FROM means GROUP BY icustay_id, tw_hour_idx)"""


def imputed_cte(spec=dic.DEFAULT_SPEC) -> str:
    med = {cat.lower(): m for _, cat, m, _, _ in dic.FEATURE_ROWS}
    cols = []
    for s in spec:
        lv = f"last_value({s.source} IGNORE NULLS) OVER w"
        if s.impute == "raw":
            cols.append(f"{s.source} AS {s.name}")
        elif s.impute == "locf_zero":
            cols.append(f"coalesce({lv}, 0) AS {s.name}")
        else:
            cols.append(f"coalesce({lv}, {dbl(med[s.default])}) AS {s.name}")
    masks = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END AS m_{c}"
                      for c in dic.FEATURE_COLUMNS)
    body = ",\n    ".join(cols)
    return f"""
imp AS (
  SELECT icustay_id, tw_hour_idx,
    {body},
    {masks}
  FROM pv
  WINDOW w AS (PARTITION BY icustay_id ORDER BY tw_hour_idx
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def score_cte(w: int) -> str:
    no_drugs = ("dopamine IS NULL AND dobutamine IS NULL AND epinephrine IS NULL "
                "AND norepinephrine IS NULL")
    return f"""
sc AS (
  SELECT *,
    CASE WHEN abp_mean >= 70 AND {no_drugs} THEN 0
         WHEN abp_mean < 70 AND {no_drugs} THEN 1
         WHEN dopamine <= 5 OR dobutamine IS NOT NULL THEN 2
         WHEN (dopamine > 5 AND dopamine <= 15) OR (epinephrine > 0 AND epinephrine <= 0.1)
              OR (norepinephrine > 0 AND norepinephrine <= 0.1) THEN 3
         WHEN dopamine > 15 OR epinephrine > 0.1 OR norepinephrine > 0.1 THEN 4
         ELSE 0 END AS cardiovascular_points,
    CASE WHEN pao2 / (fio2 / 100) < 100 THEN 4 WHEN pao2 / (fio2 / 100) < 200 THEN 3
         WHEN pao2 / (fio2 / 100) < 300 THEN 2 WHEN pao2 / (fio2 / 100) < 400 THEN 1
         WHEN pao2 / (fio2 / 100) >= 400 THEN 0 END AS respiration_points,
    CASE WHEN creatinine < 1.2 THEN 0 WHEN creatinine <= 1.9 THEN 1
         WHEN creatinine <= 3.4 THEN 2 WHEN creatinine <= 4.9 THEN 3
         WHEN creatinine > 4.9 THEN 4 END AS creatinine_points,
    CASE WHEN gcs < 6 THEN 4 WHEN gcs <= 9 THEN 3 WHEN gcs <= 12 THEN 2
         WHEN gcs <= 14 THEN 1 WHEN gcs = 15 THEN 0 END AS gcs_points,
    CASE WHEN bilirubin <= 1.2 THEN 0 WHEN bilirubin <= 1.9 THEN 1
         WHEN bilirubin <= 5.9 THEN 2 WHEN bilirubin <= 11.9 THEN 3
         WHEN bilirubin > 11.9 THEN 4 END AS bilirubin_points,
    CASE WHEN platelets < 20 THEN 4 WHEN platelets < 50 THEN 3 WHEN platelets < 100 THEN 2
         WHEN platelets < 150 THEN 1 WHEN platelets >= 150 THEN 0 END AS platelets_points,
    CASE WHEN urine < {w}::DOUBLE / 120 THEN 4 WHEN urine < {w}::DOUBLE / 48 THEN 3
         ELSE 0 END AS urine_points
  FROM imp)"""


SCORE_PARTS = ["cardiovascular_points", "respiration_points", "creatinine_points", "gcs_points",
               "bilirubin_points", "platelets_points", "urine_points"]


def R(expr: str) -> str:
    """Round to 6 places exactly as the Spark side does: snap to 9 places
    first (absorbs summation-order noise below 5e-10 at decimal ties), then
    round half away from zero to 6 places."""
    return f"round(round(({expr}) * 1000000000.0) / 1000.0) / 1000000.0"


def r6(cols) -> str:
    return ", ".join(f"{R(c)} AS {c}" for c in cols)


def total_expr() -> str:
    return "CAST(" + " + ".join(SCORE_PARTS) + " AS INTEGER) AS total_sofa_score"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes)


DAY_US = 86_400_000_000


def patients_stays_ctes() -> str:
    """CTEs p (patients from customer) and s (stays from orders)."""
    return f"""
p AS (
  SELECT c_custkey AS subject_id, c_mktsegment AS gender,
         make_timestamp(CAST(floor((c_acctbal + 1000.0) / 100.0) + 1900 AS INTEGER), 7, 1, 0, 0, 0)
           AS dob
  FROM customer),
s AS (
  SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderkey AS icustay_id,
         o_orderstatus AS dbsource, o_orderpriority AS first_careunit,
         o_orderpriority AS last_careunit, CAST(NULL AS INTEGER) AS first_wardid,
         CAST(NULL AS INTEGER) AS last_wardid, o_orderdate AS intime,
         make_timestamp(epoch_us(o_orderdate)
                        + CAST(floor(o_totalprice / 100000.0 * {float(DAY_US)!r}) AS BIGINT))
           AS outtime,
         o_totalprice / 100000.0 AS los
  FROM orders),
cohort AS (
  SELECT s.subject_id, s.icustay_id, s.hadm_id, p.gender, s.dbsource, s.first_careunit,
         s.last_careunit, s.first_wardid, s.last_wardid, s.intime, s.outtime, s.los,
         CAST(year(s.intime) - year(p.dob) AS DOUBLE) AS pt_age
  FROM p JOIN s ON p.subject_id = s.subject_id
  WHERE year(s.intime) - year(p.dob) >= 16 AND year(s.intime) - year(p.dob) <= 75
    AND s.los > 0.5)"""


def text_sql(expr: str, decimals: int) -> str:
    return (f"regexp_replace(regexp_replace(printf('%.{decimals}f', {expr}), "
            f"'(\\.\\d*?)0+$', '\\1'), '\\.$', '')")


TOKENS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '')"


def vocab_ctes(num_words: int = 20000) -> str:
    return f"""
docs AS (SELECT doc_id, {TOKENS} AS toks FROM documents),
tk AS (SELECT unnest(toks) AS token FROM docs),
cnt AS (SELECT token, count(*) AS count FROM tk GROUP BY token),
rk AS (SELECT token, count, row_number() OVER (ORDER BY count DESC, token) + 3 AS id FROM cnt),
vocab AS (SELECT token, CAST(id AS INTEGER) AS id, count FROM rk WHERE id < {num_words})"""


def encode_ctes() -> str:
    return """
pos AS (SELECT doc_id, unnest(toks) AS token, unnest(range(len(toks))) AS pos FROM docs),
ided AS (SELECT p.doc_id, p.pos, coalesce(v.id, 2) AS id
         FROM pos p LEFT JOIN vocab v ON p.token = v.token),
seq AS (SELECT doc_id, list(id ORDER BY pos) AS ids FROM ided GROUP BY doc_id),
enc AS (SELECT d.doc_id, list_concat([1], coalesce(s.ids, [])) AS ids
        FROM docs d LEFT JOIN seq s ON d.doc_id = s.doc_id)"""


def pad_sql(ids: str, n: int, zero: str = "0") -> str:
    return (f"list_concat(list_transform(range(greatest({n} - len({ids}), 0)), lambda i: {zero}), "
            f"{ids}[greatest(len({ids}) - {n}, 0) + 1 : len({ids})])")


def head_weights(width: int = 64) -> list[float]:
    """Fixed rule-built head weights for the SQL-checkable head score."""
    return [((i % 7) - 3) / 10.0 for i in range(width)]


HEAD_BIAS = 0.1


def _case(col: str, table) -> str:
    arms = " ".join(f"WHEN {col} IN ({', '.join(map(str, codes))}) THEN '{cat}'"
                    for cat, codes in table)
    return f"CASE {arms} END"


def _in(codes) -> str:
    return "(" + ", ".join(str(c) for c in codes) + ")"


def clinical_long_ctes(temp_category: str = "Temperature") -> str:
    """The seven derived clinical tables and the eight branches -> ``lng``."""
    pools = an.code_pools()

    def pick(pool, key):
        return f"[{', '.join(map(str, pools[pool]))}][({key}) % {len(pools[pool])} + 1]"

    def hours(h):
        return f"make_timestamp(epoch_us(o_orderdate) + CAST({h} AS BIGINT) * 3600000000)"

    chart_v = "CASE WHEN l_linenumber <> 7 THEN l_quantity * 2 END"
    wl_chart = [c for c in sum((cs for _, cs in dic.CHART_CODES), [])
                if c not in dic.CHART_NOT_WHITELISTED]
    wl_lab = [c for c in sum((cs for _, cs in dic.LAB_CODES), [])
              if c not in dic.LAB_NOT_WHITELISTED]
    cv_codes = sum((cs for _, cs in dic.CV_CODES), [])
    mv_codes = sum((cs for _, cs in dic.MV_CODES), [])
    return f"""{patients_stays_ctes()},
lo AS (SELECT l.*, o.o_custkey, o.o_orderdate FROM lineitem l JOIN orders o
       ON l.l_orderkey = o.o_orderkey),
chart AS (
  SELECT l_orderkey * 8 + l_linenumber AS row_id, o_custkey AS subject_id, l_orderkey AS hadm_id,
         l_orderkey AS icustay_id, {pick('chart', 'l_partkey')} AS itemid,
         {hours('l_linenumber * 2')} AS charttime, CAST({chart_v} AS VARCHAR) AS value,
         {chart_v} AS valuenum
  FROM lo WHERE o_custkey IN (SELECT subject_id FROM cohort)),
labs AS (
  SELECT o_custkey AS subject_id, l_orderkey AS hadm_id, {pick('lab', 'l_suppkey')} AS itemid,
         l_shipdate AS charttime, CAST(l_extendedprice / 100 AS VARCHAR) AS value,
         l_extendedprice / 100 AS valuenum
  FROM lo),
labs_stays AS (
  SELECT l.*, s.icustay_id FROM labs l JOIN s ON l.hadm_id = s.hadm_id
  WHERE epoch_us(l.charttime) - epoch_us(s.intime) >= -3600000000
    AND epoch_us(s.outtime) - epoch_us(l.charttime) >= -3600000000),
outp AS (
  SELECT o_custkey AS subject_id, l_orderkey AS hadm_id, l_orderkey AS icustay_id,
         {hours('l_linenumber')} AS charttime,
         CASE WHEN l_linenumber <= 2 THEN {pick('urine', 'l_partkey')} ELSE 40000 END AS itemid,
         l_extendedprice / 10 AS value
  FROM lo),
cv AS (
  SELECT o_custkey AS subject_id, l_orderkey AS hadm_id, l_orderkey AS icustay_id,
         {hours('l_linenumber * 3')} AS charttime, {pick('cv', 'l_partkey')} AS itemid,
         l_discount * 100 AS rate, 'mcg/kg/min' AS rateuom
  FROM lo WHERE l_returnflag <> 'N' AND o_custkey IN (SELECT subject_id FROM cohort)),
mv AS (
  SELECT o_custkey AS subject_id, l_orderkey AS hadm_id, l_orderkey AS icustay_id,
         {hours('l_linenumber * 3')} AS starttime, {pick('mv', 'l_partkey')} AS itemid,
         l_tax * 100 AS rate, 'mcg/kg/min' AS rateuom
  FROM lo WHERE l_returnflag = 'N' AND o_custkey IN (SELECT subject_id FROM cohort)),
gcs AS (
  SELECT subject_id, hadm_id, icustay_id, charttime, value AS cvalue, valuenum FROM (
    SELECT DISTINCT row_id, subject_id, hadm_id, icustay_id, charttime, value, valuenum
    FROM chart WHERE itemid = {dic.GCS_TOTAL_CODE})
  UNION ALL
  SELECT subject_id, hadm_id, icustay_id, charttime, {text_sql('sum(val)', 0)} AS cvalue,
         sum(val) AS valuenum FROM (
    SELECT DISTINCT row_id, subject_id, hadm_id, icustay_id, charttime, valuenum AS val
    FROM chart WHERE itemid IN {_in(dic.GCS_COMPONENT_CODES)})
  GROUP BY charttime, subject_id, hadm_id, icustay_id),
lng AS (
  SELECT subject_id, hadm_id, icustay_id, {_case('itemid', dic.CHART_CODES)} AS itemcat, itemid,
         charttime, value AS cvalue, valuenum, 'u' AS valueuom
  FROM chart WHERE itemid IN {_in(wl_chart)} AND valuenum IS NOT NULL AND valuenum >= 0
    AND valuenum <= 3000 AND hadm_id IN (SELECT hadm_id FROM cohort)
  UNION ALL
  SELECT subject_id, hadm_id, icustay_id, 'FiO2', itemid, charttime,
    {text_sql('CASE WHEN valuenum BETWEEN 20 AND 100 THEN valuenum WHEN valuenum BETWEEN 0.2 AND 1 THEN valuenum * 100 END', 3)},
    CASE WHEN valuenum BETWEEN 20 AND 100 THEN valuenum
         WHEN valuenum BETWEEN 0.2 AND 1 THEN valuenum * 100 END, '%'
  FROM chart WHERE itemid IN {_in(dic.FIO2_CODES)} AND valuenum IS NOT NULL AND valuenum >= 0
    AND hadm_id IN (SELECT hadm_id FROM cohort)
  UNION ALL
  SELECT subject_id, hadm_id, icustay_id, '{temp_category}', itemid, charttime,
    {text_sql('CASE WHEN valuenum BETWEEN 20 AND 50 THEN valuenum WHEN valuenum BETWEEN 68 AND 122 THEN (valuenum - 32) * 5 / 9 END', 3)},
    CASE WHEN valuenum BETWEEN 20 AND 50 THEN valuenum
         WHEN valuenum BETWEEN 68 AND 122 THEN (valuenum - 32) * 5 / 9 END, 'C'
  FROM chart WHERE itemid IN {_in(dic.TEMP_CODES)}
  UNION ALL
  SELECT subject_id, hadm_id, icustay_id, {_case('itemid', dic.LAB_CODES)}, itemid, charttime,
         value, valuenum, 'u'
  FROM labs_stays WHERE itemid IN {_in(wl_lab)} AND valuenum IS NOT NULL AND valuenum >= 0
    AND valuenum <= 3000 AND hadm_id IN (SELECT hadm_id FROM cohort)
  UNION ALL
  SELECT subject_id, hadm_id, icustay_id, 'GCS', {dic.GCS_TOTAL_CODE}, charttime, cvalue,
         valuenum, 'points'
  FROM gcs WHERE valuenum IS NOT NULL AND valuenum >= 3
  UNION ALL
  SELECT subject_id, hadm_id, icustay_id, {_case('itemid', dic.CV_CODES)}, itemid, charttime,
         {text_sql('rate', 6)}, rate, rateuom
  FROM cv WHERE itemid IN {_in(cv_codes)} AND rate IS NOT NULL AND rate >= 0
  UNION ALL
  SELECT subject_id, hadm_id, icustay_id, {_case('itemid', dic.MV_CODES)}, itemid, starttime,
         {text_sql('rate', 6)}, rate, rateuom
  FROM mv WHERE itemid IN {_in(mv_codes)} AND rate IS NOT NULL AND rate >= 0
  UNION ALL
  SELECT subject_id, hadm_id, icustay_id, 'URINE', itemid, charttime,
         {text_sql('value / 1000', 6)}, value / 1000, 'l'
  FROM outp WHERE itemid IN {_in(dic.URINE_CODES)} AND value IS NOT NULL AND value >= 0
    AND value <= 10000 AND icustay_id IN (SELECT icustay_id FROM cohort))"""


def clinical_win_cte() -> str:
    tws = ",\n      ".join(
        f"floor(abs(epoch_us(l.charttime) - epoch_us(c.intime)) / {float(h * US_HOUR)!r}) + 1 "
        f"AS tw_{h}hr" for h in (1, 3, 6, 12, 24))
    return f"""
win AS (
  SELECT l.*, c.intime, c.outtime,
      (epoch_us(l.charttime) - epoch_us(date_trunc('hour', c.intime))) / {float(US_HOUR)!r}
        AS hour_diff,
      {tws}
  FROM lng l JOIN cohort c ON l.subject_id = c.subject_id AND l.hadm_id = c.hadm_id
  WHERE epoch_us(l.charttime) - epoch_us(c.intime) >= -{US_HOUR}
    AND epoch_us(c.outtime) - epoch_us(l.charttime) >= -{US_HOUR}
    AND l.valuenum >= 0)"""


# what the derived logs hold, by column; the other declared columns are NULL
_VIEW_VALUES = {
    "adult_chartevents": {
        "charttime": ("hours", "l_linenumber * 2"), "itemid": ("pick", "chart", "l_partkey"),
        "value": "CAST(CASE WHEN l_linenumber <> 7 THEN l_quantity * 2 END AS VARCHAR)",
        "valuenum": "CASE WHEN l_linenumber <> 7 THEN l_quantity * 2 END", "valueuom": "'u'",
        "warning": "0", "error": "0"},
    "adult_outputevents": {
        "charttime": ("hours", "l_linenumber"), "itemid": ("pick", "urine", "l_partkey"),
        "value": "l_extendedprice / 10", "valueuom": "'ml'", "iserror": "0"},
    "adult_inputevents_cv": {
        "charttime": ("hours", "l_linenumber * 3"), "itemid": ("pick", "cv", "l_partkey"),
        "amount": "l_quantity", "amountuom": "'ml'", "rate": "l_discount * 100",
        "rateuom": "'mcg/kg/min'", "orderid": "l_suppkey", "originalamount": "l_extendedprice"},
    "adult_inputevents_mv": {
        "starttime": ("hours", "l_linenumber * 3"), "endtime": ("hours", "l_linenumber * 3 + 1"),
        "itemid": ("pick", "mv", "l_partkey"), "amount": "l_quantity", "amountuom": "'ml'",
        "rate": "l_tax * 100", "rateuom": "'mcg/kg/min'", "orderid": "l_suppkey",
        "ordercategoryname": "l_returnflag"},
}
_VIEW_ROWS = {"adult_inputevents_cv": " AND l_returnflag <> 'N'",
              "adult_inputevents_mv": " AND l_returnflag = 'N'"}


def view_sql(name: str, schema) -> str:
    """A restricted view with its full column list, rounded doubles."""
    pools = an.code_pools()
    sql_type = {"int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}

    def expr(e):
        if isinstance(e, str):
            return e
        if e[0] == "hours":
            return f"make_timestamp(epoch_us(o_orderdate) + CAST({e[1]} AS BIGINT) * 3600000000)"
        pool = pools[e[1]]
        picked = f"[{', '.join(map(str, pool))}][{e[2]} % {len(pool)} + 1]"
        return f"CASE WHEN l_linenumber <= 2 THEN {picked} ELSE 40000 END" if e[1] == "urine" else picked
    values = {"row_id": "l_orderkey * 8 + l_linenumber", "subject_id": "o_custkey",
              "hadm_id": "l_orderkey", "icustay_id": "l_orderkey", **_VIEW_VALUES[name]}
    cols = []
    for f in schema.fields:
        t = sql_type[f.dataType.simpleString()]
        e = f"CAST({expr(values[f.name])} AS {t})" if f.name in values else f"CAST(NULL AS {t})"
        cols.append(f"{R(e) if t == 'DOUBLE' and f.name in values else e} AS {f.name}")
    return (with_(patients_stays_ctes()) + "\nSELECT " + ",\n  ".join(cols)
            + "\nFROM lineitem JOIN orders ON l_orderkey = o_orderkey"
            + "\nWHERE o_custkey IN (SELECT subject_id FROM cohort)" + _VIEW_ROWS.get(name, ""))


def lab_view_sql() -> str:
    """The lab view: labs with the stay whose span holds them."""
    pool = an.code_pools()["lab"]
    return with_(patients_stays_ctes()) + f"""
SELECT o_custkey AS subject_id, l_orderkey AS hadm_id, s.icustay_id,
  [{', '.join(map(str, pool))}][l_suppkey % {len(pool)} + 1] AS itemid, l_shipdate AS charttime, s.intime, s.outtime,
  CAST(l_extendedprice / 100 AS VARCHAR) AS value, {R('l_extendedprice / 100')} AS valuenum, 'u' AS valueuom,
  CAST(NULL AS VARCHAR) AS flag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN s ON s.hadm_id = l_orderkey
WHERE epoch_us(l_shipdate) - epoch_us(s.intime) >= -3600000000
  AND epoch_us(s.outtime) - epoch_us(l_shipdate) >= -3600000000"""
