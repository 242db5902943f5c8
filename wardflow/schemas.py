"""Explicit schemas at every boundary (no inference, stable pivot columns)."""

from __future__ import annotations

from pyspark.sql import types as T

I, L, D, S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
TS = T.TimestampNTZType()


def _struct(spec: str, not_null: tuple[str, ...] = ()) -> T.StructType:
    types = {"int": I, "long": L, "double": D, "string": S, "ts": TS}
    fields = []
    for part in spec.split(","):
        name, typ = part.split()
        fields.append(T.StructField(name, types[typ], name not in not_null))
    return T.StructType(fields)


PATIENTS = _struct("subject_id int, gender string, dob ts")
ICUSTAYS = _struct(
    "subject_id int, hadm_id int, icustay_id int, dbsource string, first_careunit string, "
    "last_careunit string, first_wardid int, last_wardid int, intime ts, outtime ts, los double")
CHARTEVENTS = _struct(
    "row_id int, subject_id int, hadm_id int, icustay_id int, itemid int, charttime ts, "
    "storetime ts, cgid int, value string, valuenum double, valueuom string, warning int, "
    "error int, resultstatus string, stopped string")
LABEVENTS = _struct(
    "subject_id int, hadm_id int, itemid int, charttime ts, value string, valuenum double, "
    "valueuom string, flag string")
OUTPUTEVENTS = _struct(
    "row_id int, subject_id int, hadm_id int, icustay_id int, charttime ts, itemid int, "
    "value double, valueuom string, storetime ts, cgid int, stopped string, newbottle string, "
    "iserror int")
INPUTEVENTS_CV = _struct(
    "row_id int, subject_id int, hadm_id int, icustay_id int, charttime ts, itemid int, "
    "amount double, amountuom string, rate double, rateuom string, storetime ts, cgid int, "
    "orderid int, linkorderid int, stopped string, newbottle int, originalamount double, "
    "originalamountuom string, originalroute string, originalrate double, "
    "originalrateuom string, originalsite string")
INPUTEVENTS_MV = _struct(
    "row_id int, subject_id int, hadm_id int, icustay_id int, starttime ts, endtime ts, "
    "itemid int, amount double, amountuom string, rate double, rateuom string, storetime ts, "
    "cgid int, orderid int, linkorderid int, ordercategoryname string, "
    "secondaryordercategoryname string, ordercomponenttypedescription string, "
    "ordercategorydescription string, patientweight double, totalamount double, "
    "totalamountuom string, isopenbag int, continueinnextdept int, cancelreason int, "
    "statusdescription string, comments_editedby string, comments_canceledby string, "
    "comments_date ts, originalamount double, originalrate double")

FEATURE_DICTIONARY = _struct(
    "item_idx int, item_cat string, median_value double, mean_value double, item_unit string",
    not_null=("item_idx", "item_cat", "item_unit"))

# Long (entity-attribute-value) event rows shared by all eight branches.
LONG = _struct(
    "subject_id long, hadm_id long, icustay_id long, itemcat string, itemid int, "
    "charttime ts, cvalue string, valuenum double, valueuom string")

WINDOW_HOURS = (1, 3, 6, 12, 24)
