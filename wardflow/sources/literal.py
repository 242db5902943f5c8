"""Small literal tables as JVM-side local relations.

``spark.sql("SELECT * FROM VALUES ...")`` plans as a LocalTableScan: no
Python worker, no RDD, and Catalyst knows its exact (tiny) size, so joins
against it are broadcast without a hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _lit_sql(v, t: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {t.simpleString()})"
    if isinstance(t, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(t, T.BooleanType):
        return "true" if v else "false"
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return f"CAST('{float(v)!r}' AS DOUBLE)"
    return f"CAST({int(v)} AS {t.simpleString()})"


def local_table(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    """Rows + schema -> DataFrame backed by an inline VALUES relation."""
    names = [f.name for f in schema.fields]
    if not rows:
        return spark.createDataFrame([], schema)
    values = ",\n".join("(" + ", ".join(_lit_sql(v, f.dataType)
                                         for v, f in zip(r, schema.fields)) + ")" for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
