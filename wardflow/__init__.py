"""wardflow: irregular event logs -> regular per-stay feature matrices on Spark.

Every public function takes and returns a DataFrame (or Column) and builds a
lazy plan; nothing is collected unless a function says so explicitly.

Sub-packages:
  sources    table loading, the fixed feature dictionary, materialisation,
             analogue views over the driver's test tables
  functions  Column-level helpers (epoch/time windows, unit rules, step
             scores, array maths)
  operators  DataFrame -> DataFrame operators (cohort, semi joins, interval
             join, harmonisation, aggregation/pivot, LOCF/impute/mask,
             vocabulary, batch sequence scoring)
  plans      assembled feature plans and the query catalogue
  streaming  incremental refresh of the windowed event table
"""

__version__ = "0.1.0"
