"""Run a training-data query and its oracle SQL side by side."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from oracle_check import digest, duck  # noqa: E402

from wardflow.llm import queries  # noqa: E402


def assert_same(spark, name, sf):
    df = queries.QUERIES[name](spark, sf)
    cur = duck(sf).execute(queries.ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    a, b = digest(df.columns, [tuple(r) for r in df.collect()])[1], digest(cols, cur.fetchall())[1]
    assert len(a) == len(b)
    assert a == b, ([x for x in a if x not in b][:3], [x for x in b if x not in a][:3])
