"""Summarise the executed (adaptive, final) physical plan of catalogue queries.

usage: python tools/plan_summary.py [sf_dir] [name ...] > PLANS.md
Per query: parquet scans with the columns they read and pushed filters,
shuffle exchanges by kind, join strategies, window / aggregate / Python
nodes.  Runs each query once into the noop sink first so AQE's final plan
is what is reported.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NODES = ["SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "Window", "HashAggregate", "ObjectHashAggregate", "SortAggregate",
         "MapInPandas", "TakeOrderedAndProject", "Generate", "Sort"]


def summarise(df) -> dict:
    df.write.format("noop").mode("overwrite").save()
    jvm = df.sparkSession._jvm
    text = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    final = text.split("== Final Plan ==")[-1] if "== Final Plan ==" in text else text
    tree = final.split("\n\n")[0].split("== Initial Plan ==")[0]
    ids = set(re.findall(r"\((\d+)\)", tree))
    scans = []
    for m in re.finditer(r"\(\d+\) Scan parquet [^\n]*\n(.*?)(?:\n\n|\Z)", final, re.S):
        body = m.group(1)
        loc = re.search(r"Location: \w+ \[([^\]]*)\]", body)
        path = loc.group(1).split(",")[0] if loc else "?"
        table = os.path.basename(path)
        if re.fullmatch(r"[0-9a-f]{32}", table):          # a materialised table's run folder
            table = os.path.basename(os.path.dirname(path)) + " (materialised)"
        rs = re.search(r"ReadSchema: struct<([^>]*)>", body)
        cols = [c.split(":")[0] for c in rs.group(1).split(",")] if rs else []
        pf = re.search(r"PushedFilters: \[([^\]]*)\]", body)
        scans.append((table, cols, pf.group(1) if pf else ""))
    ex = Counter()
    for m in re.finditer(r"\((\d+)\) Exchange\n(.*?)(?:\n\n|\Z)", final, re.S):
        if m.group(1) not in ids:
            continue
        arg = re.search(r"Arguments: (\w+)", m.group(2))
        kind = arg.group(1) if arg else "?"
        ex[kind.replace("partitioning", "").replace("Partitioning", "") or kind] += 1
    nodes = Counter()
    for n in NODES:
        nodes[n] = len(re.findall(rf"(?<![A-Za-z]){n}\b[^\n(]*\(\d+\)", tree))
    return {"scans": [s for s in scans], "exchanges": dict(ex),
            "broadcasts": len(re.findall(r"BroadcastExchange[^\n(]*\(\d+\)", tree)),
            "nodes": {k: v for k, v in nodes.items() if v}}


def main():
    from wardflow.plans import catalogue
    from wardflow.session import local_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(catalogue.QUERIES)
    spark = local_session(8, 8)
    print(f"# Executed plans ({os.path.basename(sf)}, local[8], AQE final plans)\n")
    print("Generated by `python tools/plan_summary.py`.  Shuffle exchanges exclude "
          "broadcasts; `scans` lists each parquet scan with the columns it reads.\n")
    print("| query | scans (table: columns read; pushed filters) | shuffles | broadcasts "
          "| operators |")
    print("| --- | --- | --- | --- | --- |")
    for n in names:
        try:
            s = summarise(catalogue.QUERIES[n](spark, sf))
        except Exception as e:  # noqa: BLE001
            print(f"| {n} | error: {type(e).__name__} | | | |")
            continue
        scans = "<br>".join(f"{t}: {', '.join(c)}" + (f"; {f}" if f else "") for t, c, f in s["scans"])
        shuf = ", ".join(f"{k} x{v}" for k, v in s["exchanges"].items()) or "none"
        ops = ", ".join(f"{k} x{v}" for k, v in s["nodes"].items())
        print(f"| {n} | {scans} | {shuf} | {s['broadcasts']} | {ops} |")
    spark.stop()


if __name__ == "__main__":
    main()
