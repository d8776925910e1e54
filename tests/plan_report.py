"""Write PLANS.md: physical-plan features of every registered query.

Usage: python tests/plan_report.py [sf_dir]   (default /root/testdata/sf0.01)

For each query the executed plan (before AQE re-planning) is summarised:
Parquet scans of tables, the most columns that one of them reads, reads of
written stages (and their most columns), shuffles, broadcasts, windows, sorts
and joins.  Jobs that write stages while the plan is built are not part of it.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def columns(schema: str) -> int:
    """Top-level fields of a ReadSchema text."""
    depth, n = 0, 1 if schema else 0
    for c in schema:
        depth += (c == "<") - (c == ">")
        n += c == "," and depth == 0
    return n


def features(plan: str) -> dict[str, object]:
    tables = sorted(set(re.findall(r"/([a-z]+)\.parquet", plan)))
    scans = [x for x in plan.split("\n") if "FileScan parquet" in x]
    width = {x: columns(m[1]) if (m := re.search(r"ReadSchema: struct<(.*)>", x)) else 0 for x in scans}
    stages = [x for x in scans if "/evseq-" in x]
    return {
        "parquet scans": len(scans) - len(stages),
        "columns": max([width[x] for x in scans if x not in stages], default=0),
        "tables": ", ".join(tables),
        "stage reads": len(stages),
        "stage columns": max([width[x] for x in stages], default=0),
        "shuffles": len(re.findall(r"Exchange (?:hash|range|Single|Round)", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "sorts": len(re.findall(r"\bSort \[", plan)),
        "joins": ", ".join(
            f"{n}×{k}" for k, n in sorted(
                {k: len(re.findall(k, plan)) for k in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct")}.items()
            ) if n
        ),
        "pushed filters": "yes" if re.search(r"PushedFilters: \[[^\]]", plan) else "",
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from evseq.plans.catalog import QUERIES
    from evseq.session import local_session

    spark = local_session(cpus=os.environ.get("BENCH_CPUS", "*"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    cols = ["parquet scans", "columns", "tables", "stage reads", "stage columns", "shuffles", "broadcasts", "windows", "sorts", "joins", "pushed filters"]
    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `tests/plan_report.py` on `{os.path.basename(sf)}` (`local[*]`, 8 shuffle partitions, AQE on).",
        "Counts are taken from the plan before adaptive re-planning (AQE may still turn a",
        "sort-merge join into a broadcast join at runtime). `stage reads` are reads of",
        "Parquet written while the query was built; `columns` and `stage columns` are the",
        "most columns that one scan reads.",
        "",
        "| query | " + " | ".join(cols) + " |",
        "| --- | " + " | ".join("---" for _ in cols) + " |",
    ]
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        f = features(buf.getvalue())
        lines.append(f"| {name} | " + " | ".join(str(f[c]) for c in cols) + " |")
        print(name, f, flush=True)
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(out, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
