"""Summarise the physical plan of every catalogue query into PLANS.md.

    python tools/plan_report.py [--sf-dir DIR] [--out PLANS.md]

Per query: hash / range / round-robin shuffles, broadcasts, sorts, Python
evaluation nodes, jobs that ran while the query was built, and what each Parquet scan
reads (columns, pushed filters, partition filters).  Plans are taken before
execution, so they are the plans Catalyst chose for the input statistics.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    scans = []
    for m in re.finditer(r"FileScan (\w+) \[[^\]]*\].*?Location: \w+\(\d+ paths\)\[([^\]]*)\]"
                         r".*?PartitionFilters: \[([^\]]*)\], PushedFilters: \[([^\]]*)\], "
                         r"ReadSchema: (struct<[^\n]*)", plan):
        fmt, loc, pf, pushed, schema = m.groups()
        table = os.path.basename(loc.rstrip("/").split(",")[0]).replace(".parquet", "")
        if "conformkit" in loc:
            table = re.sub(r"-[0-9a-f]{32}.*", "", loc.split("conformkit/")[-1])
        cols = re.findall(r"(\w+):", schema[len("struct<"):])
        scans.append(f"{table}[{','.join(cols)}]" + (f" pushed({pushed})" if pushed else "")
                     + (f" partition({pf})" if pf else ""))
    if not scans and ("LocalTableScan" in plan or "ExistingRDD" in plan):
        scans.append("local rows: results computed when the query was built")
    return {
        "hash": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range": len(re.findall(r"Exchange rangepartitioning", plan)),
        "rr": len(re.findall(r"Exchange RoundRobinPartitioning", plan)),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "bcast": len(re.findall(r"BroadcastExchange", plan)),
        "python": len(re.findall(r"(?:BatchEvalPython|ArrowEvalPython|MapIn(?:Pandas|Arrow)|(?:FlatMap|FlatMapCo)GroupsIn(?:Pandas|Arrow))", plan)),
        "codegen": len(re.findall(r"\*\(\d+\)", plan)),
        "takeordered": "TakeOrderedAndProject" in plan,
        "scans": scans,
    }


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=os.path.join(os.path.dirname(os.path.dirname(
        os.path.abspath(__file__))), "PLANS.md"))
    a = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from conformkit.plans.catalog import entries

    spark = (SparkSession.builder.master("local[8]").appName("plan-report")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.maxMetadataStringLength", "100000")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    es = entries()
    lines = [
        "# Physical plans of the catalogue queries",
        "",
        f"Generated by `tools/plan_report.py` at `{a.sf_dir}` (plans before execution; AQE",
        "may still coalesce partitions or switch a join to broadcast at run time).",
        "Columns: shuffles by kind (hash = group/join key, range = global sort,",
        "rr = round-robin spread of an under-split input, single = gather to one",
        "partition), broadcast exchanges, Python evaluation nodes, and what each",
        "Parquet scan reads.  Scans of `conformkit/...` are round-trip files the",
        "query wrote itself.  eager = Spark jobs that ran while the query was built",
        "(writes of its round trip, passes of its aggregates, counts it needs); their",
        "plans are not shown.",
        "",
        "| query | operators | eager | hash | range | rr | single | bcast | python | scans |",
        "| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |",
    ]
    for name in sorted(es):
        spark.sparkContext.setJobGroup(name, name)
        df = es[name].fn(spark, a.sf_dir)
        eager = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        ops = " ".join(es[name].operators)
        scans = "<br>".join(s["scans"]) or "–"
        extra = " (top-n)" if s["takeordered"] else ""
        lines.append(f"| `{name}`{extra} | {ops} | {eager} | {s['hash']} | {s['range']} | {s['rr']} | "
                     f"{s['single']} | {s['bcast']} | {s['python']} | {scans} |")
    spark.stop()
    with open(a.out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print(f"wrote {a.out}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
