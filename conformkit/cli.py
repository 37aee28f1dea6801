"""Command line for the three configured jobs (run under spark-submit).

    python -m conformkit mapping  CONFIG [--key K ...] [--measure NAME=FUNC:COLUMN ...] [--show N]
    python -m conformkit rollup   CONFIG --key K ... --measure NAME=FUNC:COLUMN ... [--show N]
    python -m conformkit services CONFIG [--run-date YYYY-MM-DD] --register MODULE ...

``services`` imports the modules named with ``--register`` (code the operator
chose on the command line); their ``@service`` factories are then looked up by
the names the services config lists.  Nothing named in a config file is
imported.  The session comes from ``SparkSession.builder.getOrCreate()``, i.e.
from spark-submit's configuration.
"""

from __future__ import annotations

import argparse
import importlib
import sys
from collections.abc import Sequence

from conformkit.specs import MeasureSpec, SpecError


def parse_measure(text: str) -> MeasureSpec:
    """``name=func:column`` or ``name=count_star``."""
    try:
        name, rest = text.split("=", 1)
        func, _, column = rest.partition(":")
    except ValueError:
        raise SpecError(f"measure {text!r}: expected NAME=FUNC:COLUMN") from None
    return MeasureSpec(name.strip(), func.strip().lower(), column.strip() or None)


def build_parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="conformkit")
    sub = ap.add_subparsers(dest="command", required=True)
    for name in ("mapping", "rollup"):
        p = sub.add_parser(name)
        p.add_argument("config")
        p.add_argument("--key", action="append", default=None)
        p.add_argument("--measure", action="append", type=parse_measure, default=None)
        p.add_argument("--show", type=int, default=20)
    p = sub.add_parser("services")
    p.add_argument("config")
    p.add_argument("--run-date", default=None)
    p.add_argument("--register", action="append", default=[])
    p.add_argument("--ledger", default=None, help="folder of markers; finished jobs are skipped")
    p.add_argument("--force", action="store_true", help="run finished jobs again")
    sub.add_parser("clean", help="delete the scratch folders and tables of all runs")
    return ap


def main(argv: Sequence[str] | None = None, spark=None) -> int:
    a = build_parser().parse_args(argv)
    if spark is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.appName(f"conformkit-{a.command}").getOrCreate()

    if a.command == "mapping":
        from conformkit.plans.mapping import load_mapping, run_mapping
        out = run_mapping(spark, load_mapping(spark, a.config), keys=a.key, measures=a.measure)
        out.show(a.show, truncate=False)
    elif a.command == "rollup":
        from conformkit.plans.rollup import run_rollup
        if not a.key or not a.measure:
            raise SpecError("rollup needs --key and --measure")
        run_rollup(spark, a.config, a.key, a.measure).show(a.show, truncate=False)
    elif a.command == "services":
        from conformkit.plans.jobs import run_services
        for module in a.register:
            importlib.import_module(module)
        for r in run_services(spark, a.config, a.run_date, a.ledger, a.force):
            print(f"{r.load_type:11s} {r.target} {r.run_date}{' (done before)' if r.skipped else ''}")
    else:
        from conformkit.session import clean_scratch
        for path in clean_scratch(spark):
            print(f"deleted {path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
