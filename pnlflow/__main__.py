"""The job for spark-submit: ``spark-submit pnlflow/__main__.py --input ledger_lines=... --target ...``.

Every run parameter of ``JobParams`` is an option; without it the default holds."""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import sys
from pathlib import Path

if __package__ in (None, ""):  # run as a file
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from pnlflow.operators.joins import clear_stored  # noqa: E402
from pnlflow.plans.pipeline import full_pnl  # noqa: E402
from pnlflow.rules import JobParams  # noqa: E402
from pnlflow.session import JOB_CONF, ensure_checkpoint_dir  # noqa: E402
from pnlflow.plans.figures import Figures  # noqa: E402
from pnlflow.sources.inputs import INPUT_NAMES, read_inputs  # noqa: E402
from pnlflow.sources.results import replace_periods, replace_result  # noqa: E402


def _value(text: str, default: object) -> object:
    if isinstance(default, dt.date):
        return dt.date.fromisoformat(text)
    return tuple(x for x in text.split(",") if x) if isinstance(default, tuple) else text


def parse(argv: list[str]) -> tuple[argparse.Namespace, JobParams]:
    p = argparse.ArgumentParser(prog="pnlflow", description="Customer-by-product P&L job")
    p.add_argument("--input", action="append", default=[], metavar="NAME=LOCATION", help=f"one for each of {', '.join(INPUT_NAMES)}; planning_account_hier is optional")
    p.add_argument("--column", action="append", default=[], metavar="NAME.COLUMN=SOURCE", help="a logical column's name in its source")
    p.add_argument("--format", default="parquet", help="format of the inputs, or 'table' for catalog tables")
    p.add_argument("--target", required=True, help="path or table to replace; the old result stays until the new one is complete")
    p.add_argument("--as-table", action="store_true")
    p.add_argument("--periods-only", action="store_true", help="replace only the periods of this run in a target folder laid out by period")
    p.add_argument("--strict", action="store_true", help="fail if a conservation figure does not agree")
    defaults = JobParams()
    for f in dataclasses.fields(JobParams):
        p.add_argument("--" + f.name.replace("_", "-"), default=None, help=f"default: {getattr(defaults, f.name)}")
    a = p.parse_args(argv)
    given = {f.name: _value(getattr(a, f.name), getattr(defaults, f.name)) for f in dataclasses.fields(JobParams) if getattr(a, f.name) is not None}
    locations = dict(x.split("=", 1) for x in a.input)
    if missing := [n for n in INPUT_NAMES if n not in locations]:
        p.error(f"no --input for {', '.join(missing)}")
    a.locations, a.columns = locations, {}
    for x in a.column:
        name, source = x.split("=", 1)
        table, column = name.split(".", 1)
        a.columns.setdefault(table, {})[column] = source
    return a, JobParams(**given)


def show(figures: Figures, strict: bool) -> None:
    """Print what each step conserved; runs before the old result goes."""
    for line in figures.report(strict):
        print(line)


def main(argv: list[str], spark: SparkSession | None = None) -> None:
    a, params = parse(argv)
    if spark is None:
        builder = SparkSession.builder.appName("pnlflow")
        for k, v in JOB_CONF.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    try:
        figures = Figures()
        result = full_pnl(read_inputs(spark, a.locations, a.format, a.columns), params, figures)
        if a.periods_only:
            replace_periods(result, a.target, lambda rows: show(figures, a.strict))
        else:
            replace_result(result, a.target, a.as_table, lambda rows: show(figures, a.strict))
    finally:
        clear_stored(spark)


if __name__ == "__main__":
    main(sys.argv[1:])
