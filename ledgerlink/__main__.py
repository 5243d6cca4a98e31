"""Job entry: ``spark-submit ... -m ledgerlink COMMAND`` or ``python -m ledgerlink``.

Each command works on the tables below ``--tables``, so that a run can be split into
steps of their own; a failed check ends with a message and a non-zero status.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import SparkSession

from ledgerlink import fixed_values as fv
from ledgerlink.config import Expected
from ledgerlink.plans import run as plans
from ledgerlink.sources.specs import SourceSpec
from ledgerlink.sources.store import TableStore


def _sources(args: argparse.Namespace) -> list[SourceSpec]:
    pairs = (item.partition("=") for item in args.source)
    return [SourceSpec(name, path, args.format) for name, _, path in pairs]


def _expected(text: str) -> Expected:
    """Expected values from a JSON object, or the published ones by that name."""
    if text == "published":
        return Expected.published()
    values = json.loads(text, parse_float=Decimal)
    if values.get("total_revenue") is not None:
        values["total_revenue"] = Decimal(str(values["total_revenue"]))
    return Expected(**values)


def _step(text: str) -> tuple[str, str]:
    name, _, query = text.partition("=")
    return name.strip(), query.strip()


def parser() -> argparse.ArgumentParser:
    result = argparse.ArgumentParser(prog="ledgerlink", description=__doc__)
    commands = result.add_subparsers(dest="command", required=True)

    def command(name: str, help_text: str) -> argparse.ArgumentParser:
        added = commands.add_parser(name, help=help_text)
        added.add_argument("--out", required=True, help="folder for results")
        added.add_argument("--database", default="default")
        added.add_argument("--buckets", type=int)
        if name != "run":
            added.add_argument("--tables", required=True, help="folder of the tables")
        if name in ("stage", "run"):
            added.add_argument(
                "--source", action="append", required=True, metavar="NAME=PATH"
            )
            added.add_argument("--format", default="parquet")
        if name in ("validate", "run"):
            added.add_argument(
                "--expected", required=True,
                help="JSON object of expected values, or 'published' for those of the "
                "original data set",
            )
        return added

    command("stage", "store the sources as text tables")
    sql = command("sql", "store the results of SELECT statements as tables")
    sql.add_argument("--step", action="append", required=True, metavar="TABLE=SELECT")
    build = command("build", "build the tables of one step")
    build.add_argument("--step", choices=sorted(_BUILDS), required=True)
    command("segment", "score, segment and export the segments")
    validate = command("validate", "run the checks of a stage")
    validate.add_argument("--stage", choices=["all", *fv.STAGES], default="all")
    command("export", "write the revenue report")
    command("run", "run everything, gated after every stage")
    return result


_BUILDS = {
    "clean": plans.build_clean,
    "dedup": plans.build_dedup,
    "merge": plans.build_merged,
    "revenue": plans.build_revenue,
}


def execute(spark: SparkSession, args: argparse.Namespace) -> object:
    """Run a command; the result is small enough to print."""
    if args.command == "run":
        return plans.run(
            spark,
            _sources(args),
            args.out,
            _expected(args.expected),
            args.database,
            args.buckets,
        )
    store = TableStore(spark, args.tables, args.database, args.buckets)
    plans.attach_existing(store)
    if args.command == "stage":
        return plans.stage(store, _sources(args), args.out)
    if args.command == "sql":
        return sorted(store.run_steps([_step(text) for text in args.step]))
    if args.command == "build":
        _BUILDS[args.step](store)
        return {"built": args.step}
    if args.command == "segment":
        return plans.build_segments(store, args.out)
    if args.command == "export":
        return plans.export(store, args.out)
    return plans.validate_stage(store, args.stage, _expected(args.expected), args.out)


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("ledgerlink").getOrCreate()
    try:
        result = execute(spark, args)
    except (ValueError, FileNotFoundError) as error:
        print(error, file=sys.stderr, flush=True)
        return 1
    print(json.dumps(result, ensure_ascii=False, indent=2, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
