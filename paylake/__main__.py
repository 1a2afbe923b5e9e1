"""Command line: build the lake tables, report on them, or both.

    python -m paylake build RAW_DIR [--report OUT_DIR] [--database DB]
    python -m paylake report OUT_DIR [--database DB] [--role ROLE]

A report is one CSV folder per answer and check, written over an older one. The second form needs a catalog that
outlives the session; which one is used is left to the Spark configuration.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import replace

from pyspark.sql import SparkSession

from paylake.operators.accounts import BROADCAST_BYTES
from paylake.operators.governance import ANALYST_ROLE, CLEAR_ROLE
from paylake.plans import audit, medallion
from paylake.rules import Rules
from paylake.session import ENGINE_CONF
from paylake.sources.files import write_csv
from paylake.sources.lake import KEPT_VERSIONS

THRESHOLDS = ("baseline_days", "min_prior_days", "spike_factor", "burst_devices")


def write_report(
    spark: SparkSession, out_dir: str, rules: Rules, database: str | None, role: str
) -> None:
    views = audit.warehouse_views(spark, role, database)
    for name, df in {**audit.answers(views, rules), **audit.checks(spark, database)}.items():
        write_csv(df, f"{out_dir}/{name}", mode="overwrite")


def arguments(argv: list[str] | None) -> argparse.Namespace:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--database")
    common.add_argument("--role", choices=[ANALYST_ROLE, CLEAR_ROLE], default=ANALYST_ROLE)
    common.add_argument("--valid-from", default=Rules.valid_from)
    common.add_argument("--valid-to", default=Rules.valid_to)
    common.add_argument("--risk-merchants", nargs=2, metavar=("FROM", "TO"))
    common.add_argument("--unknown-account", default=Rules.unknown_account)
    for name in THRESHOLDS:
        common.add_argument(f"--{name.replace('_', '-')}", type=int, default=getattr(Rules, name))

    parser = argparse.ArgumentParser(prog="paylake")
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build", parents=[common])
    build.add_argument("raw_dir")
    build.add_argument("--report", metavar="OUT_DIR")
    build.add_argument("--check-accounts", action="store_true")
    build.add_argument("--silver-by-day", action="store_true")
    build.add_argument("--silver-tables", action="store_true")
    build.add_argument("--line-records", action="store_true", help="no quoted field holds a line break")
    build.add_argument("--published", metavar="DB", help="database of views masked by the reader's role")
    build.add_argument("--keep-versions", type=int, default=KEPT_VERSIONS)
    build.add_argument("--broadcast-bytes", type=int, default=BROADCAST_BYTES)
    report = commands.add_parser("report", parents=[common])
    report.add_argument("report", metavar="OUT_DIR")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    builder = SparkSession.builder.appName(f"paylake-{args.command}")
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    rules = Rules(
        valid_from=args.valid_from,
        valid_to=args.valid_to,
        unknown_account=args.unknown_account,
        **{name: getattr(args, name) for name in THRESHOLDS},
    )
    if args.risk_merchants:
        first, last = args.risk_merchants
        rules = replace(rules, risk_merchant_from=first, risk_merchant_to=last)

    if args.command == "build":
        counts = medallion.run(
            spark,
            args.raw_dir,
            rules,
            args.database,
            args.keep_versions,
            args.published,
            check_accounts=args.check_accounts,
            silver_by_day=args.silver_by_day,
            silver_tables=args.silver_tables,
            broadcast_bytes=args.broadcast_bytes,
            line_records=args.line_records,
        )
        print(json.dumps(counts.as_dict(), indent=2))
    if args.report:
        write_report(spark, args.report, rules, args.database, args.role)


if __name__ == "__main__":
    main()
