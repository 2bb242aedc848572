"""Command line: ``python -m tidewater migrate --settings db_config.ini ...``.

Runs every table routed by the ``[migration]`` section once and prints the
per-table summary. Sources are files under ``--source-root`` (parquet by
default) or, with ``--source-format jdbc``, tables reached through the
connection settings section named by ``--connection`` (``oracle``/``mysql``).
"""

from __future__ import annotations

import argparse
import sys

from tidewater.plans.migration import migrate_all
from tidewater.session import build_session
from tidewater.sources.tables import connection_options
from tidewater.spec import MigrationSpec, settings_from_ini


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidewater")
    sub = parser.add_subparsers(dest="command", required=True)
    m = sub.add_parser("migrate", help="run the incremental migration once")
    m.add_argument("--settings", required=True, help="INI file with a [migration] section")
    m.add_argument("--source-root", default="", help="folder holding source tables (file formats)")
    m.add_argument("--target-root", required=True, help="folder holding published target tables")
    m.add_argument("--state-path", default=None, help="control table location")
    m.add_argument("--source-format", default="parquet")
    m.add_argument("--connection", default=None, help="settings section with JDBC settings")
    m.add_argument("--master", default=None, help="Spark master when no session exists yet")
    args = parser.parse_args(argv)

    spark = build_session(args.master)  # without --master the submitter's choice stands
    options = (connection_options(settings_from_ini(args.settings, args.connection), args.connection)
               if args.connection else {})
    spec = MigrationSpec.from_settings(settings_from_ini(args.settings), source_root=args.source_root,
                                       target_root=args.target_root, state_path=args.state_path,
                                       source_format=args.source_format, source_options=options)
    rows = migrate_all(spark, spec).collect()
    for r in rows:
        print(f"{r['table_name']}\t{r['status']}\trows={r['rows']}\taffected={r['affected']}"
              f"\tfailed={r['failed']}\tmark={r['mark']}")
    return 0 if all(r["status"] != "failed" for r in rows) else 1


if __name__ == "__main__":
    sys.exit(main())
