"""Command line: generate landed files, run the layers, reconcile, ask SQL."""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timezone

from .session import session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledgerline")
    sub = parser.add_subparsers(dest="command", required=True)
    g = sub.add_parser("generate", help="write landed files of an invented portfolio, and what they should lead to")
    g.add_argument("--out", required=True)
    g.add_argument("--accounts", type=int, default=500)
    g.add_argument("--seed", type=int, default=42)
    r = sub.add_parser("run", help="land, refine, check, publish and compute KPIs")
    r.add_argument("--landing", required=True)
    r.add_argument("--lake", required=True)
    r.add_argument("--batch")
    r.add_argument("--as-of", type=datetime.fromisoformat, help="the moment by which ages are judged, now if not given")
    r.add_argument("--summary", help="write the run's summary here as JSON")
    r.add_argument("--kpi-csv", help="write the KPI table here as CSV")
    c = sub.add_parser("reconcile", help="walk the legacy pack to the new figures")
    c.add_argument("--lake", required=True)
    c.add_argument("--out", help="folder of the reports")
    q = sub.add_parser("sql", help="ask the published tables")
    q.add_argument("--lake", required=True)
    q.add_argument("query")
    return parser


def main(arguments: list[str] | None = None) -> int:
    args = _parser().parse_args(arguments)
    spark = session()
    from .plans import reconciliation, runner
    from .sources import exports, generate
    from .sources.catalog import Catalog

    if args.command == "generate":
        print(json.dumps(generate.landing(spark, args.out, args.accounts, args.seed), indent=2))
        return 0
    catalog = Catalog(spark, args.lake)
    if args.command == "run":
        batch = args.batch or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S")
        done = runner.run(catalog, args.landing, batch, as_of=args.as_of)
        rows = {"batch": batch, "bronze": done["bronze"], "silver": {r[1]: dict(zip(("bronze", "control", "quarantined", "duplicates", "silver"), r[2:7])) for r in done["silver"]}, "gold": {t: catalog.read(t).count() for t in catalog.tables() if t.startswith(("dim_", "fact_", "fx_", "gold_"))}}
        if args.kpi_csv:
            rows["kpi_rows"] = exports.kpi_csv(catalog, args.kpi_csv)
        if args.summary:
            exports.json_file(spark, rows, args.summary)
        print(json.dumps(rows, indent=2))
    elif args.command == "reconcile":
        print(json.dumps(reconciliation.run(catalog, args.out), indent=2, default=str))
    else:
        catalog.sql(args.query).show(100, False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
