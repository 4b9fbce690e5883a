"""Command-line entry for one daily run (spark-submit friendly).

    spark-submit hourcast/__main__.py --warehouse s3a://b/wh --landing 's3a://b/landing/*.json' \\
        --as-of 2024-01-31 --days 30

Exactly one of --landing / --csv.  Prints the run's quality-report summary
(single-row reports only) as JSON lines.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="hourcast", description=__doc__.splitlines()[0])
    ap.add_argument("--warehouse", required=True)
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--landing", help="landed JSON documents (path or glob)")
    src.add_argument("--csv", help="processed CSV (path or glob)")
    ap.add_argument("--json-lines", action="store_true",
                    help="landing files hold one document per line")
    ap.add_argument("--as-of", help="keep the last --days complete UTC days before this date")
    ap.add_argument("--days", type=int, default=30)
    ap.add_argument("--expected-rows", type=int, default=None)
    ap.add_argument("--full", action="store_true", help="re-read whole tables (no day scope)")
    ap.add_argument("--register", action="store_true", help="register catalog tables")
    ap.add_argument("--no-jitter", action="store_true")
    a = ap.parse_args(argv)

    from hourcast.plans import daily
    from hourcast.plans.ingest import weather_from_landing
    from hourcast.session import build_session
    spark = build_session(app_name="hourcast-daily")
    kw = {}
    if a.landing:
        kw["weather"] = weather_from_landing(spark, a.landing, multi_line=not a.json_lines)
    else:
        kw["csv"] = a.csv
    res = daily.run(spark, a.warehouse, expected_rows=a.expected_rows, jitter=not a.no_jitter,
                    incremental=not a.full, register_tables=a.register, as_of=a.as_of,
                    n_days=a.days, **kw)
    for name in ("fact_grain", "missing_dim_keys", "value_order", "energy_profile",
                 "weather_profile"):
        row = res.reports[name].first()
        print(json.dumps({"report": name, **{k: (v if isinstance(v, (int, float, str))
                                                 or v is None else str(v))
                                             for k, v in row.asDict().items()}}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
