"""Command line: load and transform one batch, re-run one, refresh the aggregate, report.

    python -m vitrine run      --root ROOT --feeds DIR [--as-of YYYY-MM-DD] [--strict] [--bridge]
    python -m vitrine rerun    --root ROOT --batch N
    python -m vitrine hourly   --root ROOT
    python -m vitrine health   --root ROOT
    python -m vitrine steps    --root ROOT --batch N
    python -m vitrine watch    --root ROOT --landing DIR
    python -m vitrine report   --root ROOT --name top_categories|monthly_revenue|late_rate_by_state|constraint_errors
    python -m vitrine prune    --root ROOT --keep N
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="vitrine")
    ap.add_argument("command", choices=["run", "rerun", "hourly", "health", "steps", "watch", "report", "prune"])
    ap.add_argument("--root", required=True, help="warehouse root folder (shared storage)")
    ap.add_argument("--feeds", help="folder with the nine feed files (default: rows staged as batch 0)")
    ap.add_argument("--landing", help="folder that receives feed drops (watch)")
    ap.add_argument("--batch", type=int)
    ap.add_argument("--as-of", dest="as_of")
    ap.add_argument("--strict", action="store_true")
    ap.add_argument("--bridge", action="store_true", help="resolve orders through the customer unique id")
    ap.add_argument("--triggered-by", default="CLI")
    ap.add_argument("--error-limit", type=int, help="rejected rows of a feed that stop the run (default: no limit)")
    ap.add_argument("--keep", type=int, help="versions to keep (prune)")
    reports = ["top_categories", "monthly_revenue", "late_rate_by_state", "constraint_errors"]
    ap.add_argument("--name", choices=reports, default=reports[0])
    a = ap.parse_args(argv)

    from vitrine.plans.pipeline import Pipeline, RunOptions
    from vitrine.session import get_session

    spark = get_session()
    opts = RunOptions(
        as_of=a.as_of, strict=a.strict, customer_lookup="bridge" if a.bridge else "customer_id", error_limit=a.error_limit
    )
    p = Pipeline(spark, a.root, opts)
    if a.command == "run":
        print(f"batch {p.run_pipeline(a.triggered_by, feeds_dir=a.feeds)} loaded")
        p.health_check().show(truncate=False)
    elif a.command == "rerun":
        p.rerun_batch(a.batch)
        p.step_detail(a.batch).show(truncate=False)
    elif a.command == "hourly":
        print(f"batch {p.refresh_hourly(a.triggered_by)} refreshed the daily aggregate")
    elif a.command == "health":
        p.health_check().show(truncate=False)
    elif a.command == "steps":
        p.step_detail(a.batch).show(truncate=False)
    elif a.command == "report":
        getattr(p, a.name)().show(1000, truncate=False)
    elif a.command == "prune":
        print(p.prune(a.keep or 1))
    elif a.command == "watch":
        from vitrine.streaming.feed_watch import watch_feeds

        watch_feeds(spark, a.landing, a.root, options=opts)
        p.health_check().show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
