"""Command line.

    python -m risklake build   LAKE CSV [--bounds KEY=VALUE ...]
    python -m risklake reports LAKE OUT     one CSV folder per analysis
    python -m risklake panels  LAKE OUT     one JSON folder per panel
    python -m risklake model   LAKE OUT     odds ratios, metrics, captures as CSV

LAKE, CSV and OUT are folders (or files) every executor can reach.
"""

from __future__ import annotations

import argparse
from dataclasses import fields, replace

from risklake.config import RuleBounds
from risklake.operators.ranking import capture_top
from risklake.plans import model
from risklake.plans.catalog import CATALOG
from risklake.plans.lakehouse import Lake
from risklake.session import build_session
from risklake.sources.exports import write_panel_json, write_result_csv

REPORTS = (
    "a0 a1a a1b a1c a1d a2 a3a a3b a4a a4b a4c a4d a4e a5a a5b_auc a5b_chi2 a5c fraud_by_type "
    "mom_rate auc_by_month"
).split()
PANELS = (
    "panel_cube panel_kpis panel_monthly rolling7_rate rolling7_by_channel panel_bars_channel "
    "panel_bars_category panel_bars_segment panel_heat_channel_category panel_heat_hour_dow "
    "panel_smallcell_rollup capture_curve panel_cutoff panel_table engine_point risk_cube_all"
).split()


def parse_bounds(pairs: list[str]) -> RuleBounds:
    kinds = {f.name: type(f.default) for f in fields(RuleBounds)}
    given = dict(p.split("=", 1) for p in pairs)
    return replace(RuleBounds(), **{k: kinds[k](v) for k, v in given.items()})


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="risklake", description=__doc__)
    parser.add_argument("command", choices=("build", "reports", "panels", "model"))
    parser.add_argument("lake")
    parser.add_argument("target")
    parser.add_argument("--bounds", nargs="*", default=[])
    parser.add_argument("--master")
    args = parser.parse_args(argv)
    spark = build_session(args.master)
    lake = Lake(spark, args.lake.rstrip("/"), parse_bounds(args.bounds))
    if args.command == "build":
        lake.build_from_csv(args.target).show(truncate=False)
        CATALOG["row_funnel"](lake).show(truncate=False)
        CATALOG["rule_hits"](lake).show(truncate=False)
    elif args.command == "reports":
        for name in REPORTS:
            write_result_csv(CATALOG[name](lake), f"{args.target}/{name}")
    elif args.command == "panels":
        for name in PANELS:
            write_panel_json(CATALOG[name](lake), f"{args.target}/{name}")
    else:
        scored = model.scored_test(lake)
        captures = [
            capture_top(scored, s, "transaction_id", "is_fraud") for s in ("p_fraude", "risk_score")
        ]
        write_result_csv(model.odds_ratios(spark, model.lake_glm(lake)), f"{args.target}/odds_ratios")
        write_result_csv(model.evaluation(scored), f"{args.target}/metricas")
        for name, df in zip(("modelo", "risk_score"), captures):
            write_result_csv(df, f"{args.target}/captura_{name}")


if __name__ == "__main__":
    main()
