"""Print the formatted physical plans of the main steps over stored layers.

usage: python tools/explain_plans.py [sf_dir]

Builds the staging layer and the universe once in a scratch folder under the
session's checkpoint folder, then explains the universe, metrics and rankings
plans (AQE off, so the static plan is shown).
"""

from __future__ import annotations

import os
import sys
import uuid

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    from tidemark.plans import metrics as M
    from tidemark.plans import rankings as R
    from tidemark.plans import universe as U
    from tidemark.plans.run import LayerRun
    from tidemark.session import build_session, shared_path
    from tidemark.settings import fixture_settings

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    run = LayerRun(spark, sf, shared_path(spark, f"explain-{uuid.uuid4().hex}"), fixture_settings())
    run.stage_quotes()
    run.stage_dimensions()
    run.build_universe()
    run.build_metrics()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    st = run.settings
    plans = {
        "universe": U.build_universe(run.snap("registry").drop("reference_date"), run.snap("fees").drop("reference_date"),
                                     run.quotes(hi=st.reference_date), run.snap("anbima").drop("reference_date"), st,
                                     stats=run.universe_stats()),
        "metrics": M.build_metrics(run.quotes(M.quotes_start(st), st.reference_date), run.mart("universe"), run.cdi(), st),
        "rankings": R.build_rankings(run.mart("metrics"), st),
    }
    for name, df in plans.items():
        print(f"\n===== {name} =====")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
