"""Print the physical plans of the key jobs (formatted or compact).

usage: python scripts/show_plans.py [sf_dir] [formatted|simple]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from acctpulse.config import FIXTURE_CONFIG as CFG  # noqa: E402
from acctpulse.operators import engagement as E  # noqa: E402
from acctpulse.operators.mart import MART_COLUMNS, account_base, exclude_shells, score_base, stage_all  # noqa: E402
from acctpulse.session import build_session  # noqa: E402
from acctpulse.sources.fixtures import raw_tables  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    mode = sys.argv[2] if len(sys.argv) > 2 else "simple"
    spark = build_session(extra={"spark.ui.showConsoleProgress": "false"})
    staged = stage_all(raw_tables(spark, sf_dir), CFG)
    jobs = {
        "stg_submissions (ghost filter + dedup)": staged.submissions,
        "engagement_summary (fused, one event pass)": E.engagement_summary(staged.submissions, CFG),
        "period_metrics (plain, for comparison)": E.period_metrics(E.tag_periods(staged.submissions, CFG), CFG),
    }
    base = account_base(staged, CFG)
    jobs["account_score_mart (after the account base is written)"] = exclude_shells(
        score_base(base, CFG, staged.n_peer_groups, n_accounts=staged.n_accounts)).select(*MART_COLUMNS)
    for title, df in jobs.items():
        print(f"\n===== {title} =====")
        df.explain(mode)
    spark.stop()


if __name__ == "__main__":
    main()
