"""Headline queries, timed.  Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from phasewise.session import local_session  # noqa: E402
from phasewise.workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "stu_survey_compliance",
    "stu_survey_days",
    "stu_goodness",
    "stu_selection",
    "stu_endorsement",
    "stu_completion",
    "stu_engagement",
    "stu_outcomes",
    "stu_promis",
    "stu_demographics",
    "stu_device_avg",
    "agg_cond_distinct",
    "agg_level_overall",
    "win_midrank",
    "jn_interval",
    "dt_interval_days",
    "st_paired_t",
    "st_rm_anova",
    "st_ranksum",
    "tab_summary",
    "tab_characteristics",
    "tab_anova",
    "dev_hr",
    "dev_bouts",
    "dev_calories",
    "dev_sleep_stages",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", cores=os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            begun = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begun)
        seconds[name] = round(min(taken[1:] or taken), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
