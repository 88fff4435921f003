"""Time headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from matchwright import session
from matchwright.queries import QUERIES

HEADLINE = [
    "link_all_passes",
    "rank_links",
    "round_block_links",
    "linkage_summary",
    "roll_up",
    "champion_stats",
    "bracket_codes",
    "clean_job",
    "gate_violations",
    "quality_report",
    "score_features",
    "name_fold",
    "name_compatible",
    "interval_join",
    "second_chance",
    "greedy_match",
    "alias_linker",
    "upsert_last",
    "priority_merge",
    "dedupe_keep",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    session.LOCAL_SETTINGS["spark.ui.showConsoleProgress"] = "false"
    spark = session.local_session("bench", cores)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    QUERIES["frequency"](spark, folder).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
