"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local threads.
Queries that read chat files find them landed beforehand; landing is timed apart.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chatloom.session import build_session  # noqa: E402
from workload import adapter  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = [
    "records_per_title",
    "emote_panel",
    "legacy_badge_info",
    "attach_titles",
    "badge_distribution",
    "badge_name_frequency",
    "badge_name_frequency_cross",
    "badges_of_users_or_not",
    "colour_share_users",
    "gold_report",
    "union_panels",
    "search_titles",
    "download_manifest",
    "read_chat_files",
    "file_status",
    "silver_job",
    "gold_job",
    "ingest_chat_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.TemporaryDirectory(prefix="bench-")
    spark = build_session(
        "bench",
        **{
            "spark.checkpoint.dir": scratch.name,
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    run("records_per_title")
    started = time.perf_counter()
    adapter.landed(spark, sf_dir)
    landing = round(time.perf_counter() - started, 3)
    times = {name: run(name) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "landing": landing,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()
    scratch.cleanup()


if __name__ == "__main__":
    main()
