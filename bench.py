"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list).
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from candor.plans.catalog import QUERIES
from candor.plans.fixtures import table
from candor.session import local_session, scratch_path

HEADLINE = (
    "a04_a06_split_report",
    "a07_k03_w06_refusal_types",
    "a13_marker_frequency",
    "j02_merge_results",
    "j05_verdict_lookup",
    "v01_math_score",
    "v03_code_score",
    "v06_tool_score",
    "v10_v11_refusals",
    "v17_v18_score_candidates",
    "w01_unique_queries",
)


def seconds(spark, name: str, folder: str) -> float:
    """Wall time of one full run: every output column of every row is computed, none is collected."""
    start = time.perf_counter()
    QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def in_several_files(spark, folder: str, files: int) -> str:
    """A copy of the tables in several files each, outside the measured time. The given ones have one row group, which a single task would read."""
    copy = scratch_path(spark, "bench")
    for path in sorted(Path(folder).glob("*.parquet")):
        spark.read.parquet(str(path)).repartition(files).write.parquet(f"{copy}/{path.name}")
    return copy


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus, "bench")
    candidates = table(spark, folder, "lineitem").count()
    inputs = in_several_files(spark, folder, cpus)
    times = {}
    for name in names:
        # The first run pays for code generation; the better of two warm runs counts.
        seconds(spark, name, inputs)
        times[name] = round(min(seconds(spark, name, inputs) for _ in range(2)), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus, "candidate_rows": candidates, "input_files": cpus,
        "candidates_scored_per_second": round(candidates / times["v17_v18_score_candidates"]) if "v17_v18_score_candidates" in times else None,
    }))


if __name__ == "__main__":
    main()
