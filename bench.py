"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from docweave.plans.catalog import QUERIES  # noqa: E402
from docweave.session import build_session  # noqa: E402

HEADLINE = (
    "nearest_chunks", "bm25_scores", "rank_fusion", "search_results", "answer_payload", "golden_metrics",
    "file_scope", "file_paths", "change_dispositions", "merged_state", "run_totals", "replaced_index",
    "state_rows", "latest_changes", "orphan_report", "trimmed_grid", "table_markdown", "filled_down",
    "workbook_markdown", "packed_pages", "answered_calls", "text_tokens", "cleanup_markdown", "fixed_chunks",
    "unescape_page_text", "chunk_study",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
