"""Headline queries on the given tables; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the number of local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

from foliospark.plans.registry import load_all, runnable
from foliospark.session import build_session

HEADLINE = (
    "d2_ingest_documents",
    "d3_classify_words",
    "d4_extract_attributes",
    "d6_chunk_packed",
    "d6_chunk_stride",
    "d7_term_statistics",
    "d8_bm25_search",
    "d9_vector_search",
    "d11_build_prompts",
    "d13_judge_scores",
    "d15_split_plan",
    "d16_split_pages",
    "d18_sheet_previews",
    "s10_master_rows",
    "s16_html_text",
    "m1_merge_extractions",
    "m4_csv_states",
    "v1_processing_summary",
    "v3_stage_status",
    "v12_combined_trend",
    "v13_run_statistics",
    "t3_stage_chain",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(cpus),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    wanted = [q for q in HEADLINE if not sys.argv[1:] or q in sys.argv[1:]]
    # One small query first, so that starting the session is not measured.
    runnable("a1_counts")(spark, sf_dir).collect()
    times = {}
    for name in wanted:
        start = time.perf_counter()
        runnable(name)(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
