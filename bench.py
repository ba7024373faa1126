"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR names the input folder (default sf0.1), BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import os
import time

from scholion.plans import registry
from scholion.session import INPUT_PARTITIONS, build_session

HEADLINE = [
    "split_sections", "main_signal_tasks", "header_path_chunks", "label_lines_char", "label_lines_prop",
    "char_tasks", "prop_tasks", "proc_tasks", "render_prompts", "parse_responses", "merge_characterizations",
    "merge_properties", "merge_process_steps", "dedupe_samples", "final_documents", "exact_pairs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set(INPUT_PARTITIONS, cpus if cpus.isdigit() else "8")
    queries = registry.queries()
    queries[HEADLINE[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm up
    timings = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
