"""Time the headline queries; prints one JSON line."""

import json
import os
import sys
import time

from marginalia.catalog import QUERIES
from marginalia.session import local_session

HEADLINE = (
    "validate_links", "plan_updates", "best_match", "quality_report", "chapters", "sections_with_lines", "section_diff",
    "extract_summary", "renumber_headings", "finalize_document", "rebuild_toc", "pack_chunks", "split_sheets",
    "merge_chunks", "split_or_merge_outputs", "content_similarity", "embedding_topk", "glossary", "inventory",
    "run_statistics", "unique_names", "plan_structure",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(cores, cores)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in chosen:
        start = time.time()
        QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
