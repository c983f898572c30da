"""Wall-clock seconds of the headline queries: one cold run, then the median of warm runs; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from tracklake.plans import registry

HEADLINE = ["source_audit", "class_sample", "hamming_pairs", "components", "keep_policy", "match_detections", "nms", "average_precision", "image_level", "recall_by_size", "gap_filled", "moving_average", "rolling_decisions", "track_decisions", "track_events", "auroc", "sequence_features", "curation_run"]


def main() -> None:
    sf_dir, cpus, warm = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_WARM", "3"))
    conf = {"spark.sql.shuffle.partitions": "16", "spark.driver.memory": "8g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC"}
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        runs = []
        for _ in range(1 + warm):
            start = time.perf_counter()
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:] or runs), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total seconds of the headline queries, warm", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf_dir}))


if __name__ == "__main__":
    main()
