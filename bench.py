"""Time the headline queries and print one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from stratloom.registry import all_queries

HEADLINE = ["consolidate_v2", "build_markers", "evidence_page_join", "page_links", "geocode_in_box_join",
            "context_region_fix", "river_basin_fix", "admin_propagation", "snap_to_existing", "line_highlight_join",
            "flatten_records", "relevance_gate", "build_proposals", "queue_index", "topical_filter", "html_article",
            "catalog_rollup", "norm_search", "page_rotation", "sequential_id"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    qs, times = all_queries(), {}
    for k in only or HEADLINE:
        start = time.time()
        qs[k](spark, folder).write.format("noop").mode("overwrite").save()
        times[k] = round(time.time() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
