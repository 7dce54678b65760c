"""Seconds per headline query: median of three runs after one warm-up.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores of the local session. Prints one JSON
line; the value is the sum over the queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from wayfield.plans import catalog

HEADLINE = (
    "rng1_point_point", "rng3_point_polygon", "rng10_polygon_polygon", "rng3_point_polygon_table",
    "rng7_point_polygon_outside_batch",
    "jon1_point_point", "jon2_point_point_naive", "jon1_point_point_all",
    "jon3_point_polygon", "jon4_point_polygon_naive", "jon8_polygon_polygon",
    "knn1_point_point", "knn2_point_polygon", "knn3_point_polygon_naive", "knn7_polygon_polygon",
    "trj2_lines_all", "trj3_contained", "trj6_running_stats", "trj7_window_stats",
    "trj10_cell_window_all", "trj11_cell_count_window_sum", "trj14_self_join",
    "trj17_trajectory_knn_lines", "trj20_speed",
    "app2_room_occupancy_filled", "app5_normalized_stay_time", "app7_geofence_batch",
    "par2_snk4_geojson_point", "par9_snk8_wkt_polygon",
    "str7_knn1_point_point", "str11_jon1_point_point",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = sys.argv[1:] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="wayfield-bench-"))
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(3)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total of medians", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))[2:]}))


if __name__ == "__main__":
    main()
