"""Time the headline queries: one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from phenolith.queries import load  # noqa: E402
from phenolith.session import local_session  # noqa: E402

HEADLINE = [
    "enrich_by_category", "nearest_complete_station", "stations_within_radius", "station_days", "window_completeness", "group_extent",
    "season_region_counts", "dedupe_location_date", "scan_occurrences_by_source", "train_eval_split", "hash_partition", "fill_elevation",
    "keyset_batches", "fit_vocabularies", "write_by_category", "evaluate_classifier"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    registry, times = load(), {}
    for name in HEADLINE:
        laps = []
        for _ in range(2):  # the first lap warms up code generation
            start = time.time()
            registry[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            laps.append(time.time() - start)
        times[name] = round(min(laps), 3)
    print(json.dumps({
        "metric": "headline query time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": sf_dir.rstrip("/").split("sf")[-1]}))


main()
