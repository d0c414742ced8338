"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data
and cores. `python bench.py all` times every registered query, `python bench.py q1 q2`
just those.
"""

from __future__ import annotations

import json
import os
import sys
import time

from calipers.plans.registry import QUERIES
from calipers.runtime import build_session

HEADLINE = [
    "dim_lookup", "eav_product", "parse_dim", "collection_dims", "front_items", "rug_dims", "images_with_dims",
    "review_json", "missing_images", "lookback_snapshot", "smoothed_mask", "components", "bounding_boxes", "hull",
    "similar_segments", "edge_endpoints", "corner_match", "side_layout", "annotation_plan", "type_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark.range(1000).selectExpr("sum(id)").collect()  # session start is not part of a query
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total wall time" if not sys.argv[1:] else "wall time",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
