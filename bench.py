"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (names separated by commas) to time others.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ratingmill.plans import all_queries  # noqa: E402
from ratingmill.session import build_session, clear_staged  # noqa: E402

HEADLINE = (
    "olap_rollup",
    "olap_drilldown",
    "olap_slice",
    "olap_dice",
    "olap_pivot",
    "ratings_first_per_key",
    "filter_movies_first",
    "split_per_user",
    "split_global",
    "fact_rating",
    "user_behaviour",
    "genre_cooccurrence",
    "long_tail",
    "user_rules",
    "order_rules",
    "user_neighbours",
    "user_based_recs",
    "item_neighbours",
    "tfidf_terms",
    "similar_to_title",
    "bias_baseline",
    "factor_predictions",
    "item_based_recs",
    "similar_items",
    "content_recs",
    "rule_boost",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "ratingmill-bench",
        master=f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = all_queries()
    # Start the JVM code paths and the Python workers outside the timing.
    registry["olap_rollup"].run(spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        registry[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
        clear_staged(spark)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
