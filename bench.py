"""Time the headline queries and print one JSON line.

Each query runs once to warm up and once for the record. Results are written to
the no-op sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import time

from checks.registered import QUERIES
from starlens.session import local_session

HEADLINE = (
    "q1_category_purchase",
    "q2_monthly_trend",
    "q3_risky_stores",
    "q4_price_band",
    "q5_negative_helpfulness",
    "stg_load_counts",
    "stg_semi_join",
    "stg_linked_reviews",
    "ft_ml_features",
    "dq_constraints",
    "lg_drop_reasons",
    "lg_profile_after",
    "ft_string_index",
    "ml_naive_bayes",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    first, recorded = {}, {}
    for times in (first, recorded):
        for name in HEADLINE:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(recorded.values()), 3),
                "unit": "sec",
                "queries": recorded,
                "first_run": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
