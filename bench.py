"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidings.plans.queries import registered  # noqa: E402
from tidings.session import build_session  # noqa: E402

HEADLINE = [
    "page_text", "page_links", "next_frontier", "crawl_report", "words_space", "sentences", "word_counts",
    "vocab_unique", "pretokens", "wordpiece_ids", "encode_pair", "token_spans", "sentence_vectors",
    "assign_fixed_centres", "null_samples", "kmeans_fit", "gap_table", "digest", "save_tables",
    "stream_timeframes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "tidings-bench", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        registered()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
            }
        )
    )


if __name__ == "__main__":
    main()
