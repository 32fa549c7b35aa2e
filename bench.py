"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores and
``BENCH_QUERIES`` (optional) a comma-separated choice of queries, or ``all``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from logloom.catalog import QUERIES  # noqa: E402
from logloom.session import get_session  # noqa: E402

HEADLINE = """
hourly_totals access_log_parse page_views referral_counts session_ids page_sequences previous_page
word_count term_frequencies tokenize tfidf top_terms fit_vocabulary encode_sequences mean_embedding
dedup_keep_last merge_prefer_old inner_join anti_join top_orders_per_customer rank_by_score
fuzzy_join geo_ip path_enumeration extract_links largest_box cooccurrence item_similarity recommend
stream_word_count stream_page_views
""".split()


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = get_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(2 * int(cpus)),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "class_counts", folder)  # starts the engine
    times = {}
    for name in names:
        runs = [run(spark, name, folder) for _ in range(repeats)]
        # with repeats, the first run only compiles the code of the query
        times[name] = round(statistics.median(runs[1:] or runs), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    result = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(folder).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
