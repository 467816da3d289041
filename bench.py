"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ticketmill.queries import QUERIES  # noqa: E402
from ticketmill.session import build_session  # noqa: E402

HEADLINE = [
    "normalized_text",
    "tfidf_weights",
    "dense_similar_pairs",
    "embedding_clusters",
    "daily_clusters",
    "daily_report",
    "pattern_report",
    "monthly_report",
    "top_phrases",
    "head_of_joined_text",
    "report_summary",
    "month_health",
    "feature_insights",
    "recurrence_tracker",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, memory="12g")
    seconds: dict[str, float] = {}
    QUERIES["month_trend"](spark, folder).write.format("noop").mode("overwrite").save()  # starts the JVM's pools
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = Path(folder).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
