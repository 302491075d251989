"""Times the batch queries and three streams on local[$BENCH_CPUS] over $BENCH_SF_DIR.

Prints one JSON line. Results are computed in full and thrown away. A query is run once
to warm up the session, then timed; streams are timed once.
"""

import json
import os
import sys
import time
import warnings
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from spanwatch.plans.queries import QUERIES

# Streams take their waves one after another, so three of them stand for all, timed once.
STREAMS = ("stream_decode", "stream_violations", "daily_doc_upsert")
BATCH = tuple(name for name in QUERIES if not name.startswith(("stream_", "daily_doc_")))


class PeakState(StreamingQueryListener):
    """The most rows that the operators of any stream have held after a micro-batch."""

    rows = 0

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        held = sum(operator.numRowsTotal for operator in event.progress.stateOperators)
        self.rows = max(self.rows, held)

    def onQueryTerminated(self, event):
        pass


def main() -> None:
    warnings.simplefilter("ignore")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("spanwatch-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def seconds(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    timed = {}
    for name in BATCH:
        seconds(name)
        timed[name] = round(seconds(name), 3)
    state = PeakState()
    spark.streams.addListener(state)
    for name in STREAMS:
        timed[name] = round(seconds(name), 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "events": events,
        "stream_events_per_sec": round(events / timed["stream_violations"], 1),
        "peak_state_rows": state.rows,
    }
    print(json.dumps(result))
    sys.stdout.flush()
    spark.stop()


if __name__ == "__main__":
    main()
