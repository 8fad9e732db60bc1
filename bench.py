"""Seconds per headline query; prints one JSON line.

Each query is planned and run to the end (every row and column is computed,
nothing is kept) once to warm up and then ``BENCH_RUNS`` times; the median
counts. ``BENCH_QUERIES`` (comma separated, or ``all``) replaces the list.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from packetloom.plans.queries import REGISTRY  # noqa: E402
from packetloom.session import configure  # noqa: E402

HEADLINE = (
    "attack_summary", "top_attackers", "class_balance", "protocol_ports",
    "traffic_by_minute", "top_talkers", "flow_kpis", "attacker_status",
    "ingest_if_absent", "decoded_captures", "retained_packets",
    "normalized_packets", "graded_alerts", "auto_blocks", "latest_packets",
    "alert_stream_run", "traffic_stream_run", "upserted_blocks", "attack_banner",
    "flow_packet_matches", "volume_both", "sql_verdicts", "catalog_search",
    "column_profile", "upload_verdicts", "text_file_verdicts", "clean_upload_rows",
    "routed_questions", "assistant_prompts", "split_replies", "assembled_replies",
)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = HEADLINE
    if chosen:
        names = list(REGISTRY) if chosen == "all" else chosen.split(",")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    spark = configure(
        builder,
        **{
            "spark.sql.shuffle.partitions": cpus.strip("*") or "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    ).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    def once(name):
        start = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        first = once(name)
        seconds[name] = round(statistics.median([once(name) for _ in range(runs)] or [first]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "median seconds per query, summed",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "runs": runs,
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
