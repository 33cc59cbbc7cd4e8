"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default: all),
BENCH_REPEAT (default 0: how often the lines are repeated for the runs at size; 100 over
sf0.1 makes 2 million lines a topic), BENCH_RUNS (default 3).  Each query is built and
written to a sink that discards the rows; the time includes measuring the lookup tables.
The best of a few runs after one warm-up counts.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailstream.catalog import QUERIES
from mailstream.catalog import fixtures as fx
from mailstream.catalog.batch import blocks, isp_domains, lists
from mailstream.plans.actions import actions_rollup
from mailstream.plans.logs import logs_rollup
from mailstream.plans.user_agents import user_agent_rollup
from mailstream.session import build_session, shared_folder

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "0"))
HEADLINE = (
    "join_isp",
    "join_lists",
    "parse_user_agent",
    "ip_to_country",
    "ip_to_country_many_blocks",
    "logs_rollup",
    "user_agent_rollup",
    "actions_rollup",
    "logs_archive",
    "upsert_snapshot",
    "stream_logs_rollup",
    "stream_user_agent_rollup",
    "stream_actions_rollup",
)


def best(build: Callable[[], DataFrame]) -> float:
    """Seconds of the best run after a warm-up."""
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times[1:] or times), 3)


def at_size(spark: SparkSession) -> dict[str, dict[str, float]]:
    """Seconds and lines a second over repeated lines that are stored first."""
    folder = shared_folder(spark, "bench")
    lines = {**fx.action_lines(spark, SF_DIR), **fx.log_lines(spark, SF_DIR)}
    copies = F.explode(F.sequence(F.lit(1), F.lit(REPEAT)))
    stored = {}
    for topic, rows in lines.items():
        path = f"{folder}/{topic}"
        rows.withColumn("copy", copies).drop("copy").write.parquet(path)
        stored[topic] = spark.read.parquet(path)
    isp, names = isp_domains(spark, SF_DIR), lists(spark, SF_DIR)
    actions = [(topic, stored[topic]) for topic in fx.ACTION_EVENTS]
    jobs = {
        "actions_rollup": (
            fx.ACTION_EVENTS,
            lambda: actions_rollup(actions, isp, names, blocks(spark, SF_DIR)),
        ),
        "logs_rollup": (
            fx.LOG_EVENTS,
            lambda: logs_rollup(stored["bounce"], stored["delivered"]),
        ),
        "user_agent_rollup": (["click"], lambda: user_agent_rollup(stored["click"], isp)),
    }
    found = {}
    for name, (topics, build) in jobs.items():
        count = sum(stored[topic].count() for topic in topics)
        seconds = best(build)
        found[name] = {"lines": count, "seconds": seconds, "lines_per_s": round(count / seconds)}
    return found


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        seconds[name] = best(lambda name=name: QUERIES[name](spark, SF_DIR))
    large = at_size(spark) if REPEAT else None
    spark.stop()
    result = {
        "metric": "headline queries, best run each, summed",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    if large:
        result["at_size"] = large
    print(json.dumps(result))


if __name__ == "__main__":
    main()
