"""Shape of the physical plans: what is read, shuffled, and never done."""

import pytest
from pyspark.sql import functions as F

from mailstream.catalog.batch import BATCH_QUERIES
from mailstream.plans.schemas import LOG_ARCHIVE
from mailstream.streaming.sinks import write_csv_archive
from compare import SF_DIR


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_no_pairwise_joins_and_no_python(spark, name):
    text = plan(BATCH_QUERIES[name](spark, SF_DIR))
    for node in ("NestedLoop", "CartesianProduct", "EvalPython", "InPandas"):
        assert node not in text


@pytest.mark.parametrize(
    ("name", "shuffles"),
    [
        ("ip_to_country", 0),
        ("join_isp", 0),
        ("parse_user_agent", 0),
        ("union_logs", 0),
        ("actions_rollup", 1),
        ("logs_rollup", 1),
        ("user_agent_rollup", 2),
    ],
)
def test_number_of_shuffles(spark, name, shuffles):
    text = plan(BATCH_QUERIES[name](spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") == shuffles
    assert text.count("Exchange") - text.count("BroadcastExchange") == shuffles


def test_topic_filter_and_columns_reach_the_scan(spark):
    text = plan(BATCH_QUERIES["union_logs"](spark, SF_DIR))
    assert "EqualTo(event_type,error)" in text and "EqualTo(event_type,purchase)" in text
    assert "props" not in text


def test_a_day_larger_than_a_file_is_split(spark, tmp_path):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
        "spark.sql.shuffle.partitions": "200",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        day = F.when(F.col("id") % 3 == 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")))
        hot = F.coalesce(day, F.lit("2024-02-01").cast("date"))
        text = F.sha2(F.col("id").cast("string"), 256)
        columns = [hot.alias(f.name) if f.name == "date" else text.alias(f.name) for f in LOG_ARCHIVE]
        write_csv_archive(spark.range(0, 30000, 1, 8).select(*columns), str(tmp_path / "csv"))
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    files = {p.name: len(list(p.glob("*.csv"))) for p in (tmp_path / "csv_backfill").glob("run=*/date=*")}
    assert files.pop("date=2024-02-01") > 1
    assert max(files.values()) <= 2
