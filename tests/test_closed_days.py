"""Closed days counted from topics that many tasks write."""

from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from mailstream.catalog import streams
from mailstream.catalog.batch import q_logs_rollup
from mailstream.session import CLOSING_BATCHES


def test_no_task_holds_a_third_of_a_topic(spark, tmp_path, monkeypatch):
    begin = datetime(2024, 1, 1)
    rows = [
        (n, n % 50, ("error", "purchase", "view")[n % 3], begin + timedelta(minutes=40 * n))
        for n in range(1000)
    ]
    schema = "event_id long, user_id long, event_type string, ts timestamp"
    events = spark.createDataFrame(rows, schema)
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(streams, "shared_folder", lambda spark, purpose: str(tmp_path / purpose))
    before = spark.conf.get(CLOSING_BATCHES)

    found = streams.q_stream_logs_closed_days(spark, str(tmp_path))
    assert spark.conf.get(CLOSING_BATCHES) == before
    counts = q_logs_rollup(spark, str(tmp_path))
    last = counts.agg(F.max("date")).first()[0]
    want = counts.where(F.col("date") <= last - timedelta(days=2))
    found = found.select(*counts.columns).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert want.count() > 100
    for topic in ("bounce", "delivered"):
        files = list(Path(tmp_path, "closed", "topics", topic).glob("part-*.parquet"))
        assert len(files) > streams.MICRO_BATCHES
