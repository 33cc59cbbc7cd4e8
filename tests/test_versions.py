"""Streams that follow versions of their lookup tables, and counts of closed days."""

import datetime
import os
from pathlib import Path

import pytest
from compare import assert_same
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from mailstream.catalog import ORACLE_SQL
from mailstream.catalog import fixtures as fx
from mailstream.operators.rollup import TOTAL
from mailstream.plans.schemas import ACTIONS_REPORT, LOG_ARCHIVE, LOGS_REPORT
from mailstream.sources.files import file_lines, file_source
from mailstream.sources.versions import (
    Followed,
    followed_blocks,
    followed_lookup,
    latest_version,
    publish_blocks,
    publish_version,
    refresh_version,
)
from mailstream.plans.logs import logs_rollup
from mailstream.streaming import archive, increments
from mailstream.streaming.archive import complete_runs, live_runs, read_archive
from mailstream.streaming.increments import start_action_counts, start_log_batches
from mailstream.streaming.jobs import await_queries, start_closed_log_days
from mailstream.streaming.sinks import Trigger, late_rows, snapshot_writer
from mailstream.streaming.snapshot import SnapshotTable, batch_versions, read_snapshot
from test_streaming import same

SMALL = "/root/testdata/sf0.001"
NOW = Trigger(available_now=True)


def lines(spark, path, *some):
    rows = spark.createDataFrame([(bytearray(x, "utf-8"),) for x in some], "value binary")
    rows.coalesce(1).write.mode("append").parquet(path)


def test_versions_are_numbered_and_complete(spark, tmp_path):
    path = str(tmp_path / "t")
    assert latest_version(spark, path) is None
    with pytest.raises(ValueError, match="no complete version"):
        followed_lookup(path).current(spark)
    one = spark.createDataFrame([(1, "one")], "id int, domain_name string")
    two = spark.createDataFrame([(1, "one"), (2, "two")], "id int, domain_name string")
    assert [publish_version(one, path), refresh_version(one, path), refresh_version(two, path)] == [0, 0, 1]
    (tmp_path / "t" / "version=7").mkdir()  # not complete
    assert latest_version(spark, path) == 1
    built = []
    followed = Followed(path, lambda session, folder: built.append(folder) or len(built))
    assert [followed.current(spark) for _ in range(3)] == [(1, 1)] * 3
    publish_version(one, path)  # 2
    assert followed.current(spark) == (2, 2) and len(built) == 2


class Actions:
    """Opens of one provider over lookup tables in versions."""

    def __init__(self, spark, folder, limit):
        self.spark, self.folder = spark, str(folder)
        self.table = SnapshotTable(f"{folder}/report", ACTIONS_REPORT, adds=True)
        publish_version(spark.createDataFrame([(1, "L")], "id int, code string"), f"{folder}/lists")
        blocks = spark.createDataFrame([(0, 9, "A")], "lo bigint, hi bigint, country string")
        publish_blocks(blocks, f"{folder}/blocks")
        self.isp = followed_lookup(f"{folder}/isp", broadcast_bytes=limit)

    def providers(self, *rows):
        table = self.spark.createDataFrame(rows, "id int, domain_name string")
        return publish_version(table, f"{self.folder}/isp")

    def opens(self, *providers):
        line = "x,evt,job1,5,2,2024-01-02 03:04:05,0.0.0.7,,ua,,,1,,{}"
        lines(self.spark, f"{self.folder}/open", *(line.format(p) for p in providers))

    def run(self):
        await_queries(
            start_action_counts(
                [("open", file_source(self.spark, f"{self.folder}/open", 1))],
                self.isp,
                followed_lookup(f"{self.folder}/lists"),
                followed_blocks(f"{self.folder}/blocks"),
                self.table,
                f"{self.folder}/cp",
                NOW,
                compact_every=3,
            )
        )

    def counts(self):
        rows = read_snapshot(self.spark, self.table).collect()
        assert {(r["country"], r["list_name"], r["type"]) for r in rows} == {("A", "L", "open")}
        return {r["domain_name"]: r[TOTAL] for r in rows}


def test_a_table_that_grows_changes_its_join_between_micro_batches(spark, tmp_path, monkeypatch):
    job = Actions(spark, tmp_path, limit=1000)
    plans = []
    publish = increments.publish
    monkeypatch.setattr(
        increments, "publish",
        lambda batch, *rest: plans.append(batch._jdf.queryExecution().executedPlan().toString()) or publish(batch, *rest),
    )
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        job.providers((1, "one"))
        job.opens(1, 1, 2)
        job.run()
        assert job.isp.current(spark)[1].small and "SortMergeJoin" not in plans[-1]
        job.providers(*((n, f"n{n}") for n in range(1, 200)))
        job.opens(*[1] * 50, 2, 3, "x")
        job.run()
        assert not job.isp.current(spark)[1].small and "SortMergeJoin" in plans[-1]
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Rows keep the names of the version that their micro-batch used.
    assert job.counts() == {"one": 2, None: 1 + 1, "n1": 50, "n2": 1, "n3": 1}
    named = batch_versions(spark, job.table).orderBy("batch").collect()
    assert [(r["batch"], r["isp_domains"], r["lists"], r["blocks"]) for r in named] == [(0, 0, 0, 0), (1, 1, 0, 0)]


def test_a_key_that_becomes_double_stops_the_stream(spark, tmp_path):
    job = Actions(spark, tmp_path, limit=10**6)
    job.providers((1, "one"))
    job.opens(1)
    job.run()
    job.providers((1, "one"), (1, "uno"))
    job.opens(1, 1)
    with pytest.raises(StreamingQueryException, match="not unique"):
        job.run()
    assert job.counts() == {"one": 1}
    job.providers((1, "eins"))
    job.run()
    assert job.counts() == {"one": 1, "eins": 2}


def test_replayed_micro_batches_count_once(spark, tmp_path):
    job = Actions(spark, tmp_path, limit=10**6)
    job.providers((1, "one"))
    for batch in range(5):
        job.opens(1, *[2] * batch)
        job.run()
        if batch in (1, 2, 4):  # the stream forgets that it finished; base or changes hold it
            for name in (str(batch), f".{batch}.crc"):
                os.remove(Path(job.folder) / "cp" / "action_counts" / "commits" / name)
            job.run()
    assert job.counts() == {"one": 5, None: 10}
    assert list(Path(job.folder).glob("report/base/batch=2/_SUCCESS"))
    assert batch_versions(spark, job.table).count() == 5


def test_a_table_that_replaces_is_refused(spark, tmp_path):
    table = SnapshotTable(str(tmp_path), ACTIONS_REPORT)
    with pytest.raises(ValueError, match="adds"):
        increments.start_increments(spark.readStream.format("rate").load(), None, table, "cp")


LOG = "mta1,{},,u@d,{}-s-0-n-u,dom-ip,bad-mailbox"


def test_state_ends_with_its_day_and_late_rows_are_counted(spark, tmp_path):
    source, none = str(tmp_path / "in"), str(tmp_path / "none")
    spark.createDataFrame([], "value binary").write.parquet(none)
    table = SnapshotTable(str(tmp_path / "out"), LOGS_REPORT)
    far = datetime.date.today() + datetime.timedelta(days=400)
    kept, late = [], 0

    def run(*some):
        nonlocal late
        lines(spark, source, *(LOG.format(day, job) for day, job in some))
        [query] = start_closed_log_days(
            file_source(spark, source, 1), file_source(spark, none),
            snapshot_writer(table), str(tmp_path / "cp"), "1 day", NOW,
        )
        await_queries([query])
        late += late_rows(query)
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        return {(str(r["date"]), r["job_id"]): r[TOTAL] for r in read_snapshot(spark, table).collect()}

    assert run(*(("2024-01-01", f"j{n}") for n in range(20)), ("2024-01-01 05:00:00", "j1")) == {}
    # Neither a bad date nor one far ahead closes a day or is counted.
    assert run(("2024-01-02", "j1"), ("nonsense", "j1"), (far, "j1"), ("2024-01-01", "j0")) == {}
    closed = run(("2024-01-03", "j1"))
    assert len(closed) == 20 and closed["2024-01-01", "j0"] == closed["2024-01-01", "j1"] == 2
    assert kept[:2] == [20, 21] and kept[2] == 2
    assert run(("2024-01-01", "j2"), ("2024-01-02", "j2"), ("2024-01-09", "j1")) == closed | {
        ("2024-01-02", "j1"): 1, ("2024-01-02", "j2"): 1, ("2024-01-03", "j1"): 1,
    }
    assert late == 1 and kept[-1] == 1


def log_lines(spark, folder, triggers):
    """Lines of both topics as so many message files each."""
    paths = {}
    for topic in fx.LOG_EVENTS:
        paths[topic] = str(folder / topic)
        rows = fx.topic_lines(spark, SMALL, topic).select("value")
        rows.repartition(triggers).write.parquet(paths[topic])
    return paths


def run_logs(spark, folder, paths, table):
    streams = [file_source(spark, paths[topic], 1) for topic in fx.LOG_EVENTS]
    queries = start_log_batches(*streams, table, str(folder / "archive"), str(folder / "cp"), NOW, 4)
    await_queries(queries)
    return queries


def archived(spark, folder):
    bounced, delivered = (
        read_archive(spark, str(folder / "archive" / name), LOG_ARCHIVE) for name in ("bounced", "delivered")
    )
    return bounced.unionByName(delivered)


def test_one_reading_fills_archives_and_counts_whatever_fails(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "FANOUT", 3)
    paths = log_lines(spark, tmp_path, 7)
    table = SnapshotTable(str(tmp_path / "report"), LOGS_REPORT, adds=True)
    calls = {"archive": 0, "publish": 0}

    def failing(name, function, at):
        def call(*args):
            calls[name] += 1
            if calls[name] in at:
                raise RuntimeError(f"{name} failed")
            return function(*args)

        return call

    # Between the archives, and between them and the counts.
    monkeypatch.setattr(increments, "archive_batch", failing("archive", increments.archive_batch, {4, 9}))
    monkeypatch.setattr(increments, "publish", failing("publish", increments.publish, {3, 5}))
    failures = 0
    while True:
        try:
            queries = run_logs(spark, tmp_path, paths, table)
            break
        except StreamingQueryException:
            failures += 1
    assert failures == 4
    # Each topic is one source of the one query.
    assert len(queries) == 1
    assert_same(read_snapshot(spark, table), ORACLE_SQL["logs_rollup"], SMALL)
    assert_same(archived(spark, tmp_path), ORACLE_SQL["logs_archive"], SMALL)
    want = logs_rollup(*(file_lines(spark, paths[topic]) for topic in fx.LOG_EVENTS))
    same(read_snapshot(spark, table), want)


def test_files_of_a_day_stay_few_and_readers_see_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "FANOUT", 3)
    path = str(tmp_path / "a")
    columns = [F.lit("x\ny\\n,\"").alias(f.name) if f.name != "date" else F.lit("2024-01-02").cast("date").alias("date") for f in LOG_ARCHIVE]
    for batch in range(30):
        rows = spark.range(2).select(*columns).withColumn("server_name", F.lit(f"s{batch}"))
        archive.archive_batch(rows, batch, path)
        archive.archive_batch(rows, batch, path)  # a replay
        before = read_archive(spark, path, LOG_ARCHIVE) if batch in (8, 26) else None
        archive.merge_runs(spark, batch, path, LOG_ARCHIVE)
        runs = live_runs(complete_runs(spark, path))
        assert len(runs) <= 2 * 3 + 1
        assert len(list(Path(path).glob("run=*/date=*/*.csv"))) <= 2 * 3 * 3 + archive.KEEP + 3
        if before is not None:
            assert before.count() == 2 * (batch + 1)  # a reader that began before
    found = read_archive(spark, path, LOG_ARCHIVE).collect()
    assert sorted(r["server_name"] for r in found) == sorted(f"s{n}" for n in range(30) for _ in range(2))
    assert {r["user"] for r in found} == {"x\ny\\n,\""}
    archive.archive_batch(spark.range(5).select(*columns), 4, path)  # long since merged
    assert read_archive(spark, path, LOG_ARCHIVE).count() == 60


def test_live_runs():
    assert live_runs([(0, 0), (0, 2), (1, 1), (2, 2), (3, 3)]) == [(0, 2), (3, 3)]
    assert live_runs([(0, 8), (0, 2), (3, 5), (6, 8), (9, 9), (8, 8)]) == [(0, 8), (9, 9)]
    assert live_runs([]) == []
