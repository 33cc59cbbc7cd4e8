"""Streams against batches, restarts, replays, and the sinks."""

import datetime
import tempfile
from types import SimpleNamespace

import pytest
from compare import assert_same, canonical

from mailstream.catalog import ORACLE_SQL
from mailstream.catalog import batch as bq
from mailstream.catalog import fixtures as fx
from mailstream.operators.decode import decode_bounces
from mailstream.operators.geo import geo_blocks
from mailstream.operators.lookup import lookup_table
from mailstream.operators.rollup import TOTAL
from mailstream.plans.actions import actions_rollup
from mailstream.plans.logs import logs_rollup
from mailstream.plans.schemas import (
    ACTIONS_REPORT,
    LOG_ARCHIVE,
    LOGS_REPORT,
    USER_AGENT_REPORT,
)
from mailstream.plans.user_agents import user_agent_rollup
from mailstream.session import shared_folder
from mailstream.sources.files import file_lines, file_source
from mailstream.streaming import snapshot
from mailstream.streaming.jobs import (
    await_queries,
    start_actions,
    start_logs,
    start_user_agents,
)
from mailstream.streaming.sinks import (
    Trigger,
    read_csv_archive,
    start_csv_archive,
    snapshot_writer,
    start_upsert,
    write_csv_archive,
)
from mailstream.streaming.snapshot import (
    SnapshotTable,
    compact,
    expire,
    publish,
    read_snapshot,
)

SMALL = "/root/testdata/sf0.001"
NOW = Trigger(available_now=True)


def same(left, right):
    left, right = canonical(left.toPandas()), canonical(right.toPandas())
    assert len(left) == len(right) and left.equals(right)


def stage(spark, topic, path, files, skip=0):
    """Write the lines of a topic as message files; returns how many."""
    lines = fx.topic_lines(spark, SMALL, topic).orderBy("event_id").collect()
    size = -(-len(lines) // files)
    parts = [lines[at : at + size] for at in range(0, len(lines), size)]
    for part in parts[skip:]:
        rows = spark.createDataFrame([(r["value"],) for r in part], "value binary")
        rows.coalesce(1).write.mode("append").parquet(path)
    return len(lines)


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    source, table = str(tmp_path / "in"), SnapshotTable(str(tmp_path / "out"), LOGS_REPORT)
    lines = fx.topic_lines(spark, SMALL, "bounce").orderBy("event_id").collect()
    delivered = str(tmp_path / "none")
    spark.createDataFrame([], "value binary").write.parquet(delivered)
    seen = []

    def write(batch, batch_id):
        seen.append(batch_id)
        snapshot_writer(table, compact_every=2)(batch, batch_id)

    for part in (lines[:60], lines[60:90], lines[90:]):
        rows = spark.createDataFrame([(r["value"],) for r in part], "value binary")
        rows.coalesce(2).write.mode("append").parquet(source)
        counts = logs_rollup(
            file_source(spark, source, max_files_per_trigger=1), file_source(spark, delivered)
        )
        await_queries([start_upsert(counts, write, str(tmp_path / "checkpoint"), NOW)])
    assert seen == sorted(set(seen)) and len(seen) >= 5
    assert list((tmp_path / "out" / "base").glob("batch=*/_SUCCESS"))
    want = logs_rollup(file_lines(spark, source), file_lines(spark, delivered))
    same(read_snapshot(spark, table), want)


def test_update_mode_emits_only_changed_keys_with_running_totals(spark, tmp_path):
    source = str(tmp_path / "in")
    line = "mta1,2024-01-02,,u@d,j{}-s-0-n-u,dom-ip,bad-mailbox"
    batches = []

    def write(batch, batch_id):
        batches.append({r["job_id"]: r[TOTAL] for r in batch.collect()})

    for jobs in ([1, 1, 2], [1], [2, 3]):
        rows = [(bytearray(line.format(j), "utf-8"),) for j in jobs]
        spark.createDataFrame(rows, "value binary").coalesce(1).write.mode("append").parquet(source)
        counts = logs_rollup(file_source(spark, source), file_source(spark, source).where("false"))
        await_queries([start_upsert(counts, write, str(tmp_path / "checkpoint"), NOW)])
    assert [b for b in batches if b] == [{"j1": 2, "j2": 1}, {"j1": 3}, {"j2": 2, "j3": 1}]


@pytest.mark.parametrize("limit", [None, 0])
def test_actions_stream_equals_batch(spark, tmp_path, limit):
    """With small lookups, and with lookups that count as too large to broadcast."""
    options = {} if limit is None else {"broadcast_bytes": limit}
    isp = lookup_table(fx.isp_table(spark, SMALL), **options)
    lists = lookup_table(fx.list_table(spark, SMALL), **options)
    blocks = geo_blocks(
        fx.nation_blocks(spark, SMALL), blocks6=fx.nation_blocks6(spark, SMALL), **options
    )
    for topic in fx.ACTION_EVENTS:
        stage(spark, topic, str(tmp_path / topic), 3)
    streams = [(t, file_source(spark, str(tmp_path / t), 1)) for t in fx.ACTION_EVENTS]
    table = SnapshotTable(str(tmp_path / "out"), ACTIONS_REPORT)
    await_queries(
        start_actions(
            streams, isp, lists, blocks, snapshot_writer(table), str(tmp_path / "cp"), NOW
        )
    )
    assert_same(read_snapshot(spark, table), ORACLE_SQL["actions_rollup"], SMALL)
    batch = [(t, file_lines(spark, str(tmp_path / t))) for t in fx.ACTION_EVENTS]
    assert_same(
        actions_rollup(batch, isp, lists, blocks), ORACLE_SQL["actions_rollup"], SMALL
    )


def test_a_preview_runs_beside_the_result(spark, tmp_path):
    lines = stage(spark, "click", str(tmp_path / "click"), 2)
    isp = bq.isp_domains(spark, SMALL)
    stream = file_source(spark, str(tmp_path / "click"), 1)
    table = SnapshotTable(str(tmp_path / "out"), USER_AGENT_REPORT)
    queries = start_user_agents(
        stream, isp, str(tmp_path / "cp"), snapshot_writer(table), NOW, preview_rows=3
    )
    await_queries(queries)
    assert_same(read_snapshot(spark, table), ORACLE_SQL["user_agent_rollup"], SMALL)
    progress = queries[1].recentProgress
    assert len(progress) >= 2 and sum(p["numInputRows"] for p in progress) == lines
    assert "Console" in progress[-1]["sink"]["description"]


@pytest.mark.parametrize("limit", [None, 0])
def test_user_agent_stream_equals_batch(spark, tmp_path, limit):
    options = {} if limit is None else {"broadcast_bytes": limit}
    isp = lookup_table(fx.isp_table(spark, SMALL), **options)
    stage(spark, "click", str(tmp_path / "click"), 2)
    table = SnapshotTable(str(tmp_path / "out"), USER_AGENT_REPORT)
    stream = file_source(spark, str(tmp_path / "click"), 1)
    await_queries(
        start_user_agents(stream, isp, str(tmp_path / "cp"), snapshot_writer(table), NOW)
    )
    assert_same(read_snapshot(spark, table), ORACLE_SQL["user_agent_rollup"], SMALL)


@pytest.mark.parametrize("limit", [None, 0])
def test_user_agent_batch_with_a_large_lookup(spark, limit):
    options = {} if limit is None else {"broadcast_bytes": limit}
    isp = lookup_table(fx.isp_table(spark, SMALL), **options)
    rows = user_agent_rollup(fx.topic_lines(spark, SMALL, "click"), isp)
    assert_same(rows, ORACLE_SQL["user_agent_rollup"], SMALL)


def test_logs_job_archives_rows_by_date(spark, tmp_path):
    for topic in fx.LOG_EVENTS:
        stage(spark, topic, str(tmp_path / topic), 2)
    table = SnapshotTable(str(tmp_path / "out"), LOGS_REPORT)
    queries = start_logs(
        file_source(spark, str(tmp_path / "bounce"), 1),
        file_source(spark, str(tmp_path / "delivered"), 1),
        snapshot_writer(table),
        str(tmp_path / "archive"),
        str(tmp_path / "cp"),
        NOW,
    )
    assert len(queries) == 3
    await_queries(queries)
    assert_same(read_snapshot(spark, table), ORACLE_SQL["logs_rollup"], SMALL)
    parts = [
        read_csv_archive(spark, str(tmp_path / "archive" / name), LOG_ARCHIVE)
        for name in ("bounced", "delivered")
    ]
    assert_same(parts[0].unionByName(parts[1]), ORACLE_SQL["union_logs"], SMALL)
    folders = {p.name for p in (tmp_path / "archive").glob("*/date=*")}
    assert "date=__HIVE_DEFAULT_PARTITION__" in folders
    day = parts[0].where("date = date'2024-01-03'")
    scan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in scan


def test_csv_keeps_null_and_empty_apart(spark, tmp_path):
    rows = [("s", datetime.date(2024, 1, 2), None, "", 'qu"ote', "a b", "1", "bounce", "hard")]
    frame = spark.createDataFrame(rows, LOG_ARCHIVE)
    write_csv_archive(frame, str(tmp_path / "csv"))
    same(read_csv_archive(spark, str(tmp_path / "csv"), LOG_ARCHIVE), frame)


def test_csv_gives_back_what_went_in(spark, tmp_path):
    values = [" lead", "trail ", "two\nlines", "a\rb", "back\\slash", "\\n", "\u0001", "\\x01", ",", '"', "\\", '\\"', ""]
    day = datetime.date(2024, 1, 2)
    rows = [("s", day, v, v, v, v, None, "bounce", v) for v in values]
    frame = spark.createDataFrame(rows, LOG_ARCHIVE)
    path = str(tmp_path / "csv")
    for _ in range(2):
        write_csv_archive(frame, path, run="a")
    same(read_csv_archive(spark, path, LOG_ARCHIVE), frame)
    write_csv_archive(frame.limit(1), path, run="b")
    assert read_csv_archive(spark, path, LOG_ARCHIVE).count() == len(rows) + 1


def test_a_backfill_is_seen_beside_a_stream(spark, tmp_path):
    stage(spark, "bounce", str(tmp_path / "in"), 2)
    rows = decode_bounces(file_source(spark, str(tmp_path / "in"), 1))
    path = str(tmp_path / "archive" / "bounced")
    await_queries([start_csv_archive(rows, path, str(tmp_path / "cp"), NOW)])
    before = read_csv_archive(spark, path, LOG_ARCHIVE)
    n = before.count()
    write_csv_archive(before.limit(5), path, run="late")
    assert read_csv_archive(spark, path, LOG_ARCHIVE).count() == n + 5


def test_a_failed_query_stops_the_others(spark, tmp_path):
    stage(spark, "bounce", str(tmp_path / "in"), 1)
    rows = decode_bounces(file_source(spark, str(tmp_path / "in")))

    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    counts = logs_rollup(
        file_source(spark, str(tmp_path / "in")), file_source(spark, str(tmp_path / "in"))
    )
    waiting = rows.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "a")).start()
    failing = start_upsert(counts, fail, str(tmp_path / "b"))
    with pytest.raises(Exception, match="sink is down"):
        await_queries([waiting, failing], poll_seconds=1)
    assert not waiting.isActive


def rows_of(spark, *rows):
    """(job_id, bounce_type, total) rows of a report, other keys fixed or NULL."""
    full = [
        ("s", datetime.date(2024, 1, 1), None, job, "u", "d", "i", "delivered", kind, total)
        for job, kind, total in rows
    ]
    return spark.createDataFrame(full, LOGS_REPORT)


def totals(frame):
    return {(r["job_id"], r["bounce_type"]): r[TOTAL] for r in frame.collect()}


def test_snapshot_replaces_and_replays(spark, tmp_path):
    table = SnapshotTable(str(tmp_path / "t"), LOGS_REPORT)
    assert totals(read_snapshot(spark, table)) == {}
    publish(rows_of(spark, ("a", None, 5), ("b", "hard", 1)), 0, table)
    publish(rows_of(spark, ("a", None, 3), ("c", None, 9)), 1, table)
    want = {("a", None): 3, ("b", "hard"): 1, ("c", None): 9}
    assert totals(read_snapshot(spark, table)) == want
    publish(rows_of(spark, ("a", None, 3), ("c", None, 9)), 1, table)
    publish(rows_of(spark, ("a", None, 5), ("b", "hard", 1)), 0, table)
    assert totals(read_snapshot(spark, table)) == want


def test_half_written_folders_are_not_read(spark, tmp_path):
    table = SnapshotTable(str(tmp_path / "t"), LOGS_REPORT)
    publish(rows_of(spark, ("a", None, 5)), 0, table)
    publish(rows_of(spark, ("a", None, 7)), 1, table)
    (tmp_path / "t" / "changes" / "batch=1" / "_SUCCESS").unlink()
    assert totals(read_snapshot(spark, table)) == {("a", None): 5}
    publish(rows_of(spark, ("a", None, 7)), 1, table)
    assert totals(read_snapshot(spark, table)) == {("a", None): 7}


def days_of(spark, *rows):
    """(day, job_id, total) rows of a report; day 0 is a NULL date."""
    full = [
        ("s", datetime.date(2024, 1, day) if day else None, None, job, "u", "d", "i", "x", None, n)
        for day, job, n in rows
    ]
    return spark.createDataFrame(full, LOGS_REPORT)


def by_day(frame):
    return {(r["date"].day if r["date"] else 0, r["job_id"]): r[TOTAL] for r in frame.collect()}


def test_compacting_changes_nothing_for_readers(spark, tmp_path):
    table = SnapshotTable(str(tmp_path / "t"), LOGS_REPORT)
    batches = [
        [(0, "a", 1), (1, "a", 1), (2, "a", 1)],
        [(1, "a", 2), (1, "b", 1)],
        [(2, "a", 5)],
        [(0, "a", 9), (2, "b", 1)],
        [(1, "b", 7)],
        [(3, "a", 1)],
    ]
    want = {}
    for n, rows in enumerate(batches):
        publish(days_of(spark, *rows), n, table)
        want.update({(day, job): total for day, job, total in rows})
        assert by_day(read_snapshot(spark, table)) == want
        if n % 2:
            compact(spark, table)
            assert by_day(read_snapshot(spark, table)) == want
            expire(spark, table)
            compact(spark, table)
        assert by_day(read_snapshot(spark, table)) == want
    base = tmp_path / "t" / "base"
    kept = {f"{p.parent.name}/{p.name}" for p in base.glob("batch=*/date=*")}
    assert kept == {
        "batch=1/date=2024-01-01",
        "batch=3/date=__HIVE_DEFAULT_PARTITION__",
        "batch=3/date=2024-01-02",
        "batch=5/date=2024-01-01",
        "batch=5/date=2024-01-03",
    }
    assert {p.name for p in (tmp_path / "t" / "changes").iterdir()} == {"batch=4", "batch=5"}
    scan = read_snapshot(spark, table).where("date = date'2024-01-01'")
    assert "PartitionFilters: [isnotnull(date" in scan._jdf.queryExecution().executedPlan().toString()


def test_days_without_changes_are_read_as_they_are(spark, tmp_path):
    table = SnapshotTable(str(tmp_path / "t"), LOGS_REPORT)
    publish(days_of(spark, (1, "a", 1), (2, "a", 1)), 0, table)
    compact(spark, table)
    plan = read_snapshot(spark, table)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    publish(days_of(spark, (2, "a", 3)), 1, table)
    compact(spark, table)
    settled = read_snapshot(spark, table)
    assert by_day(settled) == {(1, "a"): 1, (2, "a"): 3}
    assert "Aggregate" not in settled._jdf.queryExecution().executedPlan().toString()


def test_files_inside_a_stream_follow_the_rows(spark, tmp_path, monkeypatch):
    """64 shuffle partitions and 20 days, one of them with half of the keys."""
    monkeypatch.setattr(snapshot, "ROWS_PER_FILE", 500)
    monkeypatch.setenv("TZ", "UTC")
    rows = spark.range(4000).selectExpr(
        "date_add(date'2024-01-01', int(if(id % 2 = 0, 0, id % 20))) as date",
        "cast(id as string) as job_id",
    )
    others = [f for f in LOGS_REPORT if f.name not in ("date", "job_id", TOTAL)]
    rows = rows.selectExpr("*", *[f"cast(null as {f.dataType.simpleString()}) as {f.name}" for f in others])
    rows.write.parquet(str(tmp_path / "in"))
    table = SnapshotTable(str(tmp_path / "t"), LOGS_REPORT)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        keys = [n for n in LOGS_REPORT.names if n != TOTAL]
        counts = stream.groupBy(*keys).count().withColumnRenamed("count", TOTAL)
        writer = snapshot_writer(table, compact_every=1)
        await_queries([start_upsert(counts, writer, str(tmp_path / "cp"), NOW)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "t" / "base").glob("batch=0/date=*")}
    assert len(files) == 11 and 2 <= files.pop("date=2024-01-01") <= 4
    assert set(files.values()) == {1}
    assert len(list((tmp_path / "t" / "changes" / "batch=0").glob("*.parquet"))) <= 8
    assert read_snapshot(spark, table).count() == 4000


def test_a_table_takes_batches_of_one_query_only(spark, tmp_path):
    stage(spark, "bounce", str(tmp_path / "in"), 1)
    table = SnapshotTable(str(tmp_path / "t"), LOGS_REPORT)
    empty = file_source(spark, str(tmp_path / "in")).where("false")

    def run(checkpoint):
        counts = logs_rollup(file_source(spark, str(tmp_path / "in")), empty)
        await_queries([start_upsert(counts, snapshot_writer(table), checkpoint, NOW)])

    run(str(tmp_path / "cp1"))
    before = totals(read_snapshot(spark, table))
    run(str(tmp_path / "cp1"))
    assert totals(read_snapshot(spark, table)) == before
    with pytest.raises(Exception, match="belongs to streaming query"):
        run(str(tmp_path / "cp2"))


class FakeSession:
    """Just the settings that decide where a shared folder lies."""

    def __init__(self, master, **settings):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=settings.get)


def test_shared_folder_follows_the_session_setting():
    cluster = FakeSession("spark://host:7077", **{"spark.checkpoint.dir": "s3a://b/c/"})
    assert shared_folder(cluster, "x").startswith("s3a://b/c/x-")
    assert shared_folder(FakeSession("local[2]"), "x").startswith(tempfile.gettempdir())
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession("spark://host:7077"), "x")
