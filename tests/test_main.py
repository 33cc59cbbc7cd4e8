"""The command line: which sources and sinks it wires together."""

import pytest

import mailstream.__main__ as cli
from mailstream.catalog import fixtures as fx
from mailstream.catalog import ORACLE_SQL
from mailstream.plans.schemas import ACTIONS_REPORT, LOGS_REPORT, USER_AGENT_REPORT
from mailstream.sources.files import file_source
from mailstream.sources.versions import publish_blocks, publish_version
from mailstream.streaming.jobs import await_queries
from mailstream.streaming.snapshot import SnapshotTable, read_snapshot
from compare import assert_same

SMALL = "/root/testdata/sf0.001"
TOPIC_OF = {
    "open_actions": "open",
    "click_actions": "click",
    "unsub_actions": "unsub",
    "pmta-bounce": "bounce",
    "pmta-delivered": "delivered",
}


@pytest.fixture
def wired(spark, tmp_path, monkeypatch):
    """Files in place of the message bus and the database."""

    def topic_files(session, servers, topic, fail_on_data_loss, max_offsets):
        path = str(tmp_path / topic)
        lines = fx.topic_lines(spark, SMALL, TOPIC_OF[topic]).select("value")
        lines.write.mode("overwrite").parquet(path)
        return file_source(spark, path)

    def table(session, target, name, **slices):
        return {"isp_domains": fx.isp_table, "lists": fx.list_table}[name](spark, SMALL)

    monkeypatch.setattr(cli, "kafka_source", topic_files)
    monkeypatch.setattr(cli, "jdbc_dim_source", table)
    monkeypatch.setattr(
        cli, "read_geo_blocks", lambda session, *paths: fx.nation_blocks(spark, SMALL)
    )
    monkeypatch.setattr(
        cli, "read_geo_blocks6", lambda session, *paths: fx.nation_blocks6(spark, SMALL)
    )
    return tmp_path


def run(spark, folder, *argv):
    base = ["--kafka", "h:1", "--checkpoint", str(folder / "cp"), "--once"]
    args = cli.parser().parse_args([*argv, *base, "--report", str(folder / "report")])
    await_queries(cli.start(spark, args))


@pytest.mark.parametrize(
    ("job", "options", "schema", "query"),
    [
        ("actions", ["--networks", "n", "--places", "p"], ACTIONS_REPORT, "actions_rollup"),
        ("logs", ["--archive", "ARCHIVE"], LOGS_REPORT, "logs_rollup"),
        ("user-agents", [], USER_AGENT_REPORT, "user_agent_rollup"),
    ],
)
def test_jobs(spark, wired, job, options, schema, query):
    options = [str(wired / "archive") if o == "ARCHIVE" else o for o in options]
    run(spark, wired, job, *options)
    report = read_snapshot(spark, SnapshotTable(str(wired / "report"), schema))
    assert_same(report, ORACLE_SQL[query], SMALL)


def test_one_label_for_all_actions(spark, wired):
    labels = ["--click-label", "open", "--unsub-label", "open"]
    run(spark, wired, "actions", "--networks", "n", "--places", "p", *labels)
    report = read_snapshot(spark, SnapshotTable(str(wired / "report"), ACTIONS_REPORT))
    assert {r["type"] for r in report.select("type").distinct().collect()} == {"open"}
    assert report.groupBy().sum("total_count").first()[0] == 538


@pytest.mark.parametrize("job", ["actions", "logs"])
def test_missing_options(job, capsys):
    options = cli.parser()
    with pytest.raises(SystemExit):
        cli.check(options, options.parse_args([job, "--kafka", "h:1", "--checkpoint", "c"]))
    assert "needs" in capsys.readouterr().err


@pytest.mark.parametrize(
    ("job", "query"),
    [("actions", "actions_rollup"), ("logs", "logs_rollup"), ("user-agents", "user_agent_rollup")],
)
def test_jobs_without_state(spark, wired, job, query):
    versions = str(wired / "versions")
    options = ["--archive", str(wired / "archive")]
    if job == "actions":
        options = ["--lookup-versions", versions]
        publish_version(fx.isp_table(spark, SMALL), f"{versions}/isp_domains")
        publish_version(fx.list_table(spark, SMALL), f"{versions}/lists")
        publish_blocks(fx.nation_blocks(spark, SMALL), f"{versions}/blocks", fx.nation_blocks6(spark, SMALL))
    if job == "user-agents":
        options = ["--lookup-versions", versions, "--agent-texts", str(wired / "texts")]
        publish_version(fx.isp_table(spark, SMALL), f"{versions}/isp_domains")
    run(spark, wired, job, "--micro-batches", *options)
    table = SnapshotTable(str(wired / "report"), cli.JOBS[job][1], adds=True)
    assert_same(read_snapshot(spark, table), ORACLE_SQL[query], SMALL)


def test_micro_batches_need_a_report_and_versions(capsys):
    options = cli.parser()
    for more in (["--report", "r"], []):
        with pytest.raises(SystemExit):
            cli.check(options, options.parse_args(["actions", "--kafka", "h:1", "--checkpoint", "c", "--micro-batches", *more]))
        assert "needs" in capsys.readouterr().err
