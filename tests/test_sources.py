"""Options the sources and the database sink pass on; no server is contacted."""

from types import SimpleNamespace

import pytest

from mailstream.sources.jdbc import JdbcTarget, jdbc_dim_source, mysql_url
from mailstream.sources.kafka import ACTION_TOPICS, LOG_TOPICS, kafka_source
from mailstream.streaming.jdbc_upsert import merge_statements, run_statements, upsert_jdbc


class Recorder:
    """Stands for a reader or a writer: keeps what it is told, returns itself."""

    def __init__(self):
        self.kind, self.given, self.done = None, {}, []

    def format(self, kind):
        self.kind = kind
        return self

    def option(self, name, value):
        self.given[name] = value
        return self

    def options(self, **values):
        self.given.update(values)
        return self

    def mode(self, mode):
        self.given["mode"] = mode
        return self

    def load(self):
        return SimpleNamespace(select=lambda *names: names)

    def save(self):
        self.done.append("save")


TARGET = JdbcTarget(mysql_url("db", 3306, "joins"), "me", "secret")


def test_topics():
    assert ACTION_TOPICS == {
        "open": "open_actions",
        "click": "click_actions",
        "unsub": "unsub_actions",
    }
    assert LOG_TOPICS == {"bounce": "pmta-bounce", "delivered": "pmta-delivered"}


def test_kafka_options():
    reader = Recorder()
    session = SimpleNamespace(readStream=reader)
    assert kafka_source(session, "localhost:9092", "pmta-bounce") == ("value",)
    assert reader.kind == "kafka"
    assert reader.given == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "pmta-bounce",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    kafka_source(session, "h:1", "t", fail_on_data_loss=False, max_offsets_per_trigger=5)
    assert reader.given["failOnDataLoss"] == "false"
    assert reader.given["maxOffsetsPerTrigger"] == "5"


def test_dimension_options():
    reader = Recorder()
    session = SimpleNamespace(read=reader)
    jdbc_dim_source(session, TARGET, "isp_domains")
    assert reader.kind == "jdbc"
    assert reader.given == {
        "driver": "com.mysql.cj.jdbc.Driver",
        "url": "jdbc:mysql://db:3306/joins",
        "dbtable": "isp_domains",
        "user": "me",
        "password": "secret",
    }
    jdbc_dim_source(session, TARGET, "lists", partition_column="id", bounds=(0, 9), partitions=3)
    assert reader.given["partitionColumn"] == "id" and reader.given["numPartitions"] == "3"
    with pytest.raises(ValueError, match="bounds"):
        jdbc_dim_source(session, TARGET, "lists", partition_column="id")


def test_password_is_not_shown():
    assert "secret" not in repr(TARGET)


def test_upsert_stages_and_merges():
    writer, ran = Recorder(), []
    properties = {"sql.streaming.queryId": "0a1b2c3d-4e5f-6071-8293-a4b5c6d7e8f9"}
    spark = SimpleNamespace(sparkContext=SimpleNamespace(getLocalProperty=properties.get))
    batch = SimpleNamespace(
        columns=["job_id", "day", "total_count"],
        dtypes=[("job_id", "string"), ("day", "date"), ("total_count", "bigint")],
        write=writer,
        sparkSession=spark,
    )
    upsert_jdbc(batch, TARGET, "logs_table", 4, lambda *call: ran.append(call))
    assert writer.given["dbtable"] == "logs_table_staging_0a1b2c3d4e5f"
    assert writer.given["createTableColumnTypes"] == "`job_id` VARCHAR(512)"
    assert writer.given["mode"] == "overwrite" and writer.given["truncate"] == "true"
    assert writer.given["numPartitions"] == "4" and writer.done == ["save"]
    (session, target, statements), = ran
    assert (session, target) == (spark, TARGET)
    assert statements == merge_statements(
        "logs_table", "logs_table_staging_0a1b2c3d4e5f", ["job_id", "day"], ["job_id"]
    )


def test_merge_statements():
    update, insert = merge_statements("t", "s", ["a", "b"])
    staged = (
        "(SELECT `a`, `b`, MAX(`total_count`) AS `total_count` FROM `s` GROUP BY `a`, `b`) AS s"
    )
    same = "t.`a` <=> s.`a` AND t.`b` <=> s.`b`"
    assert update == (
        f"UPDATE `t` AS t JOIN {staged} ON {same} SET t.`total_count` = s.`total_count`"
    )
    assert insert == (
        "INSERT INTO `t` (`a`, `b`, `total_count`) SELECT s.`a`, s.`b`, s.`total_count` "
        f"FROM {staged} LEFT JOIN `t` AS t ON {same} WHERE t.`total_count` IS NULL"
    )


def test_texts_are_compared_by_bytes():
    update, insert = merge_statements("t", "s", ["a", "d"], ["a"])
    exact = "`a` COLLATE utf8mb4_bin"
    staged = (
        f"(SELECT {exact} AS `a`, `d`, MAX(`total_count`) AS `total_count` FROM `s` "
        f"GROUP BY {exact}, `d`) AS s"
    )
    assert staged in update and staged in insert
    assert f"t.{exact} <=> s.`a` AND t.`d` <=> s.`d`" in update


@pytest.mark.parametrize("fails", [False, True])
def test_statements_run_in_one_transaction(fails):
    log = []

    def execute(text):
        log.append(text)
        if fails and text == "two":
            raise RuntimeError("deadlock")

    def connection():
        def statement():
            return SimpleNamespace(
                executeUpdate=execute, close=lambda: None
            )

        return SimpleNamespace(
            setAutoCommit=lambda on: log.append(on),
            createStatement=statement,
            commit=lambda: log.append("commit"),
            rollback=lambda: log.append("rollback"),
            close=lambda: log.append("close"),
        )

    driver = SimpleNamespace(connect=lambda url, login: connection())
    made = SimpleNamespace(
        getDeclaredConstructor=lambda: SimpleNamespace(newInstance=lambda: driver)
    )
    loader = SimpleNamespace(loadClass=lambda name: made)
    thread = SimpleNamespace(getContextClassLoader=lambda: loader)
    java = SimpleNamespace(
        lang=SimpleNamespace(Thread=SimpleNamespace(currentThread=lambda: thread)),
        util=SimpleNamespace(Properties=lambda: SimpleNamespace(setProperty=lambda k, v: None)),
    )
    session = SimpleNamespace(_jvm=SimpleNamespace(java=java))
    if fails:
        with pytest.raises(RuntimeError, match="deadlock"):
            run_statements(session, TARGET, ["one", "two"])
    else:
        run_statements(session, TARGET, ["one", "two"])
    assert log == [False, "one", "two", "rollback" if fails else "commit", "close"]
