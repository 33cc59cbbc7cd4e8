"""User agents are parsed once over the life of a stream."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_streaming import same
from test_versions import lines

from mailstream.functions.agents import BROWSERS, FIELDS, Rule
from mailstream.operators.lookup import lookup_table
from mailstream.plans.schemas import USER_AGENT_REPORT
from mailstream.plans.user_agents import user_agent_rollup
from mailstream.sources.files import file_lines, file_source
from mailstream.sources.versions import followed_lookup, publish_version
from mailstream.streaming import archive, increments
from mailstream.streaming.agent_texts import AGENT, AgentTexts, fields_of, read_texts
from mailstream.streaming.archive import complete_runs, live_runs
from mailstream.streaming.increments import start_agent_counts
from mailstream.streaming.jobs import await_queries
from mailstream.streaming.sinks import Trigger
from mailstream.streaming.snapshot import SnapshotTable, read_snapshot

NOW = Trigger(available_now=True)
CHROME = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML||| like Gecko) Chrome/{}.0.0.0 Safari/537.36"


class Clicks:
    """Clicks of one provider, counted over a dictionary of texts."""

    def __init__(self, spark, folder, monkeypatch, **options):
        self.spark, self.folder = spark, str(folder)
        self.table = SnapshotTable(f"{folder}/report", USER_AGENT_REPORT, adds=True)
        self.texts = AgentTexts(f"{folder}/texts", **options)
        self.isp = spark.createDataFrame([(5, "five")], "id int, domain_name string")
        publish_version(self.isp, f"{folder}/isp")
        self.parsed = []
        parse = AgentTexts.parse

        def counting(texts, rows):
            self.parsed += [r[0] for r in rows.where(f"{AGENT} is not null").select(AGENT).collect()]
            return parse(texts, rows)

        monkeypatch.setattr(AgentTexts, "parse", counting)

    def clicks(self, *agents):
        line = "x,evt,job1,5,2,2024-01-02 03:04:05,0.0.0.7,,{},,,1,,5"
        lines(self.spark, f"{self.folder}/click", *(line.format(a) for a in agents))

    def run(self):
        self.parsed.clear()
        source = file_source(self.spark, f"{self.folder}/click", 1)
        isp = followed_lookup(f"{self.folder}/isp")
        await_queries(
            start_agent_counts(source, isp, self.texts, self.table, f"{self.folder}/cp", NOW, 3)
        )
        return sorted(self.parsed)

    def check(self):
        batch = user_agent_rollup(
            file_lines(self.spark, f"{self.folder}/click"), lookup_table(self.isp)
        )
        same(read_snapshot(self.spark, self.table), batch)
        held = read_texts(self.spark, self.texts)
        assert held.count() == held.select(AGENT).distinct().count()


@pytest.mark.parametrize("limit", [10**6, 0])
def test_a_text_is_parsed_once_also_after_a_restart(spark, tmp_path, monkeypatch, limit):
    job = Clicks(spark, tmp_path, monkeypatch, broadcast_bytes=limit)
    one, two, three = (CHROME.format(n) for n in (1, 2, 3))
    job.clicks(one, one, "", two, *[one] * 50)
    assert [text for text in job.run() if text] == [one, two]
    job.check()
    job.clicks(two, three, one, "", "no such browser")
    assert job.run() == [three, "no such browser"]
    job.check()
    job.clicks(one, two, three)
    assert job.run() == []
    job.check()


def test_what_the_dictionary_holds_is_what_counts(spark, tmp_path, monkeypatch):
    """A text that is looked up gets the stored fields, not newly parsed ones."""
    texts = AgentTexts(str(tmp_path / "texts"))
    held = [("known", *(f"stored {name}" for name in FIELDS[:-1]), 1)]
    stored = spark.createDataFrame(held, read_texts(spark, texts).schema)
    stored.write.parquet(archive.run_folder(texts.folder, (0, 0)))
    rows = spark.createDataFrame([("known",), ("new",), (None,), ("known",)], f"{AGENT} string")
    found = {r[AGENT]: r["browser_family"] for r in fields_of(rows, texts).table.collect()}
    assert found["known"] == "stored browser_family" and set(found) == {"known", "new"}
    assert complete_runs(spark, texts.folder) == [(0, 0), (1, 1)]
    assert fields_of(rows.limit(0), texts).table.count() == 0


def test_a_failure_after_the_texts_are_stored_doubles_nothing(spark, tmp_path, monkeypatch):
    job = Clicks(spark, tmp_path, monkeypatch)
    publish = increments.publish

    def fail(*args):
        raise RuntimeError("publish failed")

    monkeypatch.setattr(increments, "publish", fail)
    job.clicks(CHROME.format(1), CHROME.format(2), CHROME.format(1))
    with pytest.raises(StreamingQueryException, match="publish failed"):
        job.run()
    assert len(job.parsed) == 2
    monkeypatch.setattr(increments, "publish", publish)
    assert job.run() == []
    job.check()


def test_runs_stay_few_and_other_rules_begin_anew(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archive, "FANOUT", 3)
    texts = AgentTexts(str(tmp_path / "texts"))
    for n in range(10):
        rows = spark.range(n, n + 3).select(F.concat(F.lit("Chrome/"), "id").alias(AGENT))
        assert fields_of(rows, texts).table.count() == 3
        assert len(live_runs(complete_runs(spark, texts.folder))) <= 5
    held = read_texts(spark, texts)
    assert held.count() == held.select(AGENT).distinct().count() == 12
    other = AgentTexts(texts.path, (Rule("Chrome", "Mine"), *BROWSERS))
    assert other.folder != texts.folder and read_texts(spark, other).count() == 0
    families = {r["browser_family"] for r in fields_of(rows, other).table.collect()}
    assert families == {"Mine"}
