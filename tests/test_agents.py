"""User-agent rules on texts with known answers."""

import re

import pytest
from pyspark.sql import functions as F

from mailstream.catalog.agent_cases import AGENT_CASES, MISSING_AGENT
from mailstream.functions.agents import (
    BROWSERS,
    FIELDS,
    SYSTEMS,
    Rule,
    rules_from_json,
    touch_flag,
    unescape_commas,
)
from mailstream.operators.agents import parse_user_agent, struct_expand

CASES = dict((*AGENT_CASES, (None, MISSING_AGENT)))


@pytest.fixture(scope="module")
def parsed(spark):
    texts = [*CASES]
    rows = spark.createDataFrame([(t,) for t in texts], "http_user_agent string")
    found = struct_expand(parse_user_agent(rows)).collect()
    return {r["http_user_agent"]: tuple(r[name] for name in FIELDS) for r in found}


@pytest.mark.parametrize("text", [*CASES])
def test_known_texts(parsed, text):
    assert parsed[text] == CASES[text]


def test_touch_flag(spark):
    rows = spark.createDataFrame([(True,), (False,), (None,)], "t boolean")
    assert [r[0] for r in rows.select(touch_flag(F.col("t"))).collect()] == [1, 0, 2]


def test_commas_come_back(spark):
    rows = spark.createDataFrame([("a|||b||c",), (None,)], "t string")
    assert [r[0] for r in rows.select(unescape_commas("t")).collect()] == ["a,b||c", None]


def test_rules_can_be_extended(spark):
    rows = spark.createDataFrame([("MailReader/3.2 (BeOS)",)], "http_user_agent string")
    browsers = (Rule("MailReader", "Mail Reader", "MailReader/", kind="pc"), *BROWSERS)
    systems = (Rule("BeOS", "BeOS", kind="pc"), *SYSTEMS)
    row = parse_user_agent(rows, browsers=browsers, systems=systems).first()["user_agent"]
    assert row.browser_family == "Mail Reader" and row.browser_version == "3.2"
    assert row.os_family == "BeOS" and row.device_type == "pc"


def test_generated_code_is_small_enough_to_be_compiled(spark):
    """The virtual machine leaves methods of 8,000 bytes or more to its interpreter."""
    rows = spark.range(10).select(F.col("id").cast("string").alias("http_user_agent"))
    frame = struct_expand(parse_user_agent(rows))
    debug = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$")
    code = debug.__getattr__("MODULE$").codegenString(frame._jdf.queryExecution().executedPlan())
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_every_rule_word_is_met_once():
    texts = [text or "" for text in CASES]
    for rule in (*BROWSERS, *SYSTEMS):
        assert any(rule.word in text for text in texts), rule.word


def test_no_text_is_without_a_family(spark):
    words = sorted({w for r in (*BROWSERS, *SYSTEMS) for w in (r.word, r.variant) if w})
    texts = [" ".join(w for k, w in enumerate(words) if (n * 7919 + k * k) % 5 == 0) for n in range(60)]
    texts += [*words, "", " ", "\n", ";;;"]
    rows = spark.createDataFrame([(t,) for t in texts], "http_user_agent string")
    parsed = struct_expand(parse_user_agent(rows))
    assert parsed.where("browser_family is null or os_family is null or device_family is null").count() == 0


def test_rules_from_a_file(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(
        '{"browsers": [{"word": "MailReader", "family": "Mail Reader", "anchor": "MailReader/",'
        ' "device": {"family": "Kiosk", "brand": "Acme", "model": "K1"}}]}'
    )
    browsers, systems = rules_from_json(str(path))
    rows = spark.createDataFrame([("MailReader/3.2 (X11; Linux)",)], "http_user_agent string")
    row = parse_user_agent(rows, browsers=browsers, systems=systems).first()["user_agent"]
    assert (row.browser_family, row.browser_version, row.device_family) == ("Mail Reader", "3.2", "Kiosk")
    assert systems == SYSTEMS


def test_a_rule_of_a_file_beats_a_built_in_one(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text('{"browsers": [{"word": "Chrome", "family": "MyBrowser", "anchor": "Chrome/", "kind": "pc"}]}')
    browsers, systems = rules_from_json(str(path))
    text = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.1.2 Safari/537.36"
    rows = spark.createDataFrame([(text,)], "http_user_agent string")
    found = struct_expand(parse_user_agent(rows, browsers=browsers, systems=systems)).first()
    assert found["browser_family"] == "MyBrowser"
