"""Edge rows of the two line formats."""

import datetime

import pytest
from pyspark.sql import functions as F

from mailstream.functions.lines import split_line, to_day
from mailstream.operators.decode import (
    LOG_COLUMNS,
    action_fields,
    decode_actions,
    decode_bounces,
    decode_deliveries,
    log_fields,
)

AGENT = "Mozilla/5.0 (X11; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/115.0"


def lines(spark, *texts):
    return spark.createDataFrame([(bytearray(t, "utf-8"),) for t in texts], "value binary")


def action(rcpt="7", date="2024-01-02 03:04:05", ip="1.2.3.4", isp="1"):
    return f"a,b,job1,{rcpt},3,{date},{ip},,{AGENT},,,5,,{isp}"


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_action_line(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        row = action_fields(lines(spark, action())).first()
        assert row.asDict() == {
            "job_id": "job1",
            "rcpt_id": "7",
            "vmta_id": "3",
            "date": datetime.date(2024, 1, 2),
            "request_ip": "1.2.3.4",
            "http_user_agent": AGENT,
            "list_id": "5",
            "isp_id": "1",
        }
        short = action_fields(lines(spark, "", "a,b,job1", action(date="baddate"))).collect()
        assert [r["job_id"] for r in short] == [None, "job1", "job1"]
        assert all(r["date"] is None for r in short)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_trailing_empty_fields_are_kept(spark):
    sizes = lines(spark, "a,,", ",", "").select(F.size(split_line("value")).alias("n"))
    assert [r["n"] for r in sizes.collect()] == [3, 2, 1]


def test_time_of_day_is_dropped(spark):
    texts = [("2024-02-29 23:59:59",), ("2024-02-29",), ("2024-02-30",), ("",), (None,)]
    days = spark.createDataFrame(texts, "t string").select(to_day(F.col("t")).alias("d"))
    leap = datetime.date(2024, 2, 29)
    assert [r["d"] for r in days.collect()] == [leap, leap, None, None, None]


def test_unknown_recipients_are_dropped(spark):
    kept = decode_actions(
        lines(spark, action(rcpt="0"), action(rcpt="00"), action(rcpt=""), "a,b,job1"), "click"
    ).collect()
    assert len(kept) == 2
    assert {r["type"] for r in kept} == {"click"}


def bounce(rcpt="u@d.example", job="j-s-0-n-u", vmta="d.example-10.0.0.1", tail=",bad-mailbox"):
    return f"mta1,2024-01-02 00:00:00,,{rcpt},{job},{vmta}{tail}"


def test_compound_fields(spark):
    row = log_fields(lines(spark, bounce(job="j-s-1-n-u-more"))).first()
    assert (row.job_id, row.sub_id, row.is_seed, row.num, row.user) == ("j", "s", "1", "n", "u")
    assert (row.domain, row.ip, row.email_domain) == ("d.example", "10.0.0.1", "d.example")
    odd = log_fields(lines(spark, bounce(rcpt="a@b@c", job="j", vmta="my-dom-1.1.1.1"))).first()
    assert (odd.email_domain, odd.sub_id, odd.domain, odd.ip) == ("b", None, "my", "dom")
    assert log_fields(lines(spark, bounce(rcpt="noat"))).first().email_domain is None


def test_bounce_classes(spark):
    tails = {
        ",bad-mailbox": "hard",
        ",inactive-mailbox": "hard",
        ",policy-related": "soft",
        ",quota-issues": "soft",
        ",spam-related": "other",
        ",": "other",
        "": "other",
    }
    rows = decode_bounces(lines(spark, *(bounce(tail=tail) for tail in tails))).collect()
    assert [r["bounce_type"] for r in rows] == list(tails.values())
    assert {r["type"] for r in rows} == {"bounce"}


def test_seeds_are_dropped(spark):
    flags = {"0": 1, "00": 1, " 0 ": 1, "1": 0, "x": 0, "": 0}
    texts = (bounce(job=f"j-s-{flag}-{flag.strip() or 'e'}-u") for flag in flags)
    assert decode_deliveries(lines(spark, *texts)).count() == sum(flags.values())


def test_deliveries_have_a_typed_null(spark):
    rows = decode_deliveries(lines(spark, bounce(tail="")))
    assert tuple(rows.columns) == LOG_COLUMNS
    assert dict(rows.dtypes)["bounce_type"] == "string"
    assert rows.first()["bounce_type"] is None
